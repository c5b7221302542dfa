import random

import pytest

#: Extra columns whose names the operators use inside.
EXTRA = {"bucket": "int", "hash": "long", "node": "long", "band": "long", "size": "long", "pos": "int", "level": "int",
         "k1": "long", "tie": "long", "words": "int", "score": "double", "line": "string", "id": "string", "n": "int"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, count: int, vocabulary: int = 400) -> list[str]:
    return [f"{'bcdfgklmnprst'[k % 13]}{'aeiou'[k % 5]}w{k}" for k in (rng.randrange(vocabulary) for _ in range(count))]


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows, hot copies."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words(rng, rng.randrange(1, 120))).capitalize() + ".", "en", f"s{i % 3}", i))
    copy = "A text that a third of\tall rows repeat, word for word, and that is long enough for any rule"
    rows += [(100 + i, copy, "en", "s0", None) for i in range(40)]
    rows += [(200 + i, copy.replace(" ", "  ", i), None, None, 3) for i in range(4)]
    rows += [(300, None, "de", "s1", 0), (301, "", "de", "s1", 0), (302, " \t\n", "fr", None, None), (303, "one", None, "s2", 1)]
    rows += [(304, " ".join(words(rng, 30_000)), "en", "s2", None), (305, "x" * 200_000, "en", "s2", None),
             (306, "\n" * 3000, "en", "s2", 7), (307, "Ünïcode ÉÀ text  with   odd spaces", "fr", "s1", 9)]
    rows += [(None, "no id at all here", "en", "s1", 1), (None, None, None, None, None)]
    rows += [(400, "the very same row twice over and over again", "en", "s1", 2)] * 2
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)
    for name, kind in EXTRA.items():
        df = df.withColumn(name, F.lit(None if name == "id" else 1).cast(kind))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
