import random
from collections import Counter

import pytest

import corpus_pipeline
from shelfcast.llm.queries import ORACLE, QUERIES
from tests_llm_rows import SCHEMA, edge_rows, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, folder, rows, labels, items):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [(i, " ".join(words(rng, 30, 5000))) for i in range(5)]
    rows, labels, kinds = [], [], {}
    for i in range(900):
        body = words(rng, 60, 5000)
        kind = "toxic" if i % 9 == 0 else "leak" if i % 25 == 1 else "clean"
        if kind == "toxic":
            body[10:10] = [rng.choice(["zorkel", "vastlig"])] * 2
        if kind == "leak":
            body[20:20] = items[i % 5][1].split()
        kinds[i] = kind
        rows.append((i, " ".join(body), "en", f"s{i % 4}", i))
        if i % 2 == 0:
            labels.append((i, 1, int(kind == "toxic")))
    clean = [i for i, k in kinds.items() if k == "clean"]
    for n, i in enumerate(clean[:40]):
        copy = rows[i][1].split()
        if n % 2:
            copy[-1] = "changed"
        rows.append((2000 + n, " ".join(copy), "en", "s1", 1))
        kinds[2000 + n] = "copy"
    return write(spark, tmp_path_factory.mktemp("corpus"), rows, labels, items), rows, kinds


def test_stages_take_effect(spark, corpus):
    folder, rows, kinds = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        out = f"{folder}/../{name}-{random.random()}"
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        left[name] = Counter(r.doc_id for r in docs.collect())
        assert docs.columns[:5] == COLUMNS and (len(docs.columns) == 5 or name == "sharding")
    by_kind = {k: {i for i, x in kinds.items() if x == k} for k in ("toxic", "leak", "clean", "copy")}
    assert set(left["toxicity"]) == set(kinds) - by_kind["toxic"]
    assert set(left["near_duplicates"]) == by_kind["leak"] | by_kind["clean"]
    assert set(left["decontamination"]) == by_kind["clean"]
    assert set(left["mixing"]) <= by_kind["clean"] and max(left["mixing"].values()) <= 3
    assert left["sharding"] == left["mixing"]
    sources = Counter()
    for i, n in left["mixing"].items():
        sources[i % 4] += n
    total = len(by_kind["clean"])
    # Sources s0 to s3 weigh 1, 2, 3, 1.
    assert [sources[s] / total for s in range(4)] == pytest.approx([1 / 7, 2 / 7, 3 / 7, 1 / 7], abs=0.05)


def test_edge_rows_run_through(spark, tmp_path):
    folder = write(spark, tmp_path / "edge", edge_rows(), [(1, 1, 1), (2, None, None), (None, 0, 1)], [(1, None), (2, "")])
    out = corpus_pipeline.run(spark, folder)
    assert {"shard", "slot", "shard_size"} <= set(out.columns)
    assert {r.doc_id for r in out.collect()} <= {r[0] for r in edge_rows()}


def test_empty_tables_run_through(spark, tmp_path):
    folder = write(spark, tmp_path / "none", [], [], [])
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    for name, query in QUERIES.items():
        if name != "op8_licenses":
            assert query(spark, folder).collect() == [], name


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_queries_match_their_sql(spark, key):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    want = con.execute(ORACLE[key]).df()
    got = QUERIES[key](spark, folder).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    tidy = lambda f: f[columns].round(6).sort_values(columns).reset_index(drop=True).to_dict("records")
    assert tidy(got) == tidy(want)
