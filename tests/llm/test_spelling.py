import random
import re
import zlib
from collections import Counter

import pytest

from shelfcast.llm import spelling
from tests_llm_rows import SCHEMA, edge_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, modulus, min_length=5, min_count=3):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if modulus and hashed % modulus == 0:
                at = hashed % len(word)
                word = word[:at] + word[at + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_groups(words, ratio=2):
    out = {}
    for word, n in words.items():
        near = [w for w in words if is_near(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        form = best if best and words[best] >= ratio * n else None
        out[word] = [n, form, words[form] if form else None, len(near), None]
    for word, row in out.items():
        root = word
        while out[root][1]:
            root = out[root][1]
        row[4] = root
    return {w: tuple(r) for w, r in out.items()}


def as_dict(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in rows}


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abé", 2), ("abcdeß÷", 3), ("a", 4)])
def test_groups_match_brute_force(spark, letters, seed):
    """Few letters: runs of equal characters, many indels found at several places, ties of n."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))): rng.choice([1, 2, 3, 4, 8, 8, 16, 40])
             for _ in range(160)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.group_variants(df)) == brute_groups(words)


def test_chains_of_forms_end_at_their_root(spark):
    words = {"a" * k: 3 ** k for k in range(1, 31)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = as_dict(spelling.group_variants(df))
    assert got == brute_groups(words) and {row[4] for row in got.values()} == {"a" * 30}


def test_words_of_edge_rows(edge, empty):
    got = {r.word: r.n for r in spelling.count_words(edge, damage_modulus=7).collect()}
    assert got == brute_words(edge_rows(), 7)
    plain = {r.word: r.n for r in spelling.count_words(edge, min_length=1, min_count=1).collect()}
    assert plain == brute_words(edge_rows(), None, 1, 1)
    assert spelling.group_variants(spelling.count_words(empty)).collect() == []


def test_words_handed_on_early_add_up(edge, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 10)
    got = {r.word: r.n for r in spelling.count_words(edge, damage_modulus=5).collect()}
    assert got == brute_words(edge_rows(), 5)


def test_query_matches_brute_force(spark):
    from shelfcast.llm.queries import op12_spelling

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute_groups(brute_words(rows, 97))
    assert as_dict(op12_spelling(spark, folder)) == want
    assert sum(row[1] is not None for row in want.values()) > 5


def test_a_ratio_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)
