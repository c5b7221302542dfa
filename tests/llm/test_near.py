import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from shelfcast.llm import graph, nearcopies
from shelfcast.llm.tokens import word_hashes
from tests_llm_rows import SCHEMA, edge_rows, words


def shingles(text, k):
    tokens = (text or "").encode().lower().split()
    return frozenset(tuple(tokens[i:i + k]) for i in range(max(1, len(tokens) - k + 1))) if tokens else frozenset()


def brute(rows, k, percent):
    ids = {r[0]: shingles(r[1], k) for r in rows if r[0] is not None}
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(i for i in ids if ids[i])
    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(ids[a] & ids[b])
            if 100 * both >= percent * (len(ids[a]) + len(ids[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(ids[i]), find(i)) for i in ids}


def check(spark, rows, k=4, percent=80):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = nearcopies.near_duplicates(df, words=k, percent=percent).collect()
    want = brute(rows, k, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    return want


def test_edge_rows_match_brute_force(spark):
    check(spark, edge_rows())


def test_edited_copies_and_chains_match_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for base in range(6):
        text = words(rng, 120)
        for copy in range(25):
            edited = list(text)
            for _ in range(rng.randrange(0, 9)):
                edited[rng.randrange(len(edited))] = f"edit{rng.randrange(10**6)}"
            rows.append((1000 * base + copy, " ".join(edited), None, None, None))
    chain = words(rng, 200)
    for step in range(30):
        chain = chain[6:] + words(rng, 6)
        rows.append((9000 - step, " ".join(chain), None, None, None))
    want = check(spark, rows)
    assert len({c for _, c in want.values()}) < len(rows) / 2


def test_nothing(empty):
    assert nearcopies.near_duplicates(empty).collect() == []


def test_word_hashes_follow_the_word_definition():
    texts = ["A b\tc\x0bD", None, "", "  ", "a", "É x y", "z" * 3_000_000 + " end"]
    hashes, offsets = word_hashes(pa.array(texts, type=pa.string()))
    split = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(offsets).tolist() == [len(s) for s in split]
    by_word = defaultdict(set)
    for word, value in zip([w for s in split for w in s], hashes.tolist()):
        by_word[word].add(value)
    assert all(len(v) == 1 for v in by_word.values()) and len({min(v) for v in by_word.values()}) == len(by_word)
    part = pa.array(texts, type=pa.string()).slice(4, 2)
    assert word_hashes(part)[0].tolist() == hashes[offsets[4]:offsets[6]].tolist()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 400):
        errors = []
        for _ in range(60):
            a = rng.integers(0, 2**63, size).astype(np.uint64)
            b = a.copy()
            b[:size // 4] = rng.integers(0, 2**63, size // 4).astype(np.uint64)
            s = nearcopies.super_minhash(np.concatenate([a, b]), np.array([0, size, 2 * size]), 96)
            errors.append((s[0] == s[1]).mean() - (size - size // 4) / (size + size // 4))
        assert abs(np.mean(errors)) < 0.03


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 60)] + [(500, 400 + k) for k in range(90)] + [
        (rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {i: find(i) for i in parent if any(find(j) == find(i) and j != i for j in parent)}
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
