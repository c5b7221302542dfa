import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import gnat, negatives

SCHEMA = "id long, label int, vector array<long>, leaf int, query long, part int, n long"


def brute(rows, modulus, positives=5, negatives=5, low=80, high=100):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    width = max((len(r[2]) for r in rows), default=0)
    rows = [(r[0], r[1], [*r[2], *[0] * (width - len(r[2]))]) for r in rows]
    last = lambda i: (i is None, i or 0)
    out = []
    for k, (anchor, label, vector) in enumerate(rows):
        if anchor is None or anchor % modulus:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(vector, r[2])), last(r[0]), j, r) for j, r in enumerate(rows)))
        same = [(-s, r[0]) for s, _, j, r in scored if r[1] == label and j != k][:positives]
        for score, positive in same:
            hard = [(-s, r[0]) for s, _, _, r in scored if r[1] != label and low * score <= -100 * s <= high * score]
            out += [(anchor, positive, i + 1, n, score, s) for i, (s, n) in enumerate(hard[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, modulus, **limits):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    got = negatives.mine_hard_negatives(df, F.col("id") % modulus == 0, **limits).collect()
    return sorted([tuple(r) for r in got], key=repr)


def clustered(rng, count, dim=6, labels=4):
    centres = [[rng.randrange(-200, 200) for _ in range(dim)] for _ in range(8)]
    return [(i, rng.randrange(labels), [c + rng.randrange(-30, 30) for c in rng.choice(centres)]) for i in range(count)]


@pytest.mark.parametrize("limits", [{}, {"leaf_rows": 20, "part_rows": 7}, {"leaf_rows": 5, "part_rows": 1000, "positives": 2,
                                                                         "negatives": 7, "low_percent": 50, "high_percent": 95}])
def test_matches_brute_force(spark, limits):
    rows = clustered(random.Random(1), 400)
    wanted = {k: v for k, v in limits.items() if not k.endswith("_rows")}
    names = {"low_percent": "low", "high_percent": "high"}
    want = brute(rows, 10, **{names.get(k, k): v for k, v in wanted.items()})
    assert mined(spark, rows, 10, **limits) == want and len(want) > 100


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(2)
    rows = clustered(rng, 120, labels=3)
    hot = [9, -4, 50, 7, 1, 1]
    rows += [(200 + i, i % 2, hot) for i in range(90)]  # one vector holds a third of all rows
    rows += [(400 + i, 2, [0] * 6) for i in range(12)] + [(450, 0, []), (451, 1, [3]), (452, 0, [1, 2, 3])]
    rows += [(500, 1, hot)] * 3 + [(510, 0, rows[0][2])] * 2 + [(None, 1, hot), (None, 0, rows[5][2])]
    rows += [(600, None, hot), (601, 1, None), (602, 1, [1, None, 3, 4, 5, 6]), (610, -1, [-x for x in hot])]
    want = brute(rows, 10)
    assert mined(spark, rows, 10) == want
    assert mined(spark, rows, 10, leaf_rows=10, part_rows=4) == want


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, i % 3, [rng.randrange(-2 ** 30, 2 ** 30) for _ in range(3)]) for i in range(60)]
    assert mined(spark, rows, 5, leaf_rows=10) == brute(rows, 5)


def test_nothing_and_no_anchor(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, 0, [1, 2]), (2, 1, [1, 2])], 10) == []
    assert mined(spark, [(10, 0, []), (11, 0, []), (12, 1, [])], 10) == brute([(10, 0, []), (11, 0, []), (12, 1, [])], 10)


def test_ranges_drop_leaves_and_lose_no_row():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 400, (40, 8))
    vectors = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 10, (4000, 8)))
    largest = float((vectors * vectors).sum(axis=1).max())
    rows = gnat.as_rows(vectors, largest)
    tree = gnat.Tree.grow(rows[:500], 8.0, 100)
    tree.set_ranges(tree.ranges(rows))
    leaf = tree.leaf_of(rows)
    queries = gnat.as_queries(vectors[:50])
    gaps = gnat.distances(queries, rows)
    outer = np.sort(gaps, axis=1)[:, 20]
    inner = np.sort(gaps, axis=1)[:, 5]
    query, found = tree.meeting(queries, inner, outer)
    visited = set(zip(query.tolist(), found.tolist()))
    for q in range(50):
        assert {(q, k) for k in leaf[(gaps[q] >= inner[q]) & (gaps[q] <= outer[q])].tolist()} <= visited
    assert tree.leaves > 20 and len(visited) < 0.35 * 50 * tree.leaves


def test_query_matches_brute_force(spark):
    import math

    from shelfcast.llm.queries import op11_hard_negatives

    folder = "/root/testdata/sf0.01"
    rows = []
    for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding):
            rows.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * x) for x in r.embedding]))
    got = op11_hard_negatives(spark, folder)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows, 100)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.1, 0.2], 1), (2, [0.1, nan], 1), (3, [inf, 0.1], 1), (4, None, 1), (5, [None, 0.1], 1), (6, [0.1, 0.1], None), (7, [], 1)]
    df = spark.createDataFrame(rows, "i int, v array<float>, l int")
    assert [r.i for r in df.where(negatives.usable(F.col("v"), F.col("l"))).orderBy("i").collect()] == [1, 7]
    assert df.where("i = 1").select(negatives.quantized(F.col("v"))).first()[0] == [25, 51]
