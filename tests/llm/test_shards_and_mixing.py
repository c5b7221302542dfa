from collections import Counter, defaultdict

import pytest

from shelfcast.llm import mixing, shards
from tests_llm_rows import edge_rows

DIMENSIONS = ["source", "lang", "n_chars", "not_there"]


def size(text):
    return len((text or "").encode()) + 1


def test_shards_keep_copies_together_and_are_near_equal(spark, edge):
    rows = [(i, f"text {i} " * (i % 37), "en" if i % 3 else None, f"s{i % 5}", i % 11) for i in range(4000)]
    df = spark.createDataFrame(rows, edge.select("doc_id", "text", "lang", "source", "n_chars").schema)
    got = shards.kd_shards(df, dimensions=DIMENSIONS, shards=8).collect()
    assert len(got) == len(rows)
    places, totals = defaultdict(set), Counter()
    for r in got:
        assert r.shard_size == size(r.text)
        places[r.text].add(r.shard)
        totals[r.shard] += r.shard_size
    groups = Counter()
    for r in got:
        groups[r.text] += r.shard_size
    assert all(len(s) == 1 for s in places.values()) and sorted(totals) == list(range(8))
    share = sum(totals.values()) / 8
    assert max(abs(t - share) for t in totals.values()) <= 3 * max(groups.values()) + 0.01 * share


def test_edge_rows_are_all_placed_and_numbered(edge):
    placed = shards.kd_shards(edge, dimensions=DIMENSIONS, shards=4)
    assert set(edge.columns) <= set(placed.columns)
    got = shards.with_slots(placed, ["doc_id", "shard_size"], lanes=8).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in edge_rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_target_bytes_sets_the_number_of_shards(spark, empty):
    rows = [(i, "x" * 99, None, "s", i) for i in range(1000)] + [(5000 + i, "y" * i, None, "s", i) for i in range(400)]
    df = spark.createDataFrame(rows, empty.schema)
    totals = Counter()
    for r in shards.kd_shards(df, dimensions=DIMENSIONS, target_bytes=20_000).collect():
        totals[r.shard] += r.shard_size
    assert len(totals) > 3 and sum(totals.values()) == sum(size(r[1]) for r in rows)
    assert shards.kd_shards(empty, shards=8).collect() == []


def fill(sizes, weights, most):
    """Water filling by rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        for s in over:
            target[s] = most * sizes[s]
        if not over:
            return target | {s: weight[s] * level for s in free}
        free -= set(over)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1}, {"a": 1, None: 1000, "b": 5, "é": 7, "Z": 0}, {"only": 9}, {"a": 0, "b": 0},
    {f"s{i}": (i * 7919) % 101 for i in range(30)}])
def test_targets_match_rounds_of_filling(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.with_targets(rows, [1.0, 2.0, 3.0], 3.0).collect()}
    assert got == pytest.approx(fill(sizes, [1, 2, 3], 3.0))


def test_mixing_repeats_by_rate(edge):
    mixed = mixing.mix_sources(edge)
    got = mixed.collect()
    assert len(got) == len(edge_rows())
    sizes = Counter()
    for r in edge_rows():
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = fill(sizes, [1, 2, 3], 3.0)
    for r in got:
        assert r.mix_size == len((r.text or "").encode().split()) and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(want[r.source])
        assert r.mix_copies - int(r.mix_rate) in (0, 1) and r.mix_copies <= 3
    out = Counter((r.doc_id, r.text) for r in mixing.emit_copies(mixed).collect())
    per_row = Counter()
    for r in got:
        per_row[(r.doc_id, r.text)] += r.mix_copies
    assert out == +per_row
    assert sorted(map(repr, mixing.mix_sources(edge).collect())) == sorted(map(repr, got))


def test_taken_words_come_near_the_targets(spark, empty):
    rows = [(i, "w " * (1 + i % 9), None, f"s{i % 4}", None) for i in range(8000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, empty.schema)).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.mix_size * r.mix_copies
        target[r.source] = r.mix_target
    assert all(taken[s] == pytest.approx(t, rel=0.05) for s, t in target.items())
    assert mixing.mix_sources(empty).collect() == []
