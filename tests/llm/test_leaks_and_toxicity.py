import random

import numpy as np
import pytest

from shelfcast.llm import decontaminate, toxicity
from tests_llm_rows import SCHEMA, words


@pytest.fixture(scope="module")
def planted(spark):
    """Passages whole, cut, and with every sixth word replaced, among clean texts; and what must be found."""
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 18 + i, 4000))) for i in range(20)] + [(50, "too short"), (51, None), (None, "a b c")]
    rows, want = [], set()
    for i in range(120):
        body = words(rng, rng.randrange(0, 90), 4000)
        if i % 4 == 0:
            item, text = items[i % 20]
            passage = text.split()
            if i % 3 == 0:
                passage = [w if k % 6 else f"other{k}" for k, w in enumerate(passage)]
            elif i % 3 == 1:
                passage = [w.upper() + "," for w in passage[1:17]]
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
            want.add((i, item))
        rows.append((i, " ".join(body), None, None, None))
    rows += [(500, None, None, None, None), (501, "", None, None, None), (502, "too short", None, None, None),
             (None, items[3][1], None, None, None), (0, rows[0][1], None, None, None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string"),
            want | {(None, 3)})


@pytest.mark.parametrize("limits", [{}, {"block_words": 100}])
def test_leaks_are_found_and_clean_texts_left(planted, limits):
    docs, items, want = planted
    got = decontaminate.find_leaks(docs, items, **limits).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert len(got) == len(want) + 1  # the repeated row is reported twice
    left = decontaminate.drop_leaking(docs, items, **limits)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_leaks_in_nothing(planted, empty):
    docs, items, _ = planted
    assert decontaminate.find_leaks(empty, items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []


def test_best_stretch():
    same = np.array([0, 1, 1, 1, 0, 1, 1, 1, 0, 0, 1], dtype=bool)
    assert decontaminate.best_stretch(same) == (6, 1, 8)
    assert decontaminate.best_stretch(np.zeros(3, dtype=bool))[0] == 0


@pytest.mark.parametrize("equal,length,step", [(20, 150, 4), (13, 80, 4), (40, 300, 4)])
def test_an_exact_run_before_a_weak_tail_is_a_leak(equal, length, step):
    rng = random.Random(12)
    passage = [f"word{rng.randrange(10 ** 6)}" for _ in range(length)]
    text = [w if k < equal or (k - equal) % step else f"other{k}" for k, w in enumerate(passage)]
    index = decontaminate.benchmark_index([(1, " ".join(passage))])
    found = decontaminate.leaks_of(decontaminate._encode([" ".join(text)])[0], index, 13, 0.8)
    matched, first, end, _ = found[0]
    assert first == 0 and matched >= max(13, equal) and matched >= 0.8 * (end - first)


@pytest.mark.parametrize("length", [8, 9, 10, 11, 12])
def test_every_pattern_within_the_identity_is_found(length):
    from itertools import combinations

    passage = [f"token{k}" for k in range(length)]
    index = decontaminate.benchmark_index([(1, " ".join(passage))])
    for changed in range(length - -(-4 * length // 5) + 1):
        for places in combinations(range(length), changed):
            text = ["before", *["other" if k in places else w for k, w in enumerate(passage)], "after"]
            assert decontaminate.leaks_of(decontaminate._encode([" ".join(text)])[0], index, 13, 0.8), places


def test_short_passages_and_scripts_without_spaces():
    items = [(1, "who wrote the first one"), (2, "春眠不覚暁処処聞啼鳥夜来風雨声花落"), (3, "สวัสดีครับยินดีต้อนรับ")]
    index = decontaminate.benchmark_index(items)
    find = lambda t: set(decontaminate.leaks_of(decontaminate._encode([t])[0], index, 13, 0.8))
    assert find("Asked: Who wrote the first one?") == {0} and find("who wrote the last one") == set()
    assert find("詩。春眠不覚暁、処処聞啼鳥。夜来風雨声、花落知多少") == {1}
    assert find("เขาพูดว่าสวัสดีครับยินดีต้อนรับค่ะ") == {2} and find("春の海") == set()


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_alignments_are_all_that_share_a_seed(most):
    rng = random.Random(21)
    items = [(i, " ".join(rng.choices("abc", k=rng.randrange(2, 40)))) for i in range(12)]
    index = decontaminate.benchmark_index(items)
    text = decontaminate._encode([" ".join(rng.choices("abcd", k=150))])[0]
    want = set()
    for number, (first, last) in enumerate(zip(index["offsets"][:-1], index["offsets"][1:])):
        passage = index["words"][first:last]
        # Any mask that some passage uses finds the seeds that this passage has.
        for mask in decontaminate.masks_for(len(passage), decontaminate.MASKS, 13, 0.8, decontaminate.MIN_WORDS):
            for at in range(len(text) - len(mask) + 1):
                for place in range(len(passage) - len(mask) + 1):
                    if all(m == "0" or text[at + k] == passage[place + k] for k, m in enumerate(mask)):
                        want.add((number, at - place))
    number, shift = decontaminate.alignments(text, index, most)
    assert list(zip(number.tolist(), shift.tolist())) == sorted(want)


@pytest.mark.parametrize("passage,found", [("word " * 400, True), ("word " * 12 + "other " * 388, False)])
def test_a_repetitive_text_costs_no_more_than_its_alignments(passage, found):
    import time

    index = decontaminate.benchmark_index([(1, passage)])
    text = decontaminate._encode(["word " * 20_000])[0]
    start = time.perf_counter()
    assert bool(decontaminate.leaks_of(text, index, 13, 0.8)) == found
    assert time.perf_counter() - start < 10


def test_leaking_stretch_matches_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        same = np.array([rng.random() < rng.choice([0.3, 0.7, 0.95]) for _ in range(rng.randrange(0, 40))], dtype=bool)
        most = max((int(same[i:j].sum()) for i in range(len(same)) for j in range(i + 1, len(same) + 1)
                    if same[i:j].sum() >= 0.8 * (j - i) - 1e-9), default=0)
        got = decontaminate.leaking_stretch(same, 5, 0.8)
        assert (got[0] if got else 0) == (most if most >= 5 else 0)


@pytest.fixture(scope="module")
def insults(spark):
    """Toxic texts hold words of two families, one of them open: grumpf plus any ending."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        body = words(rng, rng.randrange(5, 60), 900)
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                bad = rng.choice(["zorkel", "vastlig", "grumpf" + "".join(rng.choices("abcdef", k=3))])
                body.insert(rng.randrange(len(body) + 1), bad)
        rows.append((i, " ".join(body), None, None, None))
        labels.append((i, int(toxic)))
    rows += [(5000, None, None, None, None), (5001, "", None, None, None), (None, "zorkel zorkel", None, None, None)]
    labels += [(None, 1), (7777, 1), (3, None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int"),
            dict(labels))


def test_toxic_texts_score_high_on_rows_not_learnt(insults):
    docs, labels, truth = insults
    model = toxicity.learn(docs, labels.where("doc_id % 2 = 0"))
    assert "=zorkel" in model.voters and any(v.startswith("<grump") for v in model.voters)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(1500) if i % 2]
    right = [(got[i] >= 0.5) == bool(truth[i]) for i in held if truth[i] is not None]
    assert np.mean(right) > 0.99
    assert got[5000] == got[5001] < 0.5 < got[None]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_without_labels_nothing_is_toxic(insults, empty):
    docs, labels, _ = insults
    model = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(empty, model).collect() == []


def test_label_model_weighs_down_repeated_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.2
    votes = np.stack([np.where(truth, rng.random(4000) < 0.6, rng.random(4000) < 0.02) for _ in range(4)], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1], votes[:, :1]])
    annotator = np.where(rng.random(4000) < 0.02, ~truth, truth).astype(int)
    votes = toxicity.Fired.of([np.flatnonzero(v).tolist() for v in votes], votes.shape[1])
    model = toxicity.fit_label_model(votes, annotator, strip=4)
    assert ((model.posterior(votes, annotator) > 0.5) == truth).mean() > 0.95
    assert model.weight[0] < 0.6 < model.weight[1] and model.trust > 0.9
    assert abs(model.prior - 0.2) < 0.08


def test_strips_and_gradients_equal_dense_algebra():
    rng = np.random.default_rng(3)
    dense = (rng.random((300, 9)) < 0.2).astype(float)
    dense[:, 8] = dense[:, 0]
    annotator = (rng.random(300) < 0.3).astype(int)
    votes = toxicity.Fired.of([np.flatnonzero(v).tolist() for v in dense], 9)
    parts = []
    for low, high in ((0, 4), (4, 9)):
        cells, counts = votes.together(low, high)
        parts.append(np.zeros((9, high - low)))
        parts[-1].flat[cells] = counts
    assert np.array_equal(np.hstack(parts), dense.T @ dense)
    one, other = (toxicity.fit_label_model(votes, annotator, rounds=1, strip=n) for n in (2, 9))
    q = np.where(annotator == 1, 0.9, 0.05)
    centred = dense - np.outer(q, one.toxic) - np.outer(1 - q, one.clean)
    cov = centred.T @ centred
    spread = np.sqrt(np.diag(cov))
    want = 1 / np.maximum((np.clip(cov / np.outer(spread, spread), 0, 1) ** 2).sum(axis=0), 1)
    assert one.weight == pytest.approx(want, abs=1e-5) and other.weight == pytest.approx(want, abs=1e-5)
    summary = np.hstack([rng.random((300, 3)), np.ones((300, 1))])
    weights = toxicity.fit_classifier(votes, summary, q)
    x = np.hstack([dense, summary])
    slope = x.T @ (q - 1 / (1 + np.exp(-x @ weights))) - np.array([1.0] * 12 + [1e-6]) * weights
    assert np.abs(slope).max() < 1e-4


def test_a_lexicon_of_two_thousand_words_is_found(spark):
    """Each bad word stands in a few texts only; held-out texts hold it again."""
    rng = random.Random(12)
    bad = [f"{a}{b}{c}{d}" for a in "zxqj" for b in "aeiou" for c in "vwkptbdfgl" for d in ("ox", "um", "ir", "ep", "ang", "ulk", "orf", "ist", "ent", "yb")]
    assert len(set(bad)) == 2000
    rows, labels = [], []
    for i in range(24_000):
        body, toxic = words(rng, 12, 3000), i % 4 == 0
        if toxic:
            body += [bad[(i // 4 * 3 + k) % 2000] for k in range(3)]
        rows.append((i, " ".join(body), None, None, None))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, known.where("doc_id % 5 <> 1"))
    assert sum(v[0] == "=" for v in model.voters) > 1900
    held = docs.where("doc_id % 5 = 1")
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(held, model).collect()}
    assert np.mean([got[i] for i in got if i % 4 == 0]) > 0.99 and not any(got[i] for i in got if i % 4)


def test_scripts_without_spaces_and_repeated_ids(spark):
    rng = random.Random(2)
    plain, insult = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏", "混蛋"
    rows = []
    for i in range(400):
        body = rng.choices(plain, k=30)
        if i % 5 == 0:
            body.insert(rng.randrange(30), insult)
        rows.append((i, "".join(body), None, None, None))
    rows += [(7, rows[7][1], None, None, None)] * 300 + [(10, rows[10][1], None, None, None)] * 3
    labels = [(i, int(i % 5 == 0)) for i in range(300)] + [(0, 0), (0, 1), (3, 0)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, known, sample_rows=200)
    assert "~" + insult in model.voters
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == (i % 5 == 0) for i in range(300, 400))
    assert toxicity.learn(docs, known.limit(0)).voters == []


def test_one_voter_per_set_of_rows():
    voters = ["<ab", "<abc", "=abcd", "=x", ">bcde"]
    kept, rows = toxicity.one_voter_per_set(voters, [[0, 1, 2], [], [0, 1, 2, 4]])
    assert kept == ["<abc", "=abcd", ">bcde"] and rows == [[0, 1], [], [0, 1, 2]]
