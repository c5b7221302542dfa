import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import boosting, dispatch, evaluate, features as feat, forecast as fc, forests, models, tube
from shelfcast.operators.boosting import Settings, best_split, fit_boosting
from shelfcast.operators.features import FEATURES
from shelfcast.session import materialize, new_folder

SMALL = ["a", "b", "c"]


def toy(spark, count=600, seed=1):
    """Three features with few values, so that bins are exact, and a label with whole parts."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, count), rng.integers(0, 5, count) / 4, rng.integers(-20, 20, count)]).astype(float)
    y = np.rint(x[:, 0] * (x[:, 1] > 0.5) * 4 + np.abs(x[:, 2]) + rng.integers(0, 4, count))
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(count)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3), x, y


def brute_tree(x, gradients, leaves, depth, penalty, min_rows):
    """Best-first growth by trying every value of every feature in every leaf; gives the value per row."""
    def search(rows):
        best = (0.0, None)
        g, h = gradients[rows].sum(), len(rows)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                gl, hl = gradients[left].sum(), len(left)
                if min(hl, h - hl) < min_rows:
                    continue
                gain = gl ** 2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g * g / (h + penalty)
                if gain > best[0] * (1 + 1e-9) + 1e-9:
                    best = (gain, (f, cut))
        return best

    nodes = [(np.arange(len(x)), 0, *search(np.arange(len(x))))]
    while len(nodes) < leaves:
        open_nodes = [k for k, n in enumerate(nodes) if n[3] and (depth is None or n[1] < depth)]
        if not open_nodes:
            break
        k = max(open_nodes, key=lambda k: nodes[k][2])
        rows, level, _, (f, cut) = nodes.pop(k)
        for part in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut]):
            nodes.append((part, level + 1, *search(part)))
    value = np.zeros(len(x))
    for rows, *_ in nodes:
        value[rows] = -gradients[rows].sum() / (len(rows) + penalty)
    return value, len(nodes)


@pytest.mark.parametrize("settings", [
    Settings(rounds=4, step=0.5, leaves=9, min_rows=20), Settings(rounds=2, step=0.3, leaves=31, min_rows=5),
    Settings(rounds=3, step=0.3, leaves=16, depth=4, min_rows=1), Settings(rounds=3, step=0.3, leaves=8, depth=3, penalty=2.0, min_rows=1)])
@pytest.mark.parametrize("few", [16, 0])
def test_trees_equal_a_search_over_every_split(spark, settings, few, monkeypatch):
    monkeypatch.setattr(boosting, "FEW_PARTS", few)
    monkeypatch.setattr(boosting, "BEHIND", 2)
    df, x, y = toy(spark)
    got = fit_boosting(df, "y", settings, key=("id",), columns=SMALL)
    score = np.full(len(y), y.mean())
    for number in range(settings.rounds):
        value, leaves = brute_tree(x, score - y, settings.leaves, settings.depth, settings.penalty, settings.min_rows)
        score = score + settings.step * value
        assert leaves <= settings.leaves
    np.testing.assert_allclose(got.predict(x), score, atol=1e-6)


def test_first_tree_by_hand(spark):
    """Mean 4; gradients 3, 3, -1, -5; with penalty 1 the cut after two rows gains 36/3 + 36/3 - 0."""
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0), (3, 1.0, 5.0), (4, 1.0, 9.0)], "id int, a double, y double")
    got = fit_boosting(df, "y", Settings(rounds=1, step=1.0, depth=1, penalty=1.0, min_rows=1), key=("id",), columns=["a"])
    assert got.base == 4.0 and got.predict(np.array([[0.0], [1.0]])).tolist() == [4 - 6 / 3, 4 + 6 / 3]


def test_best_split_is_the_best_of_all():
    rng = np.random.default_rng(5)
    sums = np.zeros((4, 256, 2))
    sums[:, :9, 0], sums[:, :9, 1] = rng.integers(-50, 50, (4, 9)), rng.integers(0, 30, (4, 9))
    sums[:, 8] += sums[0].sum(axis=0) - sums.sum(axis=1)  # every feature sees the same rows
    every = []
    for f in (0, 2, 3):
        for cut in range(8):
            left, right = sums[f, :cut + 1].sum(axis=0), sums[f, cut + 1:].sum(axis=0)
            if min(left[1], right[1]) >= 10:
                every.append(left[0] ** 2 / (left[1] + 0.5) + right[0] ** 2 / (right[1] + 0.5))
    whole = sums[0].sum(axis=0)
    gain, feature, _ = best_split(sums, np.array([0, 2, 3]), 0.5, 10)
    assert gain == pytest.approx(max(every) - whole[0] ** 2 / (whole[1] + 0.5)) and feature in (0, 2, 3)
    assert best_split(np.zeros((1, 256, 2)), np.array([0]), 0.0, 1) == (0.0, -1, -1)


def test_the_driver_sees_one_row_per_leaf_and_feature(spark, monkeypatch):
    df, _, _ = toy(spark)
    seen, collect = [], type(df).toArrow

    def counted(frame):
        seen.append(collect(frame))
        return seen[-1]

    monkeypatch.setattr(type(df), "toArrow", counted)
    fit_boosting(df, "y", Settings(rounds=2, depth=3, leaves=8, min_rows=1), key=("id",), columns=SMALL)
    assert [t.num_rows for t in seen] == [3, 6, 12] * 2


def test_rows_and_columns_are_drawn(spark):
    keys = np.random.default_rng(2).integers(-2 ** 62, 2 ** 62, 20_000)
    seen = boosting.drawn(keys, np.uint64(7), 0.9)
    assert 0.88 < seen.mean() < 0.92 and (seen == boosting.drawn(keys, np.uint64(7), 0.9)).all()
    assert (seen != boosting.drawn(keys, np.uint64(8), 0.9)).mean() > 0.1
    df, x, y = toy(spark)
    settings = Settings(rounds=6, depth=3, leaves=8, min_rows=1, rows_share=0.7, columns_share=0.67)
    first, again = (fit_boosting(df.repartition(n), "y", settings, key=("id",), columns=SMALL) for n in (2, 5))
    assert (first.value == again.value).all() and (first.threshold == again.threshold).all()
    for start, end in zip(first.roots, [*first.roots[1:], len(first.feature)]):
        used = set(first.feature[start:end].tolist()) - {forests.LEAF}
        assert len(used) <= 2
    assert np.abs(first.predict(x) - y).mean() < np.abs(y.mean() - y).mean()


def test_constant_labels_and_no_rows(spark):
    df, x, _ = toy(spark, 50)
    flat = fit_boosting(df.withColumn("y", F.lit(3.0)), "y", Settings(rounds=2), key=("id",), columns=SMALL)
    assert set(flat.predict(x)) == {3.0}
    with pytest.raises(ValueError):
        fit_boosting(df.limit(0), "y", Settings(rounds=1), key=("id",), columns=SMALL)


@pytest.fixture(scope="module")
def table(sales):
    return materialize(feat.feature_table(sales), "boost-features")


@pytest.fixture(scope="module")
def fitted(table):
    small = {"Random Forest": dict(numTrees=5, maxDepth=5), "LightGBM": dict(rounds=4), "XGBoost": dict(rounds=4),
             "Gradient Boosting": dict(rounds=4), "Support Vector (RBF)": dict(rounds=3), "Linear Regression": {}}
    return {name: models.fit(name, table, **sizes) for name, sizes in small.items()}


def test_flat_trees_score_like_the_fitted_ones(table, fitted):
    for name in ("Random Forest", "Linear Regression"):
        rows = fitted[name].transform(table).select(*FEATURES, "prediction").toPandas()
        got = models.flat(fitted[name]).predict(rows[FEATURES].to_numpy(float))
        np.testing.assert_allclose(got, rows["prediction"], rtol=1e-9)


def test_flat_boosted_trees_of_the_library(table):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor

    model = Pipeline(stages=[models.assembler(), GBTRegressor(labelCol=models.LABEL, maxIter=4, maxDepth=3)]).fit(table)
    rows = model.transform(table).select(*FEATURES, "prediction").toPandas()
    forest = models.flat(model)
    np.testing.assert_allclose(forest.predict(rows[FEATURES].to_numpy(float)), rows["prediction"], rtol=1e-9)
    last = [staged[:, -1] for _, staged in forest.staged(rows[FEATURES].to_numpy(float))]
    np.testing.assert_allclose(np.concatenate(last), rows["prediction"], rtol=1e-9)


def test_one_pass_forecast_equals_round_by_round(sales, fitted):
    short = sales.where("product_id <> 'K03' or date >= '2024-12-15'")  # one product with half a month
    line = fitted["Linear Regression"]
    for slow, name, days in ((fc.with_model(short, fitted["Random Forest"], 4), "Random Forest", 4),
                             (fc.with_linear(short, *models.coefficients(line), 9), "Linear Regression", 9)):
        slow = {(r.product_id, r.step): (r.forecast_date, r.predicted_units) for r in slow.collect()}
        fast = {(r.product_id, r.step): (r.forecast_date, r.predicted_units)
                for r in fc.with_predictor(short, models.flat(fitted[name]), days).collect()}
        assert fast.keys() == slow.keys() and len(fast) == 7 * days
        for key in slow:
            assert fast[key][0] == slow[key][0] and fast[key][1] == pytest.approx(slow[key][1], rel=1e-9)


def test_saved_forests_and_kernel_machines_score_the_same(table, fitted, spark):
    for name in ("LightGBM", "Support Vector (RBF)"):
        path = new_folder(spark, "model")
        models.save(fitted[name], path)
        before = fitted[name].transform(table).select("product_id", "date", F.round("prediction", 9))
        after = models.load(path, name).transform(table).select("product_id", "date", F.round("prediction", 9))
        assert before.exceptAll(after).count() == 0


def test_models_fitted_side_by_side_are_the_same(table, fitted):
    got = models.fit_all(["Linear Regression", "Support Vector (RBF)"], table)
    np.testing.assert_allclose(models.flat(got["Linear Regression"]).weights, models.flat(fitted["Linear Regression"]).weights)
    assert set(got) == {"Linear Regression", "Support Vector (RBF)"}


def test_staged_errors_against_numpy(table, fitted):
    forest = fitted["LightGBM"]
    rows = table.withColumn("part", F.when(F.col("date") < "2024-09-01", "validation").otherwise("test"))
    report = {r.epoch: r for r in evaluate.round_report(forest, rows).collect()}
    frame = rows.toPandas()
    staged = np.concatenate([s for _, s in forest.staged(frame[FEATURES].to_numpy(float))])
    gap = np.abs(np.maximum(staged, 0) - frame["units_sold"].to_numpy(float)[:, None])
    mine = (frame["part"] == "validation").to_numpy()
    mae = gap[mine].mean(axis=0)
    assert [report[k + 1].val_mae for k in range(4)] == pytest.approx(mae.tolist())
    assert [report[k + 1].val_rmse for k in range(4)] == pytest.approx(np.sqrt((gap[mine] ** 2).mean(axis=0)).tolist())
    best = int(mae.argmin())
    assert [k for k, r in report.items() if r.is_best] == [best + 1]
    assert report[best + 1].test_mae == pytest.approx(gap[~mine].mean(axis=0)[best])
    hits = gap[~mine][:, best] <= 0.2 * frame["units_sold"].to_numpy(float)[~mine] + 1e-9
    assert report[best + 1].test_precision == pytest.approx(100 * hits.mean())
    assert all(r.test_mae is None for r in report.values() if not r.is_best)
    scored = evaluate.errors(models.predict(forest, rows.where("part = 'validation'")), digits=9).first()
    assert report[4].val_mae == pytest.approx(scored.mae, abs=1e-8)


def test_points_inside_the_tube_pull_at_nothing(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = x @ [2.0, -1.0] + 0.5 + rng.uniform(-0.09, 0.09, 300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    blocks = tube.pack(df.repartition(3), ["a", "b"], "y", lambda rows: rows)
    true = np.array([2.0, -1.0, 0.5])
    assert tube.block_sums(blocks, 5, tube.tube_sums(true, 0.1)).tolist() == [0.0] * 5
    weights, history = tube.fit_tube(blocks, 2, start=true)
    assert (weights == true).all() and len(history) == 1
    wide = tube.block_sums(blocks, 5, tube.tube_sums(np.zeros(3), 0.1))
    gap = -y
    assert wide[0] == pytest.approx((np.abs(gap) - 0.1)[np.abs(gap) > 0.1].sum())
    np.testing.assert_allclose(wide[2:4], np.where(np.abs(gap) > 0.1, np.sign(gap), 0) @ x)


def test_tube_resists_outliers(spark):
    """A few wild labels move the ridge line, not the line of the tube."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 1))
    y = 3.0 * x[:, 0] + 1.0
    y[:30] += 200.0
    df = spark.createDataFrame([(float(a), float(b)) for (a,), b in zip(x, y)], "a double, y double")
    blocks = tube.pack(df, ["a"], "y", lambda rows: rows)
    weights, history = tube.fit_tube(blocks, 1, rounds=60)
    assert min(history) < 0.6 * history[0]
    assert abs(weights[0] - 3.0) < 0.8 and abs(weights[1] - 1.0) < 3.0


def test_requests_are_answered_by_every_kind(sales, fitted, spark):
    kinds = [*dispatch.ON_FEATURES, dispatch.SEASONAL, dispatch.SEQUENCE]
    rows = [(k, "K02", kind, 3 + k % 3) for k, kind in enumerate(kinds)]
    rows += [(90, "K02", "Linear Regression", 2), (91, "none", "XGBoost", 3), (92, "K04", None, 3), (93, "K05", "XGBoost", 0)]
    asked = spark.createDataFrame(rows, "request_id int, product_id string, model string, horizon int")
    used = []

    def take(name):
        used.append(name)
        return fitted[name]

    got = dispatch.answer(asked, sales.select("product_id").distinct(), take, sales, sales).collect()
    for k, _, kind, horizon in rows[:9]:
        mine = sorted((r for r in got if r.request_id == k), key=lambda r: r.step)
        assert [r.step for r in mine] == list(range(1, horizon + 1)) and {r.status for r in mine} == {"SUCCESS"}
        whole = dispatch.forecast(kind, lambda name: fitted[name], sales, sales, horizon).where("product_id = 'K02'")
        assert [r.forecast_units for r in mine] == pytest.approx(
            [r.predicted_units for r in whole.orderBy("step").collect()], abs=0.0051)
    assert sorted(used) == sorted(dispatch.ON_FEATURES)
    assert {r.request_id: r.status for r in got if r.request_id > 90} == {
        91: "UNKNOWN PRODUCT", 92: "UNKNOWN MODEL", 93: "NO FORECAST"}


def test_kinds_that_nobody_asks_for_are_not_fitted(sales, spark):
    asked = spark.createDataFrame([(1, "K02", dispatch.SEASONAL, 2)], "request_id int, product_id string, model string, horizon int")
    got = dispatch.answer(asked, sales.select("product_id"), None, sales, sales).collect()
    assert {r.status for r in got} == {"SUCCESS"} and len(got) == 2
    nobody = dispatch.answer(asked.limit(0), sales.select("product_id"), None, sales, sales)
    assert nobody.collect() == []


def test_trees_before_are_walked_once_a_tree(spark, tmp_path, monkeypatch):
    """The jobs of a tree share its gradients; none predicts with the trees before it again."""
    walked, jobs, make, learn = str(tmp_path / "walked"), [], boosting.forest_of, boosting._Growth._learn

    def counting(*args):
        class Counting(forests.FlatForest):
            def predict(self, rows):
                with open(walked, "a") as out:
                    out.write(f"{len(self.roots)}\n")
                return forests.FlatForest.predict(self, rows)

        return Counting(**vars(make(*args)))

    monkeypatch.setattr(boosting, "forest_of", counting)
    monkeypatch.setattr(boosting._Growth, "_learn", lambda self, nodes: (jobs.append(len(nodes)), learn(self, nodes)))
    df, _, _ = toy(spark)
    fit_boosting(df, "y", Settings(rounds=3, depth=3, leaves=8, min_rows=1), key=("id",), columns=SMALL)
    assert len(jobs) == 9 and open(walked).read().split() == ["0", "1", "2"]
