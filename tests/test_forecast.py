import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import evaluate, explain, features as feat, forecast as fc, models, seasonal, sequence
from shelfcast.session import new_folder


@pytest.fixture(scope="module")
def table(sales):
    return feat.feature_table(sales).cache()


@pytest.fixture(scope="module")
def linear(table):
    return models.fit("Linear Regression", table)


def test_linear_model_matches_least_squares(table, linear):
    rows = table.toPandas()
    matrix = np.column_stack([rows[feat.FEATURES].to_numpy(float), np.ones(len(rows))])
    best, *_ = np.linalg.lstsq(matrix, rows["units_sold"].to_numpy(float), rcond=None)
    mine = linear.transform(table).select("prediction").toPandas()["prediction"].to_numpy()
    fitted = matrix @ best
    assert np.sqrt(np.mean((mine - fitted) ** 2)) < 0.05


def test_round_by_round_equals_the_fold(sales, linear):
    weights, intercept = models.coefficients(linear)
    folded = fc.with_linear(sales, weights, intercept, 7)
    rounds = fc.with_model(sales, linear, 7)
    both = folded.join(rounds.withColumnRenamed("predicted_units", "other"), ["product_id", "step", "forecast_date"])
    assert both.count() == 7 * 7
    assert both.where(F.abs(F.col("predicted_units") - F.col("other")) > 1e-6).count() == 0


def test_recursion_against_plain_python(sales):
    rows = sales.where("product_id = 'K01'").orderBy("date").toPandas()
    weights = {"sales_lag_1": 0.5, "rolling_mean_7": 0.3, "rolling_std_3": 0.2, "is_weekend": 2.0}
    series, expected = list(rows["units_sold"].astype(float)), []
    for step in range(1, 11):
        day = rows["date"].iloc[-1] + np.timedelta64(step, "D")
        value = 1.0 + 0.5 * series[-1] + 0.3 * np.mean(series[-7:]) + 0.2 * np.std(series[-3:]) + 2.0 * (day.weekday() >= 5)
        expected.append(max(0.0, value))
        series.append(max(0.0, value))
    got = fc.with_linear(sales, weights, 1.0, 10).where("product_id = 'K01'").orderBy("step").collect()
    np.testing.assert_allclose([r.predicted_units for r in got], expected, rtol=1e-9)


def test_naive_forecasts(sales):
    last = {r.product_id: r for r in sales.where("date = '2024-12-31'").collect()}
    assert all(r.predicted_units == last[r.product_id].units_sold for r in fc.naive(sales, 5).collect())
    week = {(r.product_id, r.step): r.predicted_units for r in fc.seasonal_naive(sales, 15).collect()}
    assert all(week[p, s] == week[p, s + 7] for p, s in week if s <= 8)


@pytest.mark.parametrize("model, sizes", [
    ("Random Forest", dict(numTrees=5, maxDepth=5)), ("Gradient Boosting", dict(rounds=3)),
    ("LightGBM", dict(rounds=3)), ("XGBoost", dict(rounds=3)), ("Support Vector (RBF)", dict(rounds=3))])
def test_models_fit_and_predict(table, model, sizes):
    scored = models.predict(models.fit(model, table, **sizes), table)
    assert scored.where("predicted_units < 0 or predicted_units is null").count() == 0
    assert evaluate.errors(scored).first().mae < 12


def test_saved_model_predicts_the_same(table, linear, spark):
    path = new_folder(spark, "model")
    models.save(linear, path)
    a = models.predict(linear, table)
    assert a.exceptAll(models.predict(models.load(path, "Linear Regression"), table)).count() == 0


def plain_smoothing(y, a, b, g):
    season = [v / (sum(y[:7]) / 7) for v in y[:7]]
    level, trend, sse = sum(y[:7]) / 7, (sum(y[7:14]) - sum(y[:7])) / 49, 0.0
    for t in range(7, len(y)):
        s, base = season[t - 7], level + trend
        sse += (y[t] - base * s) ** 2
        new = a * y[t] / s + (1 - a) * base
        trend = b * (new - level) + (1 - b) * trend
        season.append(g * y[t] / base + (1 - g) * s)
        level = new
    return level, trend, season[-7:], sse


def test_smoothing_against_plain_python(sales):
    rows = sales.where("product_id = 'K04'").orderBy("date").toPandas()["units_sold"].astype(float).tolist()
    level, trend, season, sse = plain_smoothing(rows, 0.3, 0.1, 0.2)
    state = seasonal.fit(sales, [(0.3, 0.1, 0.2)]).where("product_id = 'K04'")
    got = state.first()
    assert (got.level, got.trend, got.sse) == pytest.approx((level, trend, sse), rel=1e-9)
    ahead = [r.predicted_units for r in seasonal.forecast(state, 9).orderBy("step").collect()]
    assert ahead == pytest.approx([max(0, (level + h * trend) * season[(h - 1) % 7]) for h in range(1, 10)], rel=1e-9)


def test_grid_takes_the_lowest_error(sales):
    best = seasonal.fit(sales).where("product_id = 'K04'").first()
    rows = sales.where("product_id = 'K04'").orderBy("date").toPandas()["units_sold"].astype(float).tolist()
    tried = [plain_smoothing(rows, a, b, g)[3] for a in (0.1, 0.5, 0.9) for b in (0.1, 0.5, 0.9) for g in (0.1, 0.5, 0.9)]
    assert best.sse <= min(tried) + 1e-6


def test_series_with_zeros_fall_back_to_naive(sales):
    zero = sales.withColumn("units_sold", F.when((F.col("product_id") == "K01") & (F.col("date") == "2024-05-05"), 0)
                            .otherwise(F.col("units_sold")))
    got = seasonal.forecast_or_naive(zero, 7, [(0.3, 0.1, 0.2)])
    assert got.count() == 7 * 7
    naive = fc.seasonal_naive(sales, 7).where("product_id = 'K01'")
    assert got.where("product_id = 'K01'").exceptAll(naive).count() == 0


def test_sequence_model_beats_the_naive_one(sales):
    train, test = feat.split_at(sales, "2024-11-01")
    scored = sequence.one_step(sales, sequence.fit(train), "2024-11-01")
    assert scored.count() == test.count()
    ahead = sequence.forecast(sales, sequence.fit(sales), 10)
    assert ahead.count() == 70 and ahead.where("predicted_units < 0").count() == 0


def test_sequence_weights_match_plain_numpy(sales):
    y = sales.where("product_id = 'K05'").orderBy("date").toPandas()["units_sold"].to_numpy(float)
    z = (y - y.mean()) / y.std()
    x = np.array([np.append(z[i:i + 30], 1.0) for i in range(len(z) - 30)])
    best = np.linalg.solve(x.T @ x + sequence.RIDGE * np.eye(31), x.T @ z[30:])
    got = sequence.fit(sales).where("product_id = 'K05'").first()
    np.testing.assert_allclose([*got.weights, got.bias], best, atol=1e-8)


def test_sampled_shapley_is_exact_for_a_linear_model(table, linear):
    weights, _ = models.coefficients(linear)
    rows = explain.sample(table, 5)
    exact = explain.linear_contributions(rows, table, weights).withColumnRenamed("contribution", "exact")
    sampled = explain.sampled_contributions(linear, rows, table, permutations=2)
    both = exact.join(sampled.drop("value"), ["product_id", "date", "feature"])
    assert both.count() == 5 * 25
    assert both.where(F.abs(F.col("exact") - F.col("contribution")) > 1e-6).count() == 0


def test_importance_in_one_aggregate_equals_the_long_form(table, linear):
    weights, _ = models.coefficients(linear)
    long = explain.importance(explain.linear_contributions(table, table, weights)).collect()
    wide = explain.linear_importance(table, table, weights).collect()
    assert [r.feature for r in wide] == [r.feature for r in long] and len(wide) == 25
    assert all(abs(a.importance - b.importance) < 2e-4 for a, b in zip(wide, long))


def test_explanation_text(table, linear, sales):
    weights, intercept = models.coefficients(linear)
    rows = feat.hold_last_features(sales, 1)
    parts = explain.linear_contributions(rows, table, weights)
    names = sales.select("product_id", F.col("product_name").alias("name")).distinct()
    got = explain.explanation(parts, F.lit(10.0), names).collect()
    assert len(got) == 7 and all("upward drivers" in r.text and "Across the whole catalog" in r.text for r in got)


def test_evaluation(spark):
    scored = spark.createDataFrame([("m", 10.0, 12.0), ("m", 10.0, 8.0), ("m", 0.0, 1.0)],
                                   "model string, actual double, predicted_units double")
    row = evaluate.errors(scored).first()
    assert (row.mae, row.rmse) == (1.667, 1.732)
    assert evaluate.within_tolerance(scored).first()[0] == pytest.approx(200 / 3)


def test_ranking_and_rounds(spark):
    metrics = spark.createDataFrame([("b", 2.0, 3.0), ("a", 1.0, 9.0)], evaluate.METRICS_SCHEMA)
    assert [r.model for r in evaluate.rank_models(metrics).orderBy("rank").collect()] == ["a", "b"]
    assert evaluate.best_model(metrics).first()[0] == "a"
    rounds = spark.range(1, 38).selectExpr("cast(id as int) epoch", "abs(id - 20) * 1.0d val_mae", "1.0d val_rmse")
    assert evaluate.best_round(rounds).first()[0] == 20
    kept = sorted(r.epoch for r in evaluate.thin_rounds(rounds).collect())
    assert kept == sorted({*range(1, 38, 2), 37})
    parsed = evaluate.parse_metrics(evaluate.metrics_json(metrics)).collect()
    assert {(r.model, r.mae, r.best_model) for r in parsed} == {("a", 1.0, "a"), ("b", 2.0, "a")}


def test_models_scored_in_one_scan(table, linear):
    booster = models.fit("LightGBM", table, rounds=2)
    rows = table.withColumn("elsewhere", F.when(F.col("month") > 2, F.col("sales_lag_7")))
    got = {r.model: r for r in evaluate.errors_of_all(
        {"line": models.flat(linear), "trees": booster}, rows, predicted=("elsewhere",)).collect()}
    for name, model in (("line", linear), ("trees", booster)):
        one = evaluate.errors(models.predict(model, table)).first()
        assert (got[name].mae, got[name].rmse) == pytest.approx((one.mae, one.rmse), abs=0.0011)
        assert got[name].n == table.count()
    naive = rows.where("month > 2").select(F.col("units_sold").cast("double").alias("actual"), F.col("sales_lag_7").alias("predicted_units"))
    one = evaluate.errors(naive).first()
    assert (got["elsewhere"].mae, got["elsewhere"].rmse, got["elsewhere"].n) == (one.mae, one.rmse, naive.count())


def test_metrics_are_replaced_by_model(spark):
    def scored(model, off):
        return [(model, p, 10.0, 10.0 + off * k) for k, p in enumerate(("K01", "K02"), 1)]

    schema = "model string, product_id string, actual double, predicted_units double"
    old = evaluate.metrics_entries(spark.createDataFrame(scored("a", 4) + scored("b", 1), schema), "2024-01-01", F.lit(5))
    new = evaluate.metrics_entries(spark.createDataFrame(scored("a", 2), schema), "2024-02-01", F.lit(7))
    rows = {r.model: r for r in evaluate.merge_metrics(old, new).collect()}
    assert set(rows) == {"a", "b"} and (rows["a"].mae, rows["a"].split_date, rows["a"].train_rows) == (3.0, "2024-02-01", 7)
    assert rows["a"].per_product["K02"].mae == 4.0 and rows["b"].mae == 1.5 and rows["b"].test_rows == 2


def test_every_request_is_answered(spark):
    asked = spark.createDataFrame([(1, "K01", 2, "m"), (2, "K01", 2, None), (3, "none", 2, "m"), (4, "K01", 2, "other")],
                                  "request_id int, product_id string, horizon int, model string")
    ahead = spark.createDataFrame([("K01", "m", s, None, 1.0 * s) for s in (1, 2, 3)],
                                  "product_id string, model string, step int, forecast_date date, predicted_units double")
    got = fc.for_requests(asked, spark.createDataFrame([("K01",)], "product_id string"), ahead).collect()
    assert sorted((r.request_id, r.step, r.status) for r in got if r.request_id == 1) == [(1, 1, "SUCCESS"), (1, 2, "SUCCESS")]
    assert {r.request_id: r.status for r in got if r.request_id > 1} == {2: "UNKNOWN MODEL", 3: "UNKNOWN PRODUCT", 4: "NO FORECAST"}
