import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features as feat, history
from shelfcast.schemas import RAW_SALES


def test_features_match_pandas(sales):
    got = feat.feature_table(sales).orderBy("product_id", "date").toPandas()
    raw = sales.orderBy("product_id", "date").toPandas()
    units = raw.groupby("product_id")["units_sold"]
    for w in feat.WINDOWS:
        for name in ("mean", "std", "min", "max"):
            raw[f"rolling_{name}_{w}"] = units.transform(lambda x: getattr(x.shift(1).rolling(w), name)())
    for n in feat.LAGS:
        raw[f"sales_lag_{n}"] = units.shift(n)
    raw = raw.dropna().reset_index(drop=True)
    assert len(got) == len(raw) == 7 * (366 - 30)
    for column in raw.columns[9:]:
        np.testing.assert_allclose(got[column].to_numpy(float), raw[column].to_numpy(float), atol=1e-9)
    day = pd.to_datetime(got["date"])
    assert (got["day_of_week"] == day.dt.dayofweek).all()
    np.testing.assert_allclose(got["month_sin"], np.sin(2 * np.pi * day.dt.month / 12), atol=1e-12)


def test_partial_windows_are_null(sales):
    rows = sales.select("product_id", "date", feat.rolling(7, "mean").alias("m")).where("product_id = 'K01'")
    assert rows.where("m is null").count() == 7


def test_lags_go_by_row_when_dates_are_sparse(spark):
    rows = [(f"2024-01-{d:02d}", "A", u) for d, u in [(1, 5), (4, 7), (20, 9)]]
    df = spark.createDataFrame(rows, "d string, product_id string, units_sold long").select(
        F.to_date("d").alias("date"), "product_id", "units_sold")
    got = df.select("date", feat.sales_lags((1,))["sales_lag_1"].alias("v")).orderBy("date").collect()
    assert [r.v for r in got] == [None, 5.0, 7.0]


def test_short_products_give_no_feature_rows(spark):
    rows = [(f"2026-07-0{d}", "P201", "Sony", "PlayStation 5 Pro", "Electrical Appliance", 4, 0, 59990.0, 20 + d)
            for d in range(1, 6)]
    df = spark.createDataFrame(rows, "d string, product_id string, brand string, product_name string, category string, "
                                     "lead_time_days int, on_promo int, unit_price double, units_sold long")
    df = df.select(F.to_date("d").alias("date"), *[c for c in RAW_SALES.fieldNames() if c != "date"])
    assert feat.feature_table(df).count() == 0


def test_hold_last_features_allow_short_history(spark):
    rows = [(f"2024-01-{d:02d}", "A", u, 0, 10.0) for d, u in [(1, 4), (2, 6), (3, 8)]]
    df = spark.createDataFrame(rows, "d string, product_id string, units_sold long, on_promo int, unit_price double")
    df = df.withColumn("date", F.to_date("d"))
    first, second = feat.hold_last_features(df, 2).orderBy("step").collect()
    assert first.sales_lag_1 == 8 and first.sales_lag_7 == 8 and first.on_promo_lag7 == 0
    assert first.rolling_mean_7 == 6 and first.rolling_std_7 == pytest.approx(np.std([4, 6, 8]))
    assert second.rolling_mean_3 == pytest.approx((6 + 8 + 8) / 3)


def test_split_is_exclusive(sales):
    before, after = feat.split_at(sales, "2024-10-01")
    assert before.count() + after.count() == sales.count()
    assert str(after.agg(F.min("date")).first()[0]) == "2024-10-01"


def test_sequences_and_scaling(sales):
    rows = history.sequences(sales)
    assert rows.count() == 7 * (366 - 30)
    fitted = history.scaler(sales)
    scaled = history.scale(sales, fitted).groupBy("product_id").agg(
        F.avg("scaled").alias("m"), F.stddev_pop("scaled").alias("s")).collect()
    assert all(abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9 for r in scaled)


def test_profile_equals_its_parts(sales):
    profile = {r.product_id: r for r in history.product_profile(sales, 14).collect()}
    recent = {r.product_id: r for r in history.recent_demand(sales, 14).collect()}
    attributes = {r.product_id: r for r in history.product_attributes(sales).collect()}
    for key, row in profile.items():
        assert (row.avg_daily, row.sigma) == (recent[key].avg_daily, recent[key].sigma)
        assert row.last_price == attributes[key].last_price and row.brand == attributes[key].brand
