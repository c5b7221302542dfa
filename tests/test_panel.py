"""The adapter on a small hand-made fixture, a hot product included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import generator, retail


@pytest.fixture(scope="module")
def tables(spark):
    part = spark.createDataFrame(
        [(0, "B1", "T1", 5, 900.10), (1, "B1", "T1", 6, 901.20), (2, "B2", "T1", 7, 905.50)],
        "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double")
    day = dt.datetime
    lines = [(0, day(2024, 1, 1), 5.0, 0.0), (1, day(2024, 1, 1), 3.0, 0.10), (2, day(2024, 1, 4), 2.0, 0.05)]
    lines += [(0, day(2024, 1, 20), 1.0, 0.0)] * 400
    lineitem = spark.createDataFrame(
        lines, "l_partkey long, l_shipdate timestamp_ntz, l_quantity double, l_discount double")
    return lineitem, part


def test_sparse_sales(tables):
    rows = {(r.product_id, str(r.date)): r for r in retail.daily_sales(*tables).collect()}
    assert len(rows) == 3
    first = rows["B1-T1", "2024-01-01"]
    assert first.units_sold == 8 and first.on_promo == 1 and first.unit_price == 765.09  # 900.10 * 0.85 rounded
    assert rows["B1-T1", "2024-01-20"].units_sold == 400
    assert rows["B2-T1", "2024-01-04"].lead_time_days == 5


def test_dense_panel(tables):
    panel = retail.daily_panel(*tables)
    assert panel.count() == 2 * 20
    assert panel.where("units_sold = 0 and on_promo = 0").count() == 40 - 3


def test_recent_panel_equals_the_end_of_the_panel(tables):
    recent = retail.recent_panel(*tables, 14)
    whole = retail.daily_panel(*tables).where(F.col("date") > F.lit("2024-01-06").cast("date"))
    assert recent.count() == 28 and recent.exceptAll(whole).count() == 0 and whole.exceptAll(recent).count() == 0


def test_recent_filter_reaches_the_scan(spark):
    folder = "/root/testdata/sf0.001"
    lineitem, part = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "part"))
    plan = retail.recent_panel(lineitem, part, 14)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,2001-10-22T00:00)" in plan


def test_generator_is_reproducible(catalog, sales):
    again = generator.synthetic_sales(catalog, "2024-01-01", "2024-12-31")
    assert again.exceptAll(sales).count() == 0 and sales.count() == 7 * 366
    promo = sales.agg(F.avg("on_promo")).first()[0]
    assert 0.07 < promo < 0.13
    assert sales.where("product_id = 'K01' and on_promo = 0").agg(F.max("unit_price")).first()[0] == 949 * 83.0
    assert sales.where("units_sold < 0").count() == 0


def test_default_calendar_is_two_years(catalog):
    assert generator.synthetic_sales(catalog).count() == 7 * 731
