import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecast as fc
from shelfcast.plans import portfolio
from shelfcast.schemas import STORED_TABLES
from shelfcast.session import new_folder
from shelfcast.sources import files
from shelfcast.sources.store import Store


@pytest.fixture
def store(spark):
    s = Store(spark, new_folder(spark, "store"))
    s.create()
    return s


def test_creates_four_tables_once(store, sales):
    store.seed_products(sales)
    store.create()
    assert {t: store.read(t).count() for t in STORED_TABLES} == {
        "products": 7, "sales": 0, "forecasts": 0, "stock_policy": 0}


def test_duplicates_are_ignored_and_first_row_wins(store, sales):
    store.seed_sales(sales.limit(50).withColumn("units_sold", F.lit(-1).cast("long")))
    store.seed_sales(sales.unionByName(sales))
    rows = store.read("sales")
    assert rows.count() == sales.count()
    assert rows.where("units_sold = -1").count() == 50


def test_null_fields_are_refused(store, sales):
    store.seed_products(sales.withColumn("category", F.when(F.col("product_id") != "K01", F.col("category"))))
    assert store.read("products").where("product_id = 'K01'").count() == 0


def test_forecast_rows(store, spark):
    rows = spark.createDataFrame([("K05", ["2027-03-05", "2027-03-06", "2027-03-07"], [4.25, 0.0, 11.5])],
                                 "product_id string, forecast_dates array<string>, forecast array<double>")
    store.save_forecasts(rows, "LightGBM")
    got = store.read("forecasts")
    assert got.count() == 3 and got.agg(F.sum("predicted_units")).first()[0] == pytest.approx(15.75)
    assert got.where("created_at is null").count() == 0


def test_optimization_rows(store, sales):
    rows = portfolio.optimize_fixed_stock(sales, fc.naive(sales, 14), 14, with_series=False)
    store.save_optimization(rows, "Naive")
    got = store.read("stock_policy")
    assert got.count() == 7 and {r.needs_restock for r in got.collect()} <= {0, 1}


def test_unknown_table_is_refused(store):
    with pytest.raises(ValueError):
        store.read("users")


def test_csv_round_trip_keeps_quotes(spark, sales):
    path = new_folder(spark, "csv")
    files.write_sales(sales, path, "csv")
    back = files.read_raw_sales(spark, path)
    assert back.exceptAll(sales).count() == 0 and back.count() == sales.count()


def test_new_product_feed_is_read_by_name(spark, sales):
    path = new_folder(spark, "feed")
    order = ["date", "product_id", "brand", "product_name", "category", "unit_price", "lead_time_days", "on_promo", "units_sold"]
    files.write_csv(sales.select(order), path)
    assert files.read_new_products(spark, path).exceptAll(sales).count() == 0
