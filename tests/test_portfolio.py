import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecast as fc
from shelfcast.plans import portfolio


@pytest.fixture(scope="module")
def forecast(sales):
    return fc.seasonal_naive(sales, 30)


def test_counts_add_up_and_filter_holds(sales, forecast):
    rows = portfolio.optimize_portfolio(sales, forecast, 30, brand="Norvik", category=portfolio.ALL_CATEGORIES)
    assert {r.brand for r in rows.collect()} == {"Norvik"}
    s = portfolio.portfolio_summary(rows).first()
    assert s.total_products == 3 == s.high_risk_count + s.medium_risk_count + s.healthy_count


def test_empty_filter_gives_zeros(sales, forecast):
    s = portfolio.portfolio_summary(portfolio.optimize_portfolio(sales, forecast, 30, brand="Nobody")).first()
    assert list(s) == [0] * 6


def test_single_summary_equals_portfolio(spark, sales, forecast):
    stock = spark.createDataFrame([("K01", 60)], "product_id string, stock int")
    many = portfolio.optimize_portfolio(sales, forecast, 30, stock_overrides=stock).where("product_id = 'K01'").first()
    one = portfolio.summarize_product(sales, forecast, "K01", 30, current_stock=60).first()
    for field in ("avg_daily_demand", "safety_stock", "reorder_point", "eoq", "days_of_supply", "needs_restock",
                  "recommended_order_qty", "lead_time_days"):
        assert many[field] == one[field], field
    assert len(one.forecast) == 30 and one.forecast_dates[0] == "2025-01-01"


def test_missing_forecast_gives_an_error_row(sales, forecast):
    rows = portfolio.optimize_portfolio(sales, forecast.where("product_id <> 'K04'"), 30)
    bad = rows.where("risk_level = 'ERROR'").collect()
    assert [r.product_id for r in bad] == ["K04"]
    assert bad[0].reorder_point == 0.0 and bad[0].current_stock == 0 and bad[0].action == "Forecast Unavailable"
    s = portfolio.portfolio_summary(rows).first()
    assert s.total_products == 7 and s.high_risk_count + s.medium_risk_count + s.healthy_count == 6


def test_portfolio_is_deterministic(sales, forecast):
    stock = lambda: sorted((r.product_id, r.current_stock) for r in
                           portfolio.optimize_portfolio(sales, forecast, 30).collect())
    assert stock() == stock()


def test_attention_list_is_sorted(sales, forecast):
    days = [r.days_of_supply for r in portfolio.needing_attention(portfolio.optimize_portfolio(sales, forecast, 30)).collect()]
    assert days == sorted(days)


def test_drill_down_joins_history_and_forecast(sales, forecast):
    rows = portfolio.drill_down(sales, forecast, portfolio.optimize_portfolio(sales, forecast, 30))
    counts = {(r.product_id, r.kind): r["count"] for r in rows.groupBy("product_id", "kind").count().collect()}
    assert counts[("K01", "history")] == 60 and counts[("K01", "forecast")] == 30
    assert rows.where(F.col("message").isNull()).count() == 0
