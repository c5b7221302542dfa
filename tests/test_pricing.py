import pytest
from pyspark.sql import functions as F

from shelfcast.functions import pricing
from shelfcast.plans import competitors


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("K01", "Smartphone", 82917.0), ("P900", "Unknown", 100.0)],
                                 "product_id string, category string, last_price double")


def test_summary_has_positive_prices(spark, products):
    rows = {r.product_id: r for r in competitors.competitor_summary(products, competitors.elasticity_table(spark)).collect()}
    row = rows["K01"]
    for shop in pricing.SHOP_NOISE:
        assert 0.89 < float(row[f"{shop}_price"]) / 82917.0 < 1.09
    assert row.competitor_avg_price > 0 and row.relative_price_index > 0 and row.ped == -1.8
    assert rows["P900"].our_price == 8300 and rows["P900"].ped == -1.5


def test_offers_win_when_positive(spark, products):
    offers = spark.createDataFrame([("K01", 70000.0, 0.0, 71000.0)],
                                   "product_id string, amazon_price double, flipkart_price double, reliance_price double")
    row = competitors.competitor_prices(competitors.our_prices(products), offers).where("product_id = 'K01'").first()
    assert float(row.amazon_price) == 70000.0 and float(row.reliance_price) == 71000.0 and row.flipkart_price > 0


@pytest.mark.parametrize("gap, level", [(6.0, "MARKET_PARITY"), (6.01, "CRITICAL_UNDERPRICING_THREAT"),
                                        (-6.0, "MARKET_PARITY"), (-6.01, "MARGIN_EXPANSION_OPPORTUNITY")])
def test_threat_limits_are_strict(spark, gap, level):
    assert spark.range(1).select(pricing.threat_level(F.lit(gap))).first()[0] == level


def test_zero_average_is_safe(spark):
    row = spark.range(1).select(pricing.price_index(F.lit(5.0), F.lit(0.0)), pricing.price_gap(F.lit(5.0), F.lit(0.0))).first()
    assert row[0] == 1.0 and row[1] is None
