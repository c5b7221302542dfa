import math

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import policy


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize("level, z", [(90, 1.28), (95, 1.65), (98, 2.05), (99, 2.33)])
def test_fixed_service_levels(spark, level, z):
    assert value(spark, policy.z_for_service_level(level)) == z
    assert value(spark, policy.z_for_service_level(F.lit(float(level)))) == z


def test_other_service_levels_use_the_normal_quantile(spark):
    assert 1.28 < value(spark, policy.z_for_service_level(93)) < 1.65
    assert value(spark, policy.z_for_service_level(93)) == pytest.approx(1.475791, abs=1e-6)
    assert value(spark, policy.z_for_service_level(F.lit(92.5))) == value(spark, policy.z_for_service_level(92))


def test_safety_stock(spark):
    assert value(spark, policy.safety_stock(5, 4, 95)) == pytest.approx(16.5)
    assert value(spark, policy.safety_stock(0, 4, 95)) == pytest.approx(1.65 * 2 * 2)


def test_lead_time_demand_and_reorder_point(spark):
    assert value(spark, policy.lead_time_demand(10, 5)) == 50.0
    assert value(spark, policy.reorder_point(10, 5, 4, 95)) == pytest.approx(50 + 1.65 * 4 * math.sqrt(5))


@pytest.mark.parametrize("args, expected", [((1000, 50, 10), 100), ((0, 50, 10), 0), ((100, 50, 0), 0)])
def test_order_quantity(spark, args, expected):
    assert value(spark, policy.economic_order_quantity(*args)) == pytest.approx(expected)


def test_days_of_supply(spark):
    assert value(spark, policy.days_of_supply(100, 10)) == 10.0
    assert value(spark, policy.days_of_supply(100, 0)) == 100.0


def test_restock_decision(spark):
    assert value(spark, policy.needs_restock(50, 100)) is True
    assert value(spark, policy.restock_quantity(50, 100, 10, 7)) == 120
    assert value(spark, policy.needs_restock(150, 100)) is False
    assert value(spark, policy.restock_quantity(150, 100, 10)) == 0
    assert value(spark, policy.needs_restock(100, 100)) is False


@pytest.mark.parametrize("args, level, action", [
    ((10, 50, 2.0, 5), "HIGH", "ORDER NOW"), ((55, 50, 6.0, 3), "MEDIUM", "REORDER SOON"),
    ((100, 50, 10.0, 3), "LOW", "STOCK OK")])
def test_risk(spark, args, level, action):
    found = policy.risk_level(*args)
    assert value(spark, found) == level
    assert value(spark, policy.risk_action(found)) == action


def test_opening_stock_is_deterministic_and_positive(spark):
    assert value(spark, policy.md5_percent(F.lit("P101"))) == 66
    first = value(spark, policy.opening_stock(F.lit("P101"), F.lit(45.0)))
    assert first == value(spark, policy.opening_stock(F.lit("P101"), F.lit(45.0))) > 0
    assert value(spark, policy.opening_stock(F.lit("P101"), F.lit(0.0))) == 5


def test_md5_percent_equals_the_whole_number(spark):
    import hashlib
    ids = [f"P{n}" for n in range(100, 160)]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select(
        "id", policy.md5_percent(F.col("id")).alias("f")).collect()
    assert all(r.f == int(hashlib.md5(r.id.encode()).hexdigest(), 16) % 100 for r in rows)


def test_price_normalization(spark):
    assert value(spark, policy.normalize_price(F.lit(100.0))) == 8300.0
    assert value(spark, policy.normalize_price(F.lit(2000.0))) == 2000.0
