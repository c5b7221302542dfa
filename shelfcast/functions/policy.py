"""Inventory policy formulas as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, functions as F

# Service level in percent -> z.
SERVICE_Z = {90: 1.28, 95: 1.65, 98: 2.05, 99: 2.33}
DEFAULT_SIGMA = 2.0
DAYS_PER_YEAR = 365
ORDERING_COST = 50.0
HOLDING_SHARE = 0.25
COVERAGE_DAYS = 7
MIN_STOCK = 5
# Upper end of the hash share, stock as a factor of the reorder point, spread of that factor.
STOCK_BANDS = [(0.25, 0.35, 0.58), (0.60, 1.02, 0.25), (1.00, 1.35, 1.15)]
USD_LIMIT = 2000
USD_RATE = 83

# Risk level -> (action, badge).
RISK_TEXT = {
    "HIGH": ("ORDER NOW", "🔴 HIGH RISK"),
    "MEDIUM": ("REORDER SOON", "🟡 MEDIUM RISK"),
    "LOW": ("STOCK OK", "🟢 HEALTHY"),
    "ERROR": ("Forecast Unavailable", "❌ ERROR"),
}


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def z_table() -> dict[int, float]:
    """z for every whole percentage: fixed values where given, else the normal quantile."""
    exact = NormalDist()
    return {p: SERVICE_Z.get(p, exact.inv_cdf(p / 100)) for p in range(1, 100)}


def z_for_service_level(service_level) -> Column:
    """Service level in percent, rounded half-even to a whole number, then looked up."""
    if not isinstance(service_level, Column):
        return F.lit(z_table()[int(round(service_level))])
    pairs = [F.lit(v) for item in z_table().items() for v in item]
    return F.element_at(F.create_map(*pairs), F.rint(service_level).cast("int"))


def safe_sigma(sigma) -> Column:
    return F.when(_col(sigma) > 0, _col(sigma)).otherwise(F.lit(DEFAULT_SIGMA))


def safety_stock(sigma, lead_days, service_level) -> Column:
    return z_for_service_level(service_level) * safe_sigma(sigma) * F.sqrt(_col(lead_days))


def lead_time_demand(avg_daily, lead_days) -> Column:
    return _col(avg_daily) * _col(lead_days)


def reorder_point(avg_daily, lead_days, sigma, service_level) -> Column:
    return lead_time_demand(avg_daily, lead_days) + safety_stock(sigma, lead_days, service_level)


def economic_order_quantity(annual_demand, ordering_cost, holding_cost) -> Column:
    demand, holding = _col(annual_demand), _col(holding_cost)
    return F.when((demand > 0) & (holding > 0),
                  F.sqrt(F.try_divide(2 * demand * _col(ordering_cost), holding))).otherwise(0.0)


def days_of_supply(stock, avg_daily) -> Column:
    avg = _col(avg_daily)
    return _col(stock) / F.when(avg > 0, avg).otherwise(1.0)


def needs_restock(stock, rop) -> Column:
    return _col(stock) < _col(rop)


def restock_quantity(stock, rop, avg_daily, coverage_days=COVERAGE_DAYS) -> Column:
    wanted = F.ceil(_col(rop) + _col(avg_daily) * _col(coverage_days) - _col(stock))
    return F.when(needs_restock(stock, rop), wanted).otherwise(0).cast("bigint")


def risk_level(stock, rop, dos, lead_days) -> Column:
    stock, rop, dos, lead = _col(stock), _col(rop), _col(dos), _col(lead_days)
    return (F.when((stock < rop) | (dos < lead), "HIGH")
            .when((stock < rop * 1.30) | (dos < lead * 1.5), "MEDIUM")
            .otherwise("LOW"))


def _risk_text(level: Column, position: int) -> Column:
    pairs = [F.lit(v) for name, text in RISK_TEXT.items() for v in (name, text[position])]
    return F.element_at(F.create_map(*pairs), level)


def risk_action(level: Column) -> Column:
    return _risk_text(level, 0)


def risk_badge(level: Column) -> Column:
    return _risk_text(level, 1)


def md5_percent(key: Column) -> Column:
    """The 128-bit md5 number modulo 100, taken over its two 64-bit halves.

    2**64 leaves the remainder 16 modulo 100.
    """
    digest = F.md5(key.cast("binary"))
    high = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(digest, 17, 16), 16, 10).cast("decimal(20,0)")
    return (((high % 100) * 16 + low % 100) % 100).cast("int")


def opening_stock(key: Column, rop: Column) -> Column:
    """Deterministic stock in three bands around the reorder point, at least 5."""
    share = md5_percent(key) / 100.0
    factor, start = F, 0.0
    for end, base, spread in STOCK_BANDS:
        factor = factor.when(share < end, base + spread * ((share - start) / (end - start)))
        start = end
    return F.greatest(F.lit(MIN_STOCK), F.rint(rop * factor).cast("bigint"))


def normalize_price(price: Column) -> Column:
    """Prices below 2000 are taken as dollars and converted."""
    return F.when(price < USD_LIMIT, price * USD_RATE).otherwise(price)
