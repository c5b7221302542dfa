"""Competitor price expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Elasticity of demand per category, and for any other category.
CATEGORY_ELASTICITY = {
    "Smartphone": -1.8,
    "Mobile": -1.8,
    "Appliance": -1.4,
    "Refrigerator": -1.3,
    "Air Conditioner": -1.5,
    "Television": -1.6,
    "Washing Machine": -1.4,
    "Kitchen Appliance": -1.2,
    "Air Purifier": -1.3,
    "Dishwasher": -1.2,
}
DEFAULT_ELASTICITY = -1.5

# Price noise of each shop, lowest and highest share.
SHOP_NOISE = {
    "amazon": (Decimal("-0.09"), Decimal("0.06")),
    "flipkart": (Decimal("-0.10"), Decimal("0.07")),
    "reliance": (Decimal("-0.07"), Decimal("0.08")),
}
NOISE_STEPS = 10000
THREAT_LIMIT = 6.0

# Threat level -> badge.
THREAT_BADGES = {
    "CRITICAL_UNDERPRICING_THREAT": "🚨 COMPETITOR UNDERPRICING RISK",
    "MARGIN_EXPANSION_OPPORTUNITY": "⚡ MARGIN EXPANSION OPPORTUNITY",
    "MARKET_PARITY": "✅ MARKET PRICE PARITY",
}
# Threat level -> recommendation template over (gap percent, average price, demand percent).
THREAT_TEXT = {
    "CRITICAL_UNDERPRICING_THREAT":
        "Competitors are averaging {gap}% cheaper (₹{price}). Expected demand drag: {demand}%. "
        "Recommend running a 5% promotional match.",
    "MARGIN_EXPANSION_OPPORTUNITY":
        "Our price is {gap}% lower than market average (₹{price}). Expected demand surge: +{demand}%. "
        "Maintain price or expand buffer stock.",
    "MARKET_PARITY":
        "Our pricing is in optimal parity with competitor average (₹{price}, variance {signed}%). "
        "Zero pricing threat detected.",
}


def hash_step(*keys) -> Column:
    """A whole number below NOISE_STEPS, uniform by md5 of the joined keys."""
    digest = F.md5(F.concat_ws("|", *keys).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % NOISE_STEPS


def simulated_price(shop: str, product_id: Column, our_price: Column) -> Column:
    low, high = SHOP_NOISE[shop]
    step = hash_step(product_id, F.lit(shop)).cast("decimal(5,0)")
    share = F.lit(1 + low) + F.lit((high - low) / NOISE_STEPS) * step
    return F.round(our_price * share, 2).cast("decimal(14,2)")


def shop_price(given: Column, simulated: Column) -> Column:
    """The given price when positive, else the simulated one."""
    offered = given.cast("decimal(14,2)")
    return F.coalesce(F.when(offered > 0, offered), simulated)


def average_price(prices: list[Column]) -> Column:
    total = prices[0]
    for price in prices[1:]:
        total = total + price
    return F.round(total.cast("decimal(18,2)") / len(prices), 2).cast("decimal(14,2)")


def price_index(our_price: Column, average: Column) -> Column:
    return F.when(average > 0, F.round(F.try_divide(our_price, average), 3)).otherwise(1).cast("double")


def price_gap(our_price: Column, average: Column) -> Column:
    """Percent above the market average; null when there is no average."""
    return F.round(F.try_divide((our_price - average) * 100, average), 2).cast("double")


def demand_impact(gap: Column, elasticity: Column) -> Column:
    return F.round(-gap * F.abs(elasticity), 1)


def threat_level(gap: Column) -> Column:
    return (F.when(gap > THREAT_LIMIT, "CRITICAL_UNDERPRICING_THREAT")
            .when(gap < -THREAT_LIMIT, "MARGIN_EXPANSION_OPPORTUNITY")
            .when(gap.isNotNull(), "MARKET_PARITY"))


def threat_badge(level: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for item in THREAT_BADGES.items() for v in item]), level)


def _fill(template: str, **values: Column) -> Column:
    parts, rest = [], template
    while "{" in rest:
        text, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(text), values[name]]
    return F.concat(*parts, F.lit(rest))


def recommendation(level: Column, gap: Column, average: Column, impact: Column) -> Column:
    def one_digit(value, pattern="%.1f"):
        return F.format_string(pattern, F.round(value, 1))

    values = dict(gap=one_digit(F.abs(gap)), price=F.format_number(average, 2),
                  demand=one_digit(F.abs(impact)), signed=one_digit(gap, "%+.1f"))
    text = F
    for name, template in THREAT_TEXT.items():
        text = text.when(level == name, _fill(template, **values))
    return text
