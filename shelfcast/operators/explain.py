"""Feature contributions to predictions and their explanation in words."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.operators.features import FEATURES

# Display label of each feature.
LABELS = {
    "day_of_week": "Day of Week",
    "month": "Month",
    "quarter": "Quarter",
    "is_weekend": "Weekend",
    "dow_sin": "Weekday (sin)",
    "dow_cos": "Weekday (cos)",
    "month_sin": "Month (sin)",
    "month_cos": "Month (cos)",
    "on_promo": "On Promo",
    "on_promo_lag7": "Promo last week",
    "unit_price": "Unit Price",
    "sales_lag_1": "Sales Yesterday",
    "sales_lag_7": "Sales 7d ago",
    "sales_lag_14": "Sales 14d ago",
    "sales_lag_30": "Sales 30d ago",
    "rolling_mean_3": "3d Avg",
    "rolling_std_3": "3d Std",
    "rolling_mean_7": "7d Avg",
    "rolling_std_7": "7d Std",
    "rolling_mean_14": "14d Avg",
    "rolling_std_14": "14d Std",
    "rolling_mean_30": "30d Avg",
    "rolling_std_30": "30d Std",
    "rolling_min_7": "7d Min",
    "rolling_max_7": "7d Max",
}
# The sentences of an explanation.
OPENING = ("For **%s**, the model's next-day baseline demand is **%.1f units**. After accounting for the product's "
           "current conditions, the forecast lands at **%.1f units**.")
DRIVER = "**%s** (%s) %s the forecast %.1f units"
UPWARD = "The strongest upward drivers are "
DOWNWARD = "The strongest downward pressures are "
CLOSING = "Across the whole catalog, the features that generally matter most to this model are "
SAMPLE_SIZE = 500
DRIVERS = 3


def label(feature: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for item in LABELS.items() for v in item]), feature)


def sample(rows: DataFrame, n: int = SAMPLE_SIZE, seed: int = 42, key=("product_id", "date")) -> DataFrame:
    """At most ``n`` rows in the order of a seeded hash of their key."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))
    return rows.orderBy(order, *key).limit(n)


def feature_means(rows: DataFrame, features=FEATURES) -> DataFrame:
    return rows.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features])


def _long(rows: DataFrame, value) -> DataFrame:
    """(product_id, date, feature, value, contribution) from one column per feature."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                                 value(c).alias("contribution")) for c in FEATURES])
    return rows.select("product_id", "date", F.explode(entries).alias("e")).select("product_id", "date", "e.*")


def linear_contributions(rows: DataFrame, background: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Exact contributions of a linear model: weight times distance from the background mean."""
    means = feature_means(background).select(F.struct(*FEATURES).alias("m")).scalar()
    return _long(rows.withColumn("_m", means), lambda c: F.lit(float(coefficients.get(c, 0.0))) * (
        F.col(c).cast("double") - F.col("_m")[c]))


def linear_importance(rows: DataFrame, background: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """``importance`` of a linear model in one aggregate over all rows, without a row per feature."""
    means = feature_means(background).select(F.struct(*FEATURES).alias("m")).scalar()
    overall = rows.withColumn("_m", means).agg(*[
        F.avg(F.abs(F.lit(float(coefficients.get(c, 0.0))) * (F.col(c).cast("double") - F.col("_m")[c]))).alias(c)
        for c in FEATURES])
    entries = F.array(*[F.struct(F.lit(LABELS[c]).alias("feature"), F.round(c, 4).alias("importance"))
                        for c in FEATURES])
    return overall.select(F.explode(entries).alias("e")).select("e.*").orderBy(F.desc("importance"), "feature")


def sampled_contributions(model: PipelineModel, rows: DataFrame, background: DataFrame,
                          permutations: int = 10, seed: int = 42) -> DataFrame:
    """Sampled Shapley values of any fitted model against the background mean.

    Each row gets ``permutations`` feature orders. A row moves from the
    background to its own values one feature at a time; the change of the
    prediction at each move is that feature's share. All moves are rows of one
    table scored by a single ``transform``. ``rows`` is meant to be a sample.
    """
    means = feature_means(background).select(F.struct(*FEATURES).alias("m")).scalar()
    names = F.array(*[F.lit(c) for c in FEATURES])
    draws = rows.select("product_id", "date", F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURES]).alias("x"),
                        means.alias("m"), F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("draw"))
    keyed = F.transform(names, lambda n: F.struct(
        F.xxhash64(F.lit(seed), F.col("product_id"), F.col("date"), F.col("draw"), n).alias("h"), n.alias("n")))
    ordered = draws.withColumn("order", F.transform(F.array_sort(keyed), lambda k: k["n"]))
    moves = ordered.withColumn("moved", F.explode(F.sequence(F.lit(0), F.lit(len(FEATURES)))))
    inputs = {c: F.when(F.array_position("order", c) <= F.col("moved"), F.col("x")[c]).otherwise(F.col("m")[c])
              for c in FEATURES}
    scored = model.transform(moves.select(
        "product_id", "date", "draw", "moved", "order", "x", *[v.alias(c) for c, v in inputs.items()]))
    path = F.array_sort(F.collect_list(F.struct("moved", "prediction")))
    paths = scored.groupBy("product_id", "date", "draw").agg(
        path.alias("path"), F.first("order").alias("order"), F.first("x").alias("x"))
    steps = paths.select("product_id", "date", "x", F.posexplode("order").alias("i", "feature"), "path")
    gain = F.element_at("path", F.col("i") + 2)["prediction"] - F.element_at("path", F.col("i") + 1)["prediction"]
    value = F.element_at(F.create_map(*[c for n in FEATURES for c in (F.lit(n), F.col("x")[n])]), F.col("feature"))
    return steps.groupBy("product_id", "date", "feature").agg(
        F.first(value).alias("value"), F.avg(gain).alias("contribution"))


def importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution of each feature, largest first."""
    return (contributions.groupBy("feature").agg(F.round(F.avg(F.abs("contribution")), 4).alias("importance"))
            .select(label(F.col("feature")).alias("feature"), "importance")
            .orderBy(F.desc("importance"), "feature"))


def drivers(contributions: DataFrame, top_n: int = DRIVERS) -> DataFrame:
    """The strongest upward and downward features of each explained row, ranked.

    A row has 25 contributions, so its ranking is a small sorted array.
    """
    signed = contributions.where(F.col("contribution") != 0).withColumn(
        "direction", F.when(F.col("contribution") > 0, "up").otherwise("down"))
    order = Window.partitionBy("product_id", "date", "direction").orderBy(
        F.desc(F.abs("contribution")), "feature")
    return signed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def explanation(contributions: DataFrame, base: Column, names: DataFrame, top_n: int = DRIVERS) -> DataFrame:
    """One paragraph per explained row: baseline, forecast, strongest drivers, global ranking."""
    overall = (importance(contributions).limit(top_n)
               .agg(F.array_sort(F.collect_list(F.struct(-F.col("importance"), F.col("feature")))).alias("g"))
               .select(F.array_join(F.transform("g", lambda e: F.concat(F.lit("**"), e["feature"], F.lit("**"))), ", ")))
    forecast = contributions.groupBy("product_id", "date").agg(
        (base + F.sum("contribution")).alias("forecast"))
    verb = F.when(F.col("direction") == "up", "pushes").otherwise("pulls")
    phrase = F.format_string(DRIVER, label(F.col("feature")),
                             F.round("value", 2).cast("string"), verb, F.round(F.abs("contribution"), 1))
    ranked = drivers(contributions, top_n).withColumn("phrase", phrase)

    def joined(direction):
        chosen = F.when(F.col("direction") == direction, F.struct("rank", "phrase"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(chosen)), lambda e: e["phrase"]), ", ")

    texts = ranked.groupBy("product_id", "date").agg(joined("up").alias("ups"), joined("down").alias("downs"))
    opening = F.format_string(OPENING, F.col("name"), F.round(base, 1), F.round("forecast", 1))
    up = F.when(F.col("ups") != "", F.concat(F.lit(UPWARD), "ups", F.lit(".")))
    down = F.when(F.col("downs") != "", F.concat(F.lit(DOWNWARD), "downs", F.lit(".")))
    closing = F.concat(F.lit(CLOSING), overall.scalar(), F.lit("."))
    return (forecast.join(texts, ["product_id", "date"], "left").join(names, "product_id")
            .select("product_id", "date", base.alias("base"), "forecast",
                    F.concat_ws(" ", opening, up, down, closing).alias("text")))
