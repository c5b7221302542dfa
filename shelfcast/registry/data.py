"""The given tables and the inputs derived from them."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators.features import feature_table
from shelfcast.session import materialize
from shelfcast.sources import retail

# Spellings a caller may use for a model; the order number picks one.
MODEL_SPELLINGS = [
    "XGBoost", " random-forest ", "gradient boosting", "LGB", "linear_regression", "svr", "Holt-Winters",
    "prophet", "LSTM", "lstm (pytorch)", "SUPPORT VECTOR (RBF)", "", "GradBoost", "transformer",
]
PART_TYPES = ["ECONOMY", "PROMO", "LARGE", "SMALL", "MEDIUM", "STANDARD", "DELUXE"]

# Question templates asked about every product: text, and whether a product is selected beside it.
QUESTION_TEMPLATES = [
    ("How did {name} sell lately", False),
    ("List everything below its reorder line", False),
    ("At which quantity do we buy {id} again, its rop please", False),
    ("Name the five most popular articles", False),
    ("Which two articles go well together", False),
    ("Whose rmse is lowest", False),
    ("  Is the current one covered for next week", True),
    ("Hey, how is {name} doing", False),
    ("   ", True),
    ("Order size of {brand} {name}", False),
    ("When does the canteen open", False),
    ("Pallets of {name} beside {id}", True),
]


class Data:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def catalog(self) -> DataFrame:
        return retail.catalog(self.part)

    @cached_property
    def sales(self) -> DataFrame:
        return retail.daily_sales(self.lineitem, self.part)

    @cached_property
    def panel(self) -> DataFrame:
        return retail.daily_panel(self.lineitem, self.part)

    @cached_property
    def stored_sales(self) -> DataFrame:
        """The sparse daily sales as a table, for plans that use them in several branches."""
        return materialize(self.sales, "daily-sales")

    @cached_property
    def stored_panel(self) -> DataFrame:
        return materialize(self.panel, "daily-panel")

    @cached_property
    def stored_features(self) -> DataFrame:
        """The engineered table, stored once for fitting, scoring and explaining."""
        return materialize(feature_table(self.sales), "features")

    @cached_property
    def last_day(self) -> date:
        return retail.last_day(self.lineitem)

    def recent(self, days: int) -> DataFrame:
        """The last days of the panel; all that a forecast or a policy figure looks at."""
        return retail.recent_panel(self.lineitem, self.part, days, self.last_day)

    def since(self, first: str) -> DataFrame:
        return retail.panel_between(self.lineitem, self.part, date.fromisoformat(first), self.last_day)

    @cached_property
    def counts(self) -> DataFrame:
        return retail.event_counts(self.table("events"))

    @cached_property
    def product_count(self) -> int:
        """Number of products; sizes the blocks of the pair operators."""
        return self.catalog.count()

    @cached_property
    def requests(self) -> DataFrame:
        """One request per order: a product, a model spelling and a horizon."""
        spelled = F.array(*[F.lit(s) for s in MODEL_SPELLINGS])
        types = F.array(*[F.lit(t) for t in PART_TYPES])
        order, customer = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            order.alias("request_id"),
            F.concat(F.lit("Brand#"), (1 + customer % 27).cast("string"), F.lit("-"),
                     F.element_at(types, (1 + order % len(PART_TYPES)).cast("int"))).alias("product_id"),
            F.element_at(spelled, (1 + order % len(MODEL_SPELLINGS)).cast("int")).alias("model_text"),
            (7 + customer % 8).cast("int").alias("horizon"))

    @cached_property
    def service_levels(self) -> DataFrame:
        """A service level of 90 to 99 percent per product, halves included."""
        return self.catalog_parts.select(
            "product_id", (90 + (F.col("first_part") % 19) / 2).cast("double").alias("service_level"))

    @cached_property
    def catalog_parts(self) -> DataFrame:
        return self.part.groupBy(retail.product_id().alias("product_id")).agg(
            F.min("p_partkey").alias("first_part"), F.sum("p_size").alias("shelf_units"),
            F.max("p_retailprice").alias("top_price"))

    @cached_property
    def stock_overrides(self) -> DataFrame:
        """Counted stock of the products with a long lead time."""
        return (self.catalog.where(F.col("lead_time_days") >= 6).select("product_id")
                .join(self.catalog_parts, "product_id").select("product_id", F.col("shelf_units").alias("stock")))

    @cached_property
    def offers(self) -> DataFrame:
        """Shop offers known for some products: zero or missing elsewhere."""
        first, top = F.col("first_part"), F.col("top_price")
        return self.catalog_parts.select(
            "product_id",
            F.when(first % 3 == 0, F.round(top * 80, 2)).alias("amazon_price"),
            F.when(first % 4 == 0, F.round(top * 90, 2)).otherwise(0.0).alias("flipkart_price"),
            F.lit(None).cast("double").alias("reliance_price"))

    @cached_property
    def questions(self) -> DataFrame:
        """Every template asked about every product, and every conversation turn."""
        templates = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(text).alias("text"), F.lit(selected).alias("selected"))
            for i, (text, selected) in enumerate(QUESTION_TEMPLATES)])
        asked = self.catalog.withColumn("t", F.explode(templates))
        text = F.col("t.text")
        for mark, column in (("{name}", "product_name"), ("{id}", "product_id"), ("{brand}", "brand")):
            text = F.replace(text, F.lit(mark), F.col(column))
        from_catalog = asked.select(
            F.concat_ws("#", "product_id", F.col("t.i").cast("string")).alias("question_id"), text.alias("text"),
            F.when(F.col("t.selected"), F.upper("product_name")).alias("selected_product"))
        spoken = self.table("conversations").select(
            F.concat_ws("#", F.lit("turn"), "conv_id", "turn").alias("question_id"), "text",
            F.lit(None).cast("string").alias("selected_product"))
        return from_catalog.unionByName(spoken)

    @cached_property
    def generator_catalog(self) -> DataFrame:
        """The catalog with a demand level and seasons for the synthetic panel."""
        seasons = (F.when(F.col("category") == "ECONOMY", F.array(*[F.lit(m) for m in (4, 5, 6, 7)]))
                   .when(F.col("category") == "PROMO", F.array(*[F.lit(m) for m in (11, 12, 1, 2)])))
        factor = F.when(F.col("category") == "ECONOMY", 2.0).when(F.col("category") == "PROMO", 1.5)
        return self.catalog.join(self.catalog_parts, "product_id").select(
            "product_id", "brand", "product_name", "category",
            (6 + F.col("first_part") % 20).cast("int").alias("base_demand"), "lead_time_days",
            F.col("list_price").alias("price"), seasons.alias("seasonal_months"), factor.alias("seasonal_factor"))
