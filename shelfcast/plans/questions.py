"""Questions answered in bulk: a table of (question_id, text) in, answers out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions import policy, text as words
from shelfcast.operators.history import product_profile
from shelfcast.session import materialize

SERVICE_LEVEL = 95
DEFAULT_STOCK = 60


def _grams(value: Column, width: Column) -> Column:
    """All substrings of one width, overlapping; none when the text is shorter.

    A lookahead finds them in one pass, so the cost grows with the text length.
    """
    return F.regexp_extract_all(value, F.concat(F.lit("(?s)(?=(.{"), width.cast("string"), F.lit("}))")), F.lit(1))


def product_terms(products: DataFrame) -> DataFrame:
    """The lower-case texts that name a product, its id and its name, with a gram width.

    Brand plus name contains the name, so it never decides alone. Short terms
    get short grams of their own, so one short name does not blunt the rest.
    """
    terms = products.select("product_id", "product_name", F.explode(F.array(
        F.lower("product_id"), F.lower("product_name"))).alias("term")).where(F.col("term") != "")
    size = F.length("term")
    return terms.withColumn("width", F.when(size >= 8, 8).when(size >= 4, 4).when(size >= 2, 2).otherwise(1))


def _anchors(terms: DataFrame) -> DataFrame:
    """For every term its gram that the fewest terms share."""
    grams = terms.select("term", F.explode(_grams(F.col("term"), F.col("width"))).alias("gram")).distinct()
    shared = grams.groupBy("gram").agg(F.count("*").alias("shared"))
    return (grams.join(shared, "gram").groupBy("term")
            .agg(F.min_by("gram", F.struct("shared", "gram")).alias("gram")))


def named_products(questions: DataFrame, products: DataFrame) -> DataFrame:
    """The product each text names, longest product name first, ids breaking ties.

    Containment has no key to join on, so both sides meet on a substring: a
    term offers its rarest gram, a text all its grams of the widths in use (at
    most four), and the exact containment test runs on the pairs that meet.
    Text grams grow with the text length and the catalog may grow freely; there
    is no text x catalog product.

    Spark takes exploded grams for as small as the file of their texts. So the terms are
    stored, which gives them a true size, and what comes from texts stands where it cannot be
    broadcast: left of a semi join, or in a sort-merge join.
    """
    named = product_terms(products)
    terms = materialize(named.join(_anchors(named), "term").withColumn("gram", F.xxhash64("gram")), "product-terms")
    widths = terms.agg(F.collect_set("width").alias("w")).scalar()
    texts = questions.select("question_id", words.clean(F.col("text")).alias("clean_text"))
    # Each distinct gram of a text leaves once, as eight bytes; equal hashes are told apart by the containment test.
    hashed = F.transform(_grams(F.col("clean_text"), F.col("width")), lambda g: F.xxhash64(g))
    grams = texts.withColumn("width", F.explode(widths)).select("question_id", F.explode(F.array_distinct(hashed)).alias("gram"))
    hits = grams.join(terms.select("gram"), "gram", "left_semi").distinct()
    met = hits.hint("merge").join(terms.drop("width"), "gram").drop("gram").distinct()
    sure = met.join(texts.hint("merge"), "question_id").where(F.contains("clean_text", F.col("term")))
    best = F.struct(-F.length("product_name"), F.col("product_id"))
    return sure.groupBy("question_id").agg(F.min_by("product_id", best).alias("matched_product"))


def context_product(questions: DataFrame, products: DataFrame, matches: DataFrame) -> DataFrame:
    """Adds the product of a question: the one its text names, else the selected
    product when the text refers to it by a context word."""
    selected = products.groupBy(F.lower("product_name").alias("selected_key")).agg(
        F.min("product_id").alias("selected_id"))
    refers = words.contains_any(words.clean(F.col("text")), words.CONTEXT_WORDS)
    # A row that needs no lookup gets a key of its own, so that such rows spread evenly.
    wanted = F.when(F.col("matched_product").isNull() & refers, F.lower("selected_product"))
    asked = questions.join(matches, "question_id", "left").withColumn(
        "selected_key", F.coalesce(wanted, F.concat(F.lit("\n"), "question_id")))
    return (asked.join(selected, "selected_key", "left")
            .withColumn("product_id", F.coalesce("matched_product", "selected_id"))
            .drop("selected_key", "selected_id", "matched_product"))


def route_questions(questions: DataFrame, products: DataFrame) -> DataFrame:
    """One intent per question, with the product for product questions.

    Only texts no earlier rule has taken are searched for product names.
    """
    matches = named_products(questions.where(~words.is_taken_early(words.clean(F.col("text")))), products)
    known = context_product(questions, products, matches).select(
        "question_id", words.clean(F.col("text")).alias("clean_text"), "product_id")
    routed = known.select("question_id", "product_id", words.route(
        F.col("clean_text"), F.col("product_id").isNotNull()).alias("intent"))
    return routed.withColumn("product_id", F.when(F.col("intent") == "product", F.col("product_id")))


def restock_alerts(recent: DataFrame, selected_product: str | None = None, current_stock: int = DEFAULT_STOCK,
                   limit: int | None = None) -> DataFrame:
    """Products whose stock is below the reorder point of their last 14 days."""
    demand = product_profile(recent, 14)
    stock = F.lit(DEFAULT_STOCK)
    if selected_product:
        stock = F.when(F.lower("product_name") == selected_product.lower(), current_stock).otherwise(stock)
    rop = policy.reorder_point(F.col("avg_daily"), F.col("lead_time_days"), F.col("sigma"), SERVICE_LEVEL)
    rows = demand.withColumn("rop", rop).withColumn("stock", stock).where(policy.needs_restock(F.col("stock"), F.col("rop")))
    alerts = rows.select(
        "brand", "product_name", "product_id",
        F.ceil("rop").cast("bigint").alias("reorder_point"),
        policy.restock_quantity(F.col("stock"), F.col("rop"), F.col("avg_daily")).alias("order_qty"))
    return alerts.orderBy("brand", "product_name", "product_id").limit(limit) if limit else alerts


def dossiers(sales: DataFrame, current_stock: int = DEFAULT_STOCK) -> DataFrame:
    """Policy figures of every product from its last 30 days and its first price."""
    base = product_profile(sales, 30)
    price = policy.normalize_price(F.col("first_price"))
    avg, sigma, lead = F.col("avg_daily"), F.col("sigma"), F.col("lead_time_days")
    eoq = policy.economic_order_quantity(avg * policy.DAYS_PER_YEAR, policy.ORDERING_COST, price * policy.HOLDING_SHARE)
    return base.select(
        "product_id", F.upper("brand").alias("brand"), F.upper("product_name").alias("product_name"), "category",
        F.format_number(F.round(price, 2), 2).alias("unit_price"),
        "lead_time_days",
        F.round(avg, 1).alias("daily_velocity"),
        F.ceil(policy.safety_stock(sigma, lead, SERVICE_LEVEL)).cast("bigint").alias("safety_stock"),
        F.ceil(policy.reorder_point(avg, lead, sigma, SERVICE_LEVEL)).cast("bigint").alias("reorder_point"),
        F.ceil(eoq).cast("bigint").alias("eoq"),
        F.round(policy.days_of_supply(current_stock, avg), 1).alias("days_of_supply"))


def demand_leaders(sales: DataFrame, limit: int = 5) -> DataFrame:
    """Products with the highest mean daily demand."""
    named = sales.groupBy("product_id").agg(
        F.min_by("brand", "date").alias("brand"), F.min_by("product_name", "date").alias("product_name"),
        (F.sum(F.col("units_sold").cast("double")) / F.count("units_sold")).alias("avg_daily"))
    return (named.orderBy(F.desc("avg_daily"), "product_id").limit(limit)
            .select("product_id", "brand", "product_name", F.round("avg_daily", 1).alias("avg_daily")))


def bundle_answer(pairs: DataFrame) -> DataFrame:
    return pairs.select("name_a", "name_b", F.rint(F.col("similarity") * 100).cast("int").alias("affinity_pct"))


def model_answer(ranked: DataFrame) -> DataFrame:
    """Models with their errors, the best one marked."""
    return ranked.select("model", "mae", "rmse", (F.col("rank") == 1).alias("is_best"))
