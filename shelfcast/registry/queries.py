"""One query per operator over the given tables, keyed by operator id."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shelfcast.functions import policy, text as words
from shelfcast.operators import (bundles, dispatch, evaluate, explain, features as feat, forecast as fc, history,
                                 models, seasonal, sequence, similarity)
from shelfcast.plans import competitors, portfolio, questions
from shelfcast.registry.data import Data
from shelfcast.schemas import STORED_TABLES
from shelfcast.session import materialize, new_folder
from shelfcast.sources import files, generator, retail
from shelfcast.sources.store import Store, new_rows

SPLIT = "2001-01-01"
# Validation days of the models: from here to the split.
VALIDATION = "2000-07-01"
HORIZON = 30
ONE_PRODUCT = "Brand#17-ECONOMY"
# A linear model with set weights, so that its recursion can be checked by SQL.
WEIGHTS = {"sales_lag_1": 0.2, "sales_lag_7": 0.25, "sales_lag_30": 0.1, "rolling_mean_7": 0.3,
           "rolling_std_14": 0.05, "rolling_min_7": -0.1, "rolling_max_7": 0.04, "is_weekend": 0.5,
           "month_sin": 0.4, "on_promo_lag7": 0.7, "unit_price": 0.0005}
INTERCEPT = 0.8
ELASTICITY = {"ECONOMY": -1.8, "PROMO": -1.6, "LARGE": -1.3, "SMALL": -1.2}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    """Register under the operator id; dates leave as ISO text."""
    def add(fn: Callable[[Data], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Data(spark, folder))
            dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
            return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df
        QUERIES[key] = run
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# ---- sources and sinks

@query("SRC1")
def raw_sales(d: Data):
    path = new_folder(d.spark, "raw-sales")
    files.write_sales(d.sales, path, "csv")
    return files.read_raw_sales(d.spark, path).orderBy("product_id", "date")


@query("SRC2")
def engineered(d: Data):
    path = new_folder(d.spark, "engineered")
    files.write_sales(feat.feature_table(d.sales), path)
    return rounded(files.read_table_file(d.spark, path).select(
        "product_id", "date", "units_sold", "sales_lag_30", "rolling_mean_7", "rolling_std_30"))


@query("SRC3")
def synthetic(d: Data):
    return generator.synthetic_sales(d.generator_catalog)


@query("SRC4")
def new_products(d: Data):
    path = new_folder(d.spark, "new-products")
    feed = d.sales.where(F.col("date") >= F.lit(SPLIT)).select(
        "date", "product_id", "brand", "product_name", "category", "unit_price", "lead_time_days",
        "on_promo", "units_sold")
    files.write_csv(feed, path)
    return files.read_new_products(d.spark, path)


@query("SRC5")
def stored_table(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    store.seed_products(d.sales)
    return store.read("products")


@query("SNK1")
def written_sales(d: Data):
    path = new_folder(d.spark, "sales")
    files.write_sales(d.sales, path)
    return files.read_table_file(d.spark, path).groupBy("category").agg(
        F.count("*").alias("n"), F.sum("units_sold").alias("units"))


@query("SNK2")
def exported_portfolio(d: Data):
    path = new_folder(d.spark, "export")
    view = portfolio.export_view(seasonal_portfolio(d))
    files.write_csv(view, path)
    return d.spark.read.schema(view.schema).csv(path, header=True, escape='"')


def naive_metrics(d: Data) -> DataFrame:
    return evaluate.errors(hold_out(d), "model")


@query("SNK3")
def metrics_report(d: Data):
    """Two runs of the report: the second replaces the entry of a model that it evaluates again."""
    scored = hold_out(d)
    cells = F.lit(d.lineitem.where(F.col("l_shipdate") < F.lit(SPLIT)).count())
    entries = materialize(evaluate.metrics_entries(scored, SPLIT, cells), "metrics")
    first = new_folder(d.spark, "metrics")
    entries.withColumn("mae", F.col("mae") + 1).write.json(first)
    again = evaluate.merge_metrics(d.spark.read.schema(entries.schema).json(first), entries)
    second = new_folder(d.spark, "metrics")
    again.write.json(second)
    return evaluate.rank_models(d.spark.read.schema(entries.schema).json(second))


@query("SNK4")
def result_tables(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    store.seed_products(d.sales)
    store.create()
    counts = [store.read(t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
              for t in STORED_TABLES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("SNK5")
def seeded_products(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    early = d.stored_sales.where(F.col("date") < F.lit("1995-01-05"))
    store.seed_products(early.withColumn("product_name", F.upper("product_name")))
    store.seed_products(d.stored_sales.unionByName(d.stored_sales))
    return store.read("products")


@query("SNK6")
def seeded_sales(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    store.seed_sales(d.stored_sales.where(F.col("date") < F.lit("1998-01-01")).withColumn("units_sold", F.lit(0)))
    store.seed_sales(d.stored_sales.unionByName(d.stored_sales.withColumn("unit_price", F.col("unit_price") + 1)))
    return store.read("sales")


@query("SNK7")
def stored_forecasts(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    store.save_forecasts(fc.as_arrays(fc.seasonal_naive(d.recent(7), 14)), "Seasonal Naive")
    return store.read("forecasts").drop("created_at")


@query("SNK8")
def stored_optimization(d: Data):
    store = Store(d.spark, new_folder(d.spark, "store"))
    store.create()
    week = d.recent(7)
    rows = portfolio.optimize_fixed_stock(week, fc.seasonal_naive(week, 14), 14, with_series=False)
    store.save_optimization(rows, "Seasonal Naive")
    return store.read("stock_policy").drop("created_at")


@query("SNK9")
def saved_model(d: Data):
    """Keys of the scored rows of three kinds of model, and whether a loaded one agrees with the one in memory."""
    train, test = feat.split_at(d.stored_features, SPLIT)
    parts = []
    for kind in ("Linear Regression", "Support Vector (RBF)"):
        fitted_model, path = models.fit(kind, train), new_folder(d.spark, "model")
        models.save(fitted_model, path)
        now = models.predict(fitted_model, test)
        then = models.predict(models.load(path, kind), test).withColumnRenamed("predicted_units", "loaded")
        parts.append(_agreement(now.join(then.drop("actual"), ["product_id", "forecast_date"]), kind))
    kind, path = "Seasonal Baseline (Holt-Winters)", new_folder(d.spark, "model")
    states = seasonal.fit(d.sales)
    models.save(states, path)
    now = seasonal.forecast(states, 7)
    then = seasonal.forecast(models.load(path, kind), 7).withColumnRenamed("predicted_units", "loaded")
    parts.append(_agreement(now.join(then.drop("step"), ["product_id", "forecast_date"]), kind))
    return reduce(DataFrame.unionByName, parts)


def _agreement(both: DataFrame, kind: str) -> DataFrame:
    same = F.abs(F.col("predicted_units") - F.col("loaded")) <= 1e-6 * (1 + F.abs("loaded"))
    return both.select(F.lit(kind).alias("model"), "product_id", "forecast_date", same.alias("agrees"))


# ---- projections and filters

KEY = ["product_id", "date"]


@query("PRJ1")
def calendar_parts(d: Data):
    return feat.calendar_features(d.sales.select(KEY))


@query("PRJ2")
def cyclic_parts(d: Data):
    return rounded(feat.cyclic_features(d.sales.select(KEY)))


@query("PRJ3")
def feature_projection(d: Data):
    return rounded(feat.feature_table(d.sales).select(*KEY, *feat.FEATURES))


@query("PRJ4")
def normalized_prices(d: Data):
    price = policy.normalize_price(F.col("p_retailprice").cast("decimal(12,2)"))
    return d.part.select("p_partkey", price.cast("double").alias("price"))


@query("PRJ5")
def display_view(d: Data):
    return portfolio.export_view(portfolio.optimize_portfolio(d.recent(1), fc.naive(d.recent(1), HORIZON), HORIZON))


def with_nulls(d: Data) -> DataFrame:
    """Sales with null promo lag and yesterday's units at the start of each product."""
    lagged = d.sales.withColumn("sales_lag_14", F.lag("units_sold", 14).over(feat.by_product()))
    return lagged.withColumn("name_hint", F.when(F.col("units_sold") > 5, F.col("product_name")))


@query("FLT1")
def without_nulls(d: Data):
    return with_nulls(d).dropna("any").select(*KEY, "units_sold", "sales_lag_14", "name_hint")


@query("FLT2")
def time_split(d: Data):
    train, test = feat.split_at(d.stored_sales.select(*KEY, "units_sold"), SPLIT)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("FLT3")
def filtered_products(d: Data):
    wanted = [("Brand#2", "All Categories"), ("All Brands", "PROMO"), ("Brand#2", "ECONOMY"), ("", "LARGE")]
    parts = [portfolio.matching_products(d.stored_sales, b, c).groupBy("product_id").agg(F.sum("units_sold").alias("units"))
             .withColumn("filter", F.lit(f"{b}|{c}")) for b, c in wanted]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("FLT4")
def one_product(d: Data):
    """The product is picked in the small parts table, so only its order lines are aggregated."""
    named = (F.col("p_brand") == "Brand#17") & (F.concat_ws(" ", "p_brand", "p_type") == "Brand#17 ECONOMY")
    parts = d.part.where((retail.product_id() == ONE_PRODUCT) | named)
    return retail.daily_sales(d.lineitem, parts).orderBy("date")


@query("FLT5")
def unknown_products(d: Data):
    return d.requests.join(d.catalog, "product_id", "left_anti").select("request_id", "product_id")


def seasonal_portfolio(d: Data, **options) -> DataFrame:
    """A season of seven days and the last attributes are all it looks at."""
    week = d.recent(7)
    return portfolio.optimize_portfolio(week, fc.seasonal_naive(week, HORIZON), HORIZON, **options)


@query("FLT6")
def attention_filter(d: Data):
    rows = seasonal_portfolio(d)
    return rows.where(F.col("risk_level").isin("HIGH", "MEDIUM")).select("product_id", "risk_level", "days_of_supply")


@query("FLT7")
def risk_map(d: Data):
    return rounded(portfolio.portfolio_map(seasonal_portfolio(d)), 4)


@query("FLT8")
def similar_pairs(d: Data):
    return similarity.product_pairs(d.stored_sales, d.product_count, digits=3, min_similarity=0.02)


@query("FLT9")
def clipped(d: Data):
    line = F.col("units_sold") * 0.5 - F.col("sales_lag_1") * 0.25
    rows = d.sales.withColumns(feat.sales_lags((1,))).dropna("any")
    return rounded(rows.select(*KEY, fc.at_least_zero(line).alias("predicted_units")))


# ---- joins

@query("JN1")
def product_days(d: Data):
    return retail.spine(d.catalog, retail.calendar_days(d.lineitem))


@query("JN2")
def unordered_pairs(d: Data):
    return similarity.varying_pairs(d.stored_sales, d.product_count)


@query("JN3")
def named_pairs(d: Data):
    return bundles.with_names(similarity.varying_pairs(d.stored_sales, d.product_count), d.catalog)


@query("JN4")
def pair_averages(d: Data):
    known = d.stored_sales.where(F.col("category") != "SMALL")
    return bundles.with_sales_impact(similarity.varying_pairs(d.stored_sales, d.product_count), known)


@query("JN5")
def overridden_stock(d: Data):
    return seasonal_portfolio(d, stock_overrides=d.stock_overrides).select("product_id", "current_stock", "risk_level")


@query("JN6")
def elasticities(d: Data):
    table = competitors.elasticity_table(d.spark, ELASTICITY)
    return competitors.with_elasticity(d.catalog.select("product_id", "category"), table)


@query("JN7")
def mentioned_products(d: Data):
    return questions.named_products(d.questions, d.catalog)


@query("JN8")
def new_keys_only(d: Data):
    rows = d.stored_sales.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    stored = rows.where(F.col("on_promo") == 1)
    return new_rows(rows, stored, "sales", ["unit_price", "units_sold"])


@query("JN9")
def error_rows(d: Data):
    last_week = F.date_sub(d.lineitem.agg(F.to_date(F.max("l_shipdate"))).scalar(), 7)
    sold_lately = d.stored_sales.where(F.col("date") > last_week)
    rows = portfolio.optimize_portfolio(d.stored_sales, fc.naive(sold_lately, HORIZON), HORIZON)
    return rows.select("product_id", "current_stock", "avg_daily_demand", "forecast_total", "reorder_point",
                       "action", "risk_level", "lead_time_days", "unit_price", "needs_restock", "status")


@query("JN10")
def filled_cells(d: Data):
    return rounded(similarity.filled_cells(d.stored_sales))


# ---- aggregations

@query("AGG1")
def panel_counts(d: Data):
    return d.sales.agg(F.countDistinct("product_id").alias("products"), F.count("*").alias("records"))


@query("AGG2")
def distinct_catalog(d: Data):
    """Products of the catalog with a sale: a semi-join on the sold part keys, no daily sums."""
    sold = d.part.join(d.lineitem.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")
    return (d.catalog.join(sold.select(retail.product_id().alias("product_id")).distinct(), "product_id", "left_semi")
            .select("product_id", "brand", "product_name", "category", "lead_time_days").orderBy("product_id"))


@query("AGG3")
def mean_units(d: Data):
    return rounded(history.mean_demand(d.sales))


@query("AGG4")
def wide_pivot(d: Data):
    # A wide table names its columns: every product that was sold.
    ids = [r[0] for r in d.stored_sales.select("product_id").distinct().orderBy("product_id").collect()]
    return rounded(similarity.sales_pivot(d.stored_sales, ids))


@query("AGG5")
def recent_demand(d: Data):
    recent = d.recent(30)
    both = [history.recent_demand(recent, n).withColumn("days", F.lit(n)) for n in (14, 30)]
    return rounded(both[0].unionByName(both[1]))


@query("AGG6")
def forecast_summary(d: Data):
    return rounded(fc.demand_summary(fc.seasonal_naive(d.recent(7), 45)), 4)


@query("AGG7")
def forecast_peak(d: Data):
    return fc.peak(fc.seasonal_naive(d.recent(7), HORIZON))


@query("AGG8")
def summary_counts(d: Data):
    return portfolio.portfolio_summary(seasonal_portfolio(d))


@query("AGG9")
def global_mean(d: Data):
    return rounded(retail.panel_mean(d.lineitem, d.part))


@query("AGG10")
def first_last(d: Data):
    return history.product_attributes(d.sales)


@query("AGG11")
def pearson(d: Data):
    return rounded(similarity.product_pairs(d.stored_sales, d.product_count), 4)


@query("AGG12")
def spearman(d: Data):
    return rounded(similarity.product_pairs(d.stored_sales, d.product_count, method="spearman"), 4)


@query("AGG13")
def full_matrix(d: Data):
    return rounded(similarity.similarity_matrix(
        similarity.product_pairs(d.stored_sales, d.product_count), d.catalog.select("product_id")), 4)


# ---- windows

def with_columns(d: Data, columns: dict[str, Column]) -> DataFrame:
    return rounded(d.sales.select(*KEY, "units_sold", *[c.alias(n) for n, c in columns.items()]))


@query("WIN1")
def lags(d: Data):
    return with_columns(d, feat.sales_lags())


@query("WIN2")
def promo_lag(d: Data):
    return with_columns(d, {"on_promo_lag7": feat.promo_lag()})


@query("WIN3")
def rolling_mean(d: Data):
    return with_columns(d, feat.rolling_stats(("mean",)))


@query("WIN4")
def rolling_std(d: Data):
    return with_columns(d, feat.rolling_stats(("std",)))


@query("WIN5")
def rolling_min(d: Data):
    return with_columns(d, feat.rolling_stats(("min",)))


@query("WIN6")
def rolling_max(d: Data):
    return with_columns(d, feat.rolling_stats(("max",)))


@query("WIN7")
def last_rows(d: Data):
    parts = [history.last_rows(d.stored_sales, n).select(*KEY, "units_sold", F.lit(n).alias("days"))
             for n in (7, 14, 30, 60)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("WIN8")
def sequences(d: Data):
    rows = history.sequences(d.sales)
    return rows.withColumn("window", F.array_join(F.transform("window", lambda v: v.cast("string")), ","))


@query("WIN9")
def scaled(d: Data):
    train, _ = feat.split_at(d.stored_sales, SPLIT)
    rows = history.unscale(history.scale(d.stored_sales.select(*KEY, "units_sold"), history.scaler(train)))
    return rounded(rows)


@query("WIN10")
def hold_last(d: Data):
    return rounded(feat.hold_last_features(d.recent(30), 14))


@query("WIN11")
def feature_table(d: Data):
    return rounded(feat.feature_table(d.sales))


# ---- sort, top-k, set operations

@query("SRT1")
def sorted_sales(d: Data):
    return d.sales.orderBy("product_id", "date")


@query("SRT2")
def top_products(d: Data):
    return rounded(history.mean_demand(d.sales).orderBy(F.desc("avg_daily"), "product_id").limit(5))


@query("SRT3")
def top_bundles(d: Data):
    return bundles.best_pairs(similarity.product_pairs(d.stored_sales, d.product_count, digits=3, best=10), 10)


@query("SRT4")
def attention_list(d: Data):
    return portfolio.needing_attention(seasonal_portfolio(d))


@query("SRT5")
def first_alerts(d: Data):
    return questions.restock_alerts(d.recent(14), limit=10)


@query("SRT6")
def thinned_rounds(d: Data):
    """Hold-out days numbered as rounds, with their pooled error."""
    per_day = evaluate.errors(hold_out(d).where(F.col("model") == "Naive"), "forecast_date", digits=6)
    first = F.lit(SPLIT).cast("date")
    rounds = per_day.select((F.datediff("forecast_date", first) + 1).alias("epoch"),
                            F.col("mae").alias("val_mae"), F.col("rmse").alias("val_rmse"))
    return evaluate.thin_rounds(rounds)


@query("SRT7")
def seeded_sample(d: Data):
    return explain.sample(d.sales, 500).select(*KEY, "units_sold")


@query("SET1")
def history_and_forecast(d: Data):
    return fc.append_to_history(d.stored_sales, fc.naive(d.stored_sales, 14))


@query("SET2")
def pooled_points(d: Data):
    return hold_out(d).select("model", "product_id", "forecast_date", "actual", "predicted_units")


# ---- scalar functions

@query("FN1")
def resolved_models(d: Data):
    return d.requests.select("request_id", words.resolve_model(F.col("model_text")).alias("model"))


@query("FN2")
def model_slugs(d: Data):
    model = words.resolve_model(F.col("model_text"))
    return d.requests.select("request_id", words.model_slug(model).alias("slug"))


@query("FN3")
def keyword_flags(d: Data):
    text = words.clean(F.col("text"))
    return d.questions.select("question_id", words.is_greeting(text).alias("greeting"), *[
        words.contains_any(text, terms).alias(intent) for intent, terms in words.INTENT_WORDS.items()])


@query("FN4")
def dossier_text(d: Data):
    rows = questions.dossiers(d.panel)
    return rows.select("product_id", F.concat_ws(
        " | ", F.concat(F.lit("DOSSIER: "), "brand", F.lit(" "), "product_name"),
        F.concat(F.lit("Unit Price: ₹"), "unit_price"),
        F.format_string("Lead Time: %d Days", "lead_time_days"),
        F.format_string("Velocity: %.1f units/day", "daily_velocity"),
        F.format_string("Runway: %.1f days", "days_of_supply")).alias("text"))


@query("FN5")
def forecast_dates(d: Data):
    last = d.sales.groupBy("product_id").agg(F.max("date").alias("last_date"))
    days = F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", 14)))
    return last.select("product_id", days.alias("day")).select(
        "product_id", F.date_format("day", "yyyy-MM-dd").alias("day"), F.date_format("day", "MMM dd, yyyy").alias("label"))


@query("FN6")
def math_functions(d: Data):
    u, p = F.col("units_sold").cast("double"), F.col("unit_price")
    return rounded(d.sales.select(
        *KEY, F.sin(u).alias("sin"), F.cos(u).alias("cos"), F.sqrt(u).alias("sqrt"),
        F.ceil(p).cast("bigint").alias("ceil"), F.abs(u - 40).alias("abs"), F.round(p / 7, 2).alias("round"),
        F.least(F.greatest(u, F.lit(12.0)), F.lit(35.0)).alias("clip")))


@query("FN7")
def service_z(d: Data):
    return d.service_levels.select("product_id", "service_level",
                                   F.round(policy.z_for_service_level(F.col("service_level")), 6).alias("z"))


@query("FN8")
def hash_factor(d: Data):
    return d.part.select("p_partkey", policy.md5_percent(F.concat(F.lit("P"), F.col("p_partkey").cast("string")))
                         .alias("factor"))


@query("FN9")
def array_tail(d: Data):
    state = feat.recent_history(d.recent(30))
    tail = feat._tail(F.concat("units", F.array(F.lit(1.0))), 7)
    return state.select("product_id", F.element_at("units", -1).alias("last"), F.element_at("units", -7).alias("week_ago"),
                        F.size("units").alias("n"), feat._add(tail).alias("tail_sum"),
                        F.element_at(tail, 1).alias("tail_first"))


@query("FN10")
def metrics_entries(d: Data):
    report = evaluate.metrics_json(naive_metrics(d))
    noted = report.select(F.replace("report", F.lit('"metrics":{'), F.lit('"metrics":{"note":"text","Broken":{"MAE":"n/a"},'))
                          .alias("report"))
    return evaluate.parse_metrics(noted)


# ---- models and forecasts

# Fits of the current application; those of an ended one are released when the next one asks.
FITTED: dict[tuple, object] = {}


def fit_missing(d: Data, names: list[str]) -> None:
    """Fits the named models that no query of this session has asked for yet, side by side."""
    application = d.spark.sparkContext.applicationId
    for key in [k for k in FITTED if k[0] != application]:
        del FITTED[key]
    missing = [n for n in names if (application, d.folder, n) not in FITTED]
    if missing:
        train, _ = feat.split_at(d.stored_features, SPLIT)
        for name, model in models.fit_all(missing, train).items():
            FITTED[application, d.folder, name] = model


def fitted(d: Data, model: str):
    """The model at its library size. Queries of one session that ask for the same fit share it."""
    fit_missing(d, [model])
    train, test = feat.split_at(d.stored_features, SPLIT)
    return FITTED[d.spark.sparkContext.applicationId, d.folder, model], train, test


def model_errors(d: Data, model: str) -> DataFrame:
    pipeline, _, test = fitted(d, model)
    return evaluate.errors(models.predict(pipeline, test)).select(F.lit(model).alias("model"), "mae", "rmse")


for _key, _model in {"MDL1": "Linear Regression", "MDL2": "Random Forest", "MDL3": "Gradient Boosting",
                     "MDL4": "LightGBM", "MDL5": "XGBoost", "MDL6": "Support Vector (RBF)"}.items():
    query(_key)(lambda d, model=_model: model_errors(d, model))


@query("MDL7")
def holt_winters(d: Data):
    return rounded(seasonal.fit(d.sales).drop("season", "last_date"), 5)


@query("MDL8")
def seasonal_naive(d: Data):
    return fc.seasonal_naive(d.recent(7), HORIZON)


@query("MDL9")
def sequence_model(d: Data):
    train, _ = feat.split_at(d.stored_panel, SPLIT)
    return evaluate.errors(sequence.one_step(d.stored_panel, sequence.fit(train), SPLIT), "product_id")


@query("FC1")
def recursive_linear(d: Data):
    return rounded(fc.with_linear(d.recent(30), WEIGHTS, INTERCEPT, 14))


@query("FC1_MODEL")
def recursive_model(d: Data):
    pipeline, _, _ = fitted(d, "Random Forest")
    return rounded(fc.with_predictor(d.recent(30), models.flat(pipeline), 14), 4)


@query("FC2")
def naive(d: Data):
    return fc.naive(d.recent(1), HORIZON)


@query("FC3")
def seasonal_forecast(d: Data):
    return rounded(seasonal.forecast(seasonal.fit(d.sales), 14), 3)


@query("FC4")
def sequence_forecast(d: Data):
    return rounded(sequence.forecast(d.stored_panel, sequence.fit(d.stored_panel), 14), 3)


@query("FC5")
def dispatched(d: Data):
    """A week ahead from every kind of model."""
    fit_missing(d, dispatch.ON_FEATURES)
    parts = [dispatch.forecast(kind, lambda name: fitted(d, name)[0], d.stored_sales, d.stored_panel, 7)
             .withColumn("model", F.lit(kind)) for kind in words.MODEL_NAMES]
    return rounded(reduce(DataFrame.unionByName, parts), 3)


def asked(d: Data) -> DataFrame:
    return d.requests.select("request_id", "product_id", "horizon", words.resolve_model(F.col("model_text")).alias("model"))


@query("FC6")
def requested_forecasts(d: Data):
    """Every request gets an answer from the kind of model it names: forecast rows, or one row
    that says what is missing."""
    wanted = [r[0] for r in asked(d).select("model").distinct().collect() if r[0] in dispatch.ON_FEATURES]
    fit_missing(d, wanted)
    return dispatch.answer(asked(d), d.catalog, lambda name: fitted(d, name)[0], d.stored_sales, d.stored_panel)


@query("FC6_SEASONAL")
def requested_seasonal_forecasts(d: Data):
    """The requests for the seasonal model, whose fit SQL can express."""
    seasonal_only = asked(d).where(F.col("model") == dispatch.SEASONAL)
    return dispatch.answer(seasonal_only, d.catalog, lambda name: None, d.stored_sales, d.stored_panel)


# ---- evaluation and explanation

def hold_out(d: Data) -> DataFrame:
    """Naive and seasonal-naive forecasts of the hold-out next to the actual units."""
    # The forecasts look at the last week before the split, the comparison at the days after it.
    train, test = feat.split_at(materialize(d.since(days_before(SPLIT, 7)), "hold-out"), SPLIT)
    horizon = (d.last_day - date.fromisoformat(SPLIT)).days + 1
    return evaluate.hold_out(naive_pair(train, horizon), test)


def days_before(day: str, n: int) -> str:
    return (date.fromisoformat(day) - timedelta(days=n)).isoformat()


def naive_pair(train: DataFrame, horizon: int) -> DataFrame:
    return (fc.naive(train, horizon).withColumn("model", F.lit("Naive"))
            .unionByName(fc.seasonal_naive(train, horizon).withColumn("model", F.lit("Seasonal Naive"))))


@query("EVL1")
def hold_out_errors(d: Data):
    return evaluate.errors(hold_out(d).where(F.col("model") == "Seasonal Naive"))


@query("EVL2")
def errors_per_product(d: Data):
    return evaluate.errors(hold_out(d), "model", "product_id")


@query("EVL3")
def pooled_errors(d: Data):
    return evaluate.errors(hold_out(d), "model")


@query("EVL4")
def ranked_models(d: Data):
    return evaluate.rank_models(naive_metrics(d))


@query("EVL4_MODELS")
def ranked_fitted_models(d: Data):
    """All eight kinds of model on the hold-out, scored in one scan and ranked by error."""
    fit_missing(d, dispatch.ON_FEATURES)
    _, test = feat.split_at(d.stored_features, SPLIT)
    past, _ = feat.split_at(d.stored_panel, SPLIT)
    sold, _ = feat.split_at(d.stored_sales, SPLIT)
    horizon = (d.last_day - date.fromisoformat(SPLIT)).days + 1
    made = {dispatch.SEASONAL: seasonal.forecast_or_naive(sold, horizon),
            dispatch.SEQUENCE: sequence.one_step(d.stored_panel, sequence.fit(past), SPLIT)}
    for kind, ahead in made.items():
        test = test.join(ahead.select("product_id", F.col("forecast_date").alias("date"),
                                      F.col("predicted_units").alias(kind)), ["product_id", "date"], "left")
    scored = evaluate.errors_of_all({k: models.flat(fitted(d, k)[0]) for k in dispatch.ON_FEATURES}, test, predicted=tuple(made))
    return evaluate.rank_models(scored).join(scored.select("model", "n", "precision_pct"), "model")


@query("EVL5")
def boosting_rounds(d: Data):
    """Both boosters, validated on the last months before the split over all products, tested after it.

    The test figures are those of the round with the lowest validation error.
    """
    train, test = feat.split_at(d.stored_features, SPLIT)
    early, late = feat.split_at(train, VALIDATION)
    rows = late.withColumn("part", F.lit("validation")).unionByName(test.withColumn("part", F.lit("test")))
    kinds = ["Gradient Boosting", "LightGBM"]
    parts = [evaluate.round_report(models.flat(model), rows).select(F.lit(kind).alias("model"), "*")
             for kind, model in models.fit_all(kinds, early).items()]
    return rounded(reduce(DataFrame.unionByName, parts), 3)


@query("EVL6")
def precision(d: Data):
    return rounded(evaluate.within_tolerance(hold_out(d), "model"), 4)


@query("EVL7")
def leaderboard(d: Data):
    shown = materialize(retail.panel_between(
        d.lineitem, d.part, date.fromisoformat(days_before(VALIDATION, 7)), date.fromisoformat(days_before(SPLIT, 1))), "validation")
    early, late = feat.split_at(shown, VALIDATION)
    horizon = (date.fromisoformat(SPLIT) - date.fromisoformat(VALIDATION)).days
    return evaluate.leaderboard(
        evaluate.errors(evaluate.hold_out(naive_pair(early, horizon), late), "model"), naive_metrics(d),
        evaluate.mean_units(late), retail.panel_mean(d.lineitem, d.part), active="Naive")


@query("XAI1")
def global_importance(d: Data):
    return explain.linear_importance(d.stored_features, d.stored_features, WEIGHTS)


@query("XAI2")
def sampled_shapley(d: Data):
    pipeline, train, _ = fitted(d, "Random Forest")
    rows = explain.sample(train, 200)
    parts = explain.sampled_contributions(pipeline, rows, train)
    return rounded(parts.select("product_id", "date", "feature", "contribution"), 4)


@query("XAI3")
def local_explanations(d: Data):
    train, _ = feat.split_at(d.stored_features, SPLIT)
    ahead = feat.hold_last_features(d.recent(30), 1)
    parts = explain.linear_contributions(ahead, train, WEIGHTS)
    base = explain.feature_means(train, list(WEIGHTS)).select(
        fc.linear_score({c: F.col(c) for c in WEIGHTS}, WEIGHTS, INTERCEPT)).scalar()
    names = d.catalog.select("product_id", F.concat_ws(" ", "brand", "product_name").alias("name"))
    return rounded(explain.explanation(parts, base, names))


@query("XAI3_DRIVERS")
def top_drivers(d: Data):
    return rounded(explain.drivers(explain.linear_contributions(
        feat.hold_last_features(d.recent(30), 1), d.stored_features, WEIGHTS)), 4)


# ---- inventory policy

def policy_base(d: Data) -> DataFrame:
    """Demand of the last 14 days with lead time, price and service level of each product."""
    recent = d.recent(14)
    return (history.recent_demand(recent, 14).join(history.product_attributes(recent), "product_id")
            .join(d.service_levels, "product_id").withColumn("stock", F.lit(60)))


def _c(name: str) -> Column:
    return F.col(name)


@query("INV1")
def safety(d: Data):
    value = policy.safety_stock(_c("sigma"), _c("lead_time_days"), _c("service_level"))
    return rounded(policy_base(d).select("product_id", value.alias("safety_stock")), 4)


@query("INV2")
def lead_demand(d: Data):
    value = policy.lead_time_demand(_c("avg_daily"), _c("lead_time_days"))
    return rounded(policy_base(d).select("product_id", value.alias("lead_time_demand")), 4)


def rop_of() -> Column:
    return policy.reorder_point(_c("avg_daily"), _c("lead_time_days"), _c("sigma"), _c("service_level"))


@query("INV3")
def reorder(d: Data):
    return rounded(policy_base(d).select("product_id", rop_of().alias("reorder_point")), 4)


@query("INV4")
def order_quantity(d: Data):
    value = policy.economic_order_quantity(_c("avg_daily") * 365, 50.0, _c("last_price") * 0.25)
    return rounded(policy_base(d).select("product_id", value.alias("eoq")), 4)


@query("INV5")
def supply(d: Data):
    return rounded(policy_base(d).select(
        "product_id", policy.days_of_supply(_c("stock"), _c("avg_daily")).alias("days_of_supply")), 4)


@query("INV6")
def restock(d: Data):
    return policy_base(d).select(
        "product_id", policy.needs_restock(_c("stock"), rop_of()).alias("needs_restock"),
        policy.restock_quantity(_c("stock"), rop_of(), _c("avg_daily")).alias("recommended_order_qty"))


@query("INV7")
def risk(d: Data):
    dos = policy.days_of_supply(_c("stock"), _c("avg_daily"))
    rows = policy_base(d).withColumn("risk_level", policy.risk_level(_c("stock"), rop_of(), dos, _c("lead_time_days")))
    return rows.select("product_id", "risk_level", policy.risk_action(_c("risk_level")).alias("action"),
                       policy.risk_badge(_c("risk_level")).alias("badge"))


@query("INV8")
def opening_stock(d: Data):
    return policy_base(d).select("product_id", policy.opening_stock(_c("product_id"), rop_of()).alias("stock"))


def joined_series(rows: DataFrame) -> DataFrame:
    as_text = F.transform("forecast", lambda v: F.format_string("%.2f", v))
    return rows.withColumns({"forecast": F.array_join(as_text, ","), "forecast_dates": F.array_join("forecast_dates", ",")})


@query("INV9")
def single_summary(d: Data):
    return joined_series(portfolio.summarize_product(d.recent(7), fc.seasonal_naive(d.recent(7), 14), ONE_PRODUCT, 14))


@query("INV10")
def whole_portfolio(d: Data):
    return seasonal_portfolio(d)


@query("INV11")
def fixed_stock(d: Data):
    return joined_series(portfolio.optimize_fixed_stock(d.recent(7), fc.seasonal_naive(d.recent(7), 14), 14, current_stock=80))


@query("INV12")
def drill_down(d: Data):
    return portfolio.drill_down(d.recent(60), fc.seasonal_naive(d.recent(7), HORIZON), seasonal_portfolio(d))


# ---- pricing

def catalog_prices(d: Data) -> DataFrame:
    return competitors.our_prices(history.product_attributes(d.sales))


def money(df: DataFrame) -> DataFrame:
    exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact})


@query("PR1")
def shop_prices(d: Data):
    rows = competitors.competitor_prices(catalog_prices(d), d.offers)
    return money(rows.select("product_id", "our_price", "amazon_price", "flipkart_price", "reliance_price"))


@query("PR2")
def price_index(d: Data):
    rows = competitors.competitor_prices(catalog_prices(d), d.offers)
    return money(rows.select("product_id", "competitor_avg_price", "relative_price_index"))


@query("PR3")
def threats(d: Data):
    rows = competitors.market_threat(competitors.competitor_prices(catalog_prices(d), d.offers),
                                     competitors.elasticity_table(d.spark, ELASTICITY))
    return rows.select("product_id", "category", "price_diff_pct", "ped", "demand_impact_pct", "threat_level",
                       "threat_badge", "recommendation")


@query("PR4")
def competitor_summary(d: Data):
    return money(competitors.competitor_summary(
        history.product_attributes(d.sales), competitors.elasticity_table(d.spark, ELASTICITY), d.offers))


# ---- recommendation and questions

@query("REC1")
def recommended(d: Data):
    return bundles.recommend(d.stored_sales, d.catalog, d.product_count)


@query("REC2")
def recommended_with_sales(d: Data):
    return bundles.with_sales_impact(bundles.recommend(d.stored_sales, d.catalog, d.product_count, top_n=20), d.stored_sales)


@query("QST1")
def restock_alerts(d: Data):
    return questions.restock_alerts(d.recent(14), selected_product="Brand#11 MEDIUM", current_stock=5, limit=None)


@query("QST2")
def dossiers(d: Data):
    return questions.dossiers(d.panel)


@query("QST3")
def leaders(d: Data):
    return questions.demand_leaders(d.sales)


@query("QST4")
def bundle_answer(d: Data):
    return questions.bundle_answer(bundles.recommend(d.stored_sales, d.catalog, d.product_count))


@query("QST5")
def model_answer(d: Data):
    return questions.model_answer(evaluate.rank_models(naive_metrics(d)))


@query("QST6")
def routed(d: Data):
    return questions.route_questions(d.questions, d.catalog)


@query("QST7")
def in_context(d: Data):
    named = questions.named_products(d.questions, d.catalog)
    return questions.context_product(d.questions, d.catalog, named).select("question_id", "product_id").where(
        F.col("product_id").isNotNull())


# ---- user functions

@query("UDF1")
def group_transform(d: Data):
    positive = d.sales.where(F.col("units_sold") > 0).select(*KEY, "units_sold")
    week = feat.transform_groups(positive, "week_units", F.sum, frame=(-6, 0))
    return rounded(week.withColumn("share", F.col("units_sold") / F.col("week_units")).drop("week_units"))


class LinearPredictor:
    """Any object with ``predict`` can forecast."""

    def __init__(self, weights, intercept):
        self.weights, self.intercept = weights, intercept

    def predict(self, matrix):
        return matrix @ self.weights + self.intercept


@query("UDF2")
def foreign_model(d: Data):
    weights = [WEIGHTS.get(c, 0.0) for c in feat.FEATURES]
    rows = feat.feature_table(d.sales)
    return rounded(rows.select(*KEY, models.score_with(LinearPredictor(weights, INTERCEPT), rows).alias("prediction")), 4)


@query("UDF3")
def fit_by_group(d: Data):
    """The sequence model of each product; its scaling can be checked by SQL."""
    train, _ = feat.split_at(d.sales, SPLIT)
    return rounded(sequence.fit(train).select("product_id", "center", "scale", F.size("weights").alias("lags")), 4)
