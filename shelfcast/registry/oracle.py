"""DuckDB SQL for every query that SQL can express, over the same tables.

The statements share one list of common table expressions; DuckDB drops those a
statement does not use. Rounding goes through the shortest decimal text, as it
does in Spark, so that both engines round the same value half up.
"""

from __future__ import annotations

from shelfcast.functions import policy, pricing, text as words
from shelfcast.operators.explain import LABELS
from shelfcast.operators.features import FEATURES, LAGS, WINDOWS
from shelfcast.plans.portfolio import DISPLAY
from shelfcast.registry import queries as q
from shelfcast.registry.data import MODEL_SPELLINGS, PART_TYPES, QUESTION_TEMPLATES

WIDE = "DECIMAL(38,18)"


def r(expr: str, digits: int = 6) -> str:
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS {WIDE}), {digits}) AS DOUBLE)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def iso(column: str = "date") -> str:
    return f"CAST({column} AS VARCHAR) AS {column.split('.')[-1]}"


CELL_COLUMNS = "product_id, brand, product_name, category, lead_time_days"
PRICE = "CAST(CASE WHEN on_promo = 1 THEN round(list_price * 0.85, 2) ELSE list_price END AS DOUBLE)"

SALES = f"""
catalog AS (
  SELECT concat_ws('-', p_brand, p_type) AS product_id, p_brand AS brand,
         concat_ws(' ', p_brand, p_type) AS product_name, p_type AS category,
         CAST(3 + min(p_partkey) % 6 AS INTEGER) AS lead_time_days,
         min(CAST(p_retailprice AS DECIMAL(12,2))) AS list_price,
         min(p_partkey) AS first_part, CAST(sum(p_size) AS BIGINT) AS shelf_units, max(p_retailprice) AS top_price
  FROM part GROUP BY p_brand, p_type),
sold AS (
  SELECT concat_ws('-', p_brand, p_type) AS product_id, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(l_quantity) AS BIGINT) AS units_sold,
         CAST(max(l_discount) >= CAST(0.09 AS DOUBLE) AS INTEGER) AS on_promo
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
sales AS (
  SELECT date, {CELL_COLUMNS}, on_promo, {PRICE} AS unit_price, units_sold
  FROM sold JOIN catalog USING (product_id)),
days AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)),
                                     INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem),
panel_cells AS (
  SELECT d.date, c.*, coalesce(s.on_promo, 0) AS on_promo, coalesce(s.units_sold, 0) AS units_sold
  FROM catalog c CROSS JOIN days d LEFT JOIN sold s ON s.product_id = c.product_id AND s.date = d.date),
panel AS (SELECT date, {CELL_COLUMNS}, on_promo, {PRICE} AS unit_price, units_sold FROM panel_cells)"""


def sales_features(source: str) -> str:
    order = "PARTITION BY product_id ORDER BY date"
    columns = [
        "isodow(date) - 1 AS day_of_week", "month(date) AS month", "quarter(date) AS quarter",
        "CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend",
        "sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin", "cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos",
        "sin(2 * pi() * month(date) / 12) AS month_sin", "cos(2 * pi() * month(date) / 12) AS month_cos",
        f"CAST(coalesce(lag(on_promo, 7) OVER ({order}), 0) AS DOUBLE) AS on_promo_lag7"]
    columns += [f"CAST(lag(units_sold, {n}) OVER ({order}) AS DOUBLE) AS sales_lag_{n}" for n in LAGS]
    for w in WINDOWS:
        frame = f"OVER ({order} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        full = f"CASE WHEN count(units_sold) {frame} = {w} THEN"
        s, p = f"sum(units_sold) {frame}", f"sum(units_sold * units_sold) {frame}"
        columns += [
            f"{full} CAST({s} AS DOUBLE) / {w} END AS rolling_mean_{w}",
            f"{full} sqrt(CAST({w} * {p} - {s} * {s} AS DOUBLE) / ({w} * ({w} - 1))) END AS rolling_std_{w}",
            f"{full} CAST(min(units_sold) {frame} AS DOUBLE) END AS rolling_min_{w}",
            f"{full} CAST(max(units_sold) {frame} AS DOUBLE) END AS rolling_max_{w}"]
    return f"SELECT *, {', '.join(columns)} FROM {source}"


DERIVED = (["day_of_week", "month", "quarter", "is_weekend", "dow_sin", "dow_cos", "month_sin", "month_cos",
            "on_promo_lag7"] + [f"sales_lag_{n}" for n in LAGS]
           + [f"rolling_{s}_{w}" for w in WINDOWS for s in ("mean", "std", "min", "max")])
INTEGER_FEATURES = {"day_of_week", "month", "quarter", "is_weekend", "on_promo"}


def feature_columns(names) -> str:
    return ", ".join(f"CAST({n} AS INTEGER) AS {n}" if n in INTEGER_FEATURES else f"{r(n)} AS {n}" for n in names)


FEATURE_CTES = f"""
all_features AS ({sales_features('sales')}),
features AS (SELECT * FROM all_features WHERE sales_lag_30 IS NOT NULL AND rolling_std_30 IS NOT NULL)"""

# Demand of the last n rows, exact sums first.
RECENT = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS back FROM panel)"""


def recent(n: int) -> str:
    return f"""(SELECT product_id, total / n AS avg_daily, CASE WHEN gap > 0 THEN sqrt(gap / (n * n)) ELSE 2.0 END AS sigma
      FROM (SELECT product_id, CAST(count(*) AS DOUBLE) AS n, CAST(sum(units_sold) AS DOUBLE) AS total,
                   CAST(count(*) * sum(units_sold * units_sold) - sum(units_sold) * sum(units_sold) AS DOUBLE) AS gap
            FROM ranked WHERE back <= {n} GROUP BY product_id))"""


def naive(source: str, horizon: str) -> str:
    return f"""(SELECT product_id, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS forecast_date,
      CAST(units AS DOUBLE) AS predicted_units
      FROM (SELECT product_id, max(date) AS last_date, arg_max(units_sold, date) AS units FROM {source} GROUP BY product_id),
           (SELECT unnest(range(1, 1 + {horizon})) AS step))"""


def seasonal_naive(source: str, horizon: str) -> str:
    return f"""(SELECT product_id, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS forecast_date,
      CAST(week[(step - 1) % len(week) + 1] AS DOUBLE) AS predicted_units
      FROM (SELECT product_id, max(date) AS last_date, list(units_sold ORDER BY date) AS week
            FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS b FROM {source}) t
            WHERE b <= 7 GROUP BY product_id),
           (SELECT unnest(range(1, 1 + {horizon})) AS step))"""


DEMAND = f"""
demand AS (
  SELECT product_id, {r('total / n', 10)} AS avg_daily, {r('sqrt(gap / (n * n))', 10)} AS forecast_std, total AS forecast_total
  FROM (SELECT product_id, CAST(count(*) AS DOUBLE) AS n, sum(predicted_units) AS total,
               greatest(count(*) * sum(predicted_units * predicted_units) - sum(predicted_units) * sum(predicted_units), 0) AS gap
        FROM fc GROUP BY product_id))"""

Z_LIST = ", ".join(f"({p}, CAST({z!r} AS DOUBLE))" for p, z in policy.z_table().items())
Z = f"""
z_table(pct, z) AS (VALUES {Z_LIST}),
levels AS (SELECT product_id, 90 + (first_part % 19) / 2.0 AS service_level FROM catalog),
level_z AS (SELECT product_id, service_level, z FROM levels JOIN z_table ON pct = round_even(service_level, 0))"""

MD5_FACTOR = "CAST(concat('0x', md5({0})) AS UHUGEINT) % 100"


def opening_stock(key: str, rop: str) -> str:
    f = f"(CAST({md5_percent(key)} AS DOUBLE) / 100.0::DOUBLE)"
    (e1, b1, s1), (e2, b2, s2), (e3, b3, s3) = policy.STOCK_BANDS
    d = lambda v: f"CAST({v!r} AS DOUBLE)"
    factor = (f"CASE WHEN {f} < {d(e1)} THEN {d(b1)} + {d(s1)} * ({f} / {d(e1)}) "
              f"WHEN {f} < {d(e2)} THEN {d(b2)} + {d(s2)} * (({f} - {d(e1)}) / ({d(e2)} - {d(e1)})) "
              f"ELSE {d(b3)} + {d(s3)} * (({f} - {d(e2)}) / ({d(e3)} - {d(e2)})) END")
    return f"greatest(5, CAST(round_even({rop} * ({factor}), 0) AS BIGINT))"


def md5_percent(key: str) -> str:
    high = f"CAST(concat('0x', substr(md5({key}), 1, 16)) AS UHUGEINT)"
    low = f"CAST(concat('0x', substr(md5({key}), 17, 16)) AS UHUGEINT)"
    return f"CAST((({high} % 100) * 16 + {low} % 100) % 100 AS INTEGER)"


def risk_text(level: str, position: int) -> str:
    return "CASE " + level + " " + " ".join(
        f"WHEN {text(n)} THEN {text(t[position])}" for n, t in policy.RISK_TEXT.items()) + " END"


def risk_level(stock: str, rop: str, dos: str, lead: str) -> str:
    return (f"CASE WHEN {stock} < {rop} OR {dos} < {lead} THEN 'HIGH' "
            f"WHEN {stock} < {rop} * 1.30::DOUBLE OR {dos} < {lead} * 1.5::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END")


ATTRIBUTES = """
attributes AS (
  SELECT product_id, arg_min(brand, date) AS brand, arg_min(product_name, date) AS product_name,
         arg_min(category, date) AS category, arg_min(lead_time_days, date) AS lead_time_days,
         arg_min(unit_price, date) AS first_price, arg_max(unit_price, date) AS last_price
  FROM {0} GROUP BY product_id)"""

Z95 = f"CAST({policy.SERVICE_Z[95]} AS DOUBLE)"


def portfolio_ctes(forecast: str, source: str = "panel", overrides: str | None = None) -> str:
    """The portfolio table as CTEs ending in ``portfolio``."""
    given = f"LEFT JOIN ({overrides}) o USING (product_id)" if overrides else ""
    stock = opening_stock("product_id", "rop")
    stock = f"coalesce(o_stock, {stock})" if overrides else stock
    o_stock = "o.stock AS o_stock," if overrides else ""
    return f"""
fc AS (SELECT * FROM {forecast}), {DEMAND}, {ATTRIBUTES.format(source)},
p1 AS (SELECT a.*, {o_stock} CASE WHEN last_price < 2000 THEN last_price * 83 ELSE last_price END AS price,
              avg_daily, CASE WHEN forecast_std > 0 THEN forecast_std ELSE 2.0 END AS sigma, forecast_total
       FROM attributes a LEFT JOIN demand USING (product_id) {given}),
p2 AS (SELECT *, {Z95} * sigma * sqrt(lead_time_days) AS ss,
              avg_daily * lead_time_days + {Z95} * sigma * sqrt(lead_time_days) AS rop FROM p1),
p3 AS (SELECT *, {stock} AS stock FROM p2),
p4 AS (SELECT *, stock / CASE WHEN avg_daily > 0 THEN avg_daily ELSE 1.0::DOUBLE END AS dos,
              CASE WHEN avg_daily > 0 AND price > 0 THEN sqrt(2 * (avg_daily * 365) * 50 / (price * 0.25::DOUBLE)) ELSE 0.0 END AS eoq,
              stock < rop AS needs FROM p3),
p5 AS (SELECT *, CASE WHEN avg_daily IS NULL THEN 'ERROR' ELSE {risk_level('stock', 'rop', 'dos', 'lead_time_days')} END AS risk FROM p4),
portfolio AS (
  SELECT product_id, product_name, brand, category,
         CAST(CASE WHEN ok THEN stock ELSE 0 END AS BIGINT) AS current_stock,
         CASE WHEN ok THEN {r('avg_daily', 2)} ELSE 0.0 END AS avg_daily_demand,
         CASE WHEN ok THEN {r('sigma', 2)} ELSE 0.0 END AS forecast_std,
         CAST(CASE WHEN ok THEN round_even(forecast_total, 0) ELSE 0 END AS BIGINT) AS forecast_total,
         CASE WHEN ok THEN {r('ss', 2)} ELSE 0.0 END AS safety_stock,
         CASE WHEN ok THEN {r('rop', 2)} ELSE 0.0 END AS reorder_point,
         CASE WHEN ok THEN {r('dos', 2)} ELSE 0.0 END AS days_of_supply,
         {risk_text('risk', 1)} AS risk_badge,
         CAST(CASE WHEN ok AND needs THEN ceil(rop + avg_daily * 7 - stock) ELSE 0 END AS BIGINT) AS recommended_order_qty,
         {risk_text('risk', 0)} AS action, risk AS risk_level,
         CASE WHEN ok THEN {r('eoq', 2)} ELSE 0.0 END AS eoq,
         CASE WHEN ok THEN {r('avg_daily * 365', 2)} ELSE 0.0 END AS annual_demand,
         CAST(CASE WHEN ok THEN lead_time_days ELSE 0 END AS INTEGER) AS lead_time_days,
         CASE WHEN ok THEN {r('price', 2)} ELSE 0.0 END AS unit_price,
         CASE WHEN ok THEN needs ELSE false END AS needs_restock,
         CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED: no forecast' END AS status
  FROM (SELECT *, avg_daily IS NOT NULL AS ok FROM p5))"""


PORTFOLIO = portfolio_ctes(seasonal_naive("panel", "30"))

FIXED_STOCK = """
fc AS (SELECT * FROM {forecast}), {demand}, {attributes},
kpi AS (SELECT *, {z} * CASE WHEN forecast_std > 0 THEN forecast_std ELSE 2.0 END * sqrt(lead_time_days) AS ss,
               avg_daily * 365 AS annual FROM attributes JOIN demand USING (product_id)),
kpi2 AS (SELECT *, avg_daily * lead_time_days + ss AS rop FROM kpi),
fixed AS (
  SELECT product_id, product_name, category, lead_time_days, last_price AS unit_price, 14 AS horizon_days,
         {avg} AS avg_daily_demand, {std} AS forecast_std, {ss} AS safety_stock, {rop} AS reorder_point,
         {eoq} AS eoq, {annual} AS annual_demand, {dos} AS days_of_supply,
         {stock} < rop AS needs_restock,
         CAST(CASE WHEN {stock} < rop THEN ceil(rop + avg_daily * 7 - {stock}) ELSE 0 END AS BIGINT) AS recommended_order_qty
  FROM kpi2),
arrays AS (SELECT product_id, string_agg(printf('%.2f', {units}), ',' ORDER BY step) AS forecast,
                  string_agg(CAST(forecast_date AS VARCHAR), ',' ORDER BY step) AS forecast_dates
           FROM fc GROUP BY product_id)"""


def fixed_stock(stock: int) -> str:
    return FIXED_STOCK.format(
        forecast=seasonal_naive("panel", "14"), demand=DEMAND, attributes=ATTRIBUTES.format("panel"), z=Z95,
        avg=r("avg_daily", 2), std=r("forecast_std", 2), ss=r("ss", 2), rop=r("rop", 2), annual=r("annual", 2),
        eoq=r("CASE WHEN annual > 0 AND last_price > 0 THEN sqrt(2 * annual * 50 / (last_price * 0.25::DOUBLE)) ELSE 0.0 END", 2),
        dos=r(f"{stock} / CASE WHEN avg_daily > 0 THEN avg_daily ELSE 1.0::DOUBLE END", 2),
        units=r("predicted_units", 2), stock=stock)


HOLD_OUT_DAYS = f"(SELECT datediff('day', DATE '{q.SPLIT}', CAST(max(l_shipdate) AS DATE)) + 1 FROM lineitem)"


def hold_out(name: str, before: str, to: str | None, horizon: str) -> str:
    train = f"(SELECT * FROM panel WHERE date < DATE '{before}')"
    upto = f"AND p.date < DATE '{to}'" if to else ""
    return f"""
{name} AS (
  SELECT model, f.product_id, f.forecast_date, CAST(p.units_sold AS DOUBLE) AS actual, f.predicted_units
  FROM (SELECT 'Naive' AS model, * FROM {naive(train + ' t0', horizon)}
        UNION ALL SELECT 'Seasonal Naive' AS model, * FROM {seasonal_naive(train + ' t1', horizon)}) f
  JOIN panel p ON p.product_id = f.product_id AND p.date = f.forecast_date AND p.date >= DATE '{before}' {upto})"""


HOLD_OUT = hold_out("hold_out", q.SPLIT, None, HOLD_OUT_DAYS)
MAE, RMSE = "sum(abs(actual - predicted_units)) / count(*)", "sqrt(sum((actual - predicted_units) ** 2) / count(*))"
METRICS = f"""{HOLD_OUT},
metrics AS (SELECT model, {r(MAE, 3)} AS mae, {r(RMSE, 3)} AS rmse FROM hold_out GROUP BY model),
ranked_models AS (SELECT model, mae, rmse, CAST(row_number() OVER (ORDER BY mae, model) AS INTEGER) AS rank FROM metrics)"""

CELLS = """
sold_days AS (SELECT DISTINCT date FROM sales),
means AS (SELECT product_id, CAST(sum(units_sold) AS DOUBLE) / count(*) AS mean_units FROM sales GROUP BY product_id),
cells AS (SELECT m.product_id, d.date, coalesce(CAST(s.units_sold AS DOUBLE), mean_units) AS units
          FROM means m CROSS JOIN sold_days d LEFT JOIN sales s ON s.product_id = m.product_id AND s.date = d.date),
varied AS (SELECT product_id FROM cells GROUP BY product_id HAVING max(units) > min(units)),
centered AS (SELECT product_id, date, units - avg(units) OVER (PARTITION BY product_id) AS dev
             FROM cells WHERE product_id IN (SELECT product_id FROM varied)),
norms AS (SELECT product_id, sqrt(sum(dev * dev)) AS norm FROM centered GROUP BY product_id),
pairs AS (SELECT a.product_id AS product_a, b.product_id AS product_b,
                 sum(a.dev * b.dev) / (any_value(na.norm) * any_value(nb.norm)) AS similarity
          FROM centered a JOIN centered b ON a.date = b.date AND a.product_id < b.product_id
          JOIN norms na ON na.product_id = a.product_id JOIN norms nb ON nb.product_id = b.product_id GROUP BY 1, 2)"""
PAIRS3 = f"""{CELLS},
pairs3 AS (SELECT product_a, product_b, {r('similarity', 3)} AS similarity FROM pairs)"""


def named(pairs: str) -> str:
    return f"""SELECT p.*, a.product_name AS name_a, b.product_name AS name_b, a.category AS category_a, b.category AS category_b
    FROM ({pairs}) p JOIN catalog a ON a.product_id = product_a JOIN catalog b ON b.product_id = product_b"""


def best(n: int) -> str:
    return f"SELECT * FROM pairs3 WHERE similarity >= 0 ORDER BY similarity DESC, product_a, product_b LIMIT {n}"


def impact(pairs: str, source: str = "sales") -> str:
    return f"""SELECT p.*, coalesce(a.m, 0.0) AS avg_daily_sales_a, coalesce(b.m, 0.0) AS avg_daily_sales_b,
           {r('coalesce(a.m, 0.0) + coalesce(b.m, 0.0)', 2)} AS bundle_avg_daily_sales
    FROM ({pairs}) p
    LEFT JOIN (SELECT product_id, {r('CAST(sum(units_sold) AS DOUBLE) / count(*)', 2)} AS m FROM {source} GROUP BY product_id) a ON a.product_id = product_a
    LEFT JOIN (SELECT product_id, {r('CAST(sum(units_sold) AS DOUBLE) / count(*)', 2)} AS m FROM {source} GROUP BY product_id) b ON b.product_id = product_b"""


REQUESTS = f"""
requests AS (
  SELECT o_orderkey AS request_id,
         concat('Brand#', 1 + o_custkey % 27, '-', {listed(PART_TYPES)}[1 + o_orderkey % {len(PART_TYPES)}]) AS product_id,
         {listed(MODEL_SPELLINGS)}[1 + o_orderkey % {len(MODEL_SPELLINGS)}] AS model_text,
         CAST(7 + o_custkey % 8 AS INTEGER) AS horizon FROM orders),
aliases(alias, model) AS (VALUES {', '.join(f'({text(a)}, {text(m)})' for a, m in words.MODEL_ALIASES.items())}),
names(model) AS (VALUES {', '.join(f'({text(m)})' for m in words.MODEL_NAMES)}),
resolved AS (
  SELECT request_id, product_id, horizon,
         CASE WHEN coalesce(model_text, '') = '' THEN 'XGBoost' ELSE coalesce(a.model, n.model) END AS model
  FROM requests
  LEFT JOIN aliases a ON a.alias = replace(replace(lower(trim(model_text)), '-', '_'), ' ', '_')
  LEFT JOIN names n ON lower(n.model) = lower(trim(model_text)))"""

TEMPLATES = ", ".join(f"({i}, {text(t)}, {str(s).lower()})" for i, (t, s) in enumerate(QUESTION_TEMPLATES))
SPACE = "concat(' ', chr(9), chr(10), chr(13), chr(11), chr(12))"
QUESTIONS = f"""
templates(i, template, selected) AS (VALUES {TEMPLATES}),
questions AS (
  SELECT concat_ws('#', product_id, i) AS question_id,
         replace(replace(replace(template, '{{name}}', product_name), '{{id}}', product_id), '{{brand}}', brand) AS text,
         CASE WHEN selected THEN upper(product_name) END AS selected_product
  FROM catalog CROSS JOIN templates
  UNION ALL SELECT concat_ws('#', 'turn', conv_id, turn), text, NULL FROM conversations),
asked AS (SELECT *, lower(trim(text, {SPACE})) AS clean FROM questions),
matches AS (
  SELECT question_id, arg_min(product_id, (-length(product_name), product_id)) AS matched_product
  FROM asked JOIN catalog ON contains(clean, lower(product_id)) OR contains(clean, lower(product_name))
  GROUP BY question_id)"""


def any_of(terms, column: str = "clean") -> str:
    return "(" + " OR ".join(f"contains({column}, {text(t)})" for t in terms) + ")"


def whole_word(column: str = "clean") -> str:
    edge = r"[^\p{L}\p{N}_]"
    return f"regexp_matches({column}, '(^|{edge})({'|'.join(words.GREETING_WORDS)})({edge}|$)')"


GREETING = f"({whole_word()} OR {any_of(words.GREETING_PHRASES)})"
CONTEXT = f"""
selected_ids AS (SELECT lower(product_name) AS selected_key, min(product_id) AS selected_id FROM catalog GROUP BY 1),
known AS (
  SELECT a.question_id, clean, coalesce(matched_product, selected_id) AS product_id
  FROM asked a LEFT JOIN {{matches}} m USING (question_id)
  LEFT JOIN selected_ids s ON matched_product IS NULL AND {any_of(words.CONTEXT_WORDS)} AND selected_key = lower(selected_product))"""

ELASTIC = ", ".join(f"({text(c)}, CAST({e!r} AS DOUBLE))" for c, e in q.ELASTICITY.items())


def noise(shop: str) -> str:
    low, high = pricing.SHOP_NOISE[shop]
    step = f"CAST(CAST(concat('0x', substr(md5(concat_ws('|', product_id, '{shop}')), 1, 8)) AS BIGINT) % {pricing.NOISE_STEPS} AS DECIMAL(5,0))"
    return (f"CAST(round(our_price * ({1 + low} + CAST({(high - low) / pricing.NOISE_STEPS:f} AS DECIMAL(9,6)) * {step}), 2) AS DECIMAL(14,2))")


def shop(offer: str, name: str) -> str:
    return f"coalesce(CASE WHEN {offer} > 0 THEN CAST({offer} AS DECIMAL(14,2)) END, {noise(name)}) AS {name}_price"


def prices(elasticities: str = "(NULL, NULL)") -> str:
    gap = "gap"
    one = lambda v, f="{:.1f}": f"format('{f}', {r(v, 1)})"
    fill = {"{gap}": one("abs(gap)"), "{price}": "format('{:,.2f}', CAST(average AS DOUBLE))",
            "{demand}": one("abs(impact)"), "{signed}": one("gap", "{:+.1f}")}

    def sentence(template: str) -> str:
        parts = [text(template)]
        for mark, expr in fill.items():
            parts = [piece for p in parts for piece in _split(p, mark, expr)]
        return "concat(" + ", ".join(parts) + ")"

    texts = " ".join(f"WHEN {text(n)} THEN {sentence(t)}" for n, t in pricing.THREAT_TEXT.items())
    badges = " ".join(f"WHEN {text(n)} THEN {text(t)}" for n, t in pricing.THREAT_BADGES.items())
    return f"""{ATTRIBUTES.format('sales')},
elasticity(category, e) AS (VALUES {elasticities}),
ours AS (SELECT product_id, category,
                CAST(CASE WHEN last_price < 2000 THEN CAST(last_price AS DECIMAL(12,2)) * 83 ELSE CAST(last_price AS DECIMAL(12,2)) END AS DECIMAL(14,2)) AS our_price
         FROM attributes),
offers AS (SELECT product_id, CASE WHEN first_part % 3 = 0 THEN {r('top_price * 80', 2)} END AS amazon_offer,
                  CASE WHEN first_part % 4 = 0 THEN {r('top_price * 90', 2)} ELSE 0.0 END AS flipkart_offer,
                  CAST(NULL AS DOUBLE) AS reliance_offer FROM catalog),
shops AS (SELECT product_id, category, our_price, {shop('amazon_offer', 'amazon')}, {shop('flipkart_offer', 'flipkart')},
                 {shop('reliance_offer', 'reliance')} FROM ours LEFT JOIN offers USING (product_id)),
averaged AS (SELECT *, CAST(round(CAST(amazon_price + flipkart_price + reliance_price AS DECIMAL(30,12)) / 3, 2) AS DECIMAL(14,2)) AS average FROM shops),
gaps AS (SELECT a.*, CASE WHEN average > 0 THEN {r('CAST(our_price AS DOUBLE) / CAST(average AS DOUBLE)', 3)} ELSE 1.0 END AS price_index,
                {r('(CAST(our_price AS DOUBLE) - CAST(average AS DOUBLE)) * 100 / CAST(average AS DOUBLE)', 2)} AS gap,
                coalesce(e, -1.5::DOUBLE) AS ped
         FROM averaged a LEFT JOIN elasticity USING (category)),
impacts AS (SELECT *, {r('-gap * abs(ped)', 1)} AS impact,
                   CASE WHEN {gap} > 6 THEN 'CRITICAL_UNDERPRICING_THREAT' WHEN {gap} < -6 THEN 'MARGIN_EXPANSION_OPPORTUNITY'
                        WHEN {gap} IS NOT NULL THEN 'MARKET_PARITY' END AS level FROM gaps),
threats AS (SELECT *, CASE level {badges} END AS threat_badge, CASE level {texts} END AS recommendation FROM impacts)"""


def _split(piece: str, mark: str, expr: str) -> list[str]:
    if not piece.startswith("'") or mark not in piece:
        return [piece]
    left, _, right = piece.partition(mark)
    return [left + "'", expr, *_split("'" + right, mark, expr)]


POLICY_BASE = f"""{RECENT}, {ATTRIBUTES.format('(SELECT * FROM ranked WHERE back <= 14) t14')}, {Z},
base AS (SELECT product_id, avg_daily, sigma, lead_time_days, last_price, z, CAST(60 AS BIGINT) AS stock,
                z * sigma * sqrt(lead_time_days) AS ss, avg_daily * lead_time_days AS ltd,
                avg_daily * lead_time_days + z * sigma * sqrt(lead_time_days) AS rop,
                60 / CASE WHEN avg_daily > 0 THEN avg_daily ELSE 1.0::DOUBLE END AS dos
         FROM {recent(14)} JOIN attributes USING (product_id) JOIN level_z USING (product_id))"""

# Features of the next days with the last sale repeated, by window frames over history plus future rows.
_HOLD = "PARTITION BY product_id ORDER BY date"


def hold_features() -> str:
    columns = []
    for n in LAGS:
        columns.append(f"CAST(lag(units_sold, {n}) OVER ({_HOLD}) AS DOUBLE) AS sales_lag_{n}")
    for w in WINDOWS:
        frame = f"OVER ({_HOLD} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        n, s, p = f"count(*) {frame}", f"sum(units_sold) {frame}", f"sum(units_sold * units_sold) {frame}"
        columns += [f"CAST({s} AS DOUBLE) / {n} AS rolling_mean_{w}",
                    f"sqrt(CAST({n} * {p} - {s} * {s} AS DOUBLE) / ({n} * {n})) AS rolling_std_{w}",
                    f"CAST(min(units_sold) {frame} AS DOUBLE) AS rolling_min_{w}",
                    f"CAST(max(units_sold) {frame} AS DOUBLE) AS rolling_max_{w}"]
    return ", ".join(columns)


def hold_last(horizon: int) -> str:
    return f"""{RECENT},
ends AS (SELECT product_id, max(date) AS last_date, arg_max(units_sold, date) AS last_units,
                arg_max(unit_price, date) AS last_price FROM panel GROUP BY product_id),
grown AS (
  SELECT product_id, 0 AS step, date, units_sold, on_promo, unit_price FROM ranked WHERE back <= 30
  UNION ALL SELECT product_id, step, CAST(last_date + CAST(step AS INTEGER) AS DATE), last_units, 0, last_price
  FROM ends, (SELECT CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS step)),
held_all AS (
  SELECT product_id, step, date, CAST(isodow(date) - 1 AS DOUBLE) AS day_of_week, CAST(month(date) AS DOUBLE) AS month,
         CAST(quarter(date) AS DOUBLE) AS quarter, CAST(isodow(date) >= 6 AS DOUBLE) AS is_weekend,
         sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos,
         sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos,
         CAST(on_promo AS DOUBLE) AS on_promo, CAST(lag(on_promo, 7) OVER ({_HOLD}) AS DOUBLE) AS on_promo_lag7,
         unit_price, {hold_features()}
  FROM grown),
held AS (SELECT * FROM held_all WHERE step > 0)"""


def linear_terms(value) -> str:
    return " + ".join([f"CAST({q.INTERCEPT} AS DOUBLE)"] + [f"CAST({w} AS DOUBLE) * {value(c)}" for c, w in q.WEIGHTS.items()])


def _state_value(name: str) -> str:
    tail = lambda w: f"list_slice(units, len(units) - {w - 1}, len(units))"
    day = "CAST(last_date + step + 1 AS DATE)"
    if name.startswith("sales_lag_"):
        return f"units[len(units) - {int(name[10:]) - 1}]"
    if name.startswith("rolling_"):
        _, stat, w = name.split("_")
        fn = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}[stat]
        return f"list_aggregate({tail(int(w))}, '{fn}')"
    return {"is_weekend": f"CAST(isodow({day}) >= 6 AS DOUBLE)", "month_sin": f"sin(2 * pi() * month({day}) / 12)",
            "on_promo_lag7": "promos[len(promos) - 6]", "unit_price": "unit_price"}[name]


RECURSIVE_LINEAR = f"""{RECENT},
start AS (SELECT product_id, max(date) AS last_date, arg_max(unit_price, date) AS unit_price,
                 list(CAST(units_sold AS DOUBLE) ORDER BY date) AS units, list(CAST(on_promo AS DOUBLE) ORDER BY date) AS promos
          FROM ranked WHERE back <= 30 GROUP BY product_id),
state AS (
  SELECT product_id, last_date, unit_price, units, promos, 0 AS step FROM start
  UNION ALL
  SELECT product_id, last_date, unit_price, list_append(units, greatest(0.0::DOUBLE, {linear_terms(_state_value)})),
         list_append(promos, 0.0::DOUBLE), step + 1 FROM state WHERE step < 14)"""

SERIES = """
series AS (SELECT product_id, max(date) AS last_date, list(CAST(units_sold AS DOUBLE) ORDER BY date) AS ys FROM sales
           GROUP BY product_id HAVING count(*) >= 14 AND min(units_sold) > 0)"""


def smoothing(sets: str) -> str:
    return f"""{SERIES},
points AS (SELECT product_id, date, CAST(row_number() OVER (PARTITION BY product_id ORDER BY date) AS INTEGER) AS t,
                  CAST(units_sold AS DOUBLE) AS y FROM sales),
sets(alpha, beta, gamma) AS ({sets}),
hw AS (
  SELECT product_id, alpha, beta, gamma, 7 AS t, list_sum(ys[1:7]) / 7 AS level,
         (list_sum(ys[8:14]) / 7 - list_sum(ys[1:7]) / 7) / 7 AS trend,
         list_transform(ys[1:7], lambda v: v / (list_sum(ys[1:7]) / 7)) AS season, CAST(0 AS DOUBLE) AS sse
  FROM series CROSS JOIN sets
  UNION ALL
  SELECT product_id, alpha, beta, gamma, t + 1, moved, beta * (moved - level) + (1 - beta) * trend,
         list_append(season[2:], gamma * (y / base) + (1 - gamma) * s), sse + (y - base * s) * (y - base * s)
  FROM (SELECT *, alpha * (y / s) + (1 - alpha) * base AS moved
        FROM (SELECT hw.*, points.y, season[1] AS s, level + trend AS base
              FROM hw JOIN points ON points.product_id = hw.product_id AND points.t = hw.t + 1))),
fitted AS (SELECT * FROM (
  SELECT hw.*, last_date, ys, row_number() OVER (PARTITION BY hw.product_id ORDER BY sse, alpha, beta, gamma) AS k
  FROM hw JOIN series ON series.product_id = hw.product_id AND hw.t = len(ys) WHERE isfinite(sse)) WHERE k = 1)"""


GRID = ("SELECT a.v, b.v, c.v FROM (SELECT unnest(range(1, 10)) / 10 AS v) a, (SELECT unnest(range(1, 10)) / 10 AS v) b, "
        "(SELECT unnest(range(1, 10)) / 10 AS v) c")


def weights_of(source: str, background: str) -> str:
    """Contributions of the set linear model, one row per feature."""
    rows = " UNION ALL ".join(
        f"SELECT product_id, date, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
        + (f"CAST({q.WEIGHTS[c]} AS DOUBLE) * (CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM {background}))"
           if c in q.WEIGHTS else "0.0")
        + f" AS contribution FROM {source}" for c in FEATURES)
    return f"contributions AS ({rows})"


LABEL_CASE = "CASE feature " + " ".join(f"WHEN '{c}' THEN {text(v)}" for c, v in LABELS.items()) + " END"

GENERATOR = """
cells0 AS (
  SELECT c.*, CAST(6 + first_part % 20 AS INTEGER) AS base_demand, CAST(d AS DATE) AS date,
         md5(concat_ws('|', product_id, CAST(CAST(d AS DATE) AS VARCHAR))) AS h
  FROM catalog c, (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS d)),
cells1 AS (
  SELECT *, (CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u0,
         (CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u1,
         (CAST(concat('0x', substr(h, 17, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u2 FROM cells0),
cells2 AS (SELECT *, CAST(u2 < 0.10::DOUBLE AS INTEGER) AS on_promo, sqrt(-2 * ln(u0)) * cos(2 * pi() * u1) AS z FROM cells1),
synthetic AS (
  SELECT *, base_demand * CASE WHEN isodow(date) >= 6 THEN 1.35::DOUBLE ELSE 1.0::DOUBLE END
    * CASE WHEN category = 'ECONOMY' AND month(date) IN (4, 5, 6, 7) THEN 2.0::DOUBLE
           WHEN category = 'PROMO' AND month(date) IN (11, 12, 1, 2) THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
    * CASE WHEN month(date) IN (11, 12) THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END
    * CASE WHEN on_promo = 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS demand FROM cells2)"""


def sql(body: str, *ctes: str) -> str:
    return f"WITH RECURSIVE {', '.join([SALES, *ctes])}\n{body}"


SALES_COLUMNS = f"{iso()}, {CELL_COLUMNS}, on_promo, unit_price, units_sold"
KEYED = f"product_id, {iso()}"


def window_query(names) -> str:
    return sql(f"SELECT {KEYED}, units_sold, {', '.join(f'{r(n)} AS {n}' for n in names)} FROM all_features", FEATURE_CTES)


def _queries() -> dict[str, str]:
    o: dict[str, str] = {}
    o["SRC1"] = sql(f"SELECT {SALES_COLUMNS} FROM sales")
    o["SRC2"] = sql(f"SELECT {KEYED}, units_sold, sales_lag_30, {r('rolling_mean_7')} AS rolling_mean_7, "
                    f"{r('rolling_std_30')} AS rolling_std_30 FROM features", FEATURE_CTES)
    o["SRC3"] = sql(
        f"SELECT {iso()}, {CELL_COLUMNS}, on_promo, CAST(round(CASE WHEN on_promo = 1 THEN list_price * 83 * 0.85 "
        "ELSE list_price * 83 END, 2) AS DOUBLE) AS unit_price, "
        "greatest(0, CAST(floor(demand * (1 + 0.05::DOUBLE * z)) AS BIGINT)) AS units_sold FROM synthetic", GENERATOR)
    o["SRC4"] = sql(f"SELECT {SALES_COLUMNS} FROM sales WHERE date >= DATE '{q.SPLIT}'")
    products = "SELECT DISTINCT product_id, product_name, category, lead_time_days FROM sales"
    o["SRC5"] = sql(products)
    o["SNK1"] = sql("SELECT category, count(*) AS n, CAST(sum(units_sold) AS BIGINT) AS units FROM sales GROUP BY category")
    view = "SELECT " + ", ".join(f'{c} AS "{label}"' for c, label in DISPLAY.items()) + " FROM portfolio"
    o["SNK2"] = sql(view, PORTFOLIO)
    o["SNK3"] = sql("SELECT * FROM ranked_models", METRICS)
    o["SNK4"] = sql("SELECT 'products' AS table_name, count(DISTINCT product_id) AS n FROM sales "
                    "UNION ALL SELECT unnest(['sales', 'forecasts', 'stock_policy']), 0")
    o["SNK5"] = sql(
        "SELECT product_id, CASE WHEN min(date) < DATE '1995-01-05' THEN upper(any_value(product_name)) "
        "ELSE any_value(product_name) END AS product_name, any_value(category) AS category, "
        "any_value(lead_time_days) AS lead_time_days FROM sales GROUP BY product_id")
    o["SNK6"] = sql(f"SELECT {iso()}, product_id, on_promo, unit_price, "
                    "CAST(CASE WHEN date < DATE '1998-01-01' THEN 0 ELSE units_sold END AS BIGINT) AS units_sold FROM sales")
    o["SNK7"] = sql(f"SELECT product_id, 'Seasonal Naive' AS model_name, {iso('forecast_date')}, predicted_units "
                    f"FROM {seasonal_naive('panel', '14')}")
    o["SNK8"] = sql("SELECT product_id, 'Seasonal Naive' AS model_name, avg_daily_demand, safety_stock, reorder_point, eoq, "
                    "days_of_supply, CAST(needs_restock AS INTEGER) AS needs_restock, recommended_order_qty FROM fixed",
                    fixed_stock(60))

    o["SNK9"] = sql(f"""SELECT model, product_id, CAST(date AS VARCHAR) AS forecast_date, true AS agrees
        FROM features, (SELECT unnest(['Linear Regression', 'Support Vector (RBF)']) AS model) WHERE date >= DATE '{q.SPLIT}'
        UNION ALL SELECT 'Seasonal Baseline (Holt-Winters)', product_id, CAST(CAST(last_date + step AS DATE) AS VARCHAR), true
        FROM series, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS step)""", FEATURE_CTES, SERIES)

    parts = "CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend"
    o["PRJ1"] = sql(f"SELECT {KEYED}, {parts} FROM sales")
    o["PRJ2"] = sql(f"SELECT {KEYED}, " + ", ".join(f"{r(c)} AS {c}" for c in DERIVED[4:8]) + " FROM all_features", FEATURE_CTES)
    o["PRJ3"] = sql(f"SELECT {KEYED}, {feature_columns(FEATURES)} FROM features", FEATURE_CTES)
    o["PRJ4"] = ("SELECT p_partkey, CAST(CASE WHEN CAST(p_retailprice AS DECIMAL(12,2)) < 2000 THEN CAST(p_retailprice AS DECIMAL(12,2)) * 83 "
                 "ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS DOUBLE) AS price FROM part")
    o["PRJ5"] = sql(view, portfolio_ctes(naive("panel", "30")))
    o["FLT1"] = sql(f"SELECT {KEYED}, units_sold, sales_lag_14, name_hint FROM (SELECT *, lag(units_sold, 14) OVER "
                    "(PARTITION BY product_id ORDER BY date) AS sales_lag_14, CASE WHEN units_sold > 5 THEN product_name END "
                    "AS name_hint FROM sales) WHERE sales_lag_14 IS NOT NULL AND name_hint IS NOT NULL")
    o["FLT2"] = sql(f"SELECT {KEYED}, units_sold, CASE WHEN date < DATE '{q.SPLIT}' THEN 'train' ELSE 'test' END AS part FROM sales")
    wanted = [("Brand#2|All Categories", "brand = 'Brand#2'"), ("All Brands|PROMO", "category = 'PROMO'"),
              ("Brand#2|ECONOMY", "brand = 'Brand#2' AND category = 'ECONOMY'"), ("|LARGE", "category = 'LARGE'")]
    o["FLT3"] = sql(" UNION ALL ".join(
        f"SELECT product_id, CAST(sum(units_sold) AS BIGINT) AS units, '{n}' AS filter FROM sales WHERE {w} GROUP BY product_id"
        for n, w in wanted))
    o["FLT4"] = sql(f"SELECT {SALES_COLUMNS} FROM sales WHERE product_id = '{q.ONE_PRODUCT}'")
    o["FLT5"] = sql("SELECT request_id, product_id FROM requests WHERE product_id NOT IN (SELECT product_id FROM catalog)", REQUESTS)
    o["FLT6"] = sql("SELECT product_id, risk_level, days_of_supply FROM portfolio WHERE risk_level IN ('HIGH', 'MEDIUM')", PORTFOLIO)
    o["FLT7"] = sql("SELECT risk_level, product_id, days_of_supply AS x, avg_daily_demand AS y, "
                    f"{r('least(greatest(current_stock / 8.0::DOUBLE + 12, 12), 35)', 4)} AS marker_size FROM portfolio "
                    "WHERE risk_level <> 'ERROR'", PORTFOLIO)
    o["FLT8"] = sql("SELECT * FROM pairs3 WHERE similarity >= 0.02::DOUBLE", PAIRS3)
    o["FLT9"] = sql(f"SELECT {KEYED}, {r('greatest(units_sold * 0.5::DOUBLE - sales_lag_1 * 0.25::DOUBLE, 0)')} AS predicted_units "
                    "FROM all_features WHERE sales_lag_1 IS NOT NULL", FEATURE_CTES)

    o["JN1"] = sql(f"SELECT product_id, {iso()} FROM catalog CROSS JOIN days")
    o["JN2"] = sql("SELECT a.product_id AS product_a, b.product_id AS product_b FROM varied a JOIN varied b ON a.product_id < b.product_id", CELLS)
    o["JN3"] = sql(named("SELECT a.product_id AS product_a, b.product_id AS product_b FROM varied a JOIN varied b ON a.product_id < b.product_id"), CELLS)
    o["JN4"] = sql(impact("SELECT a.product_id AS product_a, b.product_id AS product_b FROM varied a JOIN varied b ON a.product_id < b.product_id",
                          "(SELECT * FROM sales WHERE category <> 'SMALL') t"), CELLS)
    overridden = portfolio_ctes(seasonal_naive("panel", "30"), overrides="SELECT product_id, shelf_units AS stock FROM catalog WHERE lead_time_days >= 6")
    o["JN5"] = sql("SELECT product_id, current_stock, risk_level FROM portfolio", overridden)
    o["JN6"] = sql(f"SELECT product_id, category, coalesce(e, -1.5::DOUBLE) AS ped FROM catalog LEFT JOIN (VALUES {ELASTIC}) t(category, e) USING (category)")
    o["JN7"] = sql("SELECT * FROM matches", QUESTIONS)
    o["JN8"] = sql(f"SELECT {iso()}, product_id, on_promo, unit_price, units_sold FROM sales WHERE on_promo <> 1")
    lately = "(SELECT * FROM sales WHERE date > (SELECT max(date) - 7 FROM days)) late"
    o["JN9"] = sql("SELECT product_id, current_stock, avg_daily_demand, forecast_total, reorder_point, action, risk_level, "
                   "lead_time_days, unit_price, needs_restock, status FROM portfolio",
                   portfolio_ctes(naive(lately, "30"), source="sales"))
    o["JN10"] = sql(f"SELECT {KEYED}, {r('units')} AS units FROM cells", CELLS)

    o["AGG1"] = sql("SELECT count(DISTINCT product_id) AS products, count(*) AS records FROM sales")
    o["AGG2"] = sql("SELECT DISTINCT product_id, brand, product_name, category, lead_time_days FROM sales")
    mean = "SELECT product_id, CAST(sum(units_sold) AS DOUBLE) / count(*) AS m FROM sales GROUP BY product_id"
    o["AGG3"] = sql(f"SELECT product_id, {r('m')} AS avg_daily FROM ({mean})")
    o["AGG4"] = sql(f"SELECT * FROM (PIVOT (SELECT {iso()}, product_id, {r('units')} AS units FROM cells) "
                    "ON product_id USING max(units) GROUP BY date)", CELLS)
    o["AGG5"] = sql(" UNION ALL ".join(
        f"SELECT product_id, {r('avg_daily')} AS avg_daily, {r('sigma')} AS sigma, {n} AS days FROM {recent(n)}" for n in (14, 30)), RECENT)
    first = "CASE WHEN step <= 30 THEN predicted_units END"
    o["AGG6"] = sql(f"""SELECT d.product_id, {r('avg_daily', 4)} AS avg_daily, {r('forecast_std', 4)} AS forecast_std,
        {r('forecast_total', 4)} AS forecast_total, month_total, {r('month_avg', 4)} AS month_avg FROM demand d JOIN
        (SELECT product_id, CAST(floor(sum({first})) AS BIGINT) AS month_total, avg({first}) AS month_avg FROM fc GROUP BY product_id) USING (product_id)""",
                    f"fc AS (SELECT * FROM {seasonal_naive('panel', '45')})", DEMAND)
    o["AGG7"] = sql("SELECT product_id, max(predicted_units) AS peak_units, CAST(arg_max(forecast_date, (predicted_units, -step)) AS VARCHAR) AS peak_date "
                    f"FROM {seasonal_naive('panel', '30')} GROUP BY product_id")
    o["AGG8"] = sql("SELECT count(*) AS total_products, count(*) FILTER (risk_level = 'HIGH') AS high_risk_count, "
                    "count(*) FILTER (risk_level = 'MEDIUM') AS medium_risk_count, count(*) FILTER (risk_level = 'LOW') AS healthy_count, "
                    "CAST(coalesce(sum(recommended_order_qty), 0) AS BIGINT) AS total_recommended_order, "
                    "CAST(coalesce(sum(forecast_total), 0) AS BIGINT) AS total_forecasted_demand FROM portfolio", PORTFOLIO)
    o["AGG9"] = sql(f"SELECT {r('CAST(sum(units_sold) AS DOUBLE) / count(*)')} AS mean_units FROM panel")
    o["AGG10"] = sql("SELECT * FROM attributes", ATTRIBUTES.format("sales"))
    o["AGG11"] = sql(f"SELECT product_a, product_b, {r('similarity', 4)} AS similarity FROM pairs", CELLS)
    spearman = CELLS.replace("cells AS (", "plain AS (", 1).replace(
        "varied AS (", "cells AS (SELECT product_id, date, rank() OVER (PARTITION BY product_id ORDER BY units) + "
        "(count(*) OVER (PARTITION BY product_id, units) - 1) / 2.0::DOUBLE AS units FROM plain),\nvaried AS (", 1)
    o["AGG12"] = sql(f"SELECT product_a, product_b, {r('similarity', 4)} AS similarity FROM pairs", spearman)
    o["AGG13"] = sql(f"SELECT product_a, product_b, {r('similarity', 4)} AS similarity FROM pairs UNION ALL "
                     f"SELECT product_b, product_a, {r('similarity', 4)} FROM pairs UNION ALL SELECT product_id, product_id, 1.0 FROM catalog", CELLS)

    o["WIN1"] = window_query([f"sales_lag_{n}" for n in LAGS])
    o["WIN2"] = window_query(["on_promo_lag7"])
    for key, stat in (("WIN3", "mean"), ("WIN4", "std"), ("WIN5", "min"), ("WIN6", "max")):
        o[key] = window_query([f"rolling_{stat}_{w}" for w in WINDOWS])
    o["WIN7"] = sql(f"SELECT {KEYED}, units_sold, CAST(n AS INTEGER) AS days FROM (SELECT *, row_number() OVER (PARTITION BY product_id "
                    "ORDER BY date DESC) AS back FROM sales) JOIN (SELECT unnest([7, 14, 30, 60]) AS n) ON back <= n")
    o["WIN8"] = sql(f"SELECT {KEYED}, units_sold AS target, array_to_string(w, ',') AS \"window\" FROM (SELECT *, list(units_sold) OVER "
                    "(PARTITION BY product_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS w FROM sales) WHERE len(w) = 30")
    o["WIN9"] = sql(f"""SELECT {KEYED}, units_sold, {r('center')} AS center, {r('scale')} AS scale,
        {r('(units_sold - center) / scale')} AS scaled, {r('units_sold')} AS restored FROM sales JOIN
        (SELECT product_id, s / n AS center, CASE WHEN gap > 0 THEN sqrt(gap / (n * n)) ELSE 1.0 END AS scale FROM
          (SELECT product_id, CAST(count(*) AS DOUBLE) AS n, CAST(sum(units_sold) AS DOUBLE) AS s,
                  CAST(count(*) * sum(units_sold * units_sold) - sum(units_sold) * sum(units_sold) AS DOUBLE) AS gap
           FROM sales WHERE date < DATE '{q.SPLIT}' GROUP BY product_id)) USING (product_id)""")
    o["WIN10"] = sql(f"SELECT product_id, step, {iso()}, " + ", ".join(f"{r(c)} AS {c}" for c in FEATURES) + " FROM held", hold_last(14))
    o["WIN11"] = sql(f"SELECT {SALES_COLUMNS}, {feature_columns(DERIVED)} FROM features", FEATURE_CTES)

    o["SRT1"] = o["SRC1"]
    o["SRT2"] = sql(f"SELECT product_id, {r('m')} AS avg_daily FROM ({mean}) ORDER BY m DESC, product_id LIMIT 5")
    o["SRT3"] = sql("SELECT * FROM pairs3 ORDER BY similarity DESC, product_a, product_b LIMIT 10", PAIRS3)
    o["SRT4"] = sql("SELECT product_id, product_name, brand, current_stock, avg_daily_demand, reorder_point, days_of_supply, "
                    "recommended_order_qty, action FROM portfolio WHERE risk_level IN ('HIGH', 'MEDIUM')", PORTFOLIO)
    alerts = f"""alerts AS (SELECT brand, product_name, product_id, rop, stock, avg_daily FROM (
        SELECT *, avg_daily * lead_time_days + {Z95} * sigma * sqrt(lead_time_days) AS rop,
               CASE WHEN lower(product_name) = '{{0}}' THEN 5 ELSE 60 END AS stock
        FROM {recent(14)} JOIN catalog USING (product_id)) WHERE stock < rop)"""
    pick = ("SELECT brand, product_name, product_id, CAST(ceil(rop) AS BIGINT) AS reorder_point, "
            "CAST(ceil(rop + avg_daily * 7 - stock) AS BIGINT) AS order_qty FROM alerts")
    o["SRT5"] = sql(pick + " ORDER BY brand, product_name LIMIT 10", RECENT, alerts.format(""))
    o["SRT6"] = sql(f"""SELECT epoch, val_mae, val_rmse FROM (SELECT CAST(datediff('day', DATE '{q.SPLIT}', forecast_date) + 1 AS INTEGER) AS epoch,
        {r(MAE)} AS val_mae, {r(RMSE)} AS val_rmse, max(epoch) OVER () AS n FROM hold_out WHERE model = 'Naive' GROUP BY forecast_date)
        WHERE (epoch - 1) % greatest(1, n // 15) = 0 OR epoch = n""", HOLD_OUT)
    o["SRT7"] = sql(f"SELECT {KEYED}, units_sold FROM sales ORDER BY md5(concat_ws('|', '42', product_id, CAST(sales.date AS VARCHAR))), product_id, sales.date LIMIT 500")
    o["SET1"] = sql(f"SELECT {KEYED}, CAST(units_sold AS DOUBLE) AS units, 'history' AS kind FROM sales UNION ALL "
                    f"SELECT product_id, CAST(forecast_date AS VARCHAR), predicted_units, 'forecast' FROM {naive('sales', '14')}")
    o["SET2"] = sql(f"SELECT model, product_id, {iso('forecast_date')}, actual, predicted_units FROM hold_out", HOLD_OUT)

    o["FN1"] = sql("SELECT request_id, model FROM resolved", REQUESTS)
    o["FN2"] = sql("SELECT request_id, replace(replace(replace(lower(model), ' ', '_'), '_rbf_', '_'), '(rbf)', 'svr') AS slug FROM resolved", REQUESTS)
    o["FN3"] = sql(f"SELECT question_id, {GREETING} AS greeting, " + ", ".join(
        f"{any_of(t)} AS {n}" for n, t in words.INTENT_WORDS.items()) + " FROM asked", QUESTIONS)
    dossier = f"""{RECENT}, {ATTRIBUTES.format('panel')},
dossier AS (SELECT *, {Z95} * sigma * sqrt(lead_time_days) AS ss, CASE WHEN first_price < 2000 THEN first_price * 83 ELSE first_price END AS price
            FROM {recent(30)} JOIN attributes USING (product_id)),
dossiers AS (SELECT product_id, upper(brand) AS brand, upper(product_name) AS product_name, category,
    format('{{:,.2f}}', {r('price', 2)}) AS unit_price, lead_time_days, {r('avg_daily', 1)} AS daily_velocity,
    CAST(ceil(ss) AS BIGINT) AS safety_stock, CAST(ceil(avg_daily * lead_time_days + ss) AS BIGINT) AS reorder_point,
    CAST(ceil(CASE WHEN avg_daily > 0 THEN sqrt(2 * (avg_daily * 365) * 50 / (price * 0.25::DOUBLE)) ELSE 0 END) AS BIGINT) AS eoq,
    {r('60 / CASE WHEN avg_daily > 0 THEN avg_daily ELSE 1.0::DOUBLE END', 1)} AS days_of_supply FROM dossier)"""
    o["FN4"] = sql("SELECT product_id, concat('DOSSIER: ', brand, ' ', product_name, ' | Unit Price: ₹', unit_price, ' | Lead Time: ', lead_time_days, "
                   "' Days | Velocity: ', format('{:.1f}', daily_velocity), ' units/day | Runway: ', format('{:.1f}', days_of_supply), ' days') AS text "
                   "FROM dossiers", dossier)
    o["FN5"] = sql("SELECT product_id, strftime(day, '%Y-%m-%d') AS day, strftime(day, '%b %d, %Y') AS label FROM (SELECT product_id, "
                   "CAST(max(date) + CAST(k AS INTEGER) AS DATE) AS day FROM sales, (SELECT unnest(range(1, 15)) AS k) GROUP BY product_id, k)")
    o["FN6"] = sql(f"SELECT {KEYED}, {r('sin(units_sold)')} AS sin, {r('cos(units_sold)')} AS cos, {r('sqrt(units_sold)')} AS sqrt, "
                   f"CAST(ceil(unit_price) AS BIGINT) AS ceil, CAST(abs(units_sold - 40) AS DOUBLE) AS abs, {r('unit_price / 7', 2)} AS round, "
                   "CAST(least(greatest(units_sold, 12), 35) AS DOUBLE) AS clip FROM sales")
    o["FN7"] = sql(f"SELECT product_id, CAST(service_level AS DOUBLE) AS service_level, {r('z')} AS z FROM level_z", Z)
    o["FN8"] = f"SELECT p_partkey, {md5_percent('concat(chr(80), p_partkey)')} AS factor FROM part"
    o["FN9"] = sql("SELECT product_id, CAST(max(units_sold) FILTER (back = 1) AS DOUBLE) AS last, CAST(max(units_sold) FILTER (back = 7) AS DOUBLE) AS week_ago, "
                   "CAST(count(*) FILTER (back <= 30) AS INTEGER) AS n, CAST(sum(units_sold) FILTER (back <= 6) + 1 AS DOUBLE) AS tail_sum, "
                   "CAST(max(units_sold) FILTER (back = 6) AS DOUBLE) AS tail_first FROM ranked GROUP BY product_id", RECENT)
    o["FN10"] = sql("SELECT model, mae, rmse, (SELECT arg_min(model, (mae, model)) FROM metrics) AS best_model FROM metrics", METRICS)

    o["MDL7"] = sql(f"""SELECT product_id, n, {', '.join(f'{r(c, 5)} AS {c}' for c in ('alpha', 'beta', 'gamma', 'level', 'trend', 'sse'))} FROM
        (SELECT *, CAST(len(ys) AS INTEGER) AS n FROM fitted)""",
                    smoothing(GRID))
    o["MDL8"] = sql(f"SELECT product_id, step, {iso('forecast_date')}, predicted_units FROM {seasonal_naive('panel', '30')}")
    o["FC1"] = sql(f"SELECT product_id, step, CAST(CAST(last_date + step AS DATE) AS VARCHAR) AS forecast_date, "
                   f"{r('units[len(units)]')} AS predicted_units FROM state WHERE step > 0", RECURSIVE_LINEAR)
    o["FC2"] = sql(f"SELECT product_id, step, {iso('forecast_date')}, predicted_units FROM {naive('panel', '30')}")
    value = "greatest((level + step * trend) * season[1 + (step - 1) % 7], 0)"
    o["FC3"] = sql(f"SELECT product_id, step, CAST(CAST(last_date + step AS DATE) AS VARCHAR) AS forecast_date, {r(value, 3)} AS predicted_units "
                   "FROM fitted, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS step)", smoothing(GRID))
    o["FC6_SEASONAL"] = sql(f"""SELECT request_id, q.product_id, q.model, step, CAST(forecast_date AS VARCHAR) AS forecast_date,
        {r('predicted_units', 2)} AS forecast_units,
        CASE WHEN c.product_id IS NULL THEN 'UNKNOWN PRODUCT' WHEN step IS NULL THEN 'NO FORECAST' ELSE 'SUCCESS' END AS status
        FROM resolved q LEFT JOIN catalog c ON c.product_id = q.product_id
        LEFT JOIN (
          SELECT product_id, step, CAST(last_date + step AS DATE) AS forecast_date, {value} AS predicted_units
          FROM fitted, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS step)
          UNION ALL SELECT product_id, step, forecast_date, predicted_units
          FROM {seasonal_naive('(SELECT * FROM sales ANTI JOIN fitted USING (product_id))', '14')}) f
        ON f.product_id = q.product_id AND f.step <= q.horizon
        WHERE q.model = 'Seasonal Baseline (Holt-Winters)'""", REQUESTS, smoothing(GRID))
    o["EVL1"] = sql(f"SELECT {r(MAE, 3)} AS mae, {r(RMSE, 3)} AS rmse FROM hold_out WHERE model = 'Seasonal Naive'", HOLD_OUT)
    o["EVL2"] = sql(f"SELECT model, product_id, {r(MAE, 3)} AS mae, {r(RMSE, 3)} AS rmse FROM hold_out GROUP BY 1, 2", HOLD_OUT)
    o["EVL3"] = sql("SELECT * FROM metrics", METRICS)
    o["EVL4"] = sql("SELECT * FROM ranked_models", METRICS)
    o["EVL6"] = sql(f"SELECT model, {r('count(*) FILTER (abs(predicted_units - actual) <= 0.2::DOUBLE * abs(actual) + 1e-9) * 100.0::DOUBLE / count(*)', 4)} AS precision_pct FROM hold_out GROUP BY model", HOLD_OUT)
    o["EVL7"] = sql(f"""SELECT model, v.mae AS val_mae, {r('greatest(0, 1 - v.mae / vm.m) * 100', 2)} AS val_accuracy, t.mae AS test_mae,
        {r('greatest(0, 1 - t.mae / tm.m) * 100', 2)} AS test_accuracy,
        CASE WHEN best AND model = 'Naive' THEN '👑 BEST OPTIMAL & ACTIVE' WHEN model = 'Naive' THEN '⚡ ACTIVE FORECASTER'
             WHEN best THEN '👑 BEST OPTIMAL' ELSE 'BENCHMARK' END AS status
        FROM (SELECT model, {r(MAE, 3)} AS mae FROM validation GROUP BY model) v JOIN (SELECT *, rank = 1 AS best FROM ranked_models) t USING (model),
        (SELECT CAST(sum(units_sold) AS DOUBLE) / count(*) AS m FROM panel WHERE date >= DATE '2000-07-01' AND date < DATE '{q.SPLIT}') vm,
        (SELECT CAST(sum(units_sold) AS DOUBLE) / count(*) AS m FROM panel) tm""",
                    METRICS, hold_out("validation", "2000-07-01", q.SPLIT, "184"))
    o["XAI1"] = sql(f"SELECT {LABEL_CASE} AS feature, {r('avg(abs(contribution))', 4)} AS importance FROM contributions GROUP BY contributions.feature",
                    FEATURE_CTES, weights_of("features", "features"))
    o["XAI3_DRIVERS"] = sql(f"""SELECT {KEYED}, feature, {r('value', 4)} AS value, {r('contribution', 4)} AS contribution, direction, rank FROM
        (SELECT *, CAST(row_number() OVER (PARTITION BY product_id, date, direction ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank FROM
         (SELECT *, CASE WHEN contribution > 0 THEN 'up' ELSE 'down' END AS direction FROM contributions WHERE contribution <> 0)) WHERE rank <= 3""",
                            FEATURE_CTES, hold_last(1), weights_of("held", "features"))

    one = lambda v: f"format('{{:.1f}}', {r(v, 1)})"
    side = lambda d: f"string_agg(phrase, ', ' ORDER BY rank) FILTER (direction = '{d}')"
    o["XAI3"] = sql(f"""SELECT product_id, {iso('f.date')}, {r('base')} AS base, {r('forecast')} AS forecast,
        concat_ws(' ', concat('For **', brand, ' ', product_name, '**, the model''s next-day baseline demand is **', {one('base')},
          ' units**. After accounting for the product''s current conditions, the forecast lands at **', {one('forecast')}, ' units**.'),
          'The strongest upward drivers are ' || ups || '.', 'The strongest downward pressures are ' || downs || '.',
          'Across the whole catalog, the features that generally matter most to this model are ' ||
          (SELECT string_agg(concat('**', feature, '**'), ', ' ORDER BY importance DESC, feature) FROM overall) || '.') AS text
        FROM (SELECT product_id, date, base, base + sum(contribution) AS forecast FROM contributions, baseline GROUP BY product_id, date, base) f
        JOIN catalog USING (product_id)
        LEFT JOIN (SELECT product_id, {side('up')} AS ups, {side('down')} AS downs FROM phrases GROUP BY product_id) USING (product_id)""",
                    FEATURE_CTES, hold_last(1), f"train_features AS (SELECT * FROM features WHERE date < DATE '{q.SPLIT}')",
                    weights_of("held", "train_features"),
                    "baseline AS (SELECT " + linear_terms(lambda c: f"avg(CAST({c} AS DOUBLE))") + " AS base FROM train_features)",
                    f"""overall AS (SELECT {LABEL_CASE} AS feature, {r('avg(abs(contribution))', 4)} AS importance
                        FROM contributions GROUP BY contributions.feature ORDER BY 2 DESC, 1 LIMIT 3)""",
                    f"""phrases AS (SELECT *, concat('**', {LABEL_CASE}, '** (', CAST({r('value', 2)} AS VARCHAR), ') ',
                          CASE direction WHEN 'up' THEN 'pushes' ELSE 'pulls' END, ' the forecast ', {one('abs(contribution)')}, ' units') AS phrase
                        FROM (SELECT *, row_number() OVER (PARTITION BY product_id, date, direction ORDER BY abs(contribution) DESC, feature) AS rank
                              FROM (SELECT *, CASE WHEN contribution > 0 THEN 'up' ELSE 'down' END AS direction FROM contributions WHERE contribution <> 0))
                        WHERE rank <= 3)""")

    for key, column, name in (("INV1", "ss", "safety_stock"), ("INV2", "ltd", "lead_time_demand"), ("INV3", "rop", "reorder_point"),
                              ("INV5", "dos", "days_of_supply")):
        o[key] = sql(f"SELECT product_id, {r(column, 4)} AS {name} FROM base", POLICY_BASE)
    o["INV4"] = sql("SELECT product_id, " + r("CASE WHEN avg_daily > 0 THEN sqrt(2 * (avg_daily * 365) * 50 / (last_price * 0.25::DOUBLE)) ELSE 0 END", 4)
                    + " AS eoq FROM base", POLICY_BASE)
    o["INV6"] = sql("SELECT product_id, stock < rop AS needs_restock, CAST(CASE WHEN stock < rop THEN ceil(rop + avg_daily * 7 - stock) ELSE 0 END AS BIGINT) "
                    "AS recommended_order_qty FROM base", POLICY_BASE)
    o["INV7"] = sql(f"SELECT product_id, risk_level, {risk_text('risk_level', 0)} AS action, {risk_text('risk_level', 1)} AS badge FROM "
                    f"(SELECT product_id, {risk_level('stock', 'rop', 'dos', 'lead_time_days')} AS risk_level FROM base)", POLICY_BASE)
    o["INV8"] = sql(f"SELECT product_id, {opening_stock('product_id', 'rop')} AS stock FROM base", POLICY_BASE)
    o["INV9"] = sql(f"SELECT * FROM fixed JOIN arrays USING (product_id) WHERE product_id = '{q.ONE_PRODUCT}'", fixed_stock(60))
    o["INV10"] = sql("SELECT * FROM portfolio", PORTFOLIO)
    o["INV11"] = sql("SELECT * FROM fixed JOIN arrays USING (product_id)", fixed_stock(80))
    o["INV12"] = sql(f"""SELECT s.*, reorder_point, CASE WHEN needs_restock
          THEN concat('RESTOCK REQUIRED: Stock (', current_stock, ') is below ROP (', CAST(ceil(reorder_point) AS BIGINT), '). Order ', recommended_order_qty, ' units.')
          ELSE concat('OPTIMAL INVENTORY: Stock (', current_stock, ') is safe above ROP (', CAST(ceil(reorder_point) AS BIGINT), ').') END AS message
        FROM (SELECT {KEYED}, CAST(units_sold AS DOUBLE) AS units, 'history' AS kind FROM ranked WHERE back <= 60
              UNION ALL SELECT product_id, CAST(forecast_date AS VARCHAR), predicted_units, 'forecast' FROM fc) s JOIN portfolio USING (product_id)""",
                     RECENT, PORTFOLIO)

    d = lambda c: f"CAST({c} AS DOUBLE) AS {c}"
    o["PR1"] = sql(f"SELECT product_id, {d('our_price')}, {d('amazon_price')}, {d('flipkart_price')}, {d('reliance_price')} FROM threats", prices())
    o["PR2"] = sql("SELECT product_id, CAST(average AS DOUBLE) AS competitor_avg_price, price_index AS relative_price_index FROM threats", prices())
    threat = "gap AS price_diff_pct, ped, impact AS demand_impact_pct, level AS threat_level, threat_badge, recommendation"
    o["PR3"] = sql(f"SELECT product_id, category, {threat} FROM threats", prices(ELASTIC))
    o["PR4"] = sql(f"SELECT product_id, category, {d('our_price')}, {d('amazon_price')}, {d('flipkart_price')}, {d('reliance_price')}, "
                   f"CAST(average AS DOUBLE) AS competitor_avg_price, price_index AS relative_price_index, {threat} FROM threats", prices(ELASTIC))

    o["REC1"] = sql(named(best(5)), PAIRS3)
    o["REC2"] = sql(impact(named(best(20))), PAIRS3)
    o["QST1"] = sql(pick, RECENT, alerts.format("brand#11 medium"))
    o["QST2"] = sql("SELECT * FROM dossiers", dossier)
    o["QST3"] = sql(f"SELECT product_id, brand, product_name, {r('m', 1)} AS avg_daily FROM ({mean}) JOIN catalog USING (product_id) ORDER BY m DESC, product_id LIMIT 5")
    o["QST4"] = sql(f"SELECT name_a, name_b, CAST(round_even(similarity * 100, 0) AS INTEGER) AS affinity_pct FROM ({named(best(5))})", PAIRS3)
    o["QST5"] = sql("SELECT model, mae, rmse, rank = 1 AS is_best FROM ranked_models", METRICS)
    route = ("CASE WHEN clean = '' THEN 'empty' WHEN " + GREETING + " THEN 'greeting' WHEN " + any_of(words.INTENT_WORDS["restock"])
             + " THEN 'restock' WHEN product_id IS NOT NULL THEN 'product' "
             + " ".join(f"WHEN {any_of(words.INTENT_WORDS[i])} THEN '{i}'" for i in ("top", "bundle", "model")) + " ELSE 'help' END")
    o["QST6"] = sql(f"SELECT question_id, intent, CASE WHEN intent = 'product' THEN product_id END AS product_id FROM "
                    f"(SELECT question_id, product_id, {route} AS intent FROM known)", QUESTIONS, CONTEXT.format(matches="matches"))
    o["QST7"] = sql("SELECT question_id, product_id FROM known WHERE product_id IS NOT NULL", QUESTIONS,
                    CONTEXT.format(matches="matches"))

    o["UDF1"] = sql(f"SELECT {KEYED}, units_sold, {r('CAST(units_sold AS DOUBLE) / sum(units_sold) OVER (PARTITION BY product_id ORDER BY sales.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS share FROM sales WHERE units_sold > 0")
    o["UDF2"] = sql(f"SELECT {KEYED}, {r(linear_terms(lambda c: c), 4)} AS prediction FROM features", FEATURE_CTES)
    o["UDF3"] = sql(f"SELECT product_id, {r('avg(units_sold)', 4)} AS center, {r('CASE WHEN stddev_pop(units_sold) > 0 THEN stddev_pop(units_sold) ELSE 1 END', 4)} AS scale, 30 AS lags FROM sales WHERE date < DATE '{q.SPLIT}' GROUP BY product_id")
    return o


ORACLE = _queries()
