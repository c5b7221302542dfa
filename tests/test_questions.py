import pytest
from pyspark.sql import functions as F

from shelfcast.functions import text as words
from shelfcast.plans import questions

CASES = [
    ("", None, "empty", None),
    ("   ", None, "empty", None),
    ("Hi there", None, "greeting", None),
    ("this is a ship", None, "help", None),
    ("Which products need restock urgently?", None, "restock", None),
    ("Reorder point for Lantern 3 Lite", None, "restock", None),
    ("What about Lantern 3 Lite", None, "product", "K01"),
    ("Is the Lantern 4 Lite Plus better than the Lantern 4 Lite", None, "product", "K03"),
    ("how is k06 doing", None, "product", "K06"),
    ("what is the rop", "Beacon 24", "product", "K04"),
    ("what is the rop", None, "help", None),
    ("What are the top demand leaders?", None, "top", None),
    ("laptop prices", None, "top", None),
    ("Recommend product bundles", None, "bundle", None),
    ("Show model accuracy", None, "model", None),
    ("éhi", None, "help", None),
]


def test_routing(spark, sales):
    asked = spark.createDataFrame([(str(i), t, s) for i, (t, s, _, _) in enumerate(CASES)],
                                  "question_id string, text string, selected_product string")
    catalog = sales.select("product_id", "product_name").distinct()
    got = {int(r.question_id): r for r in questions.route_questions(asked, catalog).collect()}
    for i, (text, _, intent, product) in enumerate(CASES):
        assert (got[i].intent, got[i].product_id) == (intent, product), text


def test_matching_equals_brute_force_on_long_texts(spark, sales):
    products = sales.select("product_id", "product_name").distinct().collect()
    texts = {str(i): f"{'lorem ipsum ' * 3000}{p.product_name.upper()} and {q.product_id}{' dolor' * 3000}"
             for i, (p, q) in enumerate((p, q) for p in products for q in products)}
    texts["none"] = "nothing to see" * 100
    asked = spark.createDataFrame(list(texts.items()), "question_id string, text string")
    got = {r.question_id: r.matched_product for r in questions.named_products(
        asked, sales.select("product_id", "product_name").distinct()).collect()}
    for key, text in texts.items():
        hits = [p for p in products if p.product_id.lower() in text.lower() or p.product_name.lower() in text.lower()]
        best = min(hits, key=lambda p: (-len(p.product_name), p.product_id)).product_id if hits else None
        assert got.get(key) == best


def test_names_of_any_length_are_found(spark):
    catalog = spark.createDataFrame([("a", "q"), ("bb", "zed"), ("ccccc", "somewhat longer name")],
                                    "product_id string, product_name string")
    asked = spark.createDataFrame([("1", "xqx"), ("2", "the zed"), ("3", "Somewhat Longer Name, zed"), ("4", "-"), ("5", "cccccc")],
                                  "question_id string, text string")
    got = {r.question_id: r.matched_product for r in questions.named_products(asked, catalog).collect()}
    assert got == {"1": "a", "2": "bb", "3": "ccccc", "5": "ccccc"}


def test_no_side_that_grows_with_the_texts_is_broadcast(spark, sales, tmp_path):
    # A small file of texts explodes into far more grams than its size tells.
    texts = [(str(i), "how is Lantern 4 Lite doing " * 50, None) for i in range(200)]
    spark.createDataFrame(texts, "question_id string, text string, selected_product string").write.parquet(f"{tmp_path}/asked")
    found = questions.named_products(spark.read.parquet(f"{tmp_path}/asked"), sales.select("product_id", "product_name").distinct())
    joins = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in line]
    assert all("LeftSemi, BuildRight" in line for line in joins), joins
    assert {r.matched_product for r in found.collect()} == {"K02"} and found.count() == 200


@pytest.mark.parametrize("text, model", [
    ("XGBoost", "XGBoost"), (" random-forest ", "Random Forest"), ("SVR", "Support Vector (RBF)"),
    ("lstm (pytorch)", "LSTM (PyTorch)"), ("prophet", "Seasonal Baseline (Holt-Winters)"), ("", "XGBoost"),
    (None, "XGBoost"), ("nonsense", None)])
def test_model_names(spark, text, model):
    row = spark.createDataFrame([(text,)], "t string").select(words.resolve_model(F.col("t")).alias("m")).first()
    assert row.m == model


def test_model_slug(spark):
    names = spark.createDataFrame([("Support Vector (RBF)",), ("Random Forest",)], "m string")
    assert [r[0] for r in names.select(words.model_slug(F.col("m"))).collect()] == ["support_vector_svr", "random_forest"]


def test_alerts_dossiers_and_leaders(sales):
    alerts = questions.restock_alerts(sales, limit=10).collect()
    assert alerts and [(a.brand, a.product_name) for a in alerts] == sorted((a.brand, a.product_name) for a in alerts)
    assert questions.dossiers(sales).count() == 7
    assert [r.product_id for r in questions.demand_leaders(sales, 1).collect()] == ["K01"]
