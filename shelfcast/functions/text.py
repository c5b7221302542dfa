"""Text expressions: model names, keyword tests and question routing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The model names and the spellings accepted for them.
MODEL_NAMES = [
    "XGBoost",
    "Random Forest",
    "Gradient Boosting",
    "LightGBM",
    "Linear Regression",
    "Support Vector (RBF)",
    "Seasonal Baseline (Holt-Winters)",
    "LSTM (PyTorch)",
]
MODEL_ALIASES = {
    "xgboost": "XGBoost",
    "random_forest": "Random Forest",
    "randomforest": "Random Forest",
    "gradient_boosting": "Gradient Boosting",
    "gradboost": "Gradient Boosting",
    "lightgbm": "LightGBM",
    "lgb": "LightGBM",
    "linear_regression": "Linear Regression",
    "support_vector_svr": "Support Vector (RBF)",
    "svr": "Support Vector (RBF)",
    "seasonal": "Seasonal Baseline (Holt-Winters)",
    "holt_winters": "Seasonal Baseline (Holt-Winters)",
    "prophet": "Seasonal Baseline (Holt-Winters)",
    "lstm": "LSTM (PyTorch)",
}

# The words that decide the intent of a question.
GREETING_WORDS = ["hi", "hello", "hey", "help"]
GREETING_PHRASES = ["who are you", "what can you do"]
INTENT_WORDS = {
    "restock": ["restock", "reorder", "alert", "deficit", "stockout", "out of stock", "urgent"],
    "top": ["top", "highest", "best seller", "demand leader", "velocity", "popular"],
    "bundle": ["bundle", "recommend", "frequently bought", "together", "cross sell"],
    "model": ["model", "accuracy", "mae", "rmse", "best model", "xgboost", "random forest", "lightgbm", "lstm"],
}
CONTEXT_WORDS = ["this", "current", "selected", "my product", "rop", "safety stock", "eoq", "inventory",
                 "stock", "dossier"]

WHITESPACE = " \t\n\r\x0b\x0c"


def _map(items) -> Column:
    return F.create_map(*[F.lit(v) for item in items for v in item])


def resolve_model(name: Column, default: str = "XGBoost") -> Column:
    """The model a spelling stands for; empty means the default, unknown gives null."""
    plain = F.lower(F.btrim(name, F.lit(WHITESPACE)))
    by_alias = F.try_element_at(_map(MODEL_ALIASES.items()), F.translate(plain, "- ", "__"))
    by_name = F.try_element_at(_map((n.lower(), n) for n in MODEL_NAMES), plain)
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(default)).otherwise(F.coalesce(by_alias, by_name))


def model_slug(name: Column) -> Column:
    return F.replace(F.replace(F.replace(F.lower(name), F.lit(" "), F.lit("_")),
                               F.lit("_rbf_"), F.lit("_")), F.lit("(rbf)"), F.lit("svr"))


def clean(text: Column) -> Column:
    return F.lower(F.btrim(text, F.lit(WHITESPACE)))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when any word occurs anywhere, also inside another word.

    One pattern for all words, so that a long text is cleaned and read once.
    """
    return F.rlike(text, F.lit("|".join(words)))


def has_whole_word(text: Column, words: list[str]) -> Column:
    """True when any word stands alone; letters and digits of all scripts count as word parts."""
    edge = r"[^\p{L}\p{N}_]"
    return F.rlike(text, F.lit(f"(^|{edge})({'|'.join(words)})({edge}|$)"))


def is_greeting(text: Column) -> Column:
    return has_whole_word(text, GREETING_WORDS) | contains_any(text, GREETING_PHRASES)


def is_taken_early(text: Column) -> Column:
    """True when a rule ahead of the product rule decides a cleaned question."""
    return (text == "") | is_greeting(text) | contains_any(text, INTENT_WORDS["restock"])


def route(text: Column, names_product: Column) -> Column:
    """Intent of a cleaned question; the first rule that holds decides."""
    return (F.when(text == "", "empty")
            .when(is_greeting(text), "greeting")
            .when(contains_any(text, INTENT_WORDS["restock"]), "restock")
            .when(names_product, "product")
            .when(contains_any(text, INTENT_WORDS["top"]), "top")
            .when(contains_any(text, INTENT_WORDS["bundle"]), "bundle")
            .when(contains_any(text, INTENT_WORDS["model"]), "model")
            .otherwise("help"))
