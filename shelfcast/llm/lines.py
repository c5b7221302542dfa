"""Lines that many documents share, removed with DataFrame operations only.

Only hashes and positions of long lines are exploded and shuffled. The texts
meet the positions to drop once, by the row's own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.session import materialize

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased. Pure ASCII takes the built-in, which agrees there and is faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def long_lines(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Position and 128-bit hash of every line whose key is long enough."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    return (df.select(F.col(id_col).alias("doc_id"), F.posexplode(lines).alias("pos", "line"))
            .select("doc_id", "pos", F.btrim("line", F.lit(WHITE)).alias("stripped"))
            .where(F.char_length("stripped") >= min_chars)
            .select("doc_id", "pos", lower_ascii(F.col("stripped")).alias("key"))
            .select("doc_id", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")))


def drop_shared_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the text that is left, ``kept_text``.

    A line whose key (stripped, A-Z lower-cased) has ``min_chars`` code points and
    occurs in ``min_docs`` documents goes from every document but the one with the
    largest id. A null text is one empty line. Rows with the same id count as one
    document for the threshold, and of a shared line they lose the positions found
    in any of them; rows with a null id count as one document that never is the
    largest. Other columns are not read, whatever they are called; an empty table
    gives no rows.
    """
    lines = materialize(long_lines(df, id_col, text_col, min_chars), "long-lines")
    # Distinct documents first, then documents per key: both steps combine before their shuffle,
    # so a line that a third of all documents hold arrives as a few rows per task.
    shared = (lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("held"))
              .groupBy("h1", "h2").agg(F.count("held").alias("n"), F.max("doc_id").alias("last"))
              .where(F.col("n") >= min_docs).drop("n"))
    gone = (lines.join(shared, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("pos").alias("gone")))
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines_of = texts.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select(
        "doc_id", "gone", "text", F.split("text", "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(left, lambda at: F.get("lines", at)), "\n")
    return lines_of.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size(left)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))
