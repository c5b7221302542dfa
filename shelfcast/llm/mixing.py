"""Mixing sources to target weights: water-filled targets, repetition rates and hash-seeded copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A word of the size measure.
WORD = r"[^\x20\x09-\x0D]+"


def with_targets(sources: DataFrame, weights: list[float], max_repeats: float, source_col: str = "source",
                 size_col: str = "source_size") -> DataFrame:
    """Adds ``weight`` and ``target`` to one row per source.

    Sources in code point order, null last, get the weights in turn, repeating. The
    targets share the total of all sizes by weight; none exceeds ``max_repeats``
    times its source, and what is cut off goes to the others by weight until none is
    above. In order of size per weight the capped sources are a prefix, so sums over
    that order give the answer in one pass and no rounds are needed. The table has
    one row per source, not per document.
    """
    by_name = Window.orderBy(F.col(source_col).isNull(), F.col(source_col))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sources.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    cap = F.col(size_col) * F.lit(float(max_repeats))
    by_room = Window.orderBy(F.col("room"), F.col(source_col).isNull(), F.col(source_col))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(size_col).over(everything)
    # The level at this row: what the caps before it leave, per weight of the rest.
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = (weighed.withColumn("cap", cap).withColumn("room", F.col("cap") / F.col("weight"))
              .withColumn("level", level))
    # Capped rows have room below their level. The first row that is not capped sets the level of all after it.
    open_level = F.min(F.when(F.col("room") >= F.col("level"), F.struct("room", "level"))).over(everything)["level"]
    return (ranked.withColumn("open", open_level)
            .withColumn("target", F.when(F.col("open").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("weight") * F.col("open"))))
            .drop("cap", "room", "level", "open"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(seed: int, key: Column) -> Column:
    """A number in [0, 1) fixed by the key and the seed: the first 13 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: list[float] | None = None, max_repeats: float = 3.0, seed: int = 11) -> DataFrame:
    """The rows of ``df`` with mix_size, mix_source_size, mix_target, mix_rate and mix_copies.

    A document is to be emitted ``floor(rate)`` times plus once more when its
    hash-seeded number falls below the fraction of the rate, where the rate is its
    source's target over its source's size. No document is repeated more than
    ``max_repeats`` times. The size is the number of words, 0 for a null text; a null
    source is a source of its own; a source without words gets no copies. The draw
    depends on the id, the text and the seed, so reruns agree and equal rows are
    drawn alike. An empty table gives no rows. Columns named mix_... are replaced.
    """
    sized = df.withColumn("mix_size", word_count(F.col(text_col)))
    targets = with_targets(
        sized.groupBy(F.col(source_col).alias("mix_source")).agg(F.sum("mix_size").alias("mix_source_size")),
        weights or [1.0, 2.0, 3.0], max_repeats, "mix_source", "mix_source_size")
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    extra = unit(seed, F.col(id_col)) < F.col("mix_rate") - F.floor("mix_rate")
    return (sized.join(targets.withColumnRenamed("target", "mix_target").drop("weight"),
                       sized[source_col].eqNullSafe(F.col("mix_source")))
            .drop("mix_source").withColumn("mix_rate", rate)
            .withColumn("mix_copies", (F.floor("mix_rate") + extra.cast("int")).cast("int")))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as its mix_copies says, without the mix_ columns."""
    columns = [c for c in mixed.columns if not c.startswith("mix_")]
    copies = F.explode(F.array_repeat(F.lit(1), F.col("mix_copies"))).alias("copy")
    return mixed.where("mix_copies > 0").select(*columns, copies).drop("copy")
