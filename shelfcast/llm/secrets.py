"""Secrets in texts: fixed patterns and sliding-window entropy, as column expressions only.

Matches are located by splitting the text at the pattern: the lengths of the
pieces and of the matches add up to positions in code points. The entropy of a
window moves with its two ends: one character comes, one goes, and the sum of
c * log2(c) over the character counts is adjusted, never recomputed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed patterns of the base kinds, in the order in which equal starts are listed.
#: A run of A or of hex digits that is long enough is found with its length in the pattern.
KINDS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
ASSIGN_CHARS = 8


@dataclass(frozen=True)
class CharClass:
    """A character class: its alphabet, what a candidate looks like, and the entropy a window needs."""

    name: str
    alphabet: str
    pattern: str
    bits: float


#: A candidate is judged in the first class whose pattern it matches in full. A random window of 24
#: characters has about 3.5 bits over hex digits, 4.0 over one case with digits and 4.3 over both; text has less.
#: 99 of 100 random ones reach the bits of the last two; there separators count only before and after, or paths would.
CLASSES = (
    CharClass("hex", "0123456789abcdefABCDEF", r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]+$", 3.0),
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
              r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", 3.9),
    CharClass("lower", "abcdefghijklmnopqrstuvwxyz0123456789+/_=-",
              r"^(?=.*[0-9])(?=.*[a-z])[+/_=-]*[a-z0-9_=]+[+/_=-]*$", 3.6),
    CharClass("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-",
              r"^(?=.*[0-9])(?=.*[A-Z])[+/_=-]*[A-Z0-9_=]+[+/_=-]*$", 3.5),
)
CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
WINDOW = 24
#: One piece of 1 to 8 characters repeated from end to end; the last one may be cut.
REPEATED = "^(?:" + "|".join(rf"(?=.{{{n}}}(.*)$)\{n}" for n in range(1, 9)) + ")"
#: Suppressed candidates: one piece repeated, counting or alphabet runs, and marked examples.
ALLOW = (REPEATED, r"(?i)example|sample|placeholder|changeme|dummy", r"(?i)0123456789|abcdefghij",
         r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")

_SPAN = "array<struct<start:int,rank:int,kind:string,stop:int>>"


def _located(text: Column, pattern: str, rank: int, kind: str, keep) -> Column:
    """Spans of the matches for which ``keep(match, number)`` holds."""
    gaps = F.split(text, pattern)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit")),
                          lambda p: F.struct(F.char_length(p["gap"]).alias("gap"), F.char_length(p["hit"]).alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + part["hit"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("stop"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(lengths, start, add)["spans"]
    flags = keep(hits)
    if flags is not None:
        # Judged once for all spans, not again for each.
        judged = F.arrays_zip(spans.alias("span"), flags.alias("kept"))
        spans = F.transform(F.filter(judged, lambda j: j["kept"]), lambda j: j["span"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _base(text: Column, rank: int, kind: str) -> Column:
    pattern = KINDS[kind]
    if kind != "assign":
        return _located(text, pattern, rank, kind, lambda hits: None)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    return _located(text, pattern, rank, kind, lambda hits: F.transform(values, lambda v: F.char_length(v) >= ASSIGN_CHARS))


def window_entropy(value: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any ``window`` neighbouring characters."""
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    # Each character's cell, beside the cell of the one that leaves the window. What a lambda takes from outside
    # is worked out anew at every step, so the text must be taken apart before.
    cells = F.transform(F.split(value, ""), lambda c: F.call_function("instr", F.lit(alphabet), c) - 1)
    leaving = F.slice(F.concat(F.array_repeat(F.lit(-1), window), cells), F.lit(1), F.char_length(value))
    steps = F.arrays_zip(cells.alias("comes"), leaving.alias("goes"))
    zero = F.struct(F.lit(0).alias("n"), F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
                    F.lit(0.0).alias("best"))

    def move(state: Column, step: Column) -> Column:
        comes, goes, n = step["comes"], step["goes"], state["n"] + 1
        here, there = F.get(state["counts"], comes), F.get(state["counts"], goes)
        total = F.when(comes == goes, state["sum"]).otherwise(
            state["sum"] + F.get(weight, here + 1) - F.get(weight, here)
            + F.coalesce(F.get(weight, there - 1) - F.get(weight, there), F.lit(0.0)))
        counts = F.when(comes == goes, state["counts"]).otherwise(F.transform(
            state["counts"], lambda c, i: c + F.when(i == comes, 1).when(i == goes, -1).otherwise(0)))
        bits = F.when(n >= window, F.lit(math.log2(window)) - total / window).otherwise(F.lit(0.0))
        return F.struct(n.alias("n"), counts.alias("counts"), total.alias("sum"), F.greatest(state["best"], bits).alias("best"))

    return F.aggregate(steps, zero, move)["best"]


def _suspicious(value: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | value.rlike(pattern)
    judged = F.lit(False)
    for c in reversed(CLASSES):
        judged = F.when(value.rlike(c.pattern), window_entropy(value, c.alphabet) >= c.bits).otherwise(judged)
    return F.when(allowed, F.lit(False)).otherwise(judged)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base_spans and entropy_spans, arrays of (start, rank, kind, stop).

    Positions are code points, the stop is exclusive. Base spans are the fixed
    patterns; entropy spans are candidate strings with a window of high entropy for
    their character class that no allow-list entry names. A null or empty text has no
    spans. Repeated rows and null ids are scanned like any other, other columns are not
    read, an empty table gives no rows.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    found = rows.select(
        "doc_id", *[_base(text, rank, kind).alias(kind) for rank, kind in enumerate(KINDS)],
        _located(text, CANDIDATE, len(KINDS), "entropy",
                 lambda hits: F.transform(hits, _suspicious)).alias("entropy_spans"))
    return found.select("doc_id", F.array_sort(F.concat(*KINDS)).alias("base_spans"), "entropy_spans",
                        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS])


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order of the spans."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
