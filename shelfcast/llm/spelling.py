"""Spelling variants by permuterm rotations.

A word is marked at its end and turned around to start after each of its characters.
Two words that differ in one replaced character then share all of a rotation but its
last character; where one word lacks a character, its whole rotation is what the other
has before its last character. So the rotations, keyed by what stands before the edited
character, meet in sorted groups. A group holds one rotation per possible character and
at most one whole word, so its length is bounded by the alphabet. One scan of a group
tells each member how many neighbours it has there and which is its best, without a row
per pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.tokens import in_small_batches
from shelfcast.session import materialize

#: Marks the end of a word; no word holds it.
END = "$"
#: A maximal run of the letters of a word, in UTF-8 with A-Z lower-cased: a to z and U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000


def _count_words(modulus: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode() for w in total]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                # Only A-Z are lower-cased by bytes.
                found = Counter(RUN.findall((text.as_py() or "").encode().lower()))
                if modulus:
                    total.update(_damaged(found, (doc_id.as_py() or "").encode() + b":", modulus))
                else:
                    total.update(found)
                if len(total) >= COUNTED:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return run


def _damaged(found: dict[bytes, int], prefix: bytes, modulus: int) -> Counter[bytes]:
    """The runs of one document; those whose checksum the modulus divides lose one code point."""
    start, out = zlib.crc32(prefix), Counter()
    for run, n in found.items():
        hashed = zlib.crc32(run, start)
        if hashed % modulus == 0:
            word = run.decode()
            at = hashed % len(word)
            run = (word[:at] + word[at + 1:]).encode()
        out[run] += n
    return out


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                damage_modulus: int | None = None) -> DataFrame:
    """(word, n) of the words of all texts, of at least ``min_length`` code points and ``min_count`` occurrences.

    Words are runs of a-z and U+00C0 to U+00FF after lower-casing A-Z only. With
    ``damage_modulus`` a run whose crc32 of "<id>:<run>" it divides loses the code point at
    that crc32 modulo its length, for trials with known errors; a null id is empty there. A
    null text has no words. Each task adds up its own words before the shuffle.
    """
    texts = in_small_batches(df).select(df[id_col].cast("string").alias("id"), df[text_col].cast("string").alias("text"))
    counted = texts.mapInArrow(_count_words(damage_modulus), "word string, n long")
    return (counted.where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """One row per rotation of (word, n): its key, and what the member is in its group.

    ``rest`` is the rotation without its last character, the edited one; ``whole`` rows are
    rotations complete, for the word that lacks a character there. Of a run of equal
    characters only the first stands for an indel (``first``), as all of them leave the
    same word.
    """
    word, at = F.col("word"), F.col("at")
    length = F.char_length("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    tail, head = F.substring(word, at + 1, length), F.substring(word, F.lit(1), at)
    # at = 0..length: the whole rotation that starts at this character.
    whole = turned.select("word", "n", F.concat(tail, F.lit(END), head).alias("rest"), F.lit(True).alias("whole"),
                          F.lit(False).alias("first"))
    # at = 0..length-1: the same without the character at this place.
    same = F.substring(word, at + 1, F.lit(1)) == F.substring(word, at, F.lit(1))
    edited = turned.where(at < length).select(
        "word", "n", F.concat(F.substring(word, at + 2, length), F.lit(END), head).alias("rest"),
        F.lit(False).alias("whole"), ((at == 0) | ~same).alias("first"))
    return whole.unionByName(edited)


def _member(condition: Column) -> Column:
    return F.when(condition, F.struct((-F.col("n")).alias("less"), "word", "first"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) over (word, n): the number of words one edit away, and the one of largest n.

    ``best`` is a struct (less, word) with less = -n, ties by code-point order. Words
    without a neighbour are left out. Two words are counted once: a replacement has one place,
    an indel one first place.
    """
    groups = rotations(words).groupBy("rest").agg(
        F.sort_array(F.collect_list(_member(~F.col("whole")))).alias("edited"),
        F.max(_member(F.col("whole"))).alias("lacking"))
    groups = groups.where(F.size("edited") + F.col("lacking").isNotNull().cast("int") > 1)
    # Sorted once, so the first is everyone's best, and the second is the best of the first.
    firsts = F.filter("edited", lambda m: m["first"])
    top, second = F.col("edited")[0], F.try_element_at("edited", F.lit(2))
    partner = F.struct

    def plain(member: Column) -> Column:
        return F.when(member.isNotNull(), partner(member["less"].alias("less"), member["word"].alias("word")))

    def of_edited(member: Column) -> Column:
        other = plain(F.when(member["word"] == top["word"], second).otherwise(top))
        longer = F.when(member["first"], plain(F.col("lacking")))
        seen = F.size("edited") - 1 + F.coalesce((member["first"] & F.col("lacking").isNotNull()).cast("int"), F.lit(0))
        return F.struct(member["word"].alias("word"), seen.cast("long").alias("near"), F.least(other, longer).alias("best"))

    shorter = F.struct(F.col("lacking")["word"].alias("word"), F.size("firsts").cast("long").alias("near"),
                       plain(F.try_element_at("firsts", F.lit(1))).alias("best"))
    everyone = F.concat(F.transform("edited", of_edited),
                        F.when(F.col("lacking").isNotNull(), F.array(shorter)).otherwise(F.array().cast(
                            "array<struct<word:string,near:bigint,best:struct<less:bigint,word:string>>>")))
    found = groups.withColumn("firsts", firsts).select(F.inline(everyone)).where("near > 0")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def group_variants(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """(word, n, form, form_n, n_near, root) for a table (word, n) of distinct words.

    ``form`` is the most frequent neighbour if it is at least ``ratio`` times as frequent
    as the word, else null; ``root`` follows forms to the last one. Along forms the count
    grows by ``ratio`` each time, so a chain is never longer than the logarithm of the
    largest count, and halving it a few times finds all roots.
    """
    if ratio <= 1:
        raise ValueError("forms end only if each is more frequent than the one before")
    words = materialize(words.select("word", "n"), "spelling-words")
    found = words.join(neighbours(words), "word", "left")
    common = -F.col("best")["less"]
    formed = materialize(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common >= F.lit(ratio) * F.col("n"), F.col("best")["word"]).alias("form"),
        F.when(common >= F.lit(ratio) * F.col("n"), common).alias("form_n")), "spelling-forms")
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = materialize(links.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if links.where("moved").isEmpty():
            break
    return formed.join(links.select("word", "root"), "word", "left").select(
        "word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
