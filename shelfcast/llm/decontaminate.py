"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words at the marked positions of a mask; the unmarked
positions may differ. Seeds of the benchmark are looked up at every position of
every training text. Each hit fixes an alignment of the whole passage, and the
longest stretch that matches well enough decides. The benchmark is taken in blocks
of bounded size, so what is sent to the executors does not grow with it, and a
text never leaves its row, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.tokens import in_small_batches, mix, row_slices, word_hashes

#: Fixed masks: 1 compares the word, 0 ignores it.
MASKS = ("11101011", "1101100111", "111010010111")
#: Passages with fewer words are looked for whole and unchanged, those under EXACT_WORDS not at all.
MIN_WORDS, EXACT_WORDS = 8, 3
#: Scripts without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer): each character is a word; their punctuation is none.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30fa\u30fc-\u30ff\u3400-\u4dbf"
                      "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])|[\u3000-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20]")
_FILTER_BITS = 20
#: Pairs of places that a text and the passages share a seed at, held at a time.
PAIRS = 1 << 20


def word_separators() -> np.ndarray:
    """Everything but letters, digits and the bytes of other scripts separates words."""
    table = np.ones(256, dtype=bool)
    table[128:] = False
    for first, last in ("09", "AZ", "az"):
        table[ord(first):ord(last) + 1] = False
    return table


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed that starts at each position; shorter texts have none."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(len(mask) * 2654435761), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at, mark in enumerate(mask):
            if mark == "1":
                total = (total + words[at:at + count]) * np.uint64(0x9FB21C651E98DF25)
                total ^= total >> np.uint64(29)
    return mix(total)


def _encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parted = [t.lower() if t.isascii() else UNSPACED.sub(r" \1 ", t.lower()) for t in texts]
    return word_hashes(pa.array(parted, type=pa.string()), word_separators())


def needed(length: int, min_overlap: int, identity: float, min_words: int) -> int:
    """The matches that a passage of this many words must have."""
    return length if length < min_words else min(min_overlap, math.ceil(identity * length))


def masks_for(length: int, masks: tuple[str, ...], min_overlap: int, identity: float, min_words: int) -> tuple[str, ...]:
    """The masks of a passage of this many words.

    A short passage has one more, a plain run. The matches asked of it lie in at most one
    run more than there are differences, so one run is as long as their share.
    """
    if length < EXACT_WORDS:
        return ()
    if length < min_words:
        return ("1" * length,)
    need = needed(length, min_overlap, identity, min_words)
    if need == min_overlap:
        return masks
    return (*masks, "1" * math.ceil(need / (length - need + 1)))


def benchmark_index(items: list[tuple[int, str]], masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
                    min_overlap: int = 13, identity: float = 0.8) -> dict:
    """Sorted seeds of one block of passages with their places, and the passages' words."""
    items = [(i, t or "") for i, t in items]
    words, offsets = _encode([t for _, t in items])
    keys, places, used = [], [], set()
    for number, (first, last) in enumerate(zip(offsets[:-1], offsets[1:])):
        for mask in masks_for(int(last - first), masks, min_overlap, identity, min_words):
            used.add(mask)
            found = seeds(words[first:last], mask)
            keys.append(found)
            places.append(np.stack([np.full(len(found), number), np.arange(len(found))], axis=1))
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    places = np.concatenate(places) if places else np.zeros((0, 2), np.int64)
    order = np.argsort(keys, kind="stable")
    table = np.zeros(1 << _FILTER_BITS, dtype=bool)
    table[keys >> np.uint64(64 - _FILTER_BITS)] = True
    return {"ids": [i for i, _ in items], "words": words, "offsets": offsets, "keys": keys[order],
            "places": places[order], "filter": table, "masks": sorted(used), "min_words": min_words}


def best_stretch(same: np.ndarray, penalty: int = 2) -> tuple[int, int, int]:
    """The stretch with the largest (matches - penalty * differences): matches, first, end."""
    score = np.where(same, 1, -penalty)
    total = np.concatenate([[0], np.cumsum(score)])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    first = int(np.flatnonzero(total[:end + 1] == low[end])[-1])
    return int(same[first:end].sum()), first, end


def leaking_stretch(same: np.ndarray, need: int, identity: float) -> tuple[int, int, int] | None:
    """The stretch with the most matches of all that hold ``need`` matches at ``identity``: matches, first, end.

    With T the running sum of (match - identity), a stretch is good enough when T does
    not fall over it. It may begin and end at matches, and the last end at which T is
    high enough is the best one for a beginning.
    """
    hits = np.flatnonzero(same)
    if len(hits) < need:
        return None
    # T before the i-th match and after it, from the matches and words up to there.
    number = np.arange(len(hits))
    before = number - identity * hits
    after = number + 1 - identity * (hits + 1)
    # For each beginning the last match whose T, or that of any later one, is not below.
    highest = np.maximum.accumulate(after[::-1])[::-1]
    last = np.searchsorted(-highest, -(before - 1e-9), "right") - 1
    matches = last - number + 1
    best = int(np.argmax(matches))
    if matches[best] < need:
        return None
    return int(matches[best]), int(hits[best]), int(hits[last[best]]) + 1


def alignments(words: np.ndarray, index: dict, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct alignments that seeds fix: passages, and where in the text each passage begins.

    A repetitive text meets a repetitive passage at many pairs of places that fix the
    same alignment; about ``most`` pairs are put together at a time.
    """
    longest = int(np.diff(index["offsets"]).max(initial=0))
    span = np.int64(len(words) + 2 * longest + 1)
    codes = [np.zeros(0, np.int64)]
    for mask in index["masks"]:
        here = seeds(words, mask)
        at = np.flatnonzero(index["filter"][here >> np.uint64(64 - _FILTER_BITS)])
        first = np.searchsorted(index["keys"], here[at], "left")
        count = np.searchsorted(index["keys"], here[at], "right") - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        total = np.cumsum(count)
        begin = 0
        while begin < len(at):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, "right")))
            n = count[begin:end]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            number, place = index["places"][np.repeat(first[begin:end], n) + step].T
            codes.append(np.unique(number * span + (np.repeat(at[begin:end], n) - place + longest)))
            begin = end
    number, shift = np.divmod(np.unique(np.concatenate(codes)), span)
    return number, shift - longest


def leaks_of(words: np.ndarray, index: dict, min_overlap: int, identity: float) -> dict[int, tuple]:
    """For each passage found in a text: matched words, stretch in the text, and its length; the first of the best."""
    found: dict[int, tuple] = {}
    for number, shift in zip(*(x.tolist() for x in alignments(words, index))):
        passage = index["words"][index["offsets"][number]:index["offsets"][number + 1]]
        if found.get(number, (0,))[0] == len(passage):
            continue  # found whole
        begin, end = max(0, shift), min(len(words), shift + len(passage))
        need = needed(len(passage), min_overlap, identity, index["min_words"])
        stretch = leaking_stretch(words[begin:end] == passage[begin - shift:end - shift], need, identity)
        if stretch and stretch[0] > found.get(number, (0,))[0]:
            matched, low, high = stretch
            found[number] = (matched, begin + low, begin + high, len(passage))
    return found


def _leaks(batch: pa.RecordBatch, column: int, index: dict, min_overlap: int, identity: float) -> Iterator[tuple[int, dict]]:
    """The rows of a batch that hold passages, with what each holds."""
    words, offsets = _encode([t or "" for t in batch.column(column).to_pylist()])
    hit = np.zeros(len(words), dtype=bool)
    for mask in index["masks"]:
        here = seeds(words, mask)
        maybe = np.flatnonzero(index["filter"][here >> np.uint64(64 - _FILTER_BITS)])
        hit[maybe[np.isin(here[maybe], index["keys"])]] = True
    for row in np.unique(np.searchsorted(offsets, np.flatnonzero(hit), "right") - 1).tolist():
        if found := leaks_of(words[offsets[row]:offsets[row + 1]], index, min_overlap, identity):
            yield row, found


def _scan(shared, min_overlap: int, identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, 1):
                out = [(row, shared.value["ids"][n], *leak) for row, found in _leaks(batch, 1, shared.value, min_overlap, identity)
                       for n, leak in found.items()]
                if not out:
                    continue
                took, items, matched, first, end, length = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(took)), pa.array(items, type=pa.int64()),
                    *[pa.array(x, type=pa.int32()) for x in (matched, first, end, length)]],
                    names=["doc_id", "item_id", "matched_words", "first_word", "end_word", "item_words"])

    return run


def _without(shared, column: int, min_overlap: int, identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, column):
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row for row, _ in _leaks(batch, column, shared.value, min_overlap, identity)]] = False
                yield batch.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, min_words: int, block_words: int, min_overlap: int,
            identity: float) -> Iterator:
    """The benchmark's seeds as broadcasts of bounded size, one block after the other."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(volume / 4 / block_words))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(
            benchmark_index([(r["item"], r["text"]) for r in part], min_words=min_words, min_overlap=min_overlap,
                            identity=identity))


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", min_overlap: int = 13, identity: float = 0.8,
               min_words: int = MIN_WORDS, block_words: int = 1 << 20) -> DataFrame:
    """One row per training row and benchmark passage found in it, with the stretch that matched.

    Words are runs of letters and digits, lower-cased, and the single characters of
    scripts without spaces. A passage is found when a
    stretch aligned by a seed matches in ``min_overlap`` words, or in ``identity`` of
    a shorter passage, and at least ``identity`` of the stretch's words are equal.
    A passage under ``min_words`` words is found only whole and unchanged, one under
    three words and null or empty texts find nothing. Repeated
    rows are reported each; a null doc_id is carried. Other columns are not read.
    Empty tables give no rows. ``block_words`` bounds one block of the benchmark;
    each further block costs one more scan of the texts.
    """
    texts = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, matched_words int, first_word int, end_word int, item_words int"
    return reduce(DataFrame.unionByName, [
        texts.mapInArrow(_scan(shared, min_overlap, identity), schema)
        for shared in _blocks(benchmark, item_id, item_text, min_words, block_words, min_overlap, identity)])


def drop_leaking(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                 item_text: str = "text", min_overlap: int = 13, identity: float = 0.8, min_words: int = MIN_WORDS,
                 block_words: int = 1 << 20) -> DataFrame:
    """The rows of ``df`` in which no passage is found, with all columns, in place."""
    column = in_small_batches(df).columns.index(text_col)
    for shared in _blocks(benchmark, item_id, item_text, min_words, block_words, min_overlap, identity):
        df = df.mapInArrow(_without(shared, column, min_overlap, identity), df.schema)
    return df
