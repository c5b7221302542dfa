"""Words of Arrow text columns as 64-bit hashes, computed on whole batches of bytes.

A word is a maximal run of bytes that are not separators, with A-Z lower-cased.
Batches are cut into segments between words, so memory follows the segment size
and not the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEGMENT_BYTES = 1 << 20
#: The white space of the word definition: space and \t \n \v \f \r.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _byte_codes() -> np.ndarray:
    with np.errstate(over="ignore"):
        codes = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
    codes[65:91] = codes[97:123]
    return codes


def is_space() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(SPACE)] = True
    return table


_CODES = _byte_codes()
_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) >= size:
        return _POWERS["up"], _POWERS["down"]
    size = max(size, SEGMENT_BYTES + 4096)
    tables = {}
    for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
        out = np.full(size, np.uint64(base))
        out[0] = 1
        with np.errstate(over="ignore"):
            tables[name] = np.cumprod(out, dtype=np.uint64)
    if TaskContext.get():  # the driver keeps none, or each function sent out would carry them
        _POWERS.update(tables)
    return tables["up"], tables["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _segments(space: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Ranges that end between words, of about SEGMENT_BYTES unless one word is longer."""
    while first < last:
        end = min(first + SEGMENT_BYTES, last)
        if end < last:
            back = np.flatnonzero(space[first:end])
            if len(back):
                end = first + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(space[end:last])
                end = end + int(ahead[0]) + 1 if len(ahead) else last
        yield first, end
        first = end


def word_hashes(column: pa.Array, separators: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows, in order, and the offsets of each row's words.

    ``separators`` marks the byte values between words; white space by default.
    """
    table = is_space() if separators is None else separators
    data, offsets = text_bytes(column)
    hashes, starts_at = [], []
    space = table[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # a row begins here
    for first, last in _segments(space, 0, len(data)):
        word = ~space[first:last]
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edge[first + 1:last]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | edge[first + 1:last]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        up, down = _powers(last - first)
        with np.errstate(over="ignore"):
            total = np.cumsum(_CODES[data[first:last]] * up[:last - first], dtype=np.uint64)
            value = (total[ends] - np.where(begins > 0, total[begins - 1], np.uint64(0))) * down[begins]
            hashes.append(mix(value + (ends - begins + 1).astype(np.uint64) * _STEP))
        starts_at.append(begins + first)
    all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
    return all_hashes, np.searchsorted(starts, offsets)


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def row_slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text each."""
    _, offsets = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), batch.num_rows)
        yield batch.slice(first, end - first)
        first = end


def in_small_batches(df: DataFrame, most: str = "8m") -> DataFrame:
    """The same rows; Arrow batches of this session hold about ``most`` bytes from now on.

    The default of 64 MB is held several times over by each task, on both sides of the
    socket. Texts are long, so small batches cost nothing.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)
    return df
