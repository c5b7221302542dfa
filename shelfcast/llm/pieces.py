"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is cut where no piece of the vocabulary can reach across: before each run of
space marks. Within such a segment all adjacent symbol pairs that spell a piece stand
on an agenda ordered by score, then by position; the best pair is merged, its two new
neighbours are offered, until the agenda is empty. Symbols outside the vocabulary
become their UTF-8 bytes. In the same Arrow batch the sentencepiece library encodes every
segment that is new to the task and decodes the ids of every text, and each row says
whether both agree.

The vocabulary travels to the tasks as the bytes of its file, which only the driver
reads; the file is refused above ``MODEL_BYTES``.
"""

from __future__ import annotations

import heapq
import re
from collections import ChainMap
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from sentencepiece import SentencePieceProcessor

from shelfcast.llm.tokens import in_small_batches, row_slices

#: The mark that stands for a space, and what an unknown piece decodes to.
MARK, UNKNOWN = "▁", " ⁇ "
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
MODEL_BYTES = 16 << 20
#: Texts worked on together, in bytes.
TEXT_BYTES = 2 << 20
#: Segments that a task remembers, the longest that share an array in code points, and the rows of an array.
REMEMBERED, SHORT, TOGETHER = 500_000, 64, 8192


class Agenda:
    """The agendas of many short segments at once, one per row of an array.

    A row holds a segment's symbols and, for each adjacent pair, the place of its piece
    in the order of scores. Each round merges the best pair of every row, the leftmost of
    equals, and looks up the two new pairs; rows without a pair are done.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, ids: dict[str, int], scores: dict[str, float]):
        characters = sorted({c for piece in ids for c in piece})
        #: Characters of pieces that are no pieces themselves have numbers after all pieces.
        self.first_other = max(ids.values()) + 1
        self.others = [c for c in characters if c not in ids]
        number = {**ids, **{c: self.first_other + k for k, c in enumerate(self.others)}}
        self.first_unknown = max(number.values()) + 1
        self.points = np.array([ord(c) for c in characters], np.uint32)
        self.symbols = np.array([number[c] for c in characters], np.int32)
        place = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = sorted((self.key(number[piece[:k]], number[piece[k:]]), place[scores[piece]], i)
                       for piece, i in ids.items() for k in range(1, len(piece))
                       if piece[:k] in number and piece[k:] in number)
        self.keys = np.array([p[0] for p in pairs] + [np.iinfo(np.int64).max])
        self.places = np.array([p[1] for p in pairs] + [self.NONE], np.int32)
        self.merged = np.array([p[2] for p in pairs] + [0])

        # Pairs of the most usual characters are looked up in a square.
        usual = np.flatnonzero((self.points < 0x180) | (self.points == ord(MARK)))
        self.place_in_square = np.full(int(self.points[usual].max(initial=0)) + 1, -1, np.int32)
        self.place_in_square[self.points[usual]] = np.arange(len(usual), dtype=np.int32)
        self.square = self._pairs(self.symbols[usual][:, None], self.symbols[usual][None, :])

    @staticmethod
    def key(left, right):
        return (np.int64(1) << 22) * left + right

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the table; its last entry stands for no piece."""
        key = self.key(left, right)
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (right >= 0), at, len(self.keys) - 1).astype(np.int32)

    def _first_pairs(self, points: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The pairs of neighbouring characters."""
        at = self.place_in_square[np.minimum(points, len(self.place_in_square) - 1)]
        at[(points >= len(self.place_in_square)) | (symbols < 0)] = -1
        usual = (at[:, :-1] >= 0) & (at[:, 1:] >= 0)
        pairs = self.square[at[:, :-1], at[:, 1:]]
        other = ~usual & (symbols[:, 1:] >= 0)
        pairs[~usual] = len(self.keys) - 1
        pairs[other] = self._pairs(symbols[:, :-1][other], symbols[:, 1:][other])
        return pairs

    def character(self, symbol: int) -> str:
        """The character behind a symbol that is no piece."""
        return self.others[symbol - self.first_other] if symbol < self.first_unknown else chr(symbol - self.first_unknown)

    def symbols_of(self, segments: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbols left of each segment, as rows of the list and their symbols padded with -1.

        A character outside all pieces is first_unknown + its code point.
        """
        lengths = np.array([len(s) for s in segments])
        width = int(lengths.max())
        points = np.array(segments, f"U{width}").view(np.uint32).reshape(len(segments), width)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        symbols = np.where(self.points[at] == points, self.symbols[at], points.astype(np.int32) + np.int32(self.first_unknown))
        symbols[np.arange(width) >= lengths[:, None]] = -1
        rows = np.arange(len(segments))
        pairs = self._first_pairs(points, symbols)
        while True:
            places = self.places[pairs]
            best = places.argmin(axis=1) if places.shape[1] else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            more = places[each, best] < self.NONE if places.shape[1] else np.zeros(len(rows), bool)
            yield rows[~more], symbols[~more]
            if not more.any():
                return
            rows, symbols, pairs, best = rows[more], symbols[more], pairs[more], best[more]
            each = np.arange(len(rows))
            symbols[each, best] = self.merged[pairs[each, best]]
            keep = np.arange(symbols.shape[1] - 1)
            symbols = np.take_along_axis(symbols, keep + (keep > best[:, None]), 1)
            keep = keep[:-1]
            pairs = np.take_along_axis(pairs, keep + (keep >= best[:, None]), 1)
            if pairs.shape[1]:
                at = np.minimum(best, pairs.shape[1] - 1)
                pairs[each, at] = self._pairs(symbols[each, at], symbols[each, at + 1])
                at = np.maximum(best - 1, 0)
                pairs[each, at] = self._pairs(symbols[each, at], symbols[each, at + 1])


class PieceCodec:
    """Encodes and decodes with a vocabulary of scored merges and byte pieces."""

    def __init__(self, model: bytes):
        self.library = library = SentencePieceProcessor(model_proto=model)
        every = range(library.get_piece_size())
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in every]
        self.ids = {library.id_to_piece(i): i for i in every if not special[i]}
        self.scores = {piece: library.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = {int(library.id_to_piece(i)[1:-1], 16): i for i in every if library.is_byte(i)}
        if len(self.byte_ids) != 256 or any(library.is_unused(i) for i in every):
            raise ValueError("the vocabulary needs all byte pieces and no unused ones")
        if library.normalize(" a  Ａ\t") != f"{MARK * 2}a{MARK * 2}Ａ\t":
            raise ValueError("the vocabulary must leave texts as they are, but for a space put in front")
        self.controls = {i for i in every if library.is_control(i)}
        self.last_control = max(self.controls, default=-1)
        self.byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.spelt = [b"" if library.is_control(i) else UNKNOWN.encode() if library.is_unknown(i) else
                      self.byte_of.get(i) or library.id_to_piece(i).replace(MARK, " ").encode() for i in every]
        self.spaced = {i for piece, i in self.ids.items() if piece.startswith(MARK)}
        # A piece with a space mark after another character would join segments.
        self.joins = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        self.agenda = Agenda(self.ids, self.scores)
        self.known: dict[str, bytes] = {}
        self.doubtful: set[str] = set()

    def merge(self, segment: str) -> list[str]:
        """The symbols left when no adjacent pair spells a piece."""
        symbols: list[str | None] = list(segment)
        last = len(symbols) - 1
        before, after = list(range(-1, last)), list(range(1, last + 2))
        agenda: list[tuple[float, int, str]] = []
        scores = self.scores

        def offer(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            if pair in scores:
                heapq.heappush(agenda, (-scores[pair], left, pair))

        for left in range(last):
            offer(left, left + 1)
        while agenda:
            _, left, pair = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] is None or right > last or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = pair, None
            after[left] = after[right]
            if after[left] <= last:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [symbol for symbol in symbols if symbol is not None]

    def _bytes(self, symbol: str) -> list[int]:
        return [self.byte_ids[byte] for byte in symbol.encode()]

    def long_segment(self, segment: str) -> bytes:
        ids: list[int] = []
        for symbol in self.merge(segment):
            ids += [self.ids[symbol]] if symbol in self.ids else self._bytes(symbol)
        return np.array(ids, np.int32).tobytes()

    def short_segments(self, segments: list[str]) -> Iterator[tuple[str, bytes]]:
        """Packed ids of segments of at most SHORT code points, those of like length together."""
        segments = sorted(segments, key=len)
        for first in range(0, len(segments), TOGETHER):
            part = segments[first:first + TOGETHER]
            for rows, symbols in self.agenda.symbols_of(part):
                whole = symbols.max(axis=1, initial=0) < self.agenda.first_other
                for row, left in zip(rows[~whole], symbols[~whole].tolist()):
                    yield part[row], self._with_bytes(left)
                rows, symbols = rows[whole], symbols[whole]
                ends = 4 * np.cumsum((symbols >= 0).sum(axis=1))
                packed, start = symbols[symbols >= 0].astype(np.int32).tobytes(), 0
                for row, end in zip(rows.tolist(), ends.tolist()):
                    yield part[row], packed[start:end]
                    start = end

    def _with_bytes(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for symbol in symbols:
            if symbol >= self.agenda.first_other:
                ids += self._bytes(self.agenda.character(symbol))
            elif symbol >= 0:
                ids.append(symbol)
        return np.array(ids, np.int32).tobytes()

    def cut(self, text: str) -> list[str]:
        """The marked text in segments, each a run of marks and what follows up to the next mark."""
        marked = (MARK + text).replace(" ", MARK)
        if self.joins:
            return [marked]
        return SEGMENT.findall(marked)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts; an empty text has none. New segments of all texts are worked out together."""
        return [ids for ids, _ in self.encode_checked(texts)]

    def encode_checked(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """The ids of each text, and whether the library gives the same for all its segments."""
        cut = [self.cut(text) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set(chain.from_iterable(cut)).difference(self.known)
        long = {segment: self.long_segment(segment) for segment in new if len(segment) > SHORT}
        short = dict(self.short_segments([segment for segment in new if len(segment) <= SHORT]))
        for found in (long, short):
            self._compare(list(found), list(found.values()))
        self.known.update(short)
        packed = ChainMap(long, self.known) if long else self.known
        for segments in cut:
            yield (np.frombuffer(b"".join(map(packed.__getitem__, segments)), np.int32),
                   not self.doubtful or self.doubtful.isdisjoint(segments))

    def _compare(self, segments: list[str], packed: list[bytes]) -> None:
        """Notes the segments that the library, which puts a mark in front, encodes in another way."""
        for first in range(0, len(segments), TOGETHER):
            part, own = segments[first:first + TOGETHER], packed[first:first + TOGETHER]
            # A single mark would be an empty text, which has no ids.
            theirs = [[self.library.piece_to_id(s)] if s == MARK else ids
                      for s, ids in zip(part, self.library.encode([s[1:].replace(MARK, " ") for s in part]))]
            if np.fromiter(chain.from_iterable(theirs), np.int32).tobytes() != b"".join(own) or any(
                    4 * len(t) != len(o) for t, o in zip(theirs, own)):
                self.doubtful.update(s for s, t, o in zip(part, theirs, own) if np.array(t, np.int32).tobytes() != o)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of any ids. The space that the encoder put in front goes; each byte that is
        no part of a character becomes U+FFFD."""
        try:
            if min(ids, default=self.last_control + 1) <= self.last_control and not self.controls.isdisjoint(ids):
                raise ValueError
            text = b"".join(map(self.spelt.__getitem__, ids)).decode()
        except ValueError:  # control pieces and broken characters part the runs of bytes
            text = self._decode_runs(ids)
        first = next((i for i in ids if i not in self.controls), None)
        return text[1:] if first in self.spaced else text

    def _decode_runs(self, ids: Sequence[int]) -> str:
        parts, run = [], b""
        for i in [*ids, None]:
            if i in self.byte_of:
                run += self.byte_of[i]
                continue
            parts.append(characters(run))
            run = b""
            if i is not None:
                parts.append(self.spelt[i].decode())
        return "".join(parts)


def characters(run: bytes) -> str:
    """Bytes as text, with U+FFFD for each byte that begins no whole character."""
    parts, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                parts.append(run[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            parts.append("�")
            at += 1
    return "".join(parts)


def read_model(path: str) -> bytes:
    """The bytes of a vocabulary file, refused above MODEL_BYTES since every task holds them."""
    if Path(path).stat().st_size > MODEL_BYTES:
        raise ValueError(f"the vocabulary file has more than {MODEL_BYTES} bytes")
    return Path(path).read_bytes()


def _texts(df: DataFrame, column: str) -> DataFrame:
    rest = [c for c in df.columns if not c.startswith("piece_")]
    return in_small_batches(df).select(*rest, df[column].cast("string").alias("piece_source"))


def encode_texts(df: DataFrame, model_path: str, text_col: str = "text", whole_texts: bool = False) -> DataFrame:
    """The rows of ``df`` with piece_ids, piece_text and piece_agrees.

    ``piece_ids`` are the ids of the whole text without begin or end, ``piece_text`` is
    their decoding, and ``piece_agrees`` says that the library encodes all segments of the
    text alike and decodes all its ids alike; ``whole_texts`` has it encode each whole text
    too, which about doubles the work. A null text is empty and has no ids; texts of any length are taken
    whole, a text must fit an Arrow batch. Rows are independent: repeated rows and null
    or repeated ids are answered row by row, an empty table gives no rows. Columns named
    piece_... are replaced.
    """
    model = read_model(model_path)
    PieceCodec(model)  # a vocabulary of another kind is refused here
    source = _texts(df, text_col)
    added = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("piece_text", T.StringType()),
             T.StructField("piece_agrees", T.BooleanType())]
    schema = T.StructType([*source.schema.fields[:-1], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        for whole in batches:
            for batch in row_slices(whole, whole.num_columns - 1, TEXT_BYTES):
                yield encoded(codec, batch)

    def encoded(codec: PieceCodec, batch: pa.RecordBatch) -> pa.RecordBatch:
        sources = [value.as_py() or "" for value in batch.column(batch.num_columns - 1)]
        ids, texts, agrees = [], [], []
        for source_text, (own, same) in zip(sources, codec.encode_checked(sources)):
            listed = own.tolist()
            decoded = codec.decode(listed)
            if whole_texts:
                same = same and codec.library.encode(source_text) == listed
            ids.append(own)
            texts.append(decoded)
            agrees.append(same and codec.library.decode(listed) == decoded)
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())),
             pa.array(texts, pa.string()), pa.array(agrees, pa.bool_())], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "piece_ids") -> DataFrame:
    """The rows of ``df`` with ``piece_text``, the decoding of a column of ids.

    Null or empty ids give an empty text; control ids are left out; an id outside the
    vocabulary stops the job.
    """
    model = read_model(model_path)
    rest = [c for c in df.columns if c != "piece_text"]
    source = in_small_batches(df).select(*rest, df[ids_col].cast("array<int>").alias("piece_source"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("piece_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        for batch in batches:
            texts = [codec.decode(value.as_py() or []) for value in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             names=[f.name for f in schema])

    return source.mapInArrow(run, schema)
