"""Best-fit packing: the plan is made over counts of lengths, then pieces take planned places by their rank within a length."""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mainstay.llm.pretokens import SPECIAL, byte_level, parts, pretokens, spread, tokenizer
from mainstay.scratch import written

# Production values.
LIMIT = 4096
END_ID = 1
# A worker keeps the ids of words in two generations of about this many bytes each; longer words aren't remembered.
HELD = 96 << 20
LONG_WORD = 64
# Bytes of a remembered word besides its ids.
ENTRY = 200
# Pieces are handed on when their ids take about this many bytes.
OUT = 16 << 20
# Rows of one file that are ranked together: 2 ** 16.
RANKED_BITS = 16


class WordIds(dict):
    """Packed ids of what stands between blanks, remembered by the worker; no pre-token spans a blank.

    The younger generation is the dictionary itself. When it is full it becomes the older one, from which words that
    are met again return.
    """

    def __init__(self, path: str):
        super().__init__()
        self.path, self.model, self.held = path, tokenizer(path).model, 0
        self.special = {text: struct.pack("<I", tokenizer(path).token_to_id(text)) for text in SPECIAL}
        self.earlier: dict[str, bytes] = {}

    def _pretoken(self, pretoken: str) -> bytes:
        known = self.special.get(pretoken)
        if known is None:
            ids = [token.id for token in self.model.tokenize(byte_level(pretoken))]
            known = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def __missing__(self, word: str) -> bytes:
        packed = self.earlier.get(word)
        if packed is None:
            if word.isascii() and word.isalpha() and word.islower():
                packed = self._pretoken(word)
            else:
                packed = b"".join(map(self._pretoken, pretokens(self.path, word)))
        if len(word) <= LONG_WORD:
            if self.held > HELD:
                self.earlier, self.held = dict(self), 0
                self.clear()
            self[word] = packed
            self.held += ENTRY + len(packed)
        return packed

    def text_ids(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(b"".join(map(self.__getitem__, spread(part).split(" "))) for part in parts(text))


_workers: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    if path not in _workers:
        _workers.clear()
        _workers[path] = WordIds(path)
    return _workers[path]


def pieces(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT, end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): each text's ids and ``end_id``, cut after every ``limit`` ids."""
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            rows, held = [], 0
            for at, value in enumerate(batch.column(1)):
                ids = words.text_ids(value.as_py() or "") + end
                for number, start in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[start:start + 4 * limit]
                    rows.append((at, number, start // 4, len(part) // 4, zlib.crc32(part), part if with_ids else b""))
                    held += len(rows[-1][5])
                if held > OUT:
                    yield _piece_batch(batch.column(0), rows, names)
                    rows, held = [], 0
            yield _piece_batch(batch.column(0), rows, names)

    names = ["_key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kind = docs.schema[key].dataType.simpleString()
    kinds = f"_key {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, kinds)


def _piece_batch(keys: pa.Array, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    at, *columns = zip(*rows, strict=True) if rows else ((),) * 6
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *arrays[: len(names) - 1]], names=names)


def plan(counts: dict[int, int], limit: int = LIMIT) -> np.ndarray:
    """Best fit, longest first, over a histogram of lengths: rows (length, first rank, first sequence, in each, offset).

    The pieces of a length from the first rank on go, so many in each, to sequences from the first one on, behind
    offset. Best fit puts a piece where the least room is left that holds it, and the next piece of that length to the
    same place while it fits; so sequences with equal room are filled as one run. A run that takes pieces is left with
    less than half of its room, and a length splits at most one run and opens at most two: the number of rows
    depends on ``limit`` alone (at most about 3 * limit * log2(limit)), not on the pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(left: int, first: int, count: int) -> None:
        if left and count:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, open_pieces = 0, counts[length]
        while open_pieces:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, sequences = room[left].pop()
                if not room[left]:
                    del room[left]
                    rooms.pop(at)
            else:
                left, first = limit, opened
                sequences = -(-open_pieces // (limit // length))
                opened += sequences
            each = left // length
            used = min(sequences, open_pieces // each)
            if not used:
                each, used = open_pieces, 1
            rows.append((length, rank, first, each, limit - left))
            leave(left - each * length, first, used)
            leave(left, first + used, sequences - used)
            rank += used * each
            open_pieces -= used * each
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _ranked(table: DataFrame) -> DataFrame:
    """The rows of a written table with ``rank``, from 0, within their length, by place in the table.

    A place, file and row, is the same for every task that reads it, and no two rows share one. Counts of blocks of
    rows are added up over the blocks; within a block the rank is a row number, so a frequent length is many groups.
    """
    placed = table.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"),
    ).withColumn("_block", F.shiftright("_row", RANKED_BITS))
    group = ["length", "_file", "_block"]
    counts = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*group).orderBy("_row")) - 1
    numbered = placed.withColumn("_inside", inside).join(starts, group)
    return numbered.withColumn("rank", F.col("_before") + F.col("_inside")).drop("_file", "_block", "_row", "_before", "_inside")


def pack(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT, end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32[, ids], sequence_id and offset.

    A document is its text's ids and ``end_id``; one longer than ``limit`` is cut into pieces of ``limit``, the last of
    which may be shorter. Pieces fill sequences of at most ``limit`` ids without gaps. A null text is an empty one: its
    piece is ``end_id`` alone (none where that is None). Repeated rows and null numbers take places of their own; an
    empty table gives no rows; other columns, whatever their names, aren't read.
    """
    table = written(pieces(docs, path, text, key, limit, end_id, with_ids), "packing")
    # At most ``limit`` rows.
    counts = {row.length: row.n for row in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    planned = docs.sparkSession.sparkContext.broadcast(plan(counts, limit))
    names = ["_key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = planned.value
        starts = rows[:, 0] * 2**48 + rows[:, 1]
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = rows[np.searchsorted(starts, lengths * 2**48 + ranks, side="right") - 1]
            beyond = ranks - row[:, 1]
            sequence, offset = row[:, 2] + beyond // row[:, 3], row[:, 4] + beyond % row[:, 3] * lengths
            columns = [*(batch.column(name) for name in names), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    ranked = _ranked(table).select(*names, "rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long").withColumnRenamed("_key", key)
