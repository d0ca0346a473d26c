"""Token counts by a broadcast table of frequent pre-tokens and a cache in each worker."""

from __future__ import annotations

import heapq
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainstay.llm.pretokens import SPECIAL, byte_level, parts, pretokens, tokenizer

# The broadcast table holds at most this many pre-tokens (about 1 MB packed).
FREQUENT = 50_000
# Each task hands on at most this many of its most frequent pre-tokens; the others only miss the table.
PER_TASK = 20_000
# A task's own counter is thinned to its larger half beyond this size, a worker's cache emptied.
COUNTER = 200_000
CACHE = 200_000


def frequent_pretokens(docs: DataFrame, path: str, text: str = "text", size: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of the whole corpus, counted in each task before anything moves.

    Speed alone depends on them: a pre-token outside the list is encoded by the worker that meets it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                for part in parts(value.as_py() or ""):
                    counter.update(pretokens(path, part))
            if len(counter) > COUNTER:
                counter = Counter(dict(counter.most_common(COUNTER // 2)))
        top = heapq.nlargest(PER_TASK, counter.items(), key=lambda item: (item[1], item[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"]
        )

    rows = (
        docs.select(text).mapInArrow(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(size).select("word").collect()
    )
    return [row.word for row in rows]


def length_table(words: list[str], path: str) -> bytes:
    """Pre-tokens and their token counts, packed for the broadcast."""
    model = tokenizer(path).model
    lengths = [1 if word in SPECIAL else len(model.tokenize(byte_level(word))) for word in words]
    return zlib.compress(json.dumps([words, lengths]).encode())


class _Lengths(dict):
    """Token counts by pre-token: the frequent ones, and what this worker has met besides."""

    def __init__(self, path: str, packed: bytes):
        words, lengths = json.loads(zlib.decompress(packed))
        super().__init__(zip(words, lengths, strict=True))
        self.fixed = dict(self)
        self.model = tokenizer(path).model

    def __missing__(self, word: str) -> int:
        length = self[word] = 1 if word in SPECIAL else len(self.model.tokenize(byte_level(word)))
        return length

    def trim(self) -> None:
        if len(self) > len(self.fixed) + CACHE:
            self.clear()
            self.update(self.fixed)


_workers: dict[int, _Lengths] = {}


def _lengths(path: str, packed: bytes) -> _Lengths:
    """The worker's table; it outlives the task, so later tasks find what earlier ones have met."""
    key = zlib.crc32(packed + path.encode())
    if key not in _workers:
        _workers.clear()
        _workers[key] = _Lengths(path, packed)
    return _workers[key]


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_bytes and n_tokens of each whole text; no pre-token is shuffled.

    A null text counts as empty (0 bytes, 0 tokens). Special strings inside a text count as one token, as the
    library's default has it. Rows are treated one by one, so repeated rows give repeated results; other columns,
    whatever their names, aren't read. An empty table gives no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(length_table(frequent_pretokens(docs, path, text), path))
    names = list(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(path, table.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(len(names)):
                whole = value.as_py() or ""
                n_bytes.append(len(whole.encode("utf-8")))
                total = 0
                for part in parts(whole):
                    total += sum(map(lengths.__getitem__, pretokens(path, part)))
                    lengths.trim()
                n_tokens.append(total)
            columns = [*batch.columns[: len(names)], pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_bytes", "n_tokens"])

    source = docs.select(*names, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(count, f"{kinds}, n_bytes long, n_tokens long")
