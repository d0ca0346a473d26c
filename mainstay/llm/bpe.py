"""BPE encoding that proposes tokens greedily, checks all neighbours at once and merges only failing words."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainstay.llm.pretokens import SPECIAL, byte_level, parts, pretokens, tokenizer

END = "</w>"
# A worker keeps its words in two generations of about this many bytes; the older one goes when the younger is full.
CACHE = 8 << 20
# Texts are taken in chunks of about this many characters, a longer one in parts; ids are decoded in runs of DECODED.
CHUNK = 1 << 19
DECODED = 1 << 18
# Bytes of a remembered word besides its letters and ids.
ENTRY = 200
# No merge makes or uses this id.
NONE = -1


class Vocabulary:
    """Token ids, the merge that makes each token, and the words this worker has encoded."""

    def __init__(self, path: str):
        self.path = path
        model = json.loads(tokenizer(path).to_str())["model"]
        self.id_of: dict[str, int] = model["vocab"]
        size = max(self.id_of.values()) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, NONE, np.int64)
        self.right = np.full(size, NONE, np.int64)
        pairs = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            made = self.id_of[a + b]
            pairs.append((self.id_of[a], self.id_of[b], made))
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, self.id_of[a], self.id_of[b]
        self.size = size
        self.merge_of = {(a, b): (rank, made) for rank, (a, b, made) in reversed([*enumerate(pairs)])}
        keys = np.array([a * size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.special = {t: tokenizer(path).token_to_id(t) for t in SPECIAL}
        self.proposable = self._whole_tokens()
        self.longest = max(map(len, self.proposable))
        self.held = 0
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def _whole_tokens(self) -> dict[str, int]:
        """Tokens whose own text merges back into them; only these may be proposed."""
        whole = self.rank < 0
        for made in np.argsort(self.rank, kind="stable")[int(whole.sum()):]:
            whole[made] = whole[self.left[made]] and whole[self.right[made]]
        built = np.flatnonzero(whole & (self.rank >= 0))
        good = self.boundary_stays(self.left[built], self.right[built], self.rank[built])
        whole[built[~good]] = False
        return {text: number for text, number in self.id_of.items() if whole[number]}

    def _cross_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.iinfo(np.int64).max)

    def boundary_stays(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the boundary between tokens ``a`` and ``b``, for all pairs at once.

        Time runs backwards: of the two tokens at the boundary the one merged last is undone, and what then
        touches the boundary must not merge earlier than that. A merge of equal rank goes to the left place
        first, so it crosses when the right token is undone and doesn't when the left one is.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max) if before is None else before.astype(np.int64).copy()
        stays = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            crossed = self._cross_rank(x, y) < limit[live]
            stays[live[crossed]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            go_on = ~crossed & ((rank_x >= 0) | (rank_y >= 0))
            live, x, y, rank_x, rank_y = live[go_on], x[go_on], y[go_on], rank_x[go_on], rank_y[go_on]
            undo_left = rank_x > rank_y
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            limit[live] = np.where(undo_left, rank_x, rank_y + 1)
        return stays

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over the byte-level word; None where no token fits."""
        known, longest, end, out, at = self.proposable, self.longest, len(word), [], 0
        while at < end:
            number = known.get(word[at:] + END) if end - at <= longest else None
            if number is not None:
                out.append(number)
                return out
            for stop in range(min(end - 1, at + longest), at, -1):
                number = known.get(word[at:stop])
                if number is not None:
                    out.append(number)
                    at = stop
                    break
            else:
                return None
        return None

    def merge(self, word: str) -> list[int]:
        """The exact merges, lowest rank first and leftmost among equals, on a linked list with a heap."""
        ids = [self.id_of[c] for c in word[:-1]] + [self.id_of[word[-1] + END]]
        count, merge_of = len(ids), self.merge_of
        if count < 24:
            far = len(merge_of)
            ranks = [merge_of.get(p, (far,))[0] for p in zip(ids, ids[1:], strict=False)]
            while ranks and (least := min(ranks)) < far:
                at = ranks.index(least)
                ids[at:at + 2] = [merge_of[ids[at], ids[at + 1]][1]]
                del ranks[at]
                if at:
                    ranks[at - 1] = merge_of.get((ids[at - 1], ids[at]), (far,))[0]
                if at < len(ranks):
                    ranks[at] = merge_of.get((ids[at], ids[at + 1]), (far,))[0]
            return ids
        after, before = [*range(1, count), NONE], [NONE, *range(count - 1)]
        heap = [(merge_of[p][0], k, *p) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merge_of]
        heapq.heapify(heap)
        while heap:
            _, at, a, b = heapq.heappop(heap)
            right = after[at]
            if right == NONE or ids[at] != a or ids[right] != b:
                continue
            ids[at], ids[right] = merge_of[a, b][1], NONE
            after[at] = after[right]
            if after[at] != NONE:
                before[after[at]] = at
            for first, second in ((before[at], at), (at, after[at])):
                if first != NONE and second != NONE and (pair := (ids[first], ids[second])) in merge_of:
                    heapq.heappush(heap, (merge_of[pair][0], first, *pair))
        return [number for number in ids if number != NONE]

    def learn(self, words: set[str]) -> int:
        """Encode new words: propose, check all neighbours in one go, merge where a check fails."""
        fresh = []
        words = words - self.words.keys()
        for word in words:
            ids = self.earlier.get(word)
            if ids is None:
                fresh.append(word)
            else:
                self.words[word] = ids
        proposed: list[list[int] | None] = []
        for word in fresh:
            proposed.append([self.special[word]] if word in self.special else self.propose(byte_level(word)))
        lengths = np.array([len(p) if p else 0 for p in proposed], np.int64)
        flat = np.fromiter((i for p in proposed if p for i in p), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(fresh)), lengths)
        inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
        bad = np.zeros(len(fresh), bool)
        at = np.flatnonzero(inside)
        bad[owner[at[~self.boundary_stays(flat[at], flat[at + 1])]]] = True
        packed = flat.astype("<u4").tobytes()
        for k, word in enumerate(fresh):
            if bad[k] or proposed[k] is None:
                self.words[word] = np.array(self.merge(byte_level(word)), "<u4").tobytes()
            else:
                self.words[word] = packed[4 * (ends[k] - lengths[k]):4 * ends[k]]
        self.held += sum(ENTRY + len(word) + len(self.words[word]) for word in words)
        return int(bad.sum())

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        done: list[list[bytes]] = [[] for _ in texts]
        cut: list[tuple[int, list[str]]] = []
        size = 0
        for at, text in enumerate(texts):
            for part in parts(text):
                cut.append((at, pretokens(self.path, part)))
                size += len(part)
                if size >= CHUNK:
                    self._encode_parts(cut, done)
                    cut, size = [], 0
        self._encode_parts(cut, done)
        return [b"".join(ids) for ids in done]

    def _encode_parts(self, cut: list[tuple[int, list[str]]], done: list[list[bytes]]) -> None:
        if self.held > CACHE:
            self.words, self.earlier, self.held = {}, self.words, 0
        self.learn({word for _, words in cut for word in words})
        look = self.words.__getitem__
        for at, words in cut:
            done[at].append(b"".join(map(look, words)))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The worker's vocabulary; it outlives the task, and so do the words it has encoded."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column, null as empty, about CHUNK characters at a time."""
    chunk, size = [], 0
    for value in column:
        chunk.append(value.as_py() or "")
        size += len(chunk[-1])
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


@lru_cache(maxsize=2)
def _token_texts(path: str) -> list[str | None]:
    """Token texts by id: all that decoding needs."""
    known = tokenizer(path).get_vocab(with_added_tokens=True)
    texts: list[str | None] = [None] * (max(known.values()) + 1)
    for text, number in known.items():
        texts[number] = text
    return texts


def decode_ids(path: str, packed: bytes) -> str:
    """The tokens of packed ids joined by a blank."""
    look, ids = _token_texts(path).__getitem__, np.frombuffer(packed, "<u4")
    return " ".join(" ".join(map(look, ids[at:at + DECODED].tolist())) for at in range(0, len(ids), DECODED))


def _kinds(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{name}` {df.schema[name].dataType.simpleString()}, " for name in names)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and token_ids: each whole text's ids as packed little-endian unsigned 32-bit integers.

    A null text is encoded as an empty one, giving no ids. Rows are treated one by one: repeated rows repeat, an
    empty table gives no rows, other columns aren't read. Special strings inside a text give their own id.
    """
    names = list(keep)

    return _encoded(docs, path, text, list(keep), decoded=False)


def encode_and_decode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, token_ids and decoded: what ``encode`` and then ``decode`` give, by one worker per task."""
    return _encoded(docs, path, text, list(keep), decoded=True)


def _encoded(docs: DataFrame, path: str, text: str, names: list[str], decoded: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = vocabulary(path)
        for batch in batches:
            at = 0
            for chunk in _chunks(batch.column(len(names))):
                kept = [c.slice(at, len(chunk)) for c in batch.columns[: len(names)]]
                at += len(chunk)
                ids = rules.encode_all(chunk)
                made = [pa.array(ids, pa.binary())]
                if decoded:
                    made.append(pa.array([decode_ids(path, packed) for packed in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*names, "token_ids", "decoded"][: len(kept) + len(made)])

    kinds = _kinds(docs, names) + "token_ids binary" + (", decoded string" if decoded else "")
    return docs.select(*names, F.col(text).alias("_text")).mapInArrow(run, kinds)


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id", "token_ids")) -> DataFrame:
    """``keep`` columns and decoded: the tokens of token_ids joined by a blank, as the file, which names no decoder, has it.

    Null ids decode to an empty text.
    """
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names))
            for at in range(0, len(column), 256):
                texts = [decode_ids(path, v.as_py() or b"") for v in column.slice(at, 256)]
                kept = [c.slice(at, 256) for c in batch.columns[: len(names)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return encoded.select(*names, F.col("token_ids").alias("_ids")).mapInArrow(run, _kinds(encoded, names) + "decoded string")
