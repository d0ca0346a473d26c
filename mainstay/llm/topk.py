"""Exact top-k by histogram selection: score all, refine score histograms to the kth value, filter, break ties."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mainstay.scratch import written

# Production values.
K = 5
SCALE = 256
# Vectors per block of candidates and of queries, and blocks of candidates per shard.
CANDIDATES, QUERIES, SHARD = 4096, 512, 16
# Bins of one round; a query is located when at most ENOUGH scores reach the bin of its kth.
BINS, ENOUGH = 128, 64
EXACT = 2**53
# A task adds up the histograms of so many query blocks before it hands them on.
HELD = 32


def whole_vectors(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): floor(scale * component) of every vector that is present and finite; one vector per number.

    Numbers that repeat keep their least vector.
    """
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = vectors.where(F.col(key).isNotNull() & F.col(value).isNotNull()).where(finite)
    ints = F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return fit.select(F.col(key).alias("id"), ints.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _packed(rows: DataFrame, size: int, state: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of up to ``size`` vectors: first id, ids, the width, the components, and per-vector state as arrays."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                vectors = part.column(1).to_pylist()
                width = max(map(len, vectors))
                block = np.zeros((len(vectors), width), np.int64)
                for k, vector in enumerate(vectors):
                    block[k, : len(vector)] = vector
                ids = part.column(0).to_numpy().astype(np.int64)
                columns = [[int(ids[0])], [ids.tobytes()], [width], [block.tobytes()]]
                columns += [[part.column(2 + k).to_numpy().astype(np.int64).tobytes()] for k in range(len(state))]
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), *[pa.binary()] * len(state)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["first", "ids", "width", "block", *state]
                )

    kinds = "first long, ids binary, width int, block binary" + "".join(f", {s} binary" for s in state)
    return rows.select("id", "v", *state).mapInArrow(pack, kinds)


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where every sum is exact there. Shorter vectors count as filled up with zeros."""
    width = min(queries.shape[1], candidates.shape[1])
    queries, candidates = queries[:, :width], candidates[:, :width]
    if not width:
        return np.zeros((len(queries), len(candidates)), np.int64)
    if float(np.abs(queries).max()) * float(np.abs(candidates).max()) * width < EXACT:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _met(blocks: DataFrame, shards: int, queries: DataFrame, run, kinds: str) -> DataFrame:
    """``run`` over every block of queries against every block of candidates, shard by shard.

    Where ``run`` gives an array of histograms, a task adds up those of a block of queries before it hands them on.
    """
    dealt = _packed(queries, QUERIES, ("low", "step", "above")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    names = ["ids", "width", "block", "low", "step", "above"]
    dealt = dealt.select("shard", *[F.col(n).alias(f"q_{n}") for n in names])
    both = blocks.join(dealt, "shard").select("ids", "width", "block", *[f"q_{n}" for n in names])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                ids, width, block, q_ids, q_width, q_block, low, step, above = (c[row].as_py() for c in batch.columns)
                ids, q_ids, low, step, above = (np.frombuffer(x, np.int64) for x in (ids, q_ids, low, step, above))
                scores = _scores(np.frombuffer(q_block, np.int64).reshape(len(q_ids), q_width), np.frombuffer(block, np.int64).reshape(len(ids), width))
                found = run(scores, ids, q_ids, low, step, above)
                if isinstance(found, pa.RecordBatch):
                    yield found
                    continue
                key = q_ids.tobytes()
                held[key] = held[key] + found if key in held else found
                if len(held) >= HELD:
                    yield from map(_bin_rows, held.items())
                    held = {}
        yield from map(_bin_rows, held.items())

    return both.mapInArrow(each, kinds)


def _histograms(scores, ids, q_ids, low, step, _above):
    """Per query, in this block, the scores in each of BINS bins from ``low``, and beyond them."""
    found = np.zeros((len(q_ids), BINS + 1), np.int64)
    for k in range(len(q_ids)):
        at = (scores[k][ids != q_ids[k]] - low[k]) // step[k]
        found[k] = np.bincount(np.clip(at[at >= 0], 0, BINS), minlength=BINS + 1)
    return found


def _bin_rows(held: tuple[bytes, np.ndarray]) -> pa.RecordBatch:
    """(id, bin, n) of the bins in use."""
    query, bins = np.nonzero(held[1])
    ids = np.frombuffer(held[0], np.int64)[query]
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(bins), pa.array(held[1][query, bins])], names=["id", "bin", "n"])


def _ranges(scores, ids, q_ids, _low, _step, _above):
    low, high = np.full(len(q_ids), np.iinfo(np.int64).max), np.full(len(q_ids), np.iinfo(np.int64).min)
    for k in range(len(q_ids)):
        own = scores[k][ids != q_ids[k]]
        if len(own):
            low[k], high[k] = own.min(), own.max()
    good = low <= high
    return pa.RecordBatch.from_arrays([pa.array(q_ids[good]), pa.array(low[good]), pa.array(high[good])], names=["id", "low", "high"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of each query, by integer inner product.

    ``vectors`` and ``queries`` hold (id, v) with integer components. A vector isn't its own candidate; ties go to the
    smaller id; a query with fewer candidates returns them all. Every round scores all pairs block by block and adds up a
    histogram per query, whose bin with the kth score becomes the next round's range. Then only scores that reach the
    located bin are kept, at most k per query and block, and ranked.
    """
    spark = vectors.sparkSession
    blocks = written(_packed(vectors, CANDIDATES), "blocks")
    shards = max(1, -(-blocks.count() // SHARD))
    blocks = blocks.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int"))
    start = queries.select("id", "v", *[F.lit(0).cast("long").alias(c) for c in ("low", "step", "above")])
    ends = _met(blocks, shards, start, _ranges, "id long, low long, high long")
    ends = ends.groupBy("id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    width = F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low") + 1) / F.lit(BINS))).cast("long")
    state = written(
        queries.join(ends, "id").select("id", "v", "low", width.alias("step"), F.lit(0).cast("long").alias("above")), "state"
    )
    located = []
    while True:
        found = _met(blocks, shards, state, _histograms, "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        summed = found.withColumn("reach", F.sum("n").over(down))
        # The highest bin down to which k scores are found; the lowest of all where there are fewer.
        kth = summed.groupBy("id").agg(
            F.coalesce(F.max(F.when(F.col("reach") >= k, F.col("bin"))), F.lit(0)).alias("bin"), F.max("reach").alias("all")
        )
        reach = summed.select(F.col("id").alias("_id"), F.col("bin").alias("_bin"), "reach")
        kth = kth.join(reach, (kth["id"] == reach["_id"]) & (kth["bin"] == reach["_bin"]), "left").select("id", "bin", "reach")
        after = state.join(kth, "id").select(
            "id", "v", (F.col("low") + F.col("bin") * F.col("step")).alias("low"), "step",
            F.coalesce("reach", F.lit(0)).alias("above"),
        )
        after = written(after, "state")
        done = (F.col("step") == 1) | (F.col("above") <= ENOUGH)
        located.append(after.where(done))
        state = after.where(~done).withColumn("step", F.ceil(F.col("step") / F.lit(BINS)).cast("long"))
        if state.isEmpty():
            break
    ready = located[0]
    for more in located[1:]:
        ready = ready.unionByName(more)

    def pick(scores, ids, q_ids, low, _step, _above):
        out = [[], [], []]
        for q in range(len(q_ids)):
            at = np.flatnonzero((scores[q] >= low[q]) & (ids != q_ids[q]))
            at = at[np.lexsort((ids[at], -scores[q][at]))[:k]]
            for column, values in zip(out, (np.full(len(at), q_ids[q]), ids[at], scores[q][at]), strict=True):
                column.append(values)
        cat = [pa.array(np.concatenate(x) if x else np.zeros(0), pa.int64()) for x in out]
        return pa.RecordBatch.from_arrays(cat, names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    picked = _met(blocks, shards, ready, pick, "query_id long, vec_id long, score long")
    ranked = picked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(embeddings: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """``top_k`` for the vectors whose number is divisible by ``every``, against all others.

    Vectors that are null, or hold a null or non-finite component, take no part; an empty vector scores 0 with all. Rows
    without a number take no part; rows that share one count as their least vector. An empty table gives no rows; other
    columns aren't read.
    """
    vectors = written(whole_vectors(embeddings), "vectors")
    return top_k(vectors, vectors.where(F.pmod("id", F.lit(every)) == 0), k)
