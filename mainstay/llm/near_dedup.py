"""Near-duplicates by HyperMinHash: bands of compressed registers, corrected estimates, then the full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mainstay.scratch import written

# Production values. A link needs 100 * intersection >= SIMILAR * union of the sets of SHINGLE-word runs.
SHINGLE = 5
SIMILAR = 75
# Registers per document and per band, and mantissa bits kept of each. A pair at the bar shares no band with a chance
# of 5 in a million; pairs above it with far less.
REGISTERS, BAND = 128, 4
# Few runs crowd into equal registers and make bands that aren't independent. Up to SMALL runs, a set's bands are made of
# minima of as many hash functions; sets that may be similar to one of those have both kinds of bands.
SMALL = 16
SMALL_UP = SMALL * 100 // SIMILAR
MANTISSA = 10
# An estimate rules a pair out only beyond so many standard errors below the bar.
SIGMAS = 5.0
# Buckets with more rows than 1 / (PER_PARTITION x shuffle partitions) of all are never gathered in a task.
PER_PARTITION = 8
# A bucket is compared in square cells of about this many documents a side.
CELL = 256

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
_SHIFT = np.uint64(64 - int(np.log2(REGISTERS)))
_EDGES = np.arange(REGISTERS, dtype=np.uint64) << _SHIFT


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# From where an empty register borrows, try by try: each has an order of all registers of its own, so it finds one.
_JUMPS = np.argsort(_mixed(np.arange(1, REGISTERS**2 + 1, dtype=np.uint64) * _FACTORS[1]).reshape(REGISTERS, REGISTERS), axis=0)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word runs of a whole text.

    A-Z are lower-cased, words are runs of other than ASCII white space; fewer than five words make one run, none no run.
    """
    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < SHINGLE:
        sums = (h * _FACTORS[:n]).sum(keepdims=True) + np.uint64(n)
    else:
        sums = h[: n - 4] * _FACTORS[0]
        for k in range(1, SHINGLE):
            sums = sums + h[k : n - 4 + k] * _FACTORS[k]
    return np.unique(_mixed(sums))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Per bucket of the top bits the least hash, as leading zeros and mantissa in 16 bits; 0 for an empty bucket."""
    first = np.searchsorted(hashes, _EDGES)
    full = first < np.append(first[1:], len(hashes))
    rest = hashes[np.minimum(first, len(hashes) - 1)] << (np.uint64(64) - _SHIFT)
    zeros = np.clip(64 - np.frexp(rest.astype(np.float64))[1], 0, 62).astype(np.uint64)
    mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.where(full, (zeros << np.uint64(MANTISSA) | mantissa) + np.uint64(1), 0).astype(np.uint16)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (128 bits for the whole set), sketch (null without shingles) and small of each text.

    ``small`` is the whole set where it has few runs, else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, made, small = [], [], [], []
            for value in batch.column(1):
                found = shingles(value.as_py())
                sizes.append(len(found))
                ids.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                made.append(registers(found).tobytes() if len(found) else None)
                small.append(found.tobytes() if 0 < len(found) <= SMALL_UP else None)
            columns = [pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (ids, made, small))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_shingles", "set_id", "sketch", "small"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_id binary, sketch binary, small binary"
    )


def dense(sketch: np.ndarray) -> np.ndarray:
    """Registers with the empty ones lent by others, in an order fixed by hashing, for banding.

    Without this, short texts with few registers would share a band by one common run of words.
    """
    out, left = sketch.copy(), np.flatnonzero((sketch == 0).any(axis=1))
    for jump in _JUMPS:
        if not len(left):
            break
        part = out[left]
        out[left] = np.where(part == 0, sketch[left][:, jump], part)
        left = left[(out[left] == 0).any(axis=1)]
    return out


_SEEDS = _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _FACTORS[2])


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """Per set the least value of each of as many hash functions as there are registers."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    return np.minimum.reduceat(_mixed(np.concatenate(sets)[:, None] ^ _SEEDS), starts, axis=0)


def _band_keys(sketch: np.ndarray, n: np.ndarray, sets: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each set, first those of the registers and then those of the minima, and which of them it has.

    Only sets of at most SMALL_UP runs are read from ``sets``.
    """
    bands = REGISTERS // BAND
    keys = np.zeros((len(sketch), 2 * bands), np.uint64)
    has = np.repeat(np.stack([n > SMALL, n <= SMALL_UP], axis=1), bands, axis=1)
    steps = np.arange(1, 2 * bands + 1, dtype=np.uint64) * _FACTORS[0]
    large, small = np.flatnonzero(n > SMALL), np.flatnonzero(n <= SMALL_UP)
    if len(large):
        keys[large, :bands] = _mixed(dense(sketch[large]).view(np.uint64) + steps[:bands])
    for at in range(0, len(small), 500):
        part = small[at : at + 500]
        least = _minima([sets[k] for k in part]).reshape(len(part), bands, BAND)
        keys[part, bands:] = _mixed((least * _FACTORS[:BAND]).sum(axis=2, dtype=np.uint64) + steps[bands:])
    return keys.view(np.int64), has


def _bands(texts: DataFrame) -> DataFrame:
    """(bucket, rep, n) for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                small = [v if v is None else np.frombuffer(v, np.uint64) for v in part.column(3).to_pylist()]
                keys, has = _band_keys(_unpacked(part.column(2)), part.column(1).to_numpy(), small)
                rows = pa.array(np.nonzero(has)[0])
                columns = [pa.array(keys[has]), part.column(0).take(rows), part.column(1).take(rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "rep", "n"])

    return texts.select("rep", "n", "sketch", "small").mapInArrow(run, "bucket long, rep long, n long")


def _with_totals(rows: DataFrame, hot: DataFrame, **totals) -> DataFrame:
    """``rows`` with totals of their bucket. Hot buckets are totalled in each task first and looked up, others gathered."""
    key = Window.partitionBy("bucket")
    cold = rows.join(F.broadcast(hot), "bucket", "left_anti").withColumns({n: c.over(key) for n, c in totals.items()})
    sums = rows.join(F.broadcast(hot), "bucket", "left_semi").groupBy("bucket").agg(*[c.alias(n) for n, c in totals.items()])
    return cold.unionByName(rows.join(F.broadcast(sums), "bucket"))


def _buckets(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, rep, n, size, pivot, pivot_n) for buckets with two documents or more, and the hot buckets.

    Few buckets can hold more than their share of all rows; they are found from a sketch of the heavy keys. The pivot is
    the document that meets most others over all its buckets: of near copies the one that they were made from.
    """
    bands = _bands(texts)
    share = PER_PARTITION * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(share, 100_000)
    top = bands.agg(
        F.call_function("approx_top_k", F.col("bucket"), F.lit(most), F.lit(8 * most)).alias("top"), F.count("*").alias("all")
    )
    hot = top.select("all", F.explode("top").alias("t")).where(F.col("t.count") * share > F.col("all"))
    hot = written(hot.select(F.col("t.item").alias("bucket")), "hot")
    shared = written(_with_totals(bands, hot, size=F.count("*")).where("size > 1"), "buckets")
    met = shared.groupBy("rep").agg(F.sum("size").alias("met"))
    pivot = F.min(F.struct((-F.col("met")).alias("met"), "rep", "n"))
    rows = _with_totals(shared.join(met, "rep"), hot, first=pivot)
    columns = ["bucket", "rep", "n", "size", F.col("first.rep").alias("pivot"), F.col("first.n").alias("pivot_n")]
    return written(rows.select(*columns), "pivots"), hot


def _zero_odds(n: np.ndarray) -> np.ndarray:
    """Per text of ``n`` runs, how likely a register has each number of leading zeros."""
    steps = np.maximum(np.arange(64), 1e-9)
    beyond = -np.expm1(np.outer(n / REGISTERS, np.log1p(-np.exp2(-steps))))
    return beyond[:, :-1] - beyond[:, 1:]


def _corrected(same: np.ndarray, used: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Jaccard estimates from equal registers, less the matches expected by chance."""
    chance = chance / 2**MANTISSA
    return (same / np.maximum(used, 1) - chance) / (1 - chance)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of pairs of sketches, and the registers they rest on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return _corrected(same, used, (_zero_odds(n_a) * _zero_odds(n_b)).sum(axis=1)), used


def _allows(close: np.ndarray, used: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether estimate and sizes allow a link.

    The registers are a sample without repeats of the union, so their error shrinks as they come to hold most of it.
    """
    bar = SIMILAR / 100
    union = (n_a + n_b) / (1 + bar)
    spread = bar * (1 - bar) / np.maximum(used, 1) * np.clip(1 - used / union, 0, 1) + 1e-4
    return (close >= bar - SIGMAS * np.sqrt(spread)) & (100 * np.minimum(n_a, n_b) >= SIMILAR * np.maximum(n_a, n_b))


def _may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return _allows(*estimate(a, b, n_a, n_b), n_a, n_b)


def _similar(left: np.ndarray, right: np.ndarray) -> bool:
    """The exact test on two sorted sets."""
    x, y = (left, right) if len(left) <= len(right) else (right, left)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= SIMILAR * (len(x) + len(y) - common)


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _screened(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(k).to_numpy().astype(float) for k in (2, 3))
            good = _may_link(_unpacked(batch.column(4)), _unpacked(batch.column(5)), n_a, n_b) if len(batch) else []
            yield batch.select([0, 1]).filter(pa.array(np.asarray(good, bool)))

    side = lambda x: texts.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets_of = zip(batch.column(2), batch.column(3), strict=True)
            good = [_similar(*(np.frombuffer(v.as_py(), np.uint64) for v in pair)) for pair in sets_of]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    side = lambda x: sets.select(F.col("rep").alias(x), F.col("full").alias(f"f_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "f_a", "f_b")
    return both.mapInArrow(run, "a long, b long").distinct()


def _full_sets(docs: DataFrame, texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, full) for the wanted representatives; only their texts are made into sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                full = pa.array([shingles(v.as_py()).tobytes() for v in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), full], names=["rep", "full"])

    picked = docs.select(F.col("doc_id").alias("rep"), "text").join(wanted, "rep", "left_semi")
    return picked.mapInArrow(run, "rep long, full binary").where(F.octet_length("full") > 0)


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the least representative that links reach, by passing minima along and jumping to their labels."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("rep").alias("b"), "label")
        heard = both.join(known, "b").groupBy(F.col("a").alias("rep")).agg(F.min("label").alias("heard"))
        better = labels.join(heard, "rep").select("rep", F.col("label").alias("was"), F.least("label", "heard").alias("now"))
        jump = labels.select(F.col("rep").alias("now"), F.col("label").alias("far"))
        after = written(better.join(jump, "now").select("rep", "was", F.least("now", "far").alias("label")), "labels")
        if after.where("label <> was").isEmpty():
            return after.select("rep", "label")
        labels = after.select("rep", "label")


def _rest(buckets: DataFrame, hot: DataFrame, texts: DataFrame, full: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) of a bucket between documents that the pivots have left in different components.

    A bucket is dealt into square cells, so none is gathered whole. A cell compares registers, confirms on full sets what
    they allow, and hands on links only, each pair in the first band that it shares.
    """
    marked = buckets.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    open_rows = _with_totals(marked, hot, low=F.min("label"), high=F.max("label")).where("low < high")
    cells = F.ceil(F.col("size") / F.lit(CELL)).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int")
    dealt = open_rows.withColumn("cells", cells).withColumn("own", own).withColumn(
        "other", F.explode(F.expr("sequence(0, cells - 1)"))
    ).select(
        "bucket", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"), "own", "rep", "pivot", "label"
    )
    keys = ["bucket", "row", "col"]
    known = dealt.join(texts.select("rep", "n", "sketch"), "rep").join(full, "rep")
    ordered = known.select(*keys, "own", "rep", "pivot", "label", "n", "sketch", "full").repartition(*keys).sortWithinPartitions(*keys)

    def compare(cell: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(cell)
        bucket, row, col, own, rep, pivot, label, n = (table.column(k).to_numpy() for k in range(8))
        sketch = _unpacked(table.column(8))
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column(9)]
        n, filled, odds = n.astype(float), sketch != 0, _zero_odds(n)
        bands, has = _band_keys(sketch, n, sets)
        a, b = [], []
        for i in np.flatnonzero((rep != pivot) & (own == row)):
            others = (rep != pivot) & (own == col) & (label != label[i]) & (rep > rep[i] if row[0] == col[0] else True)
            at = np.flatnonzero(others)
            if not len(at):
                continue
            used = (filled[at] | filled[i]).sum(axis=1)
            close = _corrected(((sketch[at] == sketch[i]) & filled[i]).sum(axis=1), used, odds[at] @ odds[i])
            at = at[_allows(close, used, n[at], n[i])]
            # The pair's first shared band is this bucket's.
            at = at[bands[i][((bands[at] == bands[i]) & has[at] & has[i]).argmax(axis=1)] == bucket[0]]
            for k in at:
                if _similar(sets[i], sets[k]):
                    a.append(min(rep[i], rep[k]))
                    b.append(max(rep[i], rep[k]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(batch)] if len(batch) else []
            for start, stop in zip(cuts, cuts[1:], strict=False):
                now = tuple(key[start])
                if held and now != last:
                    yield compare(held)
                    held = []
                held.append(batch.slice(start, stop - start))
                last = now
        if held:
            yield compare(held)

    return ordered.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document.

    Equal sets are taken together first. Sketches of the different ones meet in bands; each bucket's pivot is compared
    with the others, and pairs that are then still in different components are compared in cells, so that no link
    between documents of a bucket is lost and no group is spelled out in pairs. Every link is confirmed on full sets.

    A text without words (or null) is linked with nothing. A null doc_id is linked with nothing and has a null
    component_id; kept is true. Rows that share a doc_id count as one document with several texts, linked where one
    of them is. An empty table gives no rows; columns other than doc_id and text aren't read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = written(sketches(docs), "sketches")
    sets = found.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
        F.first("small").alias("small"), F.count("*").alias("copies"),
    )
    sets = written(sets, "sets")
    texts = sets.select("rep", "n", "sketch", "small")
    buckets, hot = _buckets(texts)
    near = buckets.where(f"rep <> pivot and 100 * least(n, pivot_n) >= {SIMILAR} * greatest(n, pivot_n)")
    first = written(_screened(near.select(F.least("pivot", "rep").alias("a"), F.greatest("pivot", "rep").alias("b")).distinct(), texts), "pairs")
    full = written(_full_sets(docs, texts, buckets.select("rep").distinct()), "full")
    links = written(_confirmed(first, full), "confirmed")
    labels = components(links)
    second = written(_rest(buckets, hot, texts, full, labels), "confirmed")
    if not second.isEmpty():
        labels = components(links.union(second))
    return _classes(found, sets, labels)


def _classes(found: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Each document's component. Copies find that of their set, salted, as a set may have very many; the others their own."""
    salts = 32
    copied = sets.where("copies > 1").select("set_id", "rep").join(labels, "rep", "left").select(
        "set_id", F.coalesce("label", "rep").alias("of_set"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    )
    docs = found.select("doc_id", "n_shingles", "set_id", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    joined = docs.join(copied, ["set_id", "salt"], "left").join(labels.withColumnRenamed("rep", "doc_id"), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_set", "label", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component, with all their columns.

    Rows that repeat a kept document's number all stay.
    """
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
