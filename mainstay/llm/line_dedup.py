"""Line dedup: keys ranged over the cluster, first occurrences streamed, keep bitmaps per document returned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mainstay.llm.columns import BLANKS, free_names, let, lower_ascii
from mainstay.scratch import written

# Production values: shorter keys are never repeats.
MIN_CHARS = 10
# Keys with more rows than 1 / (PER_PARTITION x shuffle partitions) of all are settled without moving their rows.
PER_PARTITION = 8
MOST_FREQUENT = 100_000
# The first row of a document with the same number and text; both passes over the documents compute it alike.
ROW = ["doc_id", "_row"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row (doc_id, _row, pos, h1, h2) per line whose key is long enough; 128 bits stand for the key."""
    lines = docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("_row"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    keys = lines.select(*ROW, "pos", F.btrim("line", F.lit(BLANKS)).alias("key")).where(F.length("key") >= min_chars)
    low = lower_ascii(F.col("key"))
    return keys.select(*ROW, "pos", F.xxhash64(low).alias("h1"), F.xxhash64(F.lit(min_chars), low).alias("h2"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines (doc_id, _row, pos) whose key stands in a document of smaller number.

    A key that holds a large share of the lines isn't moved: its smallest document is aggregated in each task first,
    and the few such keys (at most ``PER_PARTITION`` per shuffle partition, as each holds more than its share of all
    rows) are looked up by broadcast. All others are ranged by hash and sorted by document and position; one pass
    over each range compares every line with the first of its key.
    """
    spark = lines.sparkSession
    share = PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(share, MOST_FREQUENT)
    found = lines.agg(F.call_function("approx_top_k", F.col("h1"), F.lit(most), F.lit(8 * most)).alias("top"), F.count("*").alias("n"))
    hot = found.select("n", F.explode("top").alias("t")).where(F.col("t.count") * share > F.col("n"))
    hot = hot.select(F.col("t.item").alias("h1"))
    hot_lines = lines.join(F.broadcast(hot), "h1", "left_semi")
    firsts = hot_lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    firsts = firsts.groupBy("h1").agg(F.map_from_entries(F.collect_list(F.struct("h2", "first"))).alias("firsts"))
    marked = lines.join(F.broadcast(firsts), "h1", "left")
    settled = marked.where("firsts is not null and doc_id > firsts[h2]").select(*ROW, "pos")
    ranged = (
        marked.where("firsts is null").select(*ROW, "pos", "h1", "h2")
        .repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", "doc_id", "pos")
    )
    key = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    streamed = ranged.withColumn("first", F.first("doc_id").over(key)).where("doc_id > first").select(*ROW, "pos")
    return streamed.unionByName(settled)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document that loses a line: doc_id, _row (hash of the text) and keep, its bitmap.

    keep lists the 64-line words in which a line goes, as structs (word, bits); a set bit is a kept line, and words
    that aren't listed keep all their lines. Documents that keep everything have no row. A line's key is the line
    without white space at its ends and with A-Z in lower case; keys of ``min_chars`` code points or more found in
    two documents stay only in the document of the smallest number, with all their repeats there. Rows without a
    doc_id or text hold no key and lose nothing. Rows that share a doc_id count as one document: none loses a line
    to another, and each gets the bitmap of its own text. An empty table gives no rows.
    """
    lines = written(line_hashes(docs, min_chars), "lines")
    words = repeated_lines(lines).groupBy(*ROW, F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("gone")
    )
    return words.groupBy(*ROW).agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep")
    )


def _keep_flags(keep: Column, count: Column) -> Column:
    """The bitmap spelled out, one word for every 64 lines."""
    return let(
        F.map_from_entries(keep),
        lambda known: F.transform(
            F.sequence(F.lit(0), F.shiftright(count - 1, 6)), lambda w: F.coalesce(known[w], F.lit(-1).cast("long"))
        ),
    )


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit is set."""
    return let(
        _keep_flags(keep, F.size(lines)),
        lambda flags: F.filter(
            lines,
            lambda line, i: F.get(flags, F.shiftright(i, 6)).bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), i.bitwiseAND(F.lit(63)))
            ) != 0,
        ),
    )


def _joined(docs: DataFrame, bitmaps: DataFrame, doc: str = "_doc", row: str = "_hash", keep: str = "_keep") -> DataFrame:
    marked = bitmaps.select(F.col("doc_id").alias(doc), F.col("_row").alias(row), F.col("keep").alias(keep))
    return docs.join(marked, (docs["doc_id"] == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(row)), "left")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the lines that the bitmaps drop taken out of text; all rows and columns stay.

    A document that loses all its lines keeps its row with an empty text, as other columns may still be wanted. Columns
    may have any names.
    """
    names = free_names(docs.columns, "_doc", "_hash", "_keep")
    joined, keep = _joined(docs, bitmaps, *names), F.col(names[-1])
    text = F.when(keep.isNull(), docs["text"]).otherwise(F.array_join(kept_lines(_lines(docs["text"]), keep), "\n"))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def dedup_digest(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines before dropping, n_dropped and kept_sha256 of each document's kept text.

    A null or empty text counts as one empty line.
    """
    docs = docs.select("doc_id", "text")
    joined = _joined(docs, keep_bitmaps(docs, min_chars))
    gone = F.aggregate("_keep", F.lit(0), lambda total, w: total + F.bit_count(F.bitwise_not(w["bits"])))
    kept = F.when(F.col("_keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(kept_lines(_lines(F.col("text")), F.col("_keep")), "\n")
    )
    return joined.select(
        "doc_id", F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"),
    )
