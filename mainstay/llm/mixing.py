"""Mixing sources: shares to the power of an exponent found by bisection, realised as block permutations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mainstay.llm.columns import free_names
from mainstay.scratch import written

# The exponent is a multiple of 1 / STEPS between 0 (all sources alike) and 1 (as found); a pass tries WAYS of them.
STEPS = 4096
WAYS = 16
# Rows of one source are permuted in buckets of about this many, so that no source is ordered in one task.
BUCKET_ROWS = 4096
# A source may hold a third of the rows: its quota is looked up under this many salts.
SALTS = 32
# Production values.
TARGET_ENTROPY = 0.95
BLOCK_TOKENS = 1_000_000
SEED = 17


def document_tokens(docs: DataFrame, group: str = "source", text: str = "text") -> DataFrame:
    """One slim row per document: doc_id, source, a hash of the text, and n_tokens.

    Tokens are words (runs of other than white space), at least one per document, so that every document takes room.
    Rows that repeat a document (number, source and text) count once.
    """
    count = F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0))
    return docs.select(
        "doc_id", F.col(group).alias("source"), F.xxhash64(text).alias("_row"),
        F.greatest(count, F.lit(1)).cast("long").alias("n_tokens"),
    ).dropDuplicates(["doc_id", "source", "_row"])


def source_totals(tokens: DataFrame) -> DataFrame:
    """Tokens, rows and share of each source; rows without a source form one of their own."""
    totals = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    whole = tokens.agg(F.sum("n_tokens")).scalar()
    return totals.withColumn("all_tokens", whole).withColumn("share", F.col("tokens") / F.col("all_tokens"))


def _first_step(totals: DataFrame, holds, rising: bool) -> int:
    """Bisection with WAYS sections a pass: the last step that holds, or the first one if ``rising``.

    One pass sums the powers of all shares for every exponent it tries, so a pass is one small aggregation however
    many sources there are, and only its sums come to the driver.
    """
    low, high = 0, STEPS
    while low < high:
        width = max(1, -(-(high - low) // WAYS))
        tried = [s for s in range(low, high + 1, width)] + ([high] if (high - low) % width else [])
        sums = []
        for step in tried:
            power = F.pow("share", F.lit(step / STEPS))
            sums += [
                F.sum(power).alias(f"z{step}"), F.sum(power * F.log("share")).alias(f"l{step}"),
                F.max(power / F.col("tokens")).alias(f"r{step}"), F.min(power / F.col("tokens")).alias(f"s{step}"),
            ]
        row = totals.agg(F.count("*").alias("n"), F.max("all_tokens").alias("all"), *sums).first().asDict()
        if not row["n"]:
            return STEPS
        good = [holds(step / STEPS, row[f"z{step}"], row[f"l{step}"], row[f"r{step}"], row[f"s{step}"], row) for step in tried]
        if rising:
            at = good.index(True) if True in good else len(tried) - 1
            low, high = (tried[at - 1] + 1 if at else tried[0]), tried[at]
        else:
            at = max((k for k, g in enumerate(good) if g), default=0)
            low, high = tried[at], (tried[at + 1] - 1 if at + 1 < len(tried) else tried[at])
        if width == 1:
            return tried[at]
    return low


def exponent(
    totals: DataFrame, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = None,
    budget: int | None = None,
) -> float:
    """The exponent nearest to the shares as found that reaches the target.

    ``target_entropy``: the weights' entropy is at least this part of the largest possible one. ``max_repeats``, used
    where the entropy is None: the smallest exponent at which no source is read more than so many times.
    """
    if target_entropy is not None:
        def enough(a, z, logs, _most, _least, row):
            return math.log(z) - a * logs / z >= target_entropy * math.log(row["n"]) - 1e-12

        return _first_step(totals, enough, rising=False) / STEPS

    def few(_a, z, _logs, most, least, row):
        # Without a budget the source read least is read once.
        return (most / least if budget is None else most / z * budget) <= max_repeats + 1e-12

    return _first_step(totals, few, rising=True) / STEPS


def quotas(
    totals: DataFrame, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = None,
    budget: int | None = None, whole: bool = False,
) -> DataFrame:
    """Weight and tokens to read of each source.

    ``budget`` defaults to the corpus' own tokens. With ``whole`` it is the smallest at which every source is read
    through at least once, so that mixing repeats documents but drops none.
    """
    a = exponent(totals, target_entropy, max_repeats, None if whole else budget)
    power = F.pow("share", F.lit(a))
    z, least = totals.agg(F.sum(power)).scalar(), totals.agg(F.min(power / F.col("tokens"))).scalar()
    spend = F.lit(budget).cast("double") if budget is not None else F.col("all_tokens").cast("double")
    spend = z / least if whole else spend
    quota = F.floor(spend * F.col("weight"))
    quota = F.greatest(F.round(spend * F.col("weight")).cast("long"), F.col("tokens")) if whole else quota
    return (
        totals.withColumn("weight", power / z)
        .select("source", "tokens", "rows", "weight", quota.cast("long").alias("quota"), F.lit(a).alias("exponent"))
    )


def mix(
    docs: DataFrame, target_entropy: float | None = TARGET_ENTROPY, max_repeats: float | None = None,
    budget: int | None = None, whole: bool = False, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
    group: str = "source",
) -> DataFrame:
    """The mixture as rows (doc_id, source, _row, epoch, n_tokens, block, place): one per copy of a document.

    Each source is read in permutations of all its documents, a new one each epoch, until its quota of tokens is
    reached; the last document may go over it. Stretches of equal share of every source form a block of about
    ``block_tokens`` tokens, permuted again; ``place`` counts from 1 in a block. Every order follows from the seed by
    hashing, so a lost task makes the same rows again. A null source is a source, a null text has one token, an empty
    table gives no rows; columns other than doc_id, text and the source aren't read.
    """
    tokens = written(document_tokens(docs, group), "tokens")
    totals = written(source_totals(tokens), "sources")
    plan = quotas(totals, target_entropy, max_repeats, budget, whole).where("quota > 0")
    blocks = plan.agg(F.greatest(F.lit(1), F.ceil(F.sum("quota") / F.lit(block_tokens)))).scalar()
    plan = plan.withColumn("blocks", blocks).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    plan = plan.withColumnRenamed("source", "_source").withColumnRenamed("tokens", "_tokens")
    salted = tokens.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "_row"), F.lit(SALTS)).cast("int"))
    copies = salted.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (salted["_salt"] == plan["_salt"])).select(
        "doc_id", "source", "_row", "n_tokens", "_tokens", "rows", "quota", "blocks",
        F.explode(F.sequence(F.lit(0), F.expr("(quota - 1) div _tokens"))).alias("epoch"),
    )
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    top = F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long")
    marked = copies.withColumn("_mark", mark).withColumn(
        "_bucket", F.shiftright(top * F.ceil(F.col("rows") / F.lit(BUCKET_ROWS)), 32)
    )
    bucket = Window.partitionBy("source", "epoch", "_bucket")
    ordered = bucket.orderBy("_mark", "doc_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(ordered), F.lit(0)))
    sums = marked.groupBy("source", "epoch", "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    ahead = Window.partitionBy("source", "epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_s"), F.col("epoch").alias("_e"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"),
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e")) & (F.col("_bucket") == F.col("_b"))
    start = F.col("epoch") * F.col("_tokens") + F.col("_ahead") + F.col("_inside")
    taken = placed.join(sums, same).withColumn("_start", start).where("_start < quota")
    taken = taken.withColumn("block", F.floor(F.col("_start") * (F.col("blocks") / F.col("quota"))).cast("long"))
    inside = F.md5(F.concat_ws("|", F.lit(str(seed)), "block", "_mark"))
    place = Window.partitionBy("block").orderBy("_inside_mark", "source", "doc_id", "_row")
    return taken.withColumn("_inside_mark", inside).select(
        "doc_id", "source", "_row", F.col("epoch").cast("int").alias("epoch"), "n_tokens", "block",
        F.row_number().over(place).alias("place"),
    )


def apply_mix(docs: DataFrame, mixture: DataFrame, group: str = "source") -> DataFrame:
    """``docs`` in the order of the mixture: one row per copy, with the columns of ``docs``, by block and place.

    Rows are ranged by (block, place), so partitions follow each other and one block may be several; a row that repeats a
    document stands beside it. Columns may have any names.
    """
    given = ["doc_id", "source", "_row", "block", "place"]
    doc, source, row, block, place = names = free_names(docs.columns, "_doc", "_src", "_hash", "_block", "_place")
    plan = mixture.select(*[F.col(a).alias(b) for a, b in zip(given, names, strict=True)])
    same = (
        docs["doc_id"].eqNullSafe(F.col(doc)) & docs[group].eqNullSafe(F.col(source))
        & (F.xxhash64(docs["text"]) == F.col(row))
    )
    copies = docs.join(plan, same).select(*[docs[c] for c in docs.columns], block, place)
    return copies.orderBy(block, place).drop(block, place)
