"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.scratch import written

# Production values: how far class covariances shrink to the pooled one and to its diagonal, and the bar.
POOL_SHRINK = 0.05
DIAGONAL_SHRINK = 0.02
FLOOR = 1e-3
BAR = 0.3
MARKS = "#*$%&<>"
N_STATS = 13


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text: logs of sizes, square roots of ratios."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_STATS
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [line for line in text.split("\n") if line]
    ratios = [
        len(counts) / n,
        pairs / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, counts)) / len(counts),
        text.count("!") / n,
        sum(map(text.count, MARKS)) / n,
        text.count("|") / n,
        (text.count(".") + text.count(",")) / n,
        sum(map(str.isdigit, counts)) / len(counts),
        1 - len(set(lines)) / max(len(lines), 1),
    ]
    return [math.log1p(n), math.log1p(sum(map(len, words)) / n), *map(math.sqrt, ratios)]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts], np.float64).reshape(-1, N_STATS)


def document_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics of each whole text; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(value.as_py() or "") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Discriminant:
    """Per class: log prior minus half the log determinant, mean, and inverse of the Cholesky factor."""

    constants: list[float]
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]
    fixed: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 from the difference of the Mahalanobis log densities."""
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        logs = [
            c - 0.5 * np.square((x - m) @ f.T).sum(axis=1)
            for c, m, f in zip(self.constants, self.means, self.inverse_factors, strict=True)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame) -> Discriminant:
    """Fit from rows (label, stats): counts, sums and products are added up in Spark, over all labelled rows.

    With one class only every score is that class, without labels one half.
    """
    size = 1 + N_STATS + N_STATS * N_STATS

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {0: np.zeros(size), 1: np.zeros(size)}
        for frame in batches:
            for label in (0, 1):
                x = np.array(frame.loc[frame["label"] == label, "stats"].tolist(), np.float64).reshape(-1, N_STATS)
                total[label] += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        for label, values in total.items():
            yield pd.DataFrame({"label": label, "at": np.arange(size), "value": values})

    parts = labelled.select("label", "stats").mapInPandas(moments, "label int, at int, value double")
    rows = parts.groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    sums = {0: np.zeros(size), 1: np.zeros(size)}
    for row in rows:
        sums[row.label][row.at] = row.value
    counts = {label: values[0] for label, values in sums.items()}
    if min(counts.values()) < 2:
        total = sum(counts.values())
        return Discriminant([], [], [], fixed=0.5 if not total else round(counts[1] / total))
    means, covariances = [], []
    for label in (0, 1):
        mean = sums[label][1:1 + N_STATS] / counts[label]
        second = sums[label][1 + N_STATS:].reshape(N_STATS, N_STATS) / counts[label]
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
    pooled = sum(counts[k] * covariances[k] for k in (0, 1)) / sum(counts.values())
    constants, factors = [], []
    for label in (0, 1):
        shrunk = (1 - POOL_SHRINK) * covariances[label] + POOL_SHRINK * pooled
        shrunk = (1 - DIAGONAL_SHRINK) * shrunk + DIAGONAL_SHRINK * np.diag(np.diag(shrunk)) + FLOOR * np.eye(N_STATS)
        factor = np.linalg.cholesky(shrunk)
        prior = counts[label] / sum(counts.values())
        constants.append(float(math.log(prior) - np.log(np.diag(factor)).sum()))
        factors.append(np.linalg.inv(factor))
    return Discriminant(constants, means, factors)


def held_out() -> Column:
    """Documents whose labels are never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def fit_on(statistics_of: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the labelled documents outside the held-out part; labels without a document or a value count for nothing.

    A document with several labels takes the smallest.
    """
    marks = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    marks = marks.where(~held_out())
    return fit(statistics_of.join(marks, "doc_id").select("label", "stats"))


def classify(docs: DataFrame, labels: DataFrame, bar: float = BAR) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= bar) of every document, from its text alone.

    A null text scores as an empty one. Rows are scored one by one: repeated rows repeat, null doc_ids are scored and
    not held out, an empty table gives no rows; columns other than doc_id and text aren't read.
    """
    stats = written(document_statistics(docs), "stats")
    model = fit_on(stats, labels)

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(rows.tolist(), np.float64).reshape(-1, N_STATS)))

    scored = stats.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score("stats").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= bar).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, bar: float = BAR) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    Only the statistics of documents move, to meet the labels; texts are scored where they are read.
    """
    model = fit_on(document_statistics(docs), labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts.tolist())))

    return docs.where(score(docs["text"]) >= bar)
