"""Language ID: each document as a mixture of languages, inferred by expectation-maximisation over n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.llm.pretokens import parts

# Letter trigrams fall into this many hash buckets; a language's model is one row of as many probabilities.
BUCKETS = 1 << 15
SMOOTHING = 0.1
# At most so many EM rounds; it ends when no proportion moves by MOVE. Languages under LEAST aren't tried.
ROUNDS, MOVE, LEAST = 20, 0.005, 0.03
# A further language must raise the log likelihood by this many times the log of the number of n-grams.
PENALTY = 2.0
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """How often each bucket's trigrams stand in a whole text, in lower case; other than letters count as one blank sign."""
    total = np.zeros(BUCKETS, np.int64)
    for part in parts(text or ""):
        codes = np.frombuffer(f" {part.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = _letters()[codes]
        if not is_letter.any():
            continue
        codes = np.where(is_letter, codes, 32)
        mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        total += np.bincount((mixed >> np.uint32(17))[is_letter[1:-1]], minlength=BUCKETS)
    return total


@dataclass
class LanguageModel:
    """Trigram probabilities, one column per language."""

    names: list[str]
    probabilities: np.ndarray

    def _fit(self, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log likelihood of the mixture of the given columns."""
        share = np.full(p.shape[1], 1.0 / p.shape[1])
        if p.shape[1] > 1:
            weight = counts / counts.sum()
            for _ in range(ROUNDS):
                joint = p * share
                new = (weight / joint.sum(axis=1)) @ joint
                moved = np.abs(new - share).max()
                share = new
                if moved < MOVE:
                    break
        return share, float(counts @ np.log(p @ share))

    def languages(self, text: str | None) -> tuple[str, float, list[str]]:
        """The main language, its proportion, and the set that the penalised likelihood selects."""
        found = ngrams(text)
        at = np.flatnonzero(found)
        if not len(at) or not self.names:
            return UNKNOWN, 0.0, []
        counts, p = found[at].astype(np.float64), self.probabilities[at]
        share, _ = self._fit(p, counts)
        order = np.argsort(-share, kind="stable")
        tried = order[: max(1, int((share >= LEAST).sum()))]
        cost = PENALTY * np.log(counts.sum() + 1)
        best, main, part = -np.inf, [int(order[0])], share
        for size in range(1, len(tried) + 1):
            chosen = tried[:size]
            within, likelihood = self._fit(p[:, chosen], counts)
            if likelihood - cost * size > best:
                best, main, part = likelihood - cost * size, chosen.tolist(), within
        top = int(np.argmax(part))
        return self.names[main[top]], float(min(1.0, share[main[top]])), [self.names[k] for k in main]


def held_out() -> Column:
    """Documents that nothing is learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def learn(docs: DataFrame) -> LanguageModel:
    """Trigram counts of all labelled documents, added up in each task first; one row per language comes to the driver.

    Its size is bounded by BUCKETS numbers per language, whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                totals[lang] = totals.get(lang, 0) + ngrams(value.as_py())
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "at", "n"])

    taught = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sums = taught.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    rows = sums.groupBy("lang").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    table = np.full((BUCKETS, len(rows)), SMOOTHING)
    for k, row in enumerate(rows):
        table[row.at, k] += row.n
    return LanguageModel([row.lang for row in rows], (table / table.sum(axis=0, keepdims=True)).astype(np.float64))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages of each whole text, judged by the text alone.

    ``score`` is the proportion of the text's n-grams that the mixture gives to lang_pred. A null text or one without a
    letter is `und` with score 0, as is every text where nothing could be learned. Rows without a language teach
    nothing; rows without a doc_id neither, and aren't held out. Rows are judged one by one, so repeated rows repeat; an
    empty table gives no rows; other columns aren't read.
    """
    model = model or learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, languages array<string>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        return pd.DataFrame([known.languages(t) for t in texts], columns=["lang_pred", "score", "languages"])

    judged = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), judge("text").alias("_j"))
    return judged.select("doc_id", "held_out", "_j.lang_pred", "_j.score", "_j.languages")
