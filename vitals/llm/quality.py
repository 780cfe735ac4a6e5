"""Quality by importance resampling: documents drawn in proportion to how target-like they are.

Two bag-of-n-grams models over hashed buckets (words and marks as written, and
pairs of neighbours) are counted: one over target texts, one over all raw
texts. A document's log weight is its mean log ratio per n-gram, over a
stretch of ``STRETCH`` n-grams, so that length does not decide. Adding Gumbel
noise, fixed by the id, and keeping the ``k`` highest draws without
replacement in proportion to the weights.

The raw model counts every text. The target model learns from a bounded
sample, the ``MAX_ROWS`` good documents outside the held-out fold with the
lowest hash of their id. The ``k``-th key is found by counting 16-bit digits
of the keys, four counts of at most 65 536 rows, never by gathering keys.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from vitals.llm.common import Vocabulary, mix64, ngram_hashes, plain_text, stored, summed_counts
from vitals.llm.toxicity import fold

BITS = 18
MAX_ROWS = 20_000
KEEP = 0.8
SMOOTHING = 1.0
STRETCH = 40.0
#: N-grams' worth of even evidence added to each text, so that a few words do not make an extreme mean.
PRIOR = 20.0
PIECES = re.compile(r"\w+|[^\w\s]+")


def buckets(text: str, vocabulary: Vocabulary) -> np.ndarray:
    pieces = PIECES.findall(text)
    if not pieces:
        return np.empty(0, np.int64)
    words = vocabulary.hash(pieces)
    return (np.concatenate([mix64(words), ngram_hashes(words, 2)]) >> np.uint64(64 - BITS)).astype(np.int64)


def counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in the one column of texts."""
    def counter():
        vocabulary = Vocabulary()

        def add(total, batch):
            for text in batch.column(0):
                np.add.at(total, buckets(text.as_py(), vocabulary), 1)
        return add

    return summed_counts(texts, counter, 1 << BITS)


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    def logs(c):
        return np.log((c + smoothing) / (c.sum() + smoothing * len(c)))
    return (logs(target) - logs(raw)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", max_rows=MAX_ROWS) -> np.ndarray:
    """Log ratio per bucket. Null ids and labels are left out; without any good document all ratios are 0."""
    good = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    good = good.filter(F.col("id").isNotNull() & (fold("id") != 0)).groupBy("id").agg(F.min("label").alias("label"))
    sample = good.filter(F.col("label") == 1).select("id").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    target = docs.select(F.col(doc_id).alias("id"), plain_text(text).alias("text")).join(F.broadcast(sample), "id", "left_semi")
    target = counts(target.select("text"))
    if not target.any():
        return np.zeros(1 << BITS, np.float32)
    return log_ratios(target, counts(docs.select(plain_text(text).alias("text"))))


def score(docs: DataFrame, ratios: np.ndarray, doc_id="doc_id", text="text") -> DataFrame:
    """``docs`` as struct ``doc`` with ``log_weight`` and ``key``, the weight with Gumbel noise fixed by the id."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    @F.pandas_udf("double")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary()
        for texts in batches:
            out = np.zeros(len(texts))
            for i, t in enumerate(texts):
                found = buckets(t, vocabulary)
                out[i] = STRETCH * shared.value[found].sum(dtype=np.float64) / (len(found) + PRIOR)
            yield pd.Series(out)

    uniform = (F.pmod(F.xxhash64(F.lit("gumbel"), F.col(doc_id)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = docs.select(F.struct("*").alias("doc"), weigh(plain_text(text)).alias("log_weight"), uniform.alias("uniform"))
    return rows.select("doc", "log_weight", (F.col("log_weight") - F.log(-F.log("uniform"))).alias("key"))


def ordinal(column: str):
    """Whole numbers in the order of the doubles."""
    @F.pandas_udf("long")
    def numbers(values: pd.Series) -> pd.Series:
        raw = (values.to_numpy(np.float64) + 0.0).view(np.int64)
        return pd.Series(np.where(raw < 0, np.int64(-(2 ** 63)) - raw - 1, raw))

    return numbers(column)


def top_k(rows: DataFrame, k: int, key: str, ties) -> DataFrame:
    """The ``k`` rows with the highest whole-number ``key``; of rows with the last key, the first by ``ties``."""
    total, floor, prefix = rows.count(), None, F.lit(True)
    if k >= total:
        return rows
    if k <= 0:
        return rows.limit(0)
    left = k
    flipped = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))  # digits then order as unsigned numbers
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(flipped, shift).bitwiseAND(F.lit(0xFFFF))
        seen = rows.filter(prefix).groupBy(digit.alias("digit")).count().collect()
        for row in sorted(seen, key=lambda r: -r["digit"]):
            if left <= row["count"]:
                prefix = prefix & (digit == row["digit"])
                floor = (floor or 0) << 16 | row["digit"]
                break
            left -= row["count"]
    last = floor - (1 << 63)
    tied = rows.filter(F.col(key) == last).withColumn("turn", F.row_number().over(W.partitionBy(key).orderBy(*ties)))
    return rows.filter(F.col(key) > last).unionByName(tied.filter(F.col("turn") <= left).drop("turn"))


def resample(docs: DataFrame, ratios: np.ndarray, keep: float = KEEP, doc_id="doc_id", text="text") -> DataFrame:
    """``doc_id, log_weight, key`` of the drawn documents: ``keep`` of all, rounded to whole rows.

    Null and empty texts weigh as much as an even text (log weight 0). Null
    ids share one noise value; rows that repeat an id share theirs. Ties go by
    id and weight. An empty table gives no rows.
    """
    rows = score(docs, ratios, doc_id, text).select(F.col(f"doc.{doc_id}").alias("doc_id"), "log_weight", "key")
    rows = stored(rows.withColumn("ordinal", ordinal("key")), "resample")
    drawn = top_k(rows, round(keep * rows.count()), "ordinal", ["doc_id", "log_weight"])
    return drawn.select("doc_id", "log_weight", "key")
