"""Toxicity by logistic regression learned with FTRL-proximal.

Features are presences of hashed word n-grams and skip-grams: words, their
first four and five letters (inflected forms of a word share them), pairs of
neighbours, and pairs with one or two words between. FTRL-proximal gives every
coordinate its own rate and an L1 penalty, so few weights are not zero; those
few are what is sent to the executors, at most ``2 ** BITS`` of them.

Training reads a bounded sample: the ``max_rows`` labelled documents with the
lowest hash of their id (all, if there are fewer), one at a time; their features
wait for the passes over them in a temporary file. Scoring reads everything.
"""

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitals.llm.common import PLACES, Vocabulary, mix64, plain_text, word_hash, words_of

BITS = 20
MAX_ROWS = 12_000
#: Passes over the sample: as many as give so many steps, within these bounds.
STEPS, LEAST_EPOCHS, MOST_EPOCHS = 20_000, 2, 10
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1.0
#: Features of fewer training documents are not learned (FTRL's inclusion by count).
LEAST_DOCS = 4
SKIPS = (1, 2, 3)
FOLDS = 5
#: Words and stems remembered at a time; a Python worker keeps the memory they took.
MOST_WORDS, MOST_STEMS = 150_000, 100_000
_STRETCH = 1 << 16


def feature_vocabulary() -> Vocabulary:
    """Hashes of the word, of its first four and of its first five letters."""
    stems: dict[str, int] = {}

    def stem(word):
        if word not in stems:
            if len(stems) > MOST_STEMS:
                stems.clear()
            stems[word] = word_hash(word + "~")
        return stems[word]

    return Vocabulary(lambda words: [
        list(map(word_hash, words)), [stem(w[:4]) for w in words], [stem(w[:5]) for w in words]], 3, MOST_WORDS)


def coordinates(text: str, vocabulary) -> np.ndarray:
    """Coordinates of all features of a text, with repeats."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64)
    own = vocabulary.rows(words)
    first = own[:, 0]
    hashes = [own.ravel()]
    for skip in SKIPS:
        if len(first) > skip:
            hashes.append(mix64(first[:-skip] * PLACES[0] + first[skip:] * PLACES[skip]))
    return (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def train(texts: Iterable[str], labels: list[int], epochs=None, alpha=ALPHA, beta=BETA, l1=L1, l2=L2, least_docs=LEAST_DOCS):
    """FTRL-proximal over the texts in the given order; returns (bias, coordinates, weights).

    Texts are read once, before the labels; no two of them are held at a time.
    """
    with tempfile.TemporaryFile() as features:
        docs, sizes = count_features(texts, features)
        return learn_weights(features, docs, sizes, labels, epochs, alpha, beta, l1, l2, least_docs)


def count_features(texts: Iterable[str], features) -> tuple[np.ndarray, list[int]]:
    """Writes each text's coordinates to the file; texts per coordinate, and how many coordinates each text has."""
    docs, sizes, vocabulary = np.zeros(1 << BITS, np.int32), [], feature_vocabulary()
    for text in texts:
        at = np.unique(coordinates(text, vocabulary)).astype(np.int32)
        docs[at] += 1
        features.write(at.tobytes())
        sizes.append(len(at))
    return docs, sizes


def learn_weights(features, docs, sizes, labels, epochs, alpha, beta, l1, l2, least_docs):
    epochs = epochs or min(MOST_EPOCHS, max(LEAST_EPOCHS, -(-STEPS // max(len(sizes), 1))))
    included = np.flatnonzero(docs >= least_docs)
    number = np.cumsum(docs >= least_docs, dtype=np.int32) - 1
    size = len(included)
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias, which L1 spares

    def weights(at):
        zs = z[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, w)

    def bias():
        return -z[size] / ((beta + np.sqrt(n[size])) / alpha)

    for _ in range(epochs):
        features.seek(0)
        for found, label in zip(sizes, labels):
            at = np.frombuffer(features.read(4 * found), np.int32)
            at = number[at[docs[at] >= least_docs]]
            w = weights(at)
            b = bias()
            g = sigmoid(w.sum() + b) - label
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
            z[size] += g - (np.sqrt(n[size] + g * g) - np.sqrt(n[size])) / alpha * b
            n[size] += g * g
    every = np.zeros(size)
    for low in range(0, size, _STRETCH):
        part = slice(low, min(low + _STRETCH, size))
        every[part] = weights(part)
    used = np.flatnonzero(every)
    return float(bias()), included[used].astype(np.int32), every[used].astype(np.float32)


def fold(doc_id: str | Column) -> Column:
    """Remainder that decides whether a row's label may be learned from (0: held out)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", max_rows=MAX_ROWS, epochs=None):
    """Learns from labelled rows outside the held-out fold.

    Null ids and null labels are left out; of contradicting labels of one id
    the higher counts, of documents with the same id each is a row. Without
    any row the bias is 0 and there are no weights, so every score is 0.5.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & (fold("id") != 0))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)  # at most max_rows ids, so the broadcast is bounded
    rows = docs.select(F.col(doc_id).alias("id"), plain_text(text).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(max_rows)

    def learn(batches):
        marks = []

        def texts():
            for batch in batches:
                marks.extend(batch.column(1).to_pylist())
                for text in batch.column(0):
                    yield text.as_py()

        bias, at, weight = train(texts(), marks, epochs)
        yield pa.RecordBatch.from_pydict({"bias": [bias], "at": [at.tobytes()], "weight": [weight.tobytes()]})

    learned = rows.select("text", "label").coalesce(1).mapInArrow(learn, "bias double, at binary, weight binary").collect()
    row = learned[0] if learned else None
    if row is None:
        return 0.0, np.empty(0, np.int32), np.empty(0, np.float32)
    return row["bias"], np.frombuffer(row["at"], np.int32), np.frombuffer(row["weight"], np.float32)


def score(docs: DataFrame, model, text="text") -> DataFrame:
    """``docs`` as struct ``doc`` with ``score``, the probability of label 1.

    The score looks at the text alone. Null and empty texts get the score of
    a text without features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, at, weight = shared.value
        full, vocabulary = np.zeros(1 << BITS, np.float32), feature_vocabulary()
        full[at] = weight
        for texts in batches:
            sums = np.empty(len(texts))
            for i, t in enumerate(texts):
                found = coordinates(t, vocabulary)
                found = np.unique(found[full[found] != 0])
                sums[i] = full[found].sum(dtype=np.float64) + bias
            yield pd.Series(sigmoid(sums))

    return docs.select(F.struct("*").alias("doc"), scored(plain_text(text)).alias("score"))
