import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of, prose
from vitals.llm import quality


def test_top_k_is_exact(spark):
    rng = random.Random(1)
    keys = [rng.choice([rng.randint(-2**63, 2**63 - 1), rng.randint(-3, 3), 7]) for _ in range(2000)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key long").repartition(5)
    ranked = sorted(range(2000), key=lambda i: (-keys[i], i))
    for k in (0, 1, 2, 700, 1300, 1999, 2000, 3000):
        got = {r.id for r in quality.top_k(rows, k, "key", ["id"]).collect()}
        assert got == set(ranked[:k])


def test_ordinals_keep_the_order(spark):
    values = [float("-inf"), -1e300, -2.5, -1e-300, -0.0, 0.0, 1e-300, 3.0, 1e300, float("inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", quality.ordinal("v").alias("o")).collect()
    assert [r.v for r in sorted(rows, key=lambda r: (r.o, r.v))] == values
    assert len({r.o for r in rows}) == len(values) - 1  # -0.0 is 0.0


def test_ratios_and_draw_against_brute_force(spark):
    texts = [prose(i, 50) + (" !! ## " * 20 if i % 5 == 0 else "") for i in range(400)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    folds = {r.doc_id: r.f for r in docs.select("doc_id", quality.fold("doc_id").alias("f")).collect()}
    vocabulary = quality.Vocabulary()
    raw, target = np.zeros(1 << quality.BITS), np.zeros(1 << quality.BITS)
    for i, t in enumerate(texts):
        found = quality.buckets(t, vocabulary)
        np.add.at(raw, found, 1)
        if i % 5 and folds[i]:
            np.add.at(target, found, 1)
    ratios = quality.fit(docs, labels)
    assert np.allclose(ratios, quality.log_ratios(target, raw))
    everyone = {r.doc_id: r for r in quality.resample(docs, ratios, keep=1.0).collect()}
    for i in range(0, 400, 37):
        found = quality.buckets(texts[i], vocabulary)
        assert everyone[i].log_weight == pytest.approx(quality.STRETCH * ratios[found].sum(dtype=float) / (len(found) + quality.PRIOR), abs=1e-4)
    drawn = {r.doc_id for r in quality.resample(docs, ratios, keep=0.6).collect()}
    assert drawn == set(sorted(everyone, key=lambda i: -everyone[i].key)[:240])
    assert sum(i % 5 == 0 for i in drawn) < 4


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1, None), (3, None, 1), (None, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    ratios = quality.fit(odd, labels)
    assert quality.resample(odd, ratios, keep=0.5).count() == round(0.5 * len(odd_rows))
    blank = quality.resample(odd, ratios, keep=1.0).filter(F.col("doc_id").isin(2)).first()
    assert blank.log_weight == 0.0
    assert not quality.fit(odd, labels.limit(0)).any()
    assert quality.resample(none, quality.fit(none, labels)).count() == 0
