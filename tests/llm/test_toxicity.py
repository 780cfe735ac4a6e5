import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of, prose
from vitals.llm import toxicity


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_ftrl_follows_its_formula():
    texts = [prose(i, 30) + (" vile scum" if i % 3 == 0 else "") for i in range(60)]
    labels = [int(i % 3 == 0) for i in range(60)]
    bias, at, weight = toxicity.train(texts, labels, epochs=2, l1=0.5, least_docs=1)
    vocabulary = toxicity.feature_vocabulary()
    z, n, zb, nb = {}, {}, 0.0, 0.0

    def w(i):
        return 0.0 if abs(z.get(i, 0)) <= 0.5 else -(z[i] - np.sign(z[i]) * 0.5) / ((1 + np.sqrt(n[i])) / toxicity.ALPHA + 1)

    for _ in range(2):
        for text, label in zip(texts, labels):
            found = sorted(set(toxicity.coordinates(text, vocabulary).tolist()))
            own = {i: w(i) for i in found}
            b = -zb / ((1 + np.sqrt(nb)) / toxicity.ALPHA)
            g = 1 / (1 + np.exp(-(sum(own.values()) + b))) - label
            for i in found:
                z[i] = z.get(i, 0) + g - (np.sqrt(n.get(i, 0) + g * g) - np.sqrt(n.get(i, 0))) / toxicity.ALPHA * own[i]
                n[i] = n.get(i, 0) + g * g
            zb, nb = zb + g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / toxicity.ALPHA * b, nb + g * g
    expected = {i: w(i) for i in z if w(i)}
    assert bias == pytest.approx(-zb / ((1 + np.sqrt(nb)) / toxicity.ALPHA))
    assert set(at.tolist()) == set(expected)
    assert np.allclose(weight, [expected[i] for i in at.tolist()], atol=1e-5)


def test_held_out_accuracy(spark):
    """Words that only toxic rows have, with endings not seen before; the labels of the held-out fold are not learned."""
    stems = ["scumm", "vilex", "trashy"]
    texts = [prose(i, 60) + (f" {stems[i % 3]}{'aeiou'[i % 5]} here" if i % 4 == 0 else "") for i in range(1200)]
    docs = docs_of(spark, texts)
    model = toxicity.fit(docs, labelled(spark, [(i, 1, int(i % 4 == 0)) for i in range(1200)]))
    rows = toxicity.score(docs, model).select("doc.doc_id", "score", (toxicity.fold("doc.doc_id") == 0).alias("held_out")).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.97


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = docs_of(spark, [prose(i, 20) for i in range(80)])
    fold = {r.doc_id: r.f for r in docs.select("doc_id", toxicity.fold("doc_id").alias("f")).collect()}
    one = toxicity.fit(docs, labelled(spark, [(i, 1, i % 2) for i in range(80)]))
    two = toxicity.fit(docs, labelled(spark, [(i, 1, i % 2 if fold[i] else 1 - i % 2) for i in range(80)]))
    assert one[0] == two[0] and np.array_equal(one[1], two[1]) and np.array_equal(one[2], two[2])


def test_odd_rows(spark, odd, odd_rows, none):
    labels = labelled(spark, [(1, 1, 1), (3, None, 0), (4, 1, None), (None, 1, 1), (5, 1, 0), (5, 1, 1)])
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).select("doc.*", F.col("score").alias("probability")).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.probability <= 1 for r in rows)
    blank = {r.probability for r in rows if not (r.text or "").strip(" \n\t!?")}
    assert len(blank) == 1  # null, empty and wordless texts score alike
    assert toxicity.fit(odd, labels.limit(0))[0] == 0.0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_training_memory_does_not_follow_the_texts():
    def peak(n):
        rng = random.Random(7)
        words = [f"w{i}" for i in range(2_000)]
        texts = [" ".join(rng.choices(words, k=400)) for _ in range(n)]
        tracemalloc.start()
        found = toxicity.train((t for t in texts), [i % 2 for i in range(n)], epochs=1)
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert len(found[1]) == len(found[2])
        return most

    peak(10)
    # a text has some 2 800 features; kept in memory, those of 1 200 more texts would take 13 MB and more
    assert peak(1_500) - peak(300) < 6_000_000


def test_model_does_not_depend_on_what_is_remembered(monkeypatch):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(3_000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(300)]
    labels = ["word7 " in t for t in texts]
    wanted = toxicity.train(texts, labels, epochs=3, l1=0.1)
    monkeypatch.setattr(toxicity, "MOST_WORDS", 100)
    monkeypatch.setattr(toxicity, "MOST_STEMS", 50)
    got = toxicity.train(texts, labels, epochs=3, l1=0.1)
    assert got[0] == wanted[0] and len(wanted[1])
    assert got[1].tolist() == wanted[1].tolist() and got[2].tolist() == wanted[2].tolist()
