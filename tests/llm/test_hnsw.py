import hashlib
import math

import numpy as np
import pytest

from vitals.llm import hnsw


def brute_force(rows, every, top):
    rows = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in rows:
        if q % every == 0:
            scores = {i: float(v @ rows[q]) for i, v in rows.items() if i != q}
            out[q] = sorted(scores, key=lambda i: (-scores[i], i))[:top]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_recall_over_shards(spark, scale):
    """Also where lengths differ much, so that the largest inner product is not the nearest direction."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 24)) * np.exp(scale * rng.normal(size=(3000, 1)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = found(hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_rows=700))
    want = brute_force(rows, 20, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) > 0.9


def test_copies_tie_to_the_smaller_id(spark):
    rng = np.random.default_rng(5)
    hot = [20.0] + [0.1] * 7
    rows = [(i, hot if i % 3 == 0 else [float(x) for x in rng.normal(size=8)]) for i in range(900)]
    got = found(hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), shard_rows=250))
    assert got[0] == [3 * i for i in range(1, 21)]
    assert got[60] == [3 * i for i in range(22) if 3 * i != 60][:20]
    want = brute_force(rows, 20, 20)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) > 0.9


def test_few_and_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0], "x"), (0, [1.0, 2.0], "x"), (1, [2.0, 1.0], None), (2, None, "y"), (3, [0.0, 0.0], "y"), (4, [nan, 1.0], "y"),
        (5, [inf, 1.0], "y"), (6, [None, 1.0], "y"), (None, [1.0, 1.0], "y"), (20, [-1.0, 0.5], "y"), (40, [], "y"), (-20, [3.0, 3.0], "y"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard string")
    got = hnsw.nearest(frame)
    assert found(got) == brute_force([(0, [1, 2]), (1, [2, 1]), (20, [-1, .5]), (-20, [3, 3])], 20, 20)
    assert {(r.query_id, r.vec_id): r.score for r in got.collect()}[0, 1] == 4.0
    assert hnsw.nearest(frame.limit(0)).count() == 0
    assert hnsw.nearest(frame.filter("vec_id = 20")).count() == 0


def test_several_vectors_under_one_id(spark):
    """Each is a candidate and, where its id asks, a query; copies of both count once."""
    rng = np.random.default_rng(11)
    rows = [(int(i) % 25, tuple(float(x) for x in rng.integers(-9, 10, 3))) for i in range(120)]
    rows += rows[:30] + [(7, (50.0, 50.0, 50.0)), (20, (-50.0, 2.0, 1.0)), (20, (1.0, 1.0, 1.0))]
    want, distinct = {}, sorted(set(rows))
    for own in distinct:
        if own[0] % 20 == 0 and any(own[1]):
            others = [r for r in distinct if r != own and any(r[1])]
            best = sorted((-float(np.dot(r[1], own[1])), r[0]) for r in others)[:20]
            want[own[0], hashlib.sha256(np.array(own[1], "<f8").tobytes()).hexdigest()] = [(i, -s) for s, i in best]
    got = {}
    frame = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, embedding array<double>").repartition(5)
    for r in sorted(hnsw.nearest(frame, shard_rows=40).collect(), key=lambda r: r["rank"]):
        got.setdefault((r.query_id, r.query_sha256), []).append((r.vec_id, r.score))
    assert len([k for k in want if k[0] == 20]) > 2
    assert got == want
    assert got[20, hashlib.sha256(np.ones(3).astype("<f8").tobytes()).hexdigest()][0] == (7, 150.0)


def test_huge_and_tiny_components(spark):
    rows = [(i, [1e200 * (1 + i % 7), -1e200 * (i % 5)]) for i in range(41)]
    got = found(hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert {q: len(v) for q, v in got.items()} == {0: 20, 20: 20, 40: 20}
    rows = [(i, [1e-200 * (1 + i % 7), -1e-200 * (i % 5)]) for i in range(41)]
    assert all(len(v) == 20 for v in found(hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).values())
