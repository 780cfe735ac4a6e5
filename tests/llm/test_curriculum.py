import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vitals.llm import curriculum


def targets(sizes, weights=(5, 2, 1)):
    """Resharing as it is told: by weight, what is over to the others, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(sizes), 1.5 * sum(sizes.values())
    while open_:
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def documents(spark):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "c", None, "", "é", "Z"])) for i in range(400)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def test_mix_against_brute_force(spark):
    rows, docs = documents(spark)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    per_source = defaultdict(int)
    for i, _, s in rows:
        per_source[s] += size[i]
    target, taken = targets(per_source), defaultdict(int)
    source = {i: s for i, _, s in rows}
    mixed = curriculum.mix(docs).collect()
    assert sorted(r.doc_id for r in mixed) == list(range(400))
    for r in mixed:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], per_source[s]) and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r["size"] and len(r.times) == -(-r.taken // max(r["size"], 1))
        assert all(0 <= t <= 1 for t in r.times)
        taken[s] += r.taken
    assert all(taken[s] == int(target[s] + 1e-6) for s in per_source)
    assert [tuple(r) for r in curriculum.mix(docs.repartition(2)).orderBy("doc_id").collect()] == [tuple(r) for r in sorted(mixed, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("knots", curriculum.SCHEDULES)
def test_times_invert_the_integrated_schedule(spark, knots):
    got = spark.range(101).select((F.col("id") / 100).alias("u")).select("u", curriculum.due_time(F.col("u"), knots).alias("t")).collect()
    steps = 20_000

    def rate(t):
        for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
            if t <= t1:
                return r0 + (r1 - r0) * (t - t0) / (t1 - t0)

    integral = [0.0]
    for i in range(steps):
        integral.append(integral[-1] + rate((i + 0.5) / steps) / steps)
    for u, t in got:
        assert integral[round(t * steps)] / integral[-1] == pytest.approx(u, abs=2e-4)


def test_early_sources_come_early(spark):
    rows, docs = documents(spark)
    order = curriculum.training_order(curriculum.mix(docs, keep=["doc_id", "source"])).select("kept.source", "time").collect()
    times = [r.time for r in order]
    assert times == sorted(times)
    mean = {s: sum(r.time for r in order if r.source == s) / sum(r.source == s for r in order) for s in ("", "Z", "a")}
    assert mean[""] < mean["Z"] < mean["a"]  # the first, second and third source: early, steady, late


def test_odd_rows(spark, odd, odd_rows, none):
    mixed = curriculum.mix(odd, keep=odd.columns)
    rows = mixed.collect()
    assert len(rows) == len(odd_rows) and all(r.taken == 0 for r in rows if r["size"] == 0)
    assert curriculum.training_order(mixed).select("kept.*").columns == odd.columns
    assert curriculum.mix(none).count() == 0
    blank = odd.filter("text is null or text = ''")
    assert [(r.taken, r.target) for r in curriculum.mix(blank).collect()] == [(0, 0.0)] * 3


def test_positions_count_the_words_before(spark):
    rows, docs = documents(spark)
    mixed = curriculum.mix(docs).cache()
    takes = [(time, r.doc_id, r["size"], n, min(r["size"], r.taken - n * r["size"])) for r in mixed.collect() for n, time in enumerate(r.times)]
    want, done = {}, 0
    for _, doc_id, _, repeat, words in sorted(takes):
        if repeat == 0:
            want[doc_id] = done
        done += words
    got = curriculum.positions(mixed).collect()
    assert {r.doc_id: r.position for r in got if r.position is not None} == want
    assert len(got) == 400 and all((r.position is None) == (r.taken == 0) for r in got)
    placed = [r.position for r in got if r.position is not None]
    assert placed == sorted(placed) and [r.position for r in got[len(placed):]] == [None] * (400 - len(placed))


def test_positions_of_odd_rows(odd, none):
    got = curriculum.positions(curriculum.mix(odd)).collect()
    assert len(got) == odd.count() and curriculum.positions(curriculum.mix(none)).count() == 0
