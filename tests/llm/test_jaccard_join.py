import random

import numpy as np
import pytest

from vitals.llm import jaccard_join as jj

from tests.llm.conftest import docs_of, prose


def words_of(text):
    return (text or "").encode("utf-8").lower().split()


def shingles(text):
    words = words_of(text)
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(docs):
    return sorted((tuple(r) for r in jj.joined(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share / 5))):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(jj, "TILE", 16)


def family(rng, copies):
    """A base and edits of it that resemble the base more than each other, texts that share a passage only, and others."""
    base, passage = prose(1, 160), prose(2, 60)
    texts = [edited(rng, base, rng.choice((0.08, 0.1, 0.2))) for _ in range(copies)] + [base]
    texts += [f"{prose(100 + i, rng.randrange(20, 200))} {passage} {prose(300 + i, 40)}" for i in range(copies)]
    texts += [edited(rng, t, 0.1) for t in texts[copies + 1:][:20]] + [prose(900 + i, rng.randrange(1, 9)) for i in range(40)]
    rng.shuffle(texts)
    return texts


def test_crowded_keys_against_brute_force(spark, small_tiles):
    texts = family(random.Random(5), 90)
    got = result(docs_of(spark, texts).repartition(5))
    assert got == brute(list(enumerate(texts)))
    assert len({r[2] for r in got}) < len(texts) - 50


def test_without_edits_of_the_base(spark, small_tiles):
    """Chains: each text resembles the next one only, and the first the last by links alone."""
    words = prose(3, 400).split(" ")
    texts = [" ".join(words[8 * i:8 * i + 100]) for i in range(30)]
    got = result(docs_of(spark, texts))
    assert got == brute(list(enumerate(texts)))
    assert {r[2] for r in got} == {0}


def test_exact_threshold(spark):
    """84 shingles against 105 that hold them link (0.8), against 106 not."""
    words = [f"a{i}" for i in range(110)]
    texts = [" ".join(words[:88]), " ".join(words[:109]), " ".join(words[:110])]
    assert result(docs_of(spark, texts[:2])) == [(0, 84, 0), (1, 105, 0)]
    assert result(docs_of(spark, texts[::2])) == [(0, 84, 0), (1, 106, 1)]


def test_words_and_case(spark):
    texts = ["A b c d E f", "a\tB\nc  d\x0be f ", "Ä b c d e f", "ä b c d e f", "a b c d e f", "one two", "ONE two", "two one", "x" * 5000, "X" * 5000]
    assert result(docs_of(spark, texts)) == brute(list(enumerate(texts)))


def test_odd_rows(odd, odd_rows):
    assert result(odd) == brute([(r[0], r[1]) for r in odd_rows])


def test_empty_table(none):
    assert result(none) == []


def test_signatures_bound_from_above():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, 4000, rng.integers(1, 3000)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 60, rng.integers(1, 2000)).astype(np.uint64)]))
        width = min(jj.signature_bits(len(a)), jj.signature_bits(len(b)))
        apart = int(np.bitwise_count(jj.folded(jj.signature(a), width) ^ jj.folded(jj.signature(b), width)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - apart) // 2


@pytest.mark.parametrize("more", [1, 4])
def test_near_by_signature_misses_nothing(more):
    rng = random.Random(7)
    texts = family(rng, 40)
    sets = [s for s in map(jj.shingle_set, texts) if len(s)]
    near = {tuple(sorted(p)) for i, j in jj.near_by_signature([len(s) for s in sets], [jj.signature(s, more) for s in sets], 80, more) for p in zip(i.tolist(), j.tolist())}
    if more == 1:
        few = jj.few_near_by_signature([len(s) for s in sets], [jj.signature(s) for s in sets], 80)
        assert {tuple(sorted(p)) for p in few} == near
    pairs = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                pairs += 1
                assert (j, i) in near
    assert pairs > 20


def test_listed_rows_stay_and_few_others(spark):
    listed = spark.range(0, 40_000, 2)
    bits = jj.listed_bits(listed.select(jj.F.xxhash64("id").alias("hash")))
    found = jj.may_be_listed(spark.range(40_000), jj.F.xxhash64("id"), bits).groupBy((jj.F.col("id") % 2).alias("odd")).agg(jj.F.count_if("listed").alias("n"))
    n = {r.odd: r.n for r in found.collect()}
    assert n[0] == 20_000 and n[1] < 200
    nothing = jj.listed_bits(spark.range(0).select(jj.F.xxhash64("id").alias("hash")))
    assert jj.may_be_listed(spark.range(10), jj.F.xxhash64("id"), nothing).filter("listed").isEmpty()


def test_one_row_stands_for_a_set(spark):
    rows = spark.createDataFrame([(i, bytes([i % 7]) if i % 10 else None, 1, [i]) for i in range(100)], "row long, content binary, n_shingles long, prefix array<long>")
    sets = rows.filter("content IS NOT NULL").groupBy("content").agg(jj.F.min("row").alias("node"))
    assert {r.row for r in jj.first_rows(rows, sets).collect()} == {r.node for r in sets.collect()}
