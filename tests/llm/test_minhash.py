import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import docs_of, prose
from vitals.llm import common, minhash
from vitals.llm.common import text_hashes, words_of
from vitals.llm.components import components


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: find(i) for i in root if i not in alone}


def test_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(2)
    agree, wanted = [], []
    for _ in range(150):
        grams = np.sort(rng.integers(0, 2**63, 120).astype(np.uint64))
        a, b = rng.random(120) * 3 + 0.2, rng.random(120) * 3 + 0.2
        same = rng.random(120) < 0.8
        b[same] = a[same]
        agree.append((minhash.signature(grams, a) == minhash.signature(grams, b)).mean())
        wanted.append(minhash.similarity((grams, a), (grams, b)))
    assert abs(np.mean(agree) - np.mean(wanted)) < 0.02
    assert wanted[0] == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.2)


def corpus():
    """Base texts, each with copies changed in a few places, exact copies, and a text most share a part of."""
    rng, texts = random.Random(8), []
    shared = prose(77, 60)
    for i in range(25):
        base = prose(200 + i, 150).split()
        texts.append(" ".join(base))
        for _ in range(i % 5):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
        texts.append(f"{shared} {prose(400 + i, 120)}")
    many = prose(3, 120).split()
    for i in range(40):
        copy = list(many)
        copy[3 * i % 120] = f"w{i}"
        texts.append(" ".join(copy))
    return texts + [texts[0].upper(), texts[0] + "!", "a b", "A, b", ""]


def word_by_word(text):
    return np.array([text_hashes(w)[0] for w in words_of(text)], np.uint64)


def brute_force(texts, idf, threshold):
    vectors = [minhash.shingles(word_by_word(t), idf) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if minhash.similarity(vectors[i], vectors[j]) >= threshold:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


@pytest.mark.parametrize("block", [256, 3])
def test_classes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    texts = corpus()
    docs = docs_of(spark, texts).repartition(3)
    wanted = brute_force(texts, minhash.inverse_frequencies(docs), minhash.SIMILARITY)
    rows = minhash.classes(docs).select("doc.doc_id", "class_id").collect()
    assert [r.class_id for r in sorted(rows)] == wanted
    assert len(set(wanted)) < len(texts) - 50
    assert sorted(r.doc_id for r in minhash.deduplicated(docs).collect()) == sorted(set(wanted))


def test_copies_that_resemble_only_their_base(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 16)
    rng, base = random.Random(6), prose(31, 400).split()
    texts = [" ".join(base)]
    for i in range(90):
        copy = list(base)
        for n, k in enumerate(sorted(rng.sample(range(0, 400, 8), 7))):
            copy[k] = f"w{i}x{n}"
        texts.append(" ".join(copy))
    docs = docs_of(spark, texts[1:] + texts[:1])
    idf = minhash.inverse_frequencies(docs)
    vectors = [minhash.shingles(word_by_word(t), idf) for t in texts]
    assert all(minhash.similarity(vectors[0], v) >= minhash.SIMILARITY for v in vectors[1:])
    assert sum(minhash.similarity(a, b) >= minhash.SIMILARITY for i, a in enumerate(vectors[1:]) for b in vectors[i + 2:]) < 10
    # candidates of the base: the copies that share a band with it
    own = [set(minhash.bands(*v)) for v in vectors]
    wanted = {i for i in range(90) if own[0] & own[i + 1]} | {90}
    rows = minhash.classes(docs).select("doc.doc_id", "class_id").collect()
    assert {r.doc_id for r in rows if r.class_id == min(wanted)} >= wanted


@pytest.mark.parametrize("hot", [2, 20])
def test_tiles_have_every_pair(spark, monkeypatch, hot):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 8)
    rng = random.Random(hot)
    rows = [(1 + i % 2, b"%03d" % i, rng.uniform(50, 90), b"%03d" % (i if i > hot else 0)) for i in range(60)]
    got = {}
    for r in minhash.tiled(spark.createDataFrame(rows, "band long, content binary, weight double, root binary"), 0.8).collect():
        got.setdefault(r.tile, {0: [], 1: []})[r.side].append(bytes(r.content))
    met = {frozenset((a, b)) for t in got.values() for a in t[0] for b in t[1] or t[0] if a != b}
    wanted = {frozenset((a[1], b[1])) for a in rows for b in rows if a[0] == b[0] and a[3] != b[3] and a[2] >= b[2] >= 0.8 * a[2]}
    assert wanted <= met and max(len(t[0]) for t in got.values()) < 16


def test_bound_misses_no_similar_pair():
    rng = np.random.default_rng(5)
    grams = np.sort(rng.integers(0, 2**63, 200).astype(np.uint64))
    vectors = []
    for _ in range(40):
        kept = rng.random(200) < 0.93
        vectors.append((grams[kept], (rng.integers(1, 3, 200) * 1.1)[kept] if len(vectors) % 2 else np.ones(kept.sum())))
    for threshold in (0.5, 0.8, 0.9):
        met = set(map(tuple, minhash.similar_pairs(vectors, threshold)))
        assert {(i, j) for j in range(40) for i in range(j) if minhash.similarity(vectors[i], vectors[j]) >= threshold} <= met


def test_odd_rows(spark, odd, odd_rows, none):
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    wanted = {}  # equal words or, without any, equal texts: the first by id, null ids last
    for r in sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = words_of(r[1] or "")
        wanted.setdefault(" ".join(words) if words else "\0" + (r[1] or ""), r[0])
    assert sorted((i for i, _ in ids), key=str) == sorted(wanted.values(), key=str)
    assert minhash.classes(odd).count() == len(odd_rows)
    assert minhash.classes(none).count() == 0 and minhash.deduplicated(none).count() == 0


@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("aΣς.' \n\x1c\x85_1İ@é"), max_size=25), max_size=4))
def test_word_hashes_are_those_of_the_words(texts):
    whole, common._STRETCH = common._STRETCH, 3
    try:
        cut = [text_hashes(t).tolist() for t in texts]
    finally:
        common._STRETCH = whole
    assert cut == [text_hashes(t).tolist() for t in texts] == [word_by_word(t).tolist() for t in texts]


def test_word_hashes_tell_words_apart():
    words = sorted({w for i in range(400) for w in prose(i, 200).split()} | {"ab", "ba", "é", "\U00020000", "a" * 63, "a" * 64, "a" * 1000, "a" * 1001})
    hashes = text_hashes(" ".join(words))
    assert len(set(hashes.tolist())) == len(words) == len(hashes)
    assert (hashes == word_by_word(" ".join(words))).all() and (text_hashes(" ".join(words).upper())[0] == hashes[0])


def test_components_move_links_in_few_shuffles(spark, monkeypatch):
    from vitals.llm import components as module
    steps = []

    def watched(df, purpose):
        steps.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return stored(df, purpose)

    stored = module.stored
    monkeypatch.setattr(module, "stored", watched)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = {r.node: r.root for r in components(spark.createDataFrame([(i, i + 1) for i in range(40)] * 2 + [(50, 60), (60, 50), (7, 7)], "a long, b long")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50}
    assert len(steps) > 5 and steps[1] <= 2 and max(steps[3:]) <= 2
