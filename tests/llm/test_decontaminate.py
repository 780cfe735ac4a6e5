import random

import numpy as np

from tests.llm.conftest import docs_of, prose
from vitals.llm import decontaminate as d


def smith_waterman(item, text):
    table = np.zeros((len(item) + 1, len(text) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (1 if a == b else -d.COST), table[i - 1, j] - d.COST, table[i, j - 1] - d.COST)
    return table.max()


def test_alignment_is_smith_waterman():
    rng = random.Random(3)
    for _ in range(60):
        item = np.array([rng.randint(1, 6) for _ in range(rng.randint(1, 15))])
        text = np.array([rng.randint(0, 6) for _ in range(rng.randint(1, 40))])
        best, end = d.align(item, text[None, :])
        assert best[0] == smith_waterman(item, text)
        if best[0]:
            assert smith_waterman(item, text[:end[0]]) == best[0]


def edited(text, share, seed):
    rng, out = random.Random(seed), []
    for word in text.split():
        turn = rng.random()
        if turn < share / 3:
            continue
        out.append("other" if turn < 2 * share / 3 else word)
        if 1 - share / 3 < turn:
            out.append("added")
    return " ".join(out)


def test_planted_copies_are_found_and_others_left_alone(spark):
    items = [prose(1000 + i, 25 + i) for i in range(12)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [prose(i, 200) for i in range(60)]
    planted = {}
    for n in range(36):
        share = (0.0, 0.1, 0.2)[n % 3]
        planted[n] = n % 12
        texts[n] = f"{prose(n, 90)} {edited(items[n % 12], share, n)} {prose(500 + n, 90)}"
    texts[40] = items[3].upper().replace(" ", ",\n")
    planted[40] = 3
    docs = docs_of(spark, texts)
    found = {(r.doc_id, r.item_id): r for r in d.leaks(docs, benchmark).collect()}
    assert set(found) == set(planted.items())
    exact = found[0, 0]
    assert exact.score == 1.0 and (exact.start, exact.end) == (90, 90 + 25)
    assert {r.doc_id for r in d.clean(docs, benchmark).collect()} == set(range(60)) - set(planted)


def test_a_passage_in_most_documents_is_still_found(spark):
    item = prose(7, 30)
    docs = docs_of(spark, [f"{prose(i, 40)} {item} {prose(99 + i, 40)}" for i in range(50)] + [prose(777, 90)])
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (None, "a b"), (4, "x y z")], "item_id long, text string")
    rows = d.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(i, 1) for i in range(50)]


def test_odd_rows(spark, odd, odd_rows, none):
    long = next(r[1] for r in odd_rows if r[0] == 5)
    benchmark = spark.createDataFrame([(1, " ".join(long.split()[20_000:20_040])), (2, None), (3, "")], "item_id long, text string")
    assert sorted(r.doc_id for r in d.leaks(odd, benchmark).collect()) == [5, 6]
    kept = d.clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - 2
    assert d.leaks(none, benchmark).count() == 0
    assert d.leaks(odd, benchmark.limit(0)).count() == 0 and d.clean(odd, benchmark.limit(0)).count() == len(odd_rows)
