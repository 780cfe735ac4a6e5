import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import docs_of, prose
from vitals.llm import suffixes


def brute_force(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + suffixes.LENGTH] for d in data for i in range(len(d) - suffixes.LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - suffixes.LENGTH + 1):
            if seen[d[i:i + suffixes.LENGTH]] > 1:
                gone[i:i + suffixes.LENGTH] = True
        out.append((bytes(np.frombuffer(d, np.uint8)[~gone]), int(gone.sum())))
    return out


def planted():
    rng = random.Random(9)
    passages = [prose(100 + i, 25 + 9 * i) for i in range(8)]
    line = prose(55, 24)  # in most texts, with other words around
    texts = [line.join([prose(i, 30), prose(900 + i, 30)]) for i in range(70)]
    for i in range(60):
        parts = texts[i].split(" ")
        parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        texts[i] = " ".join(parts)
    texts += [texts[0], texts[0], prose(5, 60) * 3, "a" * 700, "ab" * 300, "a" * 199, "a" * 200, "é" * 150, passages[7][3:-4]]
    texts += [texts[1][:250], texts[1][60:280], None, "", prose(2, 10)]
    return texts


@pytest.mark.parametrize("crowd, segment, bucket", [(16_384, 1 << 22, 8192), (3, 1 << 22, 8192), (16_384, 300, 1), (2, 701, 5)])
def test_against_brute_force(spark, monkeypatch, crowd, segment, bucket):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    texts = planted()
    docs = docs_of(spark, texts).repartition(4)
    if (segment, bucket) != (suffixes.SEGMENT, suffixes.BUCKET_RUNS):
        monkeypatch.setattr(suffixes, "SEGMENT", segment)
        found = [suffixes.text_runs((t or "").encode()) for t in texts]
        for text, (_, _, places) in zip(texts, found):  # every string is in one run
            size = len((text or "").encode()) - suffixes.LENGTH + 1
            assert sorted(i for p in places.tolist() for i in range(p >> 16, (p >> 16) + (p & 255))) == list(range(max(size, 0)))
    rows = suffixes.deduplicated(docs).select("kept.doc_id", "n_bytes", "removed", "rest").collect()
    wanted = brute_force(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert (bytes(r.rest), sum(s.end - s.start for s in r.removed)) == wanted[r.doc_id]
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_multikey_sort_finds_equal_strings():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 900)
    group = rng.integers(0, 3, 900)
    for length in (8, 11, 16):
        got = suffixes.equal_neighbours(data, starts, group, length)
        seen = Counter((g, data[s:s + length].tobytes()) for s, g in zip(starts, group))
        assert got.tolist() == [seen[g, data[s:s + length].tobytes()] > 1 for s, g in zip(starts, group)]


def test_odd_rows(spark, odd, odd_rows, none):
    rows = suffixes.deduplicated(odd, keep=("doc_id", "row", "kept")).select("kept.*", "n_bytes", "rest").collect()
    wanted = brute_force([r[1] for r in odd_rows])
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (bytes(r.rest), r.n_bytes) == (wanted[r.row][0], len((odd_rows[r.row][1] or "").encode()))
    assert suffixes.deduplicated(none).count() == 0
