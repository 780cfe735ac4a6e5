import random
import re
from collections import Counter

from vitals.llm import collocations as co
from vitals.llm.common import Vocabulary


def brute(rows, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    rows = []
    for phrase, a in candidates.items():
        lang, words = phrase[0], phrase[1:]
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        around = [b for o, b in candidates.items() if o[0] == lang and len(o) > len(phrase)
                  and any(o[i:i + len(words)] == words for i in range(1, len(o) - len(words) + 1))]
        if not any(100 * b >= 80 * a for b in around):
            score, _, l, r = min(cuts)
            rows.append((lang, " ".join(words), a, l, r, totals[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(best)]
    return sorted(out)


def result(docs, **options):
    rows = co.collocations(docs, **options)
    assert dict(rows.dtypes) == {"lang": "string", "phrase": "string", **dict.fromkeys(("rank", "a", "l", "r", "n", "score"), "bigint")}
    return sorted(map(tuple, rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def texts(seed, rows):
    rng = random.Random(seed)
    words = "alpha Beta gamma Delta eps zeta eta Theta iota kappa".split()
    phrases = ["new York city hall", "of the", "once upon a time", "É à", "a"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", ";", "\x0b", " - "]
    out = []
    for _ in range(rows):
        parts = [rng.choice(phrases if rng.random() < 0.4 else words) if rng.random() < 0.9 else f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        out.append(("".join(p + rng.choice(marks) for p in parts), rng.choice(["en", "de", None, ""])))
    return out


def test_against_brute_force(spark):
    rows = texts(1, 900)
    got = result(spark.createDataFrame(rows, "text string, lang string").repartition(6))
    assert got == brute(rows) and len(got) > 10


def test_runs_that_share_bits(spark, monkeypatch):
    """With few bits rare runs pass for frequent ones; windows get longer, counts do not change."""
    monkeypatch.setattr(co, "GRAM_BITS", 8)
    rows = texts(3, 500)
    assert result(spark.createDataFrame(rows, "text string, lang string")) == brute(rows)


def test_few_words_remembered(monkeypatch):
    """Numbers start anew between chunks; what a chunk counts does not depend on it."""
    import pyarrow as pa

    monkeypatch.setattr(co, "_CHUNK", 50)
    monkeypatch.setattr(co, "_WORDS_KEPT", 10)
    rows = texts(4, 80)
    batch = pa.RecordBatch.from_pydict({"text": [t for t, _ in rows], "lang": [g or "und" for _, g in rows]})
    memory, seen = co._Numbers(), Counter()
    for numbers, of, names in memory.chunks(batch):
        words = memory.strings().to_pylist()
        seen.update((names[g], words[n]) for n, g in zip(numbers.tolist(), of.tolist()) if n)
    want = Counter()
    for text, lang in rows:
        want.update((lang or "und", w.decode()) for w in co.words_and_marks(text) if w != b".")
    assert seen == want


def test_top_and_ties(spark):
    rows = [(f"{a} {b}", "en") for a, b in [("x", "y"), ("p", "q"), ("é", "f"), ("z", "z")] for _ in range(40)] + [("m n", "en")] * 29
    assert result(spark.createDataFrame(rows, "text string, lang string"), top=2) == brute(rows, top=2)
    assert [r[2] for r in result(spark.createDataFrame(rows, "text string, lang string"))] == ["p q", "x y", "é f", "z z"]


def test_numbers_beyond_64_bits(spark):
    rows = [("x y", "en")] * 40
    found = co.collocations(spark.createDataFrame(rows, "text string, lang string"), scale=10**18).first()
    assert found["score"] == 10**18 * 40 // 80  # by way of 4 * 10 ** 19


def test_odd_rows(odd, odd_rows):
    rows = [(r[1], r[2]) for r in odd_rows]
    assert result(odd, least=3) == brute(rows, least=3)


def test_empty_table(none):
    assert result(none) == []


def test_words_are_looked_up_once():
    class Counted(list):
        passes = 0

        def __iter__(self):
            self.passes += 1
            return super().__iter__()

    known = Vocabulary(width=2, hashes=lambda words: [[len(w) for w in words], [ord(w[0]) for w in words]])
    for words, numbers in ((["b", "a", "b"], [0, 1, 0]), (["a", "cc", "dd", "cc"], [1, 2, 3, 2]), ([], []), (["b"], [0])):
        counted = Counted(words)
        assert known(counted).tolist() == numbers and counted.passes == 1
    assert known.rows(["dd", "a"]).tolist() == [[2, ord("d")], [1, ord("a")]] and list(known.numbers) == ["b", "a", "cc", "dd"]
    many = [f"w{i}" for i in range(10_000)]
    assert known.hash(many).tolist() == [len(w) for w in many]
