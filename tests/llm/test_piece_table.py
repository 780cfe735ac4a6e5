import hashlib
import re

import pytest
from pyspark.sql import functions as F

from vitals.llm import piece_table

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    key = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[8 * i:8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        form, output, chars = "plain", text, (None, None)
    else:
        form = "spm" if h4 % 100 < 80 else "psm"
        output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
        chars = len(prefix), len(middle)
    return len(units), form, *chars, output, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256")


def check(docs, rows):
    made = piece_table.transformed(docs)
    restored = piece_table.text_of(F.col("output"), F.col("sentinels"), F.col("found"))
    got = made.select("doc.doc_id", "doc.text", *COLUMNS, restored.alias("again")).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r[:-1]) for r in got), key=key) == sorted(((i, t, *brute(i, t)) for i, t in rows), key=key)
    assert all(r["again"] == (r["text"] or "") for r in got)
    return got


def test_against_brute_force(spark):
    texts = ["", " ", "\t\n ", "one", " one", "one ", "a b  c\td\n\n", "x<P>y", "<", "<S", "a <P b <S c <M d", "<<P ><", "über \U0001F600 日本 x ", "S>M>P> <"]
    rows = [(100 * n + i, t) for n, t in enumerate(texts) for i in range(30)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(odd, odd_rows):
    check(odd, [(r[0], r[1]) for r in odd_rows])


def test_empty_table(none):
    assert piece_table.transformed(none).count() == 0


def test_columns_stay(odd):
    made = piece_table.transformed(odd)
    assert made.select("doc.*").columns == odd.columns


def test_marks_that_could_be_confused(odd):
    with pytest.raises(ValueError):
        piece_table.described(odd, sentinels=("ab", "ba", "c"))
    with pytest.raises(ValueError):
        piece_table.described(odd, sentinels=("<P>", "<P>", "<M>"))


def test_other_marks_and_shares(spark):
    rows = [(i, f"word{i} and more | here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    made = piece_table.transformed(docs, sentinels=marks, fim_percent=100, spm_percent=0)
    for r in made.select("doc.text", "form", "output", "output_sha256", "restored_sha256").collect():
        assert r["form"] == "psm" and r["output"].startswith("<|pre|>")
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
