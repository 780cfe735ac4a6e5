import re

import numpy as np
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import docs_of, prose
from vitals.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_force(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and total % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("a1@.+- (0)é2٣%_,"), max_size=40))
def test_base_spans_on_any_text(text):
    assert pii.base_spans(text) == brute_force(text)


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from([
    "a.b@c.de", "@", "x@y", "x@y.z.@q.r", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000.1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", "++49 30 1234567", " ", "\n", "é", "12345678901234567890", "0"]), max_size=8))
def test_base_spans_on_joined_pieces(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute_force(text)


def test_long_numbers_take_linear_time():
    text = "1" * 300_000 + "@" * 1000 + "a" * 100_000
    assert pii.base_spans(text) == []


def test_reliabilities_recover_the_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = np.array([0.95, 0.6, 0.85, 0.9, 0.5])
    votes = np.where(rng.random((20_000, 5)) < right, 2 * truth[:, None] - 1, 1 - 2 * truth[:, None])
    belief, given, prior = pii.reliabilities(votes, np.ones(20_000))
    assert abs(prior - 0.4) < 0.03 and ((belief > 0.5) == truth).mean() > 0.95
    assert np.allclose(given[1, :, 2], right, atol=0.03) and np.allclose(given[0, :, 0], right, atol=0.03)


def spans(row):
    return [(s.kind, s.start, s.end) for s in row]


def test_base_stays_and_loose_spans_are_added(spark):
    texts = [f"{prose(i, 12)} call me, phone 0{i % 8 + 1}5-555-01{i % 90 + 10:02d} {prose(i + 99, 9)} a{i}@mail.example.com" for i in range(120)]
    texts += [f"{prose(i, 12)} invoice page {i % 9}00 111 111 {prose(i, 5)}" for i in range(60)]
    docs = docs_of(spark, texts)
    weights, _ = pii.fit(docs)
    found = {r.doc_id: r for r in pii.find(docs, weights).select("doc.doc_id", "base", "spans").collect()}
    for i, text in enumerate(texts):
        assert spans(found[i].base) == brute_force(text) and set(brute_force(text)) <= set(spans(found[i].spans))
    assert sum(any(k == "phone" for k, _, _ in spans(found[i].spans)) for i in range(120)) > 100
    assert not any(spans(found[i].spans) for i in range(120, 180))


def test_odd_rows(spark, odd, odd_rows, none):
    weights, _ = pii.fit(odd)
    rows = pii.find(odd, weights).collect()
    assert len(rows) == len(odd_rows) and rows[0].doc.asDict().keys() == set(odd.columns)
    assert all(spans(r.base) == brute_force(r.doc.text or "") for r in rows)
    assert pii.find(none, pii.fit(none)[0]).count() == 0


def test_votes_read_the_whole_span():
    """The ending of a long address, not what stands at its 200th character, is looked up."""
    for ending, vote in (("com", 1), ("zzz", -1)):
        text = "a" * 150 + "@" + ".".join(["part"] * 40) + "." + ending
        (is_base, kind, start, end, votes, _), = [c for c in pii.candidates(text) if c[1] == "email"]
        assert is_base and (start, end) == (0, len(text)) and votes[2] == vote
