"""Personal data: base patterns, weak supervision for what they do not settle.

Candidates are the base spans and looser ones (numbers written without ``+``,
spelled-out addresses, long IP forms, social security numbers). Labelers of
three sorts vote on each: regexes (its form), gazetteers (known hosts and
endings) and context (words just before). Votes are counted over all
documents, expectation-maximisation estimates how reliable each labeler is,
and a logistic regression over form and context, fitted to the resulting
probabilities, decides about the loose candidates. Base spans always stay.

The driver only gets counts of distinct (votes, features) patterns, of which
there are at most a few thousand whatever the data.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitals.llm.common import plain_text

KINDS = ("email", "ip", "card", "phone", "ssn")
BASE_KINDS = KINDS[:4]

# ------------------------------------------------------------ base patterns

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Digits are taken whole and from their start on, where the leftmost match begins anyway; this keeps long numbers linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the base pattern, found from each ``@`` outwards."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            found.append((start, last))
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 8 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# ------------------------------------------------------------ loose candidates

_SSN = re.compile(r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_LOOSE_PHONE = re.compile(r"(?<![\w.+/-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])")
_SPELLED = re.compile(
    r"(?<!\w)[A-Za-z0-9._-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{2,63}){1,4}(?!\w)")
_LONG_IP = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")


def loose_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates beside the base spans, none overlapping those or each other."""
    found = []
    if "dot" in text:
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if text.count(":") >= 7:
        found += [("ip", *m.span()) for m in _LONG_IP.finditer(text)]
    if _DIGIT.search(text):
        found += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        found += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text)]
    if not found:
        return []
    kept, ends = [], sorted((s, e) for _, s, e in base)
    for kind, s, e in sorted(found, key=lambda f: (f[1], -f[2], KINDS.index(f[0]))):
        if (not kept or s >= kept[-1][2]) and all(e <= bs or s >= be for bs, be in ends):
            kept.append((kind, s, e))
    return kept


# ------------------------------------------------------------ labelers

_BEFORE = 40
_SAYS = {
    "email": re.compile(r"mail|contact|write|reach", re.I), "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|pay|account", re.I), "phone": re.compile(r"phone|call|tel\b|mobile|fax|ring", re.I),
    "ssn": re.compile(r"ssn|social|security|insured", re.I),
}
_DENIES = re.compile(r"version|isbn|order|invoice|page|score|serial|[$€£%#]\s*$", re.I)
_ENDINGS = frozenset("com net org edu gov io de fr es uk info eu".split())


def votes_of(kind: str, value: str, before: str, base: bool) -> tuple[int, ...]:
    """Votes of the labelers: 1 for, -1 against, 0 none."""
    digits = _NOT_DIGITS.sub("", value)
    form = 1 if base else 0
    if not base:
        if kind == "phone":
            form = 1 if 9 <= len(digits) <= 12 else -1
        elif kind == "ssn":
            form = 1 if digits[:3] not in ("000", "666") and digits[3:5] != "00" and digits[5:] != "0000" and digits[0] != "9" else -1
        elif kind == "ip":
            form = 1 if len(set(value.split(":"))) > 2 else -1
        else:
            form = 1 if "[" in value or "(" in value else 0
    variety = 0 if kind == "email" else 1 if len(set(digits)) >= 4 else -1
    listed = 0
    if kind == "email":
        listed = 1 if re.split(r"[^A-Za-z]+", value)[-1].lower() in _ENDINGS else -1
    elif kind == "phone":
        listed = 1 if re.search(r"\D555\D|^\D*(?:0|1)", value) else 0
    says = 1 if _SAYS[kind].search(before) else 0
    denies = -1 if _DENIES.search(before) else 0
    return form, variety, listed, says, denies


def features_of(kind: str, value: str, before: str) -> int:
    """Form and context of a candidate as bits."""
    digits, length = _NOT_DIGITS.sub("", value), len(value)
    flags = (
        *(kind == k for k in KINDS), len(digits) >= 9, len(digits) >= 13, " " in value, "-" in value, "(" in value,
        "." in value, length > 20, bool(_SAYS[kind].search(before)), bool(_DENIES.search(before)), len(set(digits)) >= 4,
        value[:1] in "+(", before[-1:] in ":=(\"'",
    )
    return sum(1 << i for i, flag in enumerate(flags) if flag)


N_FEATURES, N_LABELERS = len(KINDS) + 12, 5


def candidates(text: str):
    base = base_spans(text)
    for is_base, spans in ((True, base), (False, loose_spans(text, base))):
        for kind, s, e in spans:
            value, before = text[s:e], text[max(0, s - _BEFORE):s]
            yield is_base, kind, s, e, votes_of(kind, value, before, is_base), features_of(kind, value, before)


# ------------------------------------------------------------ aggregation of votes, classifier


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50):
    """Expectation-maximisation with one hidden label per candidate and labelers independent given it.

    Returns the probability that a candidate is personal data, per vote
    pattern, and each labeler's vote distribution given the label.
    """
    if not len(votes):
        return np.empty(0), np.full((2, N_LABELERS, 3), 1 / 3), 0.5
    belief = 1 / (1 + np.exp(-votes.sum(1).astype(float)))  # starts from the majority
    given, prior = np.zeros((2, votes.shape[1], 3)), 0.5
    for _ in range(rounds):
        for label, weight in ((1, belief * counts), (0, (1 - belief) * counts)):
            for vote in (-1, 0, 1):
                given[label, :, vote + 1] = ((votes == vote) * weight[:, None]).sum(0) + 1.0
            given[label] /= given[label].sum(1, keepdims=True)
        prior = ((belief * counts).sum() + 1) / (counts.sum() + 2)
        logs = np.log(given[:, np.arange(votes.shape[1]), votes + 1]).sum(2)
        odds = logs[1] - logs[0] + np.log(prior / (1 - prior))
        belief = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
    return belief, given, prior


def bits(features: np.ndarray) -> np.ndarray:
    return ((features[:, None] >> np.arange(N_FEATURES)) & 1).astype(float)


def span_classifier(features: np.ndarray, belief: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 30):
    """Logistic regression on the probabilistic labels by Newton's method; weights, the last the bias."""
    x = np.hstack([bits(features), np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (counts * (p - belief)) + ridge * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


def fit(docs: DataFrame, text="text"):
    """Counts votes over all documents and trains; returns (weights, reliabilities)."""
    def count(batches):
        for batch in batches:
            seen = Counter()
            for t in batch.column(0).to_pylist():
                for _, _, _, _, votes, features in candidates(t):
                    seen[(features, *votes)] += 1
            keys = list(seen)
            yield pa.RecordBatch.from_pydict({
                "features": pa.array([k[0] for k in keys], pa.int64()),
                "votes": pa.array([list(k[1:]) for k in keys], pa.list_(pa.int32())),
                "n": pa.array([seen[k] for k in keys], pa.int64())})

    seen = docs.select(plain_text(text).alias("text")).mapInArrow(count, "features long, votes array<int>, n long")
    rows = seen.groupBy("features", "votes").agg(F.sum("n").alias("n")).orderBy("features", "votes").collect()
    votes = np.array([r["votes"] for r in rows], int).reshape(-1, N_LABELERS)
    counts = np.array([r["n"] for r in rows], float)
    features = np.array([r["features"] for r in rows], np.int64)
    belief, given, _ = reliabilities(votes, counts)
    return span_classifier(features, belief, counts), given


def find(docs: DataFrame, weights, text="text") -> DataFrame:
    """``docs`` as struct ``doc`` with ``base`` and ``spans``: arrays of (kind, start, end), code points, end exclusive.

    Sorted by kind as listed in ``KINDS``, then start. Null and empty texts
    have none; repeated rows are judged alike; ids and other columns are not
    looked at.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    kind = "array<struct<kind:string,start:int,end:int>>"

    def rows(spans):
        return [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))]

    @F.arrow_udf(f"struct<base:{kind},spans:{kind}>")
    def found(texts: pa.Array) -> pa.Array:
        base, every = [], []
        for t in texts.to_pylist():
            own = list(candidates(t))
            base.append(rows([c[1:4] for c in own if c[0]]))
            every.append(rows([c[1:4] for c in own if c[0] or float(bits(np.array([c[5]]))[0] @ weights[:-1] + weights[-1]) > 0]))
        return pa.StructArray.from_arrays([pa.array(base, span), pa.array(every, span)], ["base", "spans"])

    return docs.select(F.struct("*").alias("doc"), found(plain_text(text)).alias("found")).select("doc", "found.base", "found.spans")
