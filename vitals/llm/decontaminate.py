"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are taken in blocks of bounded size; a block is sent to the
executors and met by every document, so texts never shuffle. Word trigrams of
an item in at most ``RARE`` of all documents are its seeds, and of each few
neighbouring ones the rarest, however frequent it is, so that no stretch of
an item lacks a seed. Where a document has a seed, the stretch around it is aligned with the item word by word:
a match counts 1, a replaced, missing or added word costs ``COST``. The score
is the best local alignment's share of what the whole item would give.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitals.llm.common import plain_text, summed_counts, words_of

SEED = 3
NEIGHBOURS = 3
RARE = 0.02
COST = 0.5
THRESHOLD = 0.4
BLOCK_CHARS = 8_000_000


class Items:
    """A block of test items with numbered words and trigrams; words that occur in no item are number 0."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.words: dict[str, int] = {}
        self.texts = [np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(r[1])], np.int64) for r in rows]
        self.base = len(self.words) + 1
        self.grams = np.unique(np.concatenate([self.codes(t) for t in self.texts] or [np.empty(0, np.int64)]))
        self.places: dict[int, list[tuple[int, int]]] = {}
        self.seeds = np.empty(0, np.int64)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        if len(numbers) < SEED:
            return np.empty(0, np.int64)
        a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
        return np.where((a > 0) & (b > 0) & (c > 0), (a * self.base + b) * self.base + c, -1)

    def numbers(self, text: str) -> np.ndarray:
        get = self.words.get
        words = words_of(text)
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def found(self, codes: np.ndarray, among: np.ndarray):
        """Positions in ``codes`` whose trigram is among the sorted ones, and which it is."""
        positions = np.flatnonzero(codes >= 0)
        if not len(positions) or not len(among):
            return positions[:0], positions[:0]
        at = np.minimum(np.searchsorted(among, codes[positions]), len(among) - 1)
        same = among[at] == codes[positions]
        return positions[same], at[same]

    def choose_seeds(self, documents: np.ndarray, total: int):
        """``documents``: in how many of the ``total`` documents each of ``grams`` occurs."""
        places = defaultdict(set)
        for item, text in enumerate(self.texts):
            codes = self.codes(text)
            often = documents[np.searchsorted(self.grams, codes)]
            for i in np.flatnonzero(often <= RARE * total).tolist():
                places[int(codes[i])].add((item, i))
            for low in range(max(1, len(codes) - NEIGHBOURS + 1) if len(codes) else 0):
                part = range(low, min(low + NEIGHBOURS, len(codes)))
                best = min(part, key=lambda i: (often[i], codes[i]))
                places[int(codes[best])].add((item, best))
        self.seeds = np.array(sorted(places), np.int64)
        self.places = {code: sorted(p) for code, p in places.items()}


def align(item: np.ndarray, stretches: np.ndarray):
    """Smith-Waterman of one item with many stretches (rows, padded with -1): best scores and where they end."""
    rows, length = stretches.shape
    above = np.zeros((rows, length + 1))
    best, end = np.zeros(rows), np.zeros(rows, np.int64)
    slope = COST * np.arange(length + 1)
    for word in item:
        now = np.zeros((rows, length + 1))
        now[:, 1:] = np.maximum(above[:, :-1] + np.where(stretches == word, 1.0, -COST), above[:, 1:] - COST)
        np.maximum(now, 0, out=now)
        # words added in the stretch: the best cell to the left, less the cost of the way
        now = np.maximum.accumulate(now + slope, 1) - slope
        last = now.argmax(1)
        top = now[np.arange(rows), last]
        better = top > best + 1e-9
        best[better], end[better] = top[better], last[better]
        above = now
    return best, end


def hits(items: Items, text: str, threshold: float):
    """``(item, score, start, end)`` in words, for every item the text holds at least ``threshold`` of."""
    numbers = items.numbers(text)
    positions, which = items.found(items.codes(numbers), items.seeds)
    stretches = defaultdict(list)
    for position, seed in zip(positions.tolist(), which.tolist()):
        for item, offset in items.places[int(items.seeds[seed])]:
            size = len(items.texts[item])
            slack = size // 2 + 4
            low, high = max(0, position - offset - slack), min(len(numbers), position - offset + size + slack)
            near = stretches[item]
            if near and low <= near[-1][1]:
                near[-1] = (min(low, near[-1][0]), max(high, near[-1][1]))
            else:
                near.append((low, high))
    out = []
    for item, near in stretches.items():
        known, best = items.texts[item], None
        for low, high in near:
            part = numbers[low:high]
            # words in common bound the score, so most chance seeds need no alignment
            if np.isin(known, part).sum() < threshold * len(known):
                continue
            score, end = align(known, part[None, :])
            if score[0] / len(known) >= threshold and (best is None or score[0] > best[0]):
                back, start = align(known[::-1], part[:end[0]][::-1][None, :])
                best = (score[0], low + int(end[0]) - int(start[0]), low + int(end[0]))
        if best:
            out.append((item, float(best[0] / len(known)), best[1], best[2]))
    return out


def blocks(benchmark: DataFrame, item_id="item_id", text="text"):
    """The items, one block of at most about ``BLOCK_CHARS`` characters after the other (a longer item alone makes more)."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), plain_text(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // BLOCK_CHARS))
    for block in range(n):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == block).distinct().orderBy("id", "text").collect()
        if part:
            yield Items([(r["id"], r["text"]) for r in part])


def prepare(docs: DataFrame, benchmark: DataFrame, text="text"):
    """Per block of items: document counts of its trigrams over all documents, then seeds; yields broadcast blocks."""
    texts = docs.select(plain_text(text).alias("text"))
    for items in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def counter():
            block = shared.value

            def add(total, batch):
                total[-1] += batch.num_rows
                for t in batch.column(0):
                    total[np.unique(block.found(block.codes(block.numbers(t.as_py())), block.grams)[1])] += 1
            return add

        if len(items.grams):
            counts = summed_counts(texts, counter, len(items.grams) + 1)
            items.choose_seeds(counts[:-1], int(counts[-1]))
        yield docs.sparkSession.sparkContext.broadcast(items)


def matches(docs: DataFrame, prepared, text="text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` as struct ``doc`` with ``hits``: array of (item_id, score, start, end), in words of the text."""
    kind = "array<struct<item_id:bigint,score:double,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def matcher(shared):
        @F.arrow_udf(kind)
        def found(texts: pa.Array) -> pa.Array:
            items = shared.value
            return pa.array([[
                {"item_id": items.ids[i], "score": score, "start": start, "end": end}
                for i, score, start, end in hits(items, t, threshold)] for t in texts.to_pylist()], arrow)
        return found

    columns = [matcher(shared)(plain_text(text)) for shared in prepared]
    every = F.concat(*columns) if columns else F.array().cast(kind)
    return docs.select(F.struct("*").alias("doc"), every.alias("hits"))


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id="doc_id", text="text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, start, end`` for every test item a document holds, wholly or edited.

    Null and empty texts, and items under three words, match nothing. Rows
    that repeat an id are judged each; of items with the same id the better
    alignment of a document counts, then the earlier one. An empty benchmark
    or table gives no rows. Other columns are not looked at.
    """
    found = matches(docs, list(prepare(docs, benchmark, text)), text, threshold)
    best = F.array_sort(F.col("hits"), lambda a, b: F.when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1)
                        .when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(a["start"] - b["start"]))
    first = F.filter(best, lambda h, i: (i == 0) | ~h["item_id"].eqNullSafe(F.element_at(best, F.greatest(i, F.lit(1)))["item_id"]))
    return found.select(F.col(f"doc.{doc_id}").alias("doc_id"), F.explode(first).alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame, text="text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no test item, with their columns."""
    found = matches(docs, list(prepare(docs, benchmark, text)), text, threshold)
    return found.filter(F.size("hits") == 0).select("doc.*")
