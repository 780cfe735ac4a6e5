"""Helpers shared by the operators: tables in the shared folder, words, hashes."""

import re
import tempfile
import uuid
import zlib
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = re.compile(r"\w+")
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset a local folder serves, but only for a local master; on
    a cluster its absence is an error, since executors share no local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="vitals-llm-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def plain_text(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Vocabulary:
    """Numbers words as they come and keeps ``width`` hashes of each.

    ``hashes`` maps a list of words to a list of hashes per column. Memory is
    bounded: beyond ``limit`` words it starts anew, which changes numbers but
    no hash.
    """

    def __init__(self, hashes=None, width: int = 1, limit: int = 500_000):
        self.hashes = hashes or (lambda words: [list(map(word_hash, words))])
        self.width, self.limit = width, limit
        self._reset()

    def _reset(self):
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.table = np.empty((1 << 12, self.width), np.uint64)

    def __call__(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; ``table[numbers]`` are their hashes."""
        if len(self.numbers) > self.limit:
            self._reset()
        first = len(self.numbers)
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new = list(islice(reversed(self.numbers), len(self.numbers) - first))[::-1]
        if new:
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            for column, values in enumerate(self.hashes(new)):
                self.table[first:first + len(new), column] = np.array(values, np.uint64)
        return found

    def rows(self, words: list[str]) -> np.ndarray:
        """All hashes of the words, a row for each."""
        numbers = self(words)  # first: this may replace the table
        return self.table[numbers]

    def hash(self, words: list[str]) -> np.ndarray:
        numbers = self(words)
        return self.table[:, 0][numbers]


_STRETCH = 1 << 20
_PRIME = np.uint64(0xD1342543DE82EF95)


class _Letters:
    """For each code point whether it belongs to words, and a number; made once per Python worker."""

    def __init__(self):
        letters = 0x110000
        self.of_words = np.fromiter((chr(i).isalnum() or i == 95 for i in range(letters)), bool, letters)
        self.numbers = mix64(np.arange(1, letters + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.powers = np.cumprod(np.full(64, _PRIME))


_letters: list[_Letters] = []


def text_hashes(text: str) -> np.ndarray:
    """A hash of each word of ``words_of(text)``, computed for all words of a stretch at a time.

    A word's hash adds up a number per letter times a power for its place, then
    scrambles the sum, so it depends on nothing but the word. Stretches end
    between words, which bounds memory for texts of any length.
    """
    if not _letters:
        _letters.append(_Letters())
    known, text, out, low = _letters[0], text.lower(), [], 0
    while low < len(text):
        high = low + _STRETCH
        while high < len(text) and known.of_words[ord(text[high])]:
            high += 1
        out.append(_stretch_hashes(text[low:high], known))
        low = high
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _stretch_hashes(text: str, known: _Letters) -> np.ndarray:
    try:
        points = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = known.of_words[points]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.empty(0, np.uint64)
    sizes = edges[1::2] - edges[::2]
    if sizes.max() > len(known.powers):
        known.powers = np.cumprod(np.full(2 * int(sizes.max()), _PRIME))
    starts = np.cumsum(sizes) - sizes
    letters = points[inside[1:-1]]
    values = known.numbers.take(letters)
    values *= known.powers.take(np.arange(len(letters)) - np.repeat(starts, sizes))
    return mix64(np.add.reduceat(values, starts))


word_hash = xxhash.xxh64_intdigest  # of the UTF-8 bytes


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the public splitmix64 finaliser)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


#: Odd multipliers, one per place in an n-gram.
PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF | 1 for i in range(64)], dtype=np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbouring word hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * PLACES[i]
    return mix64(total)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def summed_counts(rows: DataFrame, count_batch, size: int, chunk: int = 1 << 14) -> np.ndarray:
    """Sum of vectors of ``size`` counts over all rows.

    ``count_batch`` makes a function, in the task, that adds a batch of the
    columns to a vector. Each task sends its vector once, squeezed and cut in
    chunks, and the chunks are added up side by side; the driver gets one
    vector, ``8 * size`` bytes whatever the data.
    """
    def partial(batches):
        total, add = np.zeros(size, np.int64), count_batch()
        for batch in batches:
            add(total, batch)
        for at in range(0, size, chunk):
            part = total[at:at + chunk]
            if part.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([at], pa.int32()), "counts": [zlib.compress(part.tobytes(), 1)]})

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for counts in pdf["counts"]:
            total = total + np.frombuffer(zlib.decompress(counts), np.int64)
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    kind = "chunk int, counts binary"
    result = np.zeros(size, np.int64)
    # a first sum over groups of tasks, so that no chunk gathers a row of every task at once
    group = (F.spark_partition_id() / 32).cast("int").alias("tasks")
    first = rows.mapInArrow(partial, kind).select("chunk", "counts", group).groupBy("chunk", "tasks").applyInPandas(add_up, kind)
    for row in first.groupBy("chunk").applyInPandas(add_up, kind).collect():
        part = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
        result[row["chunk"]:row["chunk"] + len(part)] = part
    return result
