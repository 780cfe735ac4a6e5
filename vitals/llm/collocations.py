"""Phrase collocation mining by top-order marginalisation.

Phrases have up to ``LONGEST`` words and do not cross the marks that end a
piece of text. Instead of exploding every n-gram of every length, each word
gives one row: the longest window that starts with it, padded to ``LONGEST``
columns. Windows are counted once, and Spark's ROLLUP over the columns sums
them for all shorter prefixes: the count of a phrase is the sum of the windows
that begin with it, the sum of a language is its number of words.

A phrase that occurs ``least`` times consists of pairs and triples that do so
too. Two passes before count hashes of pairs, and of triples of frequent pairs,
and windows end before a rarer one, which makes few different windows of many.
The frequent ones reach the tasks as bitmaps of ``2 ** GRAM_BITS`` bits whatever
their number. What shares a bit with a frequent one only makes a window longer
than it had to be; counts are exact.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitals.llm.common import Vocabulary, mix64, plain_text, stored, word_hash

LONGEST = 4
LEAST = 30
TOP = 2000
INSIDE_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"

GRAM_BITS = 23
GRAM_SIZES = (2, 3)
_HASH_BITS = 40
_ROOM = 64  # words a window may reach past the end of a chunk
_WORDS_KEPT = 150_000
_CHUNK = 500_000

_PLAIN = bytes(
    ord("\n") if c in b".,;:!?\n\x0b\x0c\r" else ord(" ") if c == ord("\t") else c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))
_MARK = b"."  # cannot be a word


def words_and_marks(text: str) -> list[bytes]:
    """Words, with a mark between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(b"\n", b" . ").split()


class _Numbers:
    """Words as numbers, 0 for a mark; forgotten between chunks when they grow many."""

    def __init__(self):
        self.known = Vocabulary(lambda words: [list(map(word_hash, words))], limit=1 << 62)
        self._start()

    def _start(self):
        self.known._reset()
        self.known([_MARK])
        self.words = [b""]

    def chunks(self, batch):
        """Of the texts of a batch: word numbers and language numbers, and the languages, in bounded chunks."""
        langs = batch.column(1).dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        held, sizes, first = [], [], 0
        for i, text in enumerate(batch.column(0)):
            words = words_and_marks(text.as_py())
            held += words
            held.append(_MARK)
            sizes.append(len(words) + 1)
            if len(held) >= _CHUNK or i + 1 == batch.num_rows:
                if len(self.known.numbers) > _WORDS_KEPT:
                    self._start()
                yield self.known(held).astype(np.int32), np.repeat(codes[first:i + 1], sizes), names
                held, sizes, first = [], [], i + 1

    def grams(self, numbers, of, names, size):
        """Hash of the words from each on, and where all ``size`` are words of a piece."""
        salts, count = np.array([word_hash(name) for name in names], np.uint64), max(0, len(numbers) - size + 1)
        hashes, total, inside = self.known.table[:, 0][numbers], salts[of[:count]], np.ones(count, bool)
        for i in range(size):
            total = mix64(total + hashes[i:i + count])
            inside &= numbers[i:i + count] > 0
        return total >> np.uint64(64 - _HASH_BITS), inside

    def frequent(self, numbers, of, names, bitmaps):
        """Per size of ``bitmaps`` where a frequent run of so many words starts."""
        out = {}
        for size, bitmap in bitmaps.items():
            grams, inside = self.grams(numbers, of, names, size)
            place = (grams & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
            inside &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            out[size] = np.append(inside, np.zeros(len(numbers) - len(inside) + _ROOM, bool))
        return out

    def strings(self):
        """The words in the order of their numbers; the mark is empty, as a pad is."""
        new = list(self.known.numbers)[len(self.words):]
        self.words += new
        return pa.array(self.words, pa.binary()).cast(pa.string())


_own: list[_Numbers] = []


def _numbers() -> _Numbers:
    """One memory of words per Python worker, kept between tasks."""
    if not _own:
        _own.append(_Numbers())
    return _own[0]


def _texts(docs: DataFrame, text, lang) -> DataFrame:
    return docs.select(plain_text(F.col(text)).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))


def frequent_grams(texts: DataFrame, least: int, size: int, bitmaps: dict[int, np.ndarray]) -> np.ndarray:
    """Bitmap of the hashes of ``size`` neighbours that occur ``least`` times in a language; ``bitmaps`` are those of fewer neighbours."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)

    def count(batches):
        memory = _numbers()
        for batch in batches:
            for numbers, of, names in memory.chunks(batch):
                grams, inside = memory.grams(numbers, of, names, size)
                for smaller, starts in memory.frequent(numbers, of, names, shared.value).items():
                    for i in range(size - smaller + 1):
                        inside &= starts[i:i + len(inside)]
                values, counts = np.unique(grams[inside], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64))], ["gram", "n"])

    counted = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    bit = F.col("gram").bitwiseAND(F.lit((1 << GRAM_BITS) - 1))
    words = counted.select(F.shiftright(bit, 6).cast("int").alias("place"), F.expr("shiftleft(1L, int(gram & 63))").alias("bits"))
    bitmap = np.zeros(1 << (GRAM_BITS - 6), np.int64)
    for row in words.groupBy("place").agg(F.bit_or("bits").alias("bits")).collect():  # at most 2 ** (GRAM_BITS - 6) rows
        bitmap[row["place"]] = row["bits"]
    return bitmap.view(np.uint8)


def windows(texts: DataFrame, bitmaps: dict[int, np.ndarray], longest: int) -> DataFrame:
    """``lang, w1 .. w<longest>, n``: padded longest windows, counted per chunk."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)
    names = [f"w{i + 1}" for i in range(longest)]

    def count(batches):
        memory = _numbers()
        for batch in batches:
            for numbers, of, langs in memory.chunks(batch):
                frequent = memory.frequent(numbers, of, langs, shared.value)
                padded = np.append(numbers, np.zeros(longest, np.int32))
                starts = np.flatnonzero(numbers)
                columns, going = [of[starts], numbers[starts]], np.ones(len(starts), bool)
                for i in range(1, longest):
                    for size, begins in frequent.items():
                        if size <= i + 1:
                            going &= begins[starts + i + 1 - size]
                    columns.append(np.where(going, padded[starts + i], 0).astype(np.int32))
                yield _counted(columns, langs, memory.strings(), names)

    return texts.mapInArrow(count, "lang string, " + ", ".join(f"{w} string" for w in names) + ", n long")


def _counted(columns, langs, words, names):
    """Equal rows of number columns counted, as a batch of texts."""
    wide = []  # two numbers in one, so that less has to be sorted
    for i in range(0, len(columns), 2):
        pair = columns[i].astype(np.int64) << 32
        wide.append(pair | columns[i + 1] if i + 1 < len(columns) else pair)
    order = np.lexsort(wide[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in wide:
        sorted_column = column[order]
        new[1:] |= sorted_column[1:] != sorted_column[:-1]
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(order)))
    rows = order[first]
    texts = [pa.array(langs, pa.string()).take(pa.array(columns[0][rows]))] + [words.take(pa.array(c[rows])) for c in columns[1:]]
    return pa.RecordBatch.from_arrays([*texts, pa.array(counts.astype(np.int64))], ["lang", *names, "n"])


def phrase_counts(docs: DataFrame, text="text", lang="lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, words, f`` of all phrases with ``f >= least``; no words and ``f`` the number of all words per language."""
    if not 2 <= longest < _ROOM:
        raise ValueError(f"longest must be from 2 to {_ROOM - 1}")
    texts = _texts(docs, text, lang)
    names = [f"w{i + 1}" for i in range(longest)]
    bitmaps = {}
    for size in GRAM_SIZES:
        bitmaps[size] = frequent_grams(texts, least, size, bitmaps)
    counted = windows(texts, bitmaps, longest).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    # left_out has a 1 bit for each column summed over: 2 ** k - 1 for the last k.
    size = F.lit(0)
    for k in range(longest):
        size = F.when(F.col("left_out") == (1 << k) - 1, longest - k).otherwise(size)
    rows = summed.filter(F.col("left_out") < (1 << longest)).withColumn("size", size)
    rows = rows.withColumn("words", F.slice(F.array(*names), F.lit(1), F.col("size")))
    return rows.filter((F.col("size") == 0) | ((F.col("f") >= least) & (F.get("words", F.col("size") - 1) != ""))).select("lang", "words", "f")


def _long(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def collocations(
    docs: DataFrame, text="text", lang="lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
    inside_percent: int = INSIDE_PERCENT, scale: int = SCALE,
) -> DataFrame:
    """Best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the
    least score ``floor(scale * a / (l + r))`` (first such cut), ``n`` all words.
    Phrases inside a longer one that occurs ``inside_percent`` as often are
    left out. Ties go by ``a``, then by the phrase's bytes. Null languages are
    ``und``; null and empty texts hold no words; repeated rows count each;
    texts of any length are read whole; other columns are not looked at. An
    empty table, or one without a phrase that occurs often enough, gives no rows.
    """
    counts = stored(phrase_counts(docs, text, lang, least, longest).withColumn("phrase", F.array_join("words", " ")), "phrase-counts")
    phrases, totals = counts.filter(F.size("words") > 0), counts.filter(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    candidates = phrases.filter(F.size("words") > 1).withColumnRenamed("f", "a")

    # Parts of a phrase are frequent too, so each is among the counts.
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")
    rows = candidates.select("lang", "phrase", "words", "a", cut)
    rows = rows.select("lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ").alias("right"))
    rows = rows.join(phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    rows = rows.join(phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    rows = rows.withColumn("score", F.expr(f"cast(cast(a as decimal(38,0)) * {scale} div (cast(l as decimal(38,0)) + r) as bigint)"))
    scored = rows.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"), F.first("a").alias("a"))

    # The most frequent longer phrase around each phrase.
    pieces = F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size")
    inner = candidates.filter(F.size("words") > 2).select("lang", "words", "a", pieces)
    inner = inner.select("lang", "words", "a", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("around").isNull() | (_long(F.col("around")) * 100 < _long(F.col("a")) * inside_percent))

    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"))
