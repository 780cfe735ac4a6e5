"""Fill-in-middle transformation with a piece table.

A document is a table of descriptors ``(buffer, start, length)`` over buffers
that never change: its text and a buffer of sentinels, counted in code points.
Two cuts split the one descriptor of a text into prefix, middle and suffix;
an arrangement permutes these and the three sentinels; the inverse permutation
of the pieces found in an output restores the text. Hashes read the buffers
descriptor by descriptor, and texts are put together only where asked for.

A text is cut between units: a run of white space with the word after it, or
white space at the end.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitals.llm.common import plain_text

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80

# Pieces by number: prefix, middle, suffix, then the sentinels of prefix, suffix and middle.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}


def _piece(buffer: str, start, length) -> Column:
    whole = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("long")
    return F.struct(F.lit(buffer).alias("buffer"), whole(start).alias("start"), whole(length).alias("length"))


def _permuted(pieces: Column, order) -> Column:
    return F.array(*[F.get(pieces, F.lit(i)) for i in order])


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")]))
def cuts(texts: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Units of each text, and the code points before the lesser and the greater of two cuts."""
    out = []
    for text, *numbers in zip(texts.to_pylist(), one.to_pylist(), other.to_pylist()):
        units = UNIT.findall(text)
        low, high = sorted(h % (len(units) + 1) for h in numbers)
        first = sum(map(len, units[:low]))
        out.append((len(units), first, first + sum(map(len, units[low:high]))))
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))], ["n", "first", "second"])


@F.arrow_udf(T.StringType())
def sha256_of(texts: pa.Array, sentinels: pa.Array, pieces: pa.Array) -> pa.Array:
    """SHA-256 of what the pieces say, in UTF-8, read piece by piece."""
    out = []
    for text, marks, parts in zip(texts.to_pylist(), sentinels.to_pylist(), pieces.to_pylist()):
        digest = hashlib.sha256()
        for part in parts:
            buffer, start = (text if part["buffer"] == "text" else marks), part["start"]
            digest.update(buffer[start:start + part["length"]].encode("utf-8"))
        out.append(digest.hexdigest())
    return pa.array(out, pa.string())


def text_of(text: Column, sentinels: Column, pieces: Column) -> Column:
    """The text that the pieces say."""
    def read(part):
        return F.substr(F.when(part["buffer"] == "text", text).otherwise(sentinels), (part["start"] + 1).cast("int"), part["length"].cast("int"))

    return F.array_join(F.transform(pieces, read), "")


def described(
    docs: DataFrame, doc_id="doc_id", text="text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Every row as ``doc`` with its ``text``, ``sentinels``, units ``n``, ``form`` and ``pieces``.

    ``form`` is plain, psm or spm. It and the cuts follow from SHA-256 of seed
    and id alone, so reruns agree and rows that repeat an id differ only by
    their texts; a null id counts as the word null. Empty, null and marked
    texts (that hold a sentinel) are plain; ``n`` is 0 for empty and null ones.
    Texts of any length are cut whole. Other columns stay untouched in ``doc``;
    an empty table gives no rows.
    """
    marks = list(sentinels)
    if len(set(marks)) != 3 or not all(marks) or any(a[i:] == b[:len(a) - i] for a in marks for b in marks for i in range(1, len(a))):
        raise ValueError("sentinels must be three different texts, none of which ends as another begins")
    rows = docs.select(F.struct("*").alias("doc"), plain_text(F.col(text)).alias("text"), F.lit("".join(marks)).alias("sentinels"),
                       F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 256).alias("key"))
    numbers = [F.conv(F.substring("key", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = rows.select("doc", "text", "sentinels", *[h.alias(f"h{i + 1}") for i, h in enumerate(numbers)])
    rows = rows.withColumn("cut", cuts("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    length, first, second = F.length("text"), F.col("cut.first"), F.col("cut.second")
    at = [0, len(marks[0]), len(marks[0]) + len(marks[1])]
    parts = F.array(_piece("text", 0, first), _piece("text", first, second - first), _piece("text", second, length - second),
                    *[_piece("sentinels", at[i], len(marks[i])) for i in range(3)])
    rows = rows.select("doc", "text", "sentinels", F.col("cut.n").alias("n"), form.alias("form"), parts.alias("parts"), length.alias("length"))
    arranged = F.when(F.col("form") == "psm", _permuted(F.col("parts"), ORDERS["psm"])).when(
        F.col("form") == "spm", _permuted(F.col("parts"), ORDERS["spm"])).otherwise(F.array(_piece("text", 0, F.col("length"))))
    return rows.select("doc", "text", "sentinels", "n", "form", arranged.alias("pieces"))


def written(table: DataFrame) -> DataFrame:
    """The rows of ``described`` with the text their pieces make, as ``output``."""
    return table.withColumn("output", text_of(F.col("text"), F.col("sentinels"), F.col("pieces")))


def found(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """Pieces of an output's own text that restore what it was made from, from the output and its form alone.

    The sentinels are looked for in the order of the form, each once; the text
    between them cannot hold one. The inverse of the form's permutation then
    brings prefix, middle and suffix back in place.
    """
    length = F.length(output)

    def restored(order):
        # Places of the sentinels, then the pieces between them, as they stand.
        stand = [i for i in order if i < 3]
        marks = [sentinels[i - 3] for i in order if i >= 3]
        at = [F.instr(output, F.lit(mark)) - 1 for mark in marks]
        ends = [*at[1:], length]
        pieces = [_piece("text", a + len(mark), end - a - len(mark)) for a, mark, end in zip(at, marks, ends)]
        inverse = [stand.index(i) for i in range(3)]
        return F.array(*[pieces[i] for i in inverse])

    return F.when(form == "psm", restored(ORDERS["psm"])).when(form == "spm", restored(ORDERS["spm"])).otherwise(F.array(_piece("text", 0, length)))


def restored(table: DataFrame, sentinels: tuple[str, str, str] = SENTINELS, output="output", form="form") -> DataFrame:
    """Adds ``found``, the pieces of ``output`` that restore the text; ``text_of`` reads them."""
    return table.withColumn("found", found(F.col(output), F.col(form), sentinels))


def transformed(docs: DataFrame, doc_id="doc_id", text="text", sentinels: tuple[str, str, str] = SENTINELS, **options) -> DataFrame:
    """``described`` with ``output``, ``prefix_chars``, ``middle_chars`` (null if plain) and the hashes of output and restored text.

    Nulls, empty texts, repeated ids and clashing columns are as ``described`` says.
    """
    rows = restored(written(described(docs, doc_id, text, sentinels=sentinels, **options)), sentinels)
    rows = rows.withColumn("output_sha256", sha256_of("text", "sentinels", "pieces"))
    rows = rows.withColumn("restored_sha256", sha256_of("output", "sentinels", "found"))

    def chars(piece):
        return F.coalesce(*[F.when(F.col("form") == form, F.get("pieces", F.lit(order.index(piece)))["length"]) for form, order in ORDERS.items()])

    return rows.withColumn("prefix_chars", chars(0)).withColumn("middle_chars", chars(1))
