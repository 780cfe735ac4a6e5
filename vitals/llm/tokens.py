"""Token files: each shard of token ids is one compressed wavelet matrix.

Documents are range-partitioned by id, tokenized in id order and cut into
shards at document ends. A shard holds, for every bit of the ids from the
highest down, one plane of bits: the ids' bits in the order in which the bits
above have stably partitioned them, zeros first. With counts of ones kept per
block, any token can be read, counted before a position, and its n-th
occurrence found, without unpacking the ids.

Layout of a shard, little-endian: ``VWM1``, then length-prefixed zstandard
sections: a head (tokens, documents, bits; zeros of each plane), document ids
with a mark for null, document offsets, and per plane its packed bits and its
block counts. Shards are the ``content`` of one Parquet row each, so that they
live on whatever storage Spark writes to.
"""

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from vitals.llm.common import partitions, plain_text, work_folder

END = 0
SHARD_TOKENS = 1 << 22
BLOCK = 512
#: Tokens moved at a time while planes are made and read, so that their places stay in the processor's cache; divisible by 8.
_STRETCH = 1 << 16
MAGIC = b"VWM1"


def vocabulary_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------ tokenizing

#: A space after anything but white space always starts a new piece of the tokenizer, so texts may be cut there.
_CUT = re.compile(r"(?<=\S) ")
#: Marks that start a new piece after a letter; without those of which added tokens like `<|endoftext|>` are made.
_MARKS = "".join(set(string.punctuation) - set("<|>"))
_SPACE_BYTE = "\u0120"
#: Words that the tokenizer reads as one text (it is slower a word on long texts), and bytes of texts read together.
_WORDS_AT_ONCE = 64
_BYTES_AT_ONCE = 1 << 23


class Encoder:
    """Ids of texts as packed integers, remembering pieces; results never depend on the memory.

    Pieces that start with a space are kept without it. At ``limit`` pieces
    the memory becomes the older one and those of it still in use move over.
    """

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.type = np.dtype("<u4" if self.wide else "<u2")
        self.limit, self.pieces, self.older = limit, {}, {}
        # in this vocabulary a space, and nothing else, is written as the letter of byte 32
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.spaced[number] = token[0] == _SPACE_BYTE

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        found = self._read(text.split(" "))
        return b"".join(self._read(_CUT.split(text), cut=True) if found is None else found)

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text (no nulls), of which stretches are read together."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        starts = np.flatnonzero(np.diff(sizes // _BYTES_AT_ONCE, prepend=-1)).tolist()
        for low, high in zip(starts, [*starts[1:], len(texts)]):
            yield from self._together(texts.slice(low, high - low))

    def _together(self, texts: pa.Array) -> list[bytes]:
        """Looks up each distinct piece once; a text that a space does not cut everywhere is read alone."""
        if len(self.pieces) > self.limit:
            self.pieces, self.older = {}, self.pieces
        known = self.pieces
        cut = pc.split_pattern(texts, " ")
        numbered = cut.flatten().dictionary_encode()
        pieces, numbers = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        found = list(map(known.get, pieces))
        self._learn([c for c, ids in zip(pieces, found) if ids is None and c and not c[-1].isspace()])
        found = [known.get(c) if ids is None else ids for c, ids in zip(pieces, found)]
        every = np.empty(len(found), object)
        every[:] = found
        every = every.take(numbers).tolist()
        ends = cut.offsets.to_pylist()
        firsts = [pieces[i] for i in numbers[ends[:-1]].tolist()]
        out = []
        for row, (head, first, low, high) in enumerate(zip(self._ids(firsts), firsts, ends, ends[1:])):
            own, tail = every[low + 1:high], b""
            if own and own[-1] is None:  # the end of a text may be white space
                own.pop()
                tail = self._ids([" " + pieces[numbers[high - 1]]])[0]
            try:
                if high - low > 1 and first and first[-1].isspace():
                    raise TypeError
                out.append(b"".join([head, *own, tail]))
            except TypeError:  # a piece without ids: empty or with white space at its end
                out.append(self(texts[row].as_py()))
        return out

    def _read(self, pieces: list[str], cut: bool = False) -> list[bytes] | None:
        """Ids of a text's pieces, all but the first with a space before them.

        None unless they are ``cut`` as `_CUT` does: where a piece that others
        follow is empty or ends in white space. Such pieces are never remembered,
        so only those that are not known have to be looked at.
        """
        first = pieces.pop(0)
        if pieces and first and first[-1].isspace() and not cut:
            return None
        last = pieces.pop() if pieces and (not pieces[-1] or pieces[-1][-1].isspace()) else None
        if len(self.pieces) > self.limit:
            self.pieces, self.older = {}, self.pieces
        known = self.pieces
        found = list(map(known.get, pieces))
        new = {c for c, ids in zip(pieces, found) if ids is None}
        if new:
            if not cut and any(not c or c[-1].isspace() for c in new):
                return None
            self._learn(new)
            found = [known[c] if ids is None else ids for c, ids in zip(pieces, found)]
        if first:
            found.insert(0, self._ids([first])[0])
        if last is not None:
            found += self._ids([" " + last])
        return found

    def _ids(self, texts: list[str]) -> list[bytes]:
        code = "I" if self.wide else "H"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it.

        Words without spaces that end in no white space are read as one text:
        the space before each starts a new piece there, so a word's ids go from
        one spaced token to the next.
        """
        plain = [c for c in words if c and " " not in c and not c[-1].isspace()]
        found = []
        for low in range(0, len(plain), _WORDS_AT_ONCE):
            part = plain[low:low + _WORDS_AT_ONCE]
            ids = np.frombuffer(self._ids([" " + " ".join(part)])[0], self.type)
            at = np.flatnonzero(self.spaced[ids]) * ids.itemsize
            if len(at) != len(part):
                raise ValueError("the vocabulary does not mark every space before a word")
            packed, starts = ids.tobytes(), at.tolist()
            found += [packed[a:b] for a, b in zip(starts, [*starts[1:], len(packed)])]
        if len(plain) == len(words):
            return found
        known = dict(zip(plain, found))
        other = [c for c in words if c not in known]
        known.update(zip(other, self._ids([" " + c for c in other])))
        return list(map(known.__getitem__, words))

    def _learn(self, new: Iterable[str]):
        pieces, older = self.pieces, self.older
        cores, ends, unknown = {}, {}, set()
        for c in new:
            if c in older:
                pieces[c] = older[c]
                continue
            core = c.rstrip(_MARKS)
            if core != c and core and core[-1].isalpha() and core[-1] < "ɐ":  # a mark after a letter starts a piece
                ends[c] = core
                if core not in pieces:
                    if core in older:
                        pieces[core] = older[core]
                    else:
                        unknown.add(core)
                mark = c[len(core):]
                if mark not in cores:
                    cores[mark] = self._mark(mark)
            else:
                unknown.add(c)
        unknown = list(unknown)
        pieces.update(zip(unknown, self._spaced_ids(unknown)))
        for c, core in ends.items():
            pieces[c] = pieces[core] + cores[c[len(core):]]

    def _mark(self, mark: str) -> bytes:
        """Ids of marks that follow a letter, kept under a key no piece can have (it holds a space)."""
        key = f"{mark} "
        if key not in self.pieces:
            self.pieces[key] = self._ids([mark])[0]
        return self.pieces[key]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ------------------------------------------------------------ wavelet matrix


def pack(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> bytes:
    """One shard's file."""
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=1).compress
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    planes, zeros, current = [], [], ids
    after, spare, ones = np.empty_like(ids), np.empty_like(ids), np.empty_like(ids)
    for level in range(levels - 1, -1, -1):
        plane, z, o = np.empty(-(-len(ids) // 8), np.uint8), 0, 0
        for low in range(0, len(ids), _STRETCH):
            part = current[low:low + _STRETCH]
            bits = (part & ids.dtype.type(1 << level)) != 0
            plane[low // 8:(low + len(part) + 7) // 8] = np.packbits(bits, bitorder="little")
            if not level:
                z += len(part) - int(np.count_nonzero(bits))
                continue
            order = np.flatnonzero(~bits)
            after[z:z + len(order)] = part.take(order)
            z += len(order)
            order = np.flatnonzero(bits)
            ones[o:o + len(order)] = part.take(order)
            o += len(order)
        after[z:z + o] = ones[:o]
        planes.append(plane)
        zeros.append(z)
        current, after = after, spare if current is ids else current
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    known = np.array([i is not None for i in doc_ids], np.uint8)
    sections = [
        struct.pack(f"<QQQ{levels}Q", len(ids), len(doc_ids), levels, *zeros),
        known.tobytes() + np.array([i or 0 for i in doc_ids], "<i8").tobytes(), offsets.astype("<i8").tobytes(),
    ]
    for plane in planes:
        ones = np.add.reduceat(np.bitwise_count(plane), np.arange(0, len(plane), BLOCK // 8), dtype=np.int64) if len(plane) else np.empty(0)
        sections += [plane.tobytes(), np.concatenate([[0], np.cumsum(ones)]).astype("<i8").tobytes()]
    squeezed = [squeeze(s) for s in sections]
    return MAGIC + b"".join(struct.pack("<Q", len(s)) + s for s in squeezed)


class Shard:
    """Reads one shard's file: documents, tokens, counts and occurrences."""

    def __init__(self, content: bytes):
        import zstandard
        if content[:4] != MAGIC:
            raise ValueError("not a token shard")
        sections, at = [], 4
        while at < len(content):
            size, = struct.unpack_from("<Q", content, at)
            sections.append(zstandard.ZstdDecompressor().decompress(content[at + 8:at + 8 + size]))
            at += 8 + size
        self.n, docs, self.levels = struct.unpack_from("<QQQ", sections[0])
        self.zeros = struct.unpack_from(f"<{self.levels}Q", sections[0], 24)
        known, ids = np.frombuffer(sections[1], np.uint8, docs), np.frombuffer(sections[1], "<i8", docs, docs)
        self.doc_ids = [int(i) if k else None for k, i in zip(known, ids)]
        self.offsets = np.frombuffer(sections[2], "<i8")
        self.planes = [np.frombuffer(s, np.uint8) for s in sections[3::2]]
        self.ones = [np.frombuffer(s, "<i8") for s in sections[4::2]]

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a plane."""
        block = i // BLOCK
        rest = np.unpackbits(self.planes[level][block * BLOCK // 8:(i + 7) // 8], bitorder="little")
        return int(self.ones[level][block]) + int(rest[:i - block * BLOCK].sum())

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level in range(self.levels):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def rank(self, token: int, i: int) -> int:
        """How often the token occurs before position ``i``."""
        if token >> self.levels:
            return 0
        low, high = 0, min(max(i, 0), self.n)
        for level in range(self.levels):
            below, upto = self._ones(level, low), self._ones(level, high)
            if token >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + below, self.zeros[level] + upto
            else:
                low, high = low - below, high - upto
        return high - low

    def select(self, token: int, k: int) -> int:
        """Position of the token's occurrence number ``k``, from 0; -1 if there are fewer."""
        if k < 0 or k >= self.rank(token, self.n):
            return -1
        low, high = 0, self.n
        while high - low > 1:  # the last position with at most k occurrences before it
            middle = (low + high) // 2
            if self.rank(token, middle) <= k:
                low = middle
            else:
                high = middle
        return low

    def tokens(self) -> np.ndarray:
        """All ids in order, by undoing the partitions from the lowest plane up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        current, before = np.zeros(self.n, kind), np.empty(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            # the order below this plane: zeros first, then ones
            z, o = 0, self.zeros[level]
            for low in range(0, self.n, _STRETCH):
                part = before[low:low + _STRETCH]
                bits = np.unpackbits(self.planes[level][low // 8:(low + _STRETCH) // 8], count=len(part), bitorder="little").view(bool)
                if level == self.levels - 1:
                    part[:] = bits
                    continue
                order = np.flatnonzero(~bits)
                part[order] = current[z:z + len(order)]
                z += len(order)
                order = np.flatnonzero(bits)
                part[order] = current[o:o + len(order)] | kind(1 << self.levels - 1 - level)
                o += len(order)
            current, before = before, current
        return current


# ------------------------------------------------------------ on Spark

SHARDS = "part int, seq int, n_tokens long, n_docs long, content binary"


def write(docs: DataFrame, folder: str | None = None, doc_id="doc_id", text="text", path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> str:
    """Writes the shards in ascending id order, null ids first, and returns their folder.

    Every document, empty and null texts included, ends with id 0. Rows that
    repeat an id all count, ordered by a hash of their text. A document is
    never cut; one longer than a shard makes a longer shard. An empty table
    gives no shards. Other columns are left out.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "tokens")
    path = path or vocabulary_file()

    def shards(batches):
        encode, part, seq = encoder_of(path), TaskContext.get().partitionId(), 0
        end = np.array([END], encode.type).tobytes()
        ids, pieces, lengths, total = [], [], [], 0

        def shard():
            tokens = np.frombuffer(b"".join(pieces), encode.type)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_tokens": [len(tokens)],
                "n_docs": [len(ids)], "content": pa.array([pack(tokens, ids, np.array(lengths, np.int64))], pa.binary())})

        for batch in batches:
            for doc, words in zip(batch.column(0).to_pylist(), encode.many(batch.column(1))):
                packed = words + end
                ids.append(doc)
                pieces.append(packed)
                lengths.append(len(packed) // encode.type.itemsize)
                total += lengths[-1]
                if total >= shard_tokens:
                    yield shard()
                    seq, total = seq + 1, 0
                    ids, pieces, lengths = [], [], []
        if ids:
            yield shard()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), plain_text(text).alias("text"))
    rows = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows.mapInArrow(shards, SHARDS).write.option("compression", "uncompressed").parquet(folder)
    return folder


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part, seq, shard_start``: tokens of all shards before each, on two levels."""
    sizes = shards.select("part", "seq", "n_tokens")
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_start"))
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return sizes.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("inside")).alias("shard_start"))


def read_documents(spark, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    shards = spark.read.schema(SHARDS).parquet(folder)

    def documents(batches):
        for batch in batches:
            for part, seq, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shard = Shard(content.as_py())
                tokens = shard.tokens().astype("<u4")
                starts = shard.offsets.tolist()
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * len(shard.doc_ids), pa.int32()), "seq": pa.array([seq] * len(shard.doc_ids), pa.int32()),
                    "doc_id": pa.array(shard.doc_ids, pa.int64()), "at": pa.array(starts[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(shard.offsets), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(tokens[a:b].data) for a, b in zip(starts, starts[1:])], pa.int64())})

    rows = shards.select("part", "seq", "content").mapInArrow(
        documents, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
