import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vitals.llm import tokens


@pytest.fixture(scope="module")
def whole():
    found = Tokenizer.from_file(tokens.vocabulary_file())
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokens.vocabulary_file())


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.vocabulary_file(), limit=50)


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(" \n\t.,'!?aé1 \x1c\x85日<sSt"), max_size=14))
def test_pieces_give_the_ids_of_the_whole_text(whole, encoder, text):
    assert np.frombuffer(encoder(text), encoder.type).tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "a", "It's", ".", "<|", "é", "7"]), max_size=9))
def test_added_tokens_are_those_of_the_plain_encoding(plain, encoder, parts):
    text = "".join(parts)
    ids = np.frombuffer(encoder(text), encoder.type).tolist()
    assert ids == plain.encode(text, add_special_tokens=False).ids
    assert ids.count(plain.token_to_id("<|endoftext|>")) == text.count("<|endoftext|>")


def test_words_learnt_together_keep_their_ids(plain):
    rng = random.Random(4)
    words = ["it's", "don't.", "a\nb", "x,%%%", "<|endoftext|>", "<|endoftext|>,", "naïve!?", "12.5", "&&&", "日本'", "end>", "\n", "", "\xa0y"]
    texts = [" ".join(rng.choice(words) + rng.choice("abc.,") * rng.randrange(3) for _ in range(rng.randrange(40))) for _ in range(300)]
    encode = tokens.Encoder(tokens.vocabulary_file(), limit=70)
    for text in texts:
        assert np.frombuffer(encode(text), encode.type).tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (7, 2), (5000, 3), (5000, 50_257), (600, 70_000)])
def test_shard_round_trip_and_queries(size, top):
    rng = random.Random(size + top)
    ids = np.array([int(top * rng.random() ** 3) for _ in range(size)], np.uint32 if top > 65_536 else np.uint16)
    lengths = np.array([size // 3, size - size // 3], np.int64)
    shard = tokens.Shard(tokens.pack(ids, [5, None], lengths))
    assert np.array_equal(shard.tokens(), ids) and shard.doc_ids == [5, None]
    assert shard.offsets.tolist() == [0, size // 3, size]
    for i in rng.sample(range(size), min(size, 40)):
        token = int(ids[i])
        before = int((ids[:i] == token).sum())
        assert shard.access(i) == token and shard.rank(token, i) == before and shard.select(token, before) == i
        assert shard.select(token, int((ids == token).sum())) == -1
    assert shard.rank(top + 1, size) == 0 and shard.select(top + 1, 0) == -1


def test_documents_read_back(spark, odd, odd_rows, none, whole):
    folder = tokens.write(odd, shard_tokens=5_000)
    shards = spark.read.parquet(folder)
    assert shards.count() > 2
    got = tokens.read_documents(spark, folder).collect()
    start = 0
    wanted = {}
    for doc_id, text in sorted(((r[0], r[1] or "") for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [0], "<u4")
        wanted.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    at = 0
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
        wanted[row.doc_id].remove((row.n_tokens, row.ids_crc32))
    assert at == start and not any(wanted.values())
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
    assert tokens.read_documents(spark, tokens.write(none)).count() == 0


def test_planes_are_made_and_read_in_little_memory():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 50_257, 1_000_003).astype(np.uint16)

    def peak(work):
        tracemalloc.start()
        result = work()
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        return result, most / len(ids)

    content, most = peak(lambda: tokens.pack(ids, [1], np.array([len(ids)])))
    assert most < 16  # bytes a token; with the places of a whole plane's tokens it was 17.7, and 11.2 to read it
    shard = tokens.Shard(content)
    got, most = peak(shard.tokens)
    assert np.array_equal(got, ids) and most < 8


def test_ends_in_white_space_are_not_taken_for_words(plain):
    encode = tokens.Encoder(tokens.vocabulary_file())
    ends = ["", " ", "\n", " \n", "a\n", "a\t", "b \n"]
    texts = [f"{x}{a} {b}{y}" for a in ends for b in ends for x in ("", "the ") for y in ("", " the", "\nthe")]
    for text in texts + texts[::-1]:
        assert np.frombuffer(encode(text), encode.type).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_texts_read_together_keep_their_ids(plain, monkeypatch):
    rng = random.Random(6)
    parts = ["the", "it's", "a,", "x\ny", "é", "日本", "<|endoftext|>", "", "\n", "\t", "a\n", "\xa0", "7"]
    texts = [" ".join(rng.choices(parts[:7] if i % 2 else parts, k=rng.randrange(12))) + rng.choice(["", "\n", " "]) for i in range(600)] + ["", " ", "\n"]
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (1, 40, 1 << 20):
        monkeypatch.setattr(tokens, "_BYTES_AT_ONCE", size)
        encode = tokens.Encoder(tokens.vocabulary_file(), limit=20)
        got = list(encode.many(pa.array(texts, pa.string()).slice(0)))
        assert [np.frombuffer(g, encode.type).tolist() for g in got] == wanted
        assert list(encode.many(pa.array(texts, pa.string()).slice(7, 100))) == got[7:107]
    assert list(encode.many(pa.array([], pa.string()))) == []


def test_repeated_pieces_are_looked_up_once():
    class Counted(dict):
        looked_up = 0

        def get(self, key):
            Counted.looked_up += 1
            return dict.get(self, key)

    encode = tokens.Encoder(tokens.vocabulary_file())
    encode.pieces = Counted()
    list(encode.many(pa.array(["the cat and the dog " * 100] * 50)))
    assert Counted.looked_up < 100
