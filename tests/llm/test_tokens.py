import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from roadfeat.llm import tokens
from roadfeat.llm.packing import binary_lengths, pack
from roadfeat.llm.token_shards import PerfectHash, shard_digests, write_token_shards
from roadfeat.llm.tokens import Encoder
from tokenizers import Tokenizer

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = [
    "", " ", "\n", "a", "Hello, world! It's  the 1st\n\n\tday.", "x\n y \n", " lead", "trail ", "Ünḯ ǅ ß 中文 \U0001f600 é",
    "a b\x1cc\x85d", "<|endoftext|> and <|startoftext|>", "don't we'll 12345", "tab\tsep", "a b\nc d", "word " * 5000, "́x ́y",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_tokenizer(path):
    plain, encode = Tokenizer.from_file(path), Encoder(path)
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "'s", " ", " ", "\n", "1", "!!", "ing", "\t", " ", "Σ", "|"]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(1, 40))) for _ in range(400)]
    texts = [*TEXTS, *made, "~", "a~b ~ ~~", "é" * 100 + " " + "ab" * 90]
    together = list(Encoder(path).many(texts))
    for text, ids in zip(texts, together, strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), encode.dtype).tolist() == want, text
        assert np.frombuffer(ids, encode.dtype).tolist() == want, text


def test_special_tokens_are_not_made_by_lower_case():
    plain, encode = Tokenizer.from_file(WORD), Encoder(WORD)
    for text in ("a <|EndOfText|> b", "<|endoftext|>A<|STARTOFTEXT|> <|endoftext|>", "A\u3000B\x85C \x1cD"):
        assert np.frombuffer(encode(text), encode.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_new_words_cost_one_encoding(monkeypatch):
    """Words of letters go to the tokenizer once and without marks; tables that are full lose words that are not met again."""
    plain, encode, asked = Tokenizer.from_file(WORD), Encoder(WORD), []
    monkeypatch.setattr(encode.words, "encode", lambda text: asked.append(text) or encode.ids(text))
    long = "x" * 100
    list(encode.many(["alpha beta", "beta Gamma it's", f"alpha {long} {long} gamma"]))
    assert sorted(" ".join(asked).split()) == ["alpha", "beta", "gamma", "it's", long]
    assert long.encode() not in encode.words.newer
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", (0, 40 * tokens.WORD_BYTES))
    for i in range(30):
        texts = [f"common word{i}x{j} it's {long}" for j in range(20)]
        got = [np.frombuffer(ids, encode.dtype).tolist() for ids in encode.many(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encode.words.newer) + len(encode.words.older) <= 100
    assert b"common" in encode.words.newer


class Counted(dict):
    """A table that counts how often a word is looked up."""

    asked = 0

    def get(self, word, default=None):
        self.asked += 1
        return super().get(word, default)


def test_byte_words_are_looked_up_once_and_encoded_without_marks(monkeypatch):
    """op1: a word that occurs often costs one look-up; words after a blank go to the tokenizer as they stand."""
    plain, encode, asked = Tokenizer.from_file(BYTE), Encoder(BYTE), []
    encode.spaced.newer = Counted()
    monkeypatch.setattr(encode.spaced, "encode", lambda text: asked.append(text) or encode.ids(text))
    texts = ["one two two\nthree two it's two", "two one two", "x  two <|endoftext|>", None, "one two\nit's"]
    got = [np.frombuffer(ids, encode.dtype).tolist() for ids in encode.many(texts)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted("".join(asked).split(" ")) == ["", "it's", "one", "two"] and "\n" not in "".join(asked)
    assert encode.spaced.newer.asked <= 4  # the line feed too


def test_bare_words_are_looked_up_once():
    """op3: a word that occurs often costs one look-up."""
    plain, encode = Tokenizer.from_file(WORD), Encoder(WORD)
    encode.words.newer = Counted()
    texts = ["one two Two two it's\ttwo " * 50, " two  one ", None, "a~b"]
    got = [np.frombuffer(ids, encode.dtype).tolist() for ids in encode.many(texts)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encode.words.newer.asked <= 5  # the place before a first blank counts as an empty word


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_in_small_steps(path, monkeypatch):
    """Few characters and few words at once, and tables that are full at once, give the same ids."""
    monkeypatch.setattr(tokens, "AT_ONCE", 60)
    monkeypatch.setattr(tokens, "ENCODED", 3)
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", (20 * tokens.WORD_BYTES, 20 * tokens.WORD_BYTES))
    plain, rng = Tokenizer.from_file(path), random.Random(8)
    parts = ["a", "Bc", "é", "中", "'s", "7", "!", "~", "<|endoftext|>", "\u3000", "\x1c", "\x85", "\t", "\r", "long" * 30]
    texts = [
        rng.choice([" ", "\n", " ", "  ", " \n"]).join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(9)))
        for _ in range(600)
    ]
    got = [np.frombuffer(ids, plain.get_vocab_size() > 1 << 16 and "<u4" or "<u2").tolist() for ids in Encoder(path).many(texts)]
    for text, ids in zip(texts, got, strict=True):
        assert ids == plain.encode(text, add_special_tokens=False).ids, text


def test_perfect_hash_is_minimal_and_survives_a_dump():
    rng = np.random.default_rng(5)
    h1, h2 = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    hashed = PerfectHash.load(*PerfectHash.build(h1, h2).dump())
    assert sorted(hashed.slots(h1, h2)) == list(range(5000))
    assert PerfectHash.build(h1[:0], h2[:0]).slots(h1, h2).max() == -1


def rows_of(documents):
    rows = [(i * 7 % 40, t) for i, t in enumerate(TEXTS)] + [(3, None), (None, "no id"), (100, "twice"), (100, "twice")]
    return documents(rows, "1 as start,2 as shard,3 as n")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_read_back(documents):
    docs = rows_of(documents)
    shards = write_token_shards(docs, BYTE, 0)
    got = sorted(shard_digests(shards).collect(), key=lambda r: r.start)
    plain = Tokenizer.from_file(BYTE)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append(plain.encode(r.text or "", add_special_tokens=False).ids + [0])
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in {(len(x), crc(x)) for x in ids[r.doc_id]}
    absent = shards.keys.sparkSession.createDataFrame([(999, 0), (100, 2), (100, 1)], "doc_id long, copy long")
    assert [(r.doc_id, r.copy) for r in shards.find(absent).collect()] == [(100, 1)]


def test_empty_tables(documents):
    assert shard_digests(write_token_shards(documents([]), BYTE, 0)).collect() == []
    assert pack(documents([]), WORD, 2).collect() == []


def test_pack(documents):
    docs = rows_of(documents)
    plain = Tokenizer.from_file(WORD)
    want = sorted((r.doc_id is not None, r.doc_id or 0, tuple(plain.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in docs.collect())
    longest = 64
    got = pack(docs, WORD, 2, longest).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    assert all(r.length & (r.length - 1) == 0 and r.length <= longest and r.offset == 0 for r in got)
    by_id = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in by_id] == sorted((r.length for r in got), reverse=True)
    for r in got:
        assert r.ids_crc32 == crc(np.frombuffer(r.ids, "<u2")) and len(r.ids) == 2 * r.length
    whole = []
    for doc in {r.doc_id for r in got}:
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        copies = sum(r.doc_id == doc for r in docs.collect())
        if copies == 1:
            ids = tuple(np.frombuffer(b"".join(r.ids for r in mine), "<u2").tolist())
            assert [r.start for r in mine] == np.cumsum([0] + [r.length for r in mine[:-1]]).tolist()
            assert {r.doc_tokens for r in mine} == {len(ids)}
            whole.append((doc is not None, doc or 0, ids))
    ids = [x[1] if x[0] else None for x in want]
    assert sorted(whole) == [x for x in want if ids.count(x[1] if x[0] else None) == 1]


def test_binary_lengths():
    for n in range(1, 300):
        assert sum(binary_lengths(n, 64)) == n
    assert binary_lengths(64 * 2 + 5, 64) == [64, 64, 4, 1]
