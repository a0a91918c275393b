"""Backtracking byte-pair encoding and offset-table decoding, against the library and plain merging."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import docs
from quarry.llm import bpe
from quarry.llm.queries import QUERIES

PATH = bpe.tokenizer_file()
LIB = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, kept=50)


def library(text):
    ids = LIB.encode(text, add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def check(codec, text):
    ids = codec.encode(text)
    want, decoded = library(text)
    assert np.frombuffer(ids, "<u4").tolist() == want, text
    assert codec.decode(ids).decode() == decoded, text


@pytest.mark.parametrize("alphabet", ["ab", "ha!", "the in.gs'", "aáe\u0301iİΣσẞ ﬁ\u00a0\u0085中😀\u200d", "0١²x ", "<|endoftext|>s"])
def test_ids_and_texts_equal_the_librarys(codec, alphabet):
    rng = random.Random(alphabet)
    for n in range(120):
        check(codec, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 3 * n))))


def test_any_characters(codec):
    rng = random.Random(7)
    for top in (0x80, 0x250, 0x3000, 0x20000):
        for _ in range(60):
            check(codec, "".join(chr(c) for c in (rng.randrange(top) for _ in range(70)) if not 0xd800 <= c < 0xe000))


def test_edges_and_added_tokens(codec):
    for text in ["", " ", "\n\t", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "e<|endoftext|>\u0301", "\x1c a\x1db", "a" * 20_000,
                 "haha" * 5_000, "!" * 9_000, "İİ", "don't WE'LL"]:
        check(codec, text)
    assert codec.encode(None) == b"" and codec.decode(b"") == b""


def test_word_encoder_equals_plain_merging():
    """A small vocabulary with ambiguous merges, every word up to eight letters; one token is not its own encoding."""
    merges = [("b", "c"), ("a", "b"), ("c", "c"), ("ab", "c"), ("a", "bc"), ("cc", "a"), ("bc", "bc"), ("a", "a"), ("aa", "bc")]
    vocab = {t: i for i, t in enumerate(dict.fromkeys([*"abc", *(x + y for x, y in merges)]))}
    merges = [m for i, m in enumerate(merges) if (m[0] + m[1]) not in {x + y for x, y in merges[:i]}]
    m = bpe.Merges({"type": "BPE", "vocab": vocab, "merges": merges})
    rank = {p: i for i, p in enumerate(merges)}
    assert "abc" not in m.single

    def plain(word):
        parts = list(word)
        while True:
            found = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
            if found is None:
                return [vocab[p] for p in parts]
            i = found[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    import itertools
    for n in range(1, 9):
        for word in map("".join, itertools.product("abc", repeat=n)):
            assert m.encode(word.encode()) == plain(word), word


def test_unsuited_files_are_refused():
    for change in ({"type": "Unigram"}, {"byte_fallback": True}, {"unk_token": "?"}, {"dropout": 0.1}):
        with pytest.raises(ValueError):
            bpe.Merges({"type": "BPE", "vocab": {"a": 0}, "merges": [], **change})


def test_kept_pieces_are_bounded_and_recent():
    calls = []
    kept = bpe.Kept(lambda k: calls.append(k) or k, 3)
    for k in [1, 2, 3, 1, 4, 1, 5, 6, 7, 1]:
        assert kept[k] == k and len(kept) + len(kept.old) <= 6
    assert calls.count(1) == 1


def test_query_on_edge_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "Hello, World's 12"), (4, "w" * 5000 + " x" * 30_000)]
    docs(spark, rows, extra=["token_ids", "decoded_text", "n_tokens"]).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(str, (tuple(r) for r in QUERIES["op12_bpe"](spark, str(tmp_path)).collect())))
    want = []
    for doc_id, text in rows:
        ids, decoded = library(text or "")
        want.append(str((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())))
    assert got == sorted(want)
    empty = docs(spark, []).withColumn("lang", F.lit("x"))
    assert bpe.decode_documents(bpe.encode_documents(empty)).columns == [*empty.columns, "token_ids", "decoded_text"]
    assert bpe.decode_documents(bpe.encode_documents(empty)).count() == 0
    null = spark.createDataFrame([(None,)], "token_ids binary")
    assert bpe.decode_documents(null).first().decoded_text is None


def test_query_equals_the_library_on_documents(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(d + "/documents.parquet").collect()}
    rows = QUERIES["op12_bpe"](spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, decoded = library(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
