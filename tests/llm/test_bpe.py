"""Byte-level BPE against the tiktoken library, and the exact round trip."""

import hashlib

import pytest
import regex

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from ledgerline.llm import bpe  # noqa: E402
from ledgerline.llm.registry import bpe_digests  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "hello world", "a" * 3000, "  many   spaces \n\n\t x", "it's they'll WE'RE", "naïve Straße ñandú 漢字 🙂",
         "<|endoftext|> 12345 ###%%%&&&", "ab" * 500 + "aaa" * 37, "  \x1c\x1dq", "x" * 200_000, "hello world"]


@pytest.fixture(scope="module")
def reference():
    v = bpe.load_vocabulary(PATH, P.PATTERN)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(v.tokens)}, special_tokens={})


def test_same_ids_as_tiktoken_and_round_trip(spark, reference):
    rows = [(i if i else None, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe_digests(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, t, _ in rows:
        want = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in want)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_whole_table_equals_tiktoken(spark, reference):
    from ledgerline.llm.registry import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op8_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == set(docs)
    for r in got:
        want = reference.encode_ordinary(docs[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in want)).hexdigest()


def test_pieces_equal_one_by_one(reference):
    enc = bpe.Encoder(bpe.load_vocabulary(PATH, P.PATTERN))
    import random
    rnd = random.Random(5)
    words = list({"".join(rnd.choice("abtheinr  ") for _ in range(rnd.randint(1, 18))).encode() for _ in range(3000)})
    flat, off = enc.pieces(words)
    for k, w in enumerate(words):
        assert flat[off[k]:off[k + 1]].tolist() == ([enc.rank[w]] if w in enc.rank else enc.one_piece(w))


def test_pattern_splits_like_the_library(reference):
    """Every code point between two letters gives the same pieces in both pattern engines."""
    find = regex.compile(P.PATTERN).findall
    enc = bpe.Encoder(bpe.load_vocabulary(PATH, P.PATTERN))
    odd = []
    for cp in list(range(0x3000)) + list(range(0xFE00, 0x10000)) + list(range(0x1F000, 0x1FB00)):
        t = f"a{chr(cp)} {chr(cp)}1"
        mine = [i for w in find(t) for i in ([enc.rank[w.encode()]] if w.encode() in enc.rank else enc.one_piece(w.encode()))]
        if mine != reference.encode_ordinary(t):
            odd.append(hex(cp))
    assert not odd, odd


def test_empty_table(spark):
    assert bpe_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
