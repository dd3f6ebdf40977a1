"""Decontamination against a plain search over word lists."""

import hashlib
import random
import re

import numpy as np

from ledgerline.llm import decontam as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width=13):
    wins = [(i, tuple(w[k:k + width])) for i, t in items for w in [words(t)] if w for k in range(max(1, len(w) - width + 1))]
    out = []
    for i, t in docs:
        w = words(t)
        hit, ids = set(), set()
        for item, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    if item is not None:
                        ids.add(str(item))
        out.append((i, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_random_phrases(spark):
    rnd = random.Random(1)
    vocab = ["a", "b", "the", "ñu", "Ünit", "x1", "of"]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 30)))) for k in range(12)] + \
        [(3, "same id, other text with thirteen words and then some more to make it long"), (None, "b the of x1 b"), (50, None), (51, ""), (52, "!!")]
    docs = []
    for i in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.5:
            at = rnd.randint(0, len(w))
            w[at:at] = words(rnd.choice(items)[1])
        docs.append((i, ("-" if i % 3 else " ").join(w).upper() if i % 5 == 0 else ", ".join(w)))
    docs += [(None, docs[0][1]), (7, docs[7][1]), (7, docs[7][1]), (200, None), (201, ""), (202, "the " * 30_000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_hit int").repartition(3)
    got = D.contamination(df, spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string"))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted((tuple(r)[:4] + (r.contaminated,) for r in got.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_item_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BYTES", 60)
    docs = [(1, "one two three four five six"), (2, "six five four three")]
    items = [(1, "two three"), (2, "five four three"), (3, "three four")]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r)[:4] + (r.contaminated,) for r in got.collect())) == sorted(brute(docs, items))


def test_proximity(spark):
    docs = [(1, "alpha beta gamma delta"), (2, "alpha x beta gamma y delta"), (3, "delta q q q q alpha gamma q q q beta")]
    items = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in D.contamination(df, items).collect() if r.n_hit} == {1}
    assert {r.doc_id for r in D.contamination(df, items, slop=2).collect() if r.n_hit} == {1, 2}


def test_packed_gaps():
    g = np.array([0, 1, 127, 128, 16383, 16384, 1 << 21, 1 << 28, (1 << 31) - 1])
    assert D.unpack(D.pack(g)).tolist() == np.cumsum(g).tolist()
    assert D.unpack(b"").tolist() == []


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = D.contamination(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert [(x.n_words, x.n_hit, x.contaminated) for x in r] == [(2, 0, False)]
    assert hashlib.sha256(b"").hexdigest()
