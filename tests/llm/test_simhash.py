"""SimHash against brute force; the Golay keys' guarantee; components against union-find."""

import random

import numpy as np
import xxhash

from ledgerline.llm import simhash
from ledgerline.llm.components import components
from ledgerline.llm.registry import QUERIES


def slow_print(text, n=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(ids, prints):
    """Smallest id reachable over links of at most 4 bits, by brute force."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    p = np.array(prints, dtype=np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p ^ p[i]) <= 4).tolist():
            root[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(ids))]


def test_segments_within_two_bits_share_a_key():
    rnd = random.Random(1)
    for bits in (23, 18):
        for _ in range(300):
            x = rnd.getrandbits(bits)
            y = x
            for b in rnd.sample(range(bits), rnd.randint(0, 2)):
                y ^= 1 << b
            keys = [set(simhash.fuzzy_keys(np.array([w]), bits)[1].tolist()) for w in (x, y)]
            assert keys[0] & keys[1]
            assert max(map(len, keys)) <= 6


def test_prints_within_four_bits_share_a_key():
    rnd = random.Random(2)
    for _ in range(400):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), 4):
            y ^= 1 << b
        row, key = simhash.all_keys(np.array([x, y], dtype=np.uint64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_components_equal_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(250)] + [(1000, k) for k in range(1001, 1100)] \
        + [(k, k + 1) for k in range(2000, 2060)] + [(5, 5), (None, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_clusters_and_odd_rows_against_brute_force(spark):
    rnd = random.Random(4)
    centre = [rnd.getrandbits(64) for _ in range(30)]
    prints = set()
    for c in centre:
        for _ in range(60):
            x = c
            for b in rnd.sample(range(64), rnd.randint(0, 7)):
                x ^= 1 << b
            prints.add(x)
    prints |= {0, 1, 15, 31, (1 << 64) - 1}
    values = sorted(prints)
    rows = [(int(np.uint64(v).view(np.int64)),) for v in values]
    near = components(simhash.links(spark.createDataFrame(rows, "bits long"))).collect()
    root = {r.node: r.root for r in near}
    mine = [root.get(b[0], b[0]) for b in rows]
    want = groups(list(range(len(values))), values)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op4_simhash_near_dedup"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    prints = [int(got[d.doc_id].fingerprint, 16) for d in docs]
    for d, p in list(zip(docs, prints))[:150]:
        assert p == slow_print(d.text)
    assert [got[d.doc_id].component_id for d in docs] == groups([d.doc_id for d in docs], prints)


def test_nulls_empty_and_repeats(spark):
    rows = [(3, None, "a"), (2, "", "b"), (None, "   ", "c"), (7, "one two", "d"), (5, "ONE  two", None), (5, "ONE  two", None),
            (None, "unlike any other text here at all", "e"), (9, "w " * 50_000, "f")]
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, bits string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == sorted(
        [("3", "2"), ("2", "2"), ("None", "2"), ("7", "5"), ("5", "5"), ("5", "5"), ("None", "None"), ("9", "9")])
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
