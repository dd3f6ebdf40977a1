"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits.  The binary Golay code is perfect:
every 23-bit word lies within 3 bits of exactly one codeword.  A segment's fuzzy keys are the indices of
the codewords nearest to it and to its one-bit neighbours, about five of them; two segments within 2
bits always share one, since a word half way between them is a neighbour of both.

Pigeonhole over at most 4 differing bits in three segments: either no segment has more than 2 (then all
three share a fuzzy key: 36 key bits), or one has 3 or more, and of the other two one is equal and the
other within 1 bit (one segment exactly and a fuzzy key of another: 35 key bits).

Only distinct fingerprints take part.  Fingerprints of a key are verified by counting differing bits; a
large key is searched breadth-first, each found fingerprint leaving the search, so a tight cluster costs
about one comparison a member and gives a spanning forest of true links, not all its pairs.
Components of the links then name the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow, stored, text_blocks
from ledgerline.llm.components import components

# fixed values: generator polynomial of the binary Golay code, and the segments (shift, bits)
GOLAY = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
MAX_BITS = 4
SHIFTED = 8  # runs of a key up to this size are compared by shifted arrays


@lru_cache(maxsize=1)
def _tables() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes by byte of a word, and the error pattern (weight 3 at most) of each syndrome."""
    def syndrome(w: int) -> int:
        for k in range(22, 10, -1):
            if w >> k & 1:
                w ^= GOLAY << (k - 11)
        return w

    unit = [syndrome(1 << k) for k in range(23)]
    by_byte = []
    for low in (0, 8, 16):
        t = np.zeros(256, dtype=np.int32)
        for b in range(256):
            for k in range(8):
                if b >> k & 1 and low + k < 23:
                    t[b] ^= unit[low + k]
        by_byte.append(t)
    error = np.zeros(2048, dtype=np.int32)
    for i in range(23):
        error[unit[i]] = 1 << i
        for j in range(i):
            error[unit[i] ^ unit[j]] = 1 << i | 1 << j
            for k in range(j):
                error[unit[i] ^ unit[j] ^ unit[k]] = 1 << i | 1 << j | 1 << k
    return by_byte, error


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    by_byte, error = _tables()
    s = by_byte[0][words & 255] ^ by_byte[1][words >> 8 & 255] ^ by_byte[2][words >> 16]
    return (words ^ error[s]) >> 11


def fuzzy_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each word's distinct fuzzy keys, rows in order."""
    flips = np.array([0] + [1 << k for k in range(bits)], dtype=np.int32)
    keys = np.sort(codeword_index(words.astype(np.int32)[:, None] ^ flips), axis=1)
    new = np.ones(keys.shape, dtype=bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    row, at = np.nonzero(new)
    return row, keys[row, at].astype(np.int64)


def _cross(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, every key of ``left`` with every key of ``right`` (12 bits)."""
    per = np.bincount(right[0], minlength=n)
    head = np.concatenate(([0], np.cumsum(per)[:-1]))
    size = per[left[0]]
    row = np.repeat(left[0], size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(head[left[0]], size)
    return row, np.repeat(left[1], size) << 12 | right[1][at]


def all_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every key of every fingerprint; the top bits tell the kind of key."""
    n = len(prints)
    segs = [(prints >> np.uint64(s)).astype(np.int64) & ((1 << b) - 1) for s, b in SEGMENTS]
    fuzzy = [fuzzy_keys(w, b) for w, (_, b) in zip(segs, SEGMENTS)]
    row, key = _cross(_cross(fuzzy[0], fuzzy[1], n), fuzzy[2], n)
    rows, keys = [row], [key]
    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                kind += 1
                r, k = fuzzy[j]
                rows.append(r)
                keys.append(np.int64(kind) << 40 | segs[i][r] << 12 | k)
    return np.concatenate(rows), np.concatenate(keys)


def _near(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of ``prints`` (distinct) within ``max_bits``."""
    left, right = [], []
    rest = prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            hit = np.bitwise_count(rest ^ u) <= max_bits
            if hit.any():
                new = rest[hit]
                left.append(np.full(len(new), u))
                right.append(new)
                queue.extend(new)
                rest = rest[~hit]
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links_of_sorted(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of the same key; ``keys`` come sorted."""
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    start = np.concatenate(([0], cut))
    size = np.diff(np.concatenate((start, [len(keys)])))
    of = np.repeat(size, size)
    small = of <= SHIFTED
    k, p = keys[small], prints[small]
    left, right = [], []
    for s in range(1, SHIFTED):
        if len(k) <= s:
            break
        hit = (k[s:] == k[:-s]) & (np.bitwise_count(p[s:] ^ p[:-s]) <= max_bits) & (p[s:] != p[:-s])
        left.append(p[:-s][hit])
        right.append(p[s:][hit])
    for b in np.flatnonzero(size > SHIFTED):
        x, y = _near(np.unique(prints[start[b]:start[b] + size[b]]), max_bits)
        left.append(x)
        right.append(y)
    none = np.zeros(0, dtype=np.uint64)
    a = np.concatenate(left + [none])
    b = np.concatenate(right + [none])
    pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
    return pairs[:, 0], pairs[:, 1]


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42); 0 without a word."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:len(words) - shingle])).tolist()
    h = xxhash.xxh64_intdigest
    n = len(starts)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array([h(line[s:e], 42) for s, e in zip(starts[at:at + (1 << 16)], (ends[shingle - 1:] - 1)[at:at + (1 << 16)].tolist())],
                        dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``bits`` (the 64-bit fingerprint as a long) per row.  NULL, empty and word-free texts: 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_blocks(batches):
            bits = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a``, ``b``: links between the distinct values of the column ``bits`` that span every group of
    fingerprints reachable within ``max_bits`` (4 at most) a step."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the segment keys find links of up to {MAX_BITS} bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 4096):
                part = values[at:at + 4096]
                row, key = all_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row].view(np.int64))], names=["key", "bits"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            prints = np.concatenate((prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on
            if whole >= 1 << 16:
                yield _batch(keys[:whole], prints[:whole])
                keys, prints = keys[whole:], prints[whole:]
        if len(keys):
            yield _batch(keys, prints)

    def _batch(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = links_of_sorted(keys, prints, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    rows = distinct.select("bits").mapInArrow(keyed, "key long, bits long")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``bits``, ``component_id`` (smallest doc_id reachable by links), ``root`` (what the component is known
    by, whatever its ids) per row of ``docs``.

    Word-free texts share fingerprint 0 and link like any other; copies and repeated rows share a
    fingerprint and so a component.  A NULL doc_id keeps its row but never names a component (which is
    NULL where no member has an id).  Empty tables give an empty result; other columns are not read."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    first = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    near = components(links(first.select("bits"), max_bits))
    named = first.join(near.withColumnRenamed("node", "bits"), "bits", "left") \
        .select("bits", "first_id", F.coalesce("root", "bits").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    group = named.join(least, "root").select("bits", "component_id", "root")
    return prints.join(group, "bits").select("doc_id", "bits", "component_id", "root")
