"""Benchmark decontamination with a distributed positional inverted index.

Documents are indexed in shards of about ``SHARD_BYTES`` of text: for each word of a shard, the sorted word
positions where it stands (difference-coded bytes), and for the shard itself its documents' ids and
lengths.  A hot word is thus split over all shards, and a posting list is never longer than its shard.
The index is stored as a Parquet table in the shared folder.

Test items are searched in blocks of bounded size, each one pass over the postings of its words: in every
shard, a window's words are taken from the rarest on, their lists shifted by the word's offset, and
intersected until none or only true starts are left.  With ``slop`` 0 these are exact phrases; otherwise
every word may stand up to ``slop`` words off its place (proximity).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, narrow, stored, text_blocks

#: bytes of text in a shard of the index
SHARD_BYTES = 8 << 20
#: bytes of test items searched in one pass over the index (bounds what is sent to every task)
ITEM_BYTES = 4 << 20
INDEX_SCHEMA = "shard long, word binary, doc_ids array<long>, postings binary"
HIT_SCHEMA = "shard long, place int, item_id string, first int, last int"
# ASCII letters and digits and all other bytes of UTF-8 make words; A-Z become a-z
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_KEEP).split() if text else []


def pack(gaps: np.ndarray) -> bytes:
    """Seven bits a byte, the top bit set where a number goes on."""
    size = 1 + (gaps >= 1 << 7) + (gaps >= 1 << 14) + (gaps >= 1 << 21) + (gaps >= 1 << 28)
    end = np.cumsum(size)
    out = np.empty(end[-1] if len(end) else 0, dtype=np.uint8)
    for k in range(5):
        on = size > k
        if not on.any():
            break
        out[end[on] - size[on] + k] = (gaps[on] >> (7 * k) & 127) | np.where(size[on] > k + 1, 128, 0)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The positions of ``pack``ed gaps."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    last = b < 128
    which = np.concatenate(([0], np.cumsum(last)[:-1])) if len(b) else np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate(([True], last[:-1]))) if len(b) else np.zeros(0, np.int64)
    shift = 7 * (np.arange(len(b)) - head[which]) if len(b) else which
    gaps = np.add.reduceat((b & 127) << shift, head) if len(b) else np.zeros(0, np.int64)
    return np.cumsum(gaps)


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _shard_rows(shard: int, ids: list, texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
    numbers = _Numbers()
    codes, lengths = [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        w = words_of(t)
        lengths[i] = len(w)
        codes.append(np.array([numbers[x] for x in w], dtype=np.int32))
        del w
    schema = pa.schema([("shard", pa.int64()), ("word", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("postings", pa.binary())])
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([None], pa.binary()), pa.array([ids], pa.list_(pa.int64())),
                                      pa.array([lengths.astype("<i4").tobytes()], pa.binary())], schema=schema)
    if not numbers:
        return
    flat = np.concatenate(codes)
    # one free position after each document, so that no phrase runs over its end
    pos = np.arange(len(flat), dtype=np.int64) + np.repeat(np.arange(len(texts)), lengths)
    del codes
    order = np.argsort(flat, kind="stable")
    flat, pos = flat[order], pos[order]
    cut = np.concatenate(([0], np.flatnonzero(flat[1:] != flat[:-1]) + 1, [len(flat)]))
    gaps = np.diff(pos, prepend=0)
    gaps[cut[:-1]] = pos[cut[:-1]]
    size = 1 + (gaps >= 1 << 7) + (gaps >= 1 << 14) + (gaps >= 1 << 21) + (gaps >= 1 << 28)
    ends = np.concatenate(([0], np.cumsum(size)))[cut]
    data = pa.py_buffer(pack(gaps))
    words = list(numbers)
    for at in range(0, len(words), 1 << 15):
        to = min(len(words), at + (1 << 15))
        lists = pa.BinaryArray.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(ends[at:to + 1].astype("<i4")), data])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(to - at, shard)), pa.array(words[at:to], pa.binary()),
                                          pa.nulls(to - at, pa.list_(pa.int64())), lists], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: a row for each word of a shard, and one (``word`` NULL) with the shard's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        for k, (ids, texts) in enumerate(text_blocks(batches, SHARD_BYTES)):
            yield from _shard_rows(part + k, ids, texts)

    return stored(narrow(docs, id_col, text_col).mapInArrow(run, INDEX_SCHEMA), "positional_index")


def _windows(items: list[tuple], width: int) -> list[tuple[int, list[bytes]]]:
    """(item number, words) of every window; an item of fewer words, but not none, is one."""
    out = []
    for k, (_, words) in enumerate(items):
        for at in range(max(1, len(words) - width + 1)) if words else ():
            out.append((k, words[at:at + width]))
    return out


def _starts(words: list[bytes], lists: dict[bytes, np.ndarray], slop: int) -> np.ndarray:
    """Positions where the words stand in a row, from the rarest word's list on."""
    order = sorted(range(len(words)), key=lambda k: len(lists[words[k]]))
    start = lists[words[order[0]]] - order[0]
    for k in order[1:]:
        if not len(start):
            break
        held = lists[words[k]]
        at = np.searchsorted(held, start + (k - slop))
        start = start[(at < len(held)) & (held[np.minimum(at, len(held) - 1)] <= start + (k + slop))]
    return start


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals [first, last) joined where they touch."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate(([True], first[1:] > last[:-1]))
    return first[new], last[np.concatenate((new[1:], [True]))]


def _item_blocks(items: Iterable, max_bytes: int) -> Iterator[list[tuple]]:
    block, held = [], 0
    for r in items:
        size = len(r["text"] or b"")
        if block and held + size > max_bytes:
            yield block
            block, held = [], 0
        block.append((r["item_id"], words_of(bytes(r["text"]) if r["text"] is not None else None)))
        held += size
    if block:
        yield block


def find(index: DataFrame, items: DataFrame, width: int = 13, slop: int = 0, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``shard``, ``place`` (of the document in its shard), ``item_id`` (text), ``first``, ``last``: the word ranges
    [first, last) of a document that occurrences of an item's windows cover, joined where they touch."""
    spark = index.sparkSession
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = None
    for block in _item_blocks(rows.toLocalIterator(), ITEM_BYTES):
        one = _find_block(index, spark, block, width, slop)
        found = one if found is None else found.union(one)
    return found if found is not None else spark.createDataFrame([], HIT_SCHEMA)


def _find_block(index: DataFrame, spark, block: list[tuple], width: int, slop: int) -> DataFrame:
    windows = _windows(block, width)
    names = [i for i, _ in block]
    shared = spark.sparkContext.broadcast((windows, names))
    wanted = sorted({w for _, ws in windows for w in ws})
    terms = spark.createDataFrame([(bytearray(w),) for w in wanted], "word binary")

    def search(table: pa.Table) -> pa.Table:
        give_back()
        wins, item_ids = shared.value
        word = table.column("word").to_pylist()
        data = table.column("postings")
        whole = word.index(None)
        shard = table.column("shard")[whole].as_py()
        lengths = np.frombuffer(data[whole].as_py(), dtype="<i4").astype(np.int64)
        head = np.concatenate(([0], np.cumsum(lengths + 1)))
        at = {w: k for k, w in enumerate(word) if w is not None}
        lists: dict[bytes, np.ndarray] = {}
        hits: dict[int, list] = {}
        for k, ws in wins:
            if all(w in at for w in ws):
                for w in ws:
                    if w not in lists:
                        lists[w] = unpack(data[at[w]].as_py())
                s = _starts(ws, lists, slop)
                if len(s):
                    hits.setdefault(k, []).append((s, s + len(ws)))
        out: list[list] = [[], [], [], [], []]
        for k, parts in hits.items():
            s, e = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            place = np.searchsorted(head, s, side="right") - 1
            s = np.maximum(s, head[place])
            e = np.minimum(e, head[place] + lengths[place])  # of use only where words may stand off their place
            s, e = _merged(s, e)
            place = np.searchsorted(head, s, side="right") - 1
            for col, v in zip(out, (np.full(len(s), shard), place, [item_ids[k]] * len(s), s - head[place], e - head[place])):
                col.extend(v)
        types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32())
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=["shard", "place", "item_id", "first", "last"])

    held = index.where("word is not null").join(F.broadcast(terms), "word", "left_semi").select("shard", "word", "postings")
    whole = index.where("word is null").select("shard", "word", "postings")
    return held.union(whole).groupBy("shard").applyInArrow(search, HIT_SCHEMA)


def contamination(docs: DataFrame, items: DataFrame, width: int = 13, slop: int = 0, one_in: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``item_ids`` (sorted as text), ``spans`` (the hit ranges), ``contaminated`` (n_hit > 0 and at least
    one word in ``one_in``).

    NULL, empty and word-free texts have no words and no hits; word-free items have no windows; a NULL
    item id hits words but is not listed; repeated rows and NULL doc_ids stay rows of their own; an empty
    table on either side gives no hits.  Other columns are not read."""
    index = build_index(docs, id_col, text_col)
    hits = find(index, items, width, slop, item_id_col, item_text_col)
    per_doc = hits.groupBy("shard", "place").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"), F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    # words covered by the sorted ranges: each adds what lies beyond the furthest end so far
    count = ("aggregate(ranges, named_struct('upto', 0, 'n', 0), (a, r) -> named_struct('upto', greatest(a.upto, r.last), "
             "'n', a.n + greatest(0, r.last - greatest(a.upto, r.first))), a -> cast(a.n as long))")
    per_doc = per_doc.withColumn("n_hit", F.expr(count))
    rows = _documents(index)
    out = rows.join(per_doc, ["shard", "place"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      F.coalesce("ranges", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
                      ((n_hit > 0) & (n_hit * F.lit(one_in) >= F.col("n_words"))).alias("contaminated"))


def _documents(index: DataFrame) -> DataFrame:
    """``shard``, ``place``, ``doc_id``, ``n_words`` of every indexed document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, ids, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, pa.int64()),
                                                  pa.array(np.frombuffer(lengths, dtype="<i4").astype(np.int64))],
                                                 names=["shard", "place", "doc_id", "n_words"])

    return index.where("word is null").select("shard", "doc_ids", "postings") \
        .mapInArrow(run, "shard long, place int, doc_id long, n_words long")
