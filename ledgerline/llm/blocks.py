"""Texts in stored blocks, whole copies among them, and keys that several documents share.

The operators that look for repeated passages pass over the texts several times and must bring what they
learned back to them.  So the texts are written once as a table of blocks (about 2 MB of text, compressed),
bucketed by block number: what is learned is shuffled to its block, the texts themselves never are.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, narrow, row_blocks
from ledgerline.session import scratch_path

#: bytes of text in a block, and of text whose keys meet in one bucket
TEXT_BYTES, BUCKET_BYTES = 2 << 20, 16 << 20
#: a NULL id comes after all others
NO_ID = (1 << 63) - 1
#: entries of a key from which on it counts as heavy
HEAVY = 1024
HEAVY_LEVEL = HEAVY.bit_length()


def squeeze(data: bytes | np.ndarray) -> bytes:
    raw = data.tobytes() if isinstance(data, np.ndarray) else data
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def spread(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], n, codec="zstd", asbytes=True) if n else b""


def store_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``block``, ``n_bytes``, ``doc_ids``, ``sizes``, ``digests`` and ``data`` (the texts in a row) of every block.

    A NULL text counts as empty; NULL ids stay NULL.  With ``carry``, ``rest`` holds all other columns of the rows
    (an Arrow stream), and which texts are NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        for k, rows in enumerate(row_blocks(batches, "text", TEXT_BYTES)):
            texts = [t or b"" for t in rows.column("text").to_pylist()]
            sizes = [len(t) for t in texts]
            cols = [pa.array([part + k], pa.int64()), pa.array([sum(sizes)], pa.int64()),
                    pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([[hashlib.blake2b(t, digest_size=16).digest() for t in texts]], pa.list_(pa.binary())),
                    pa.array([squeeze(b"".join(texts))], pa.binary())]
            if carry:
                rest = rows.drop_columns(["doc_id", "text"]).append_column("__null", rows.column("text").is_null())
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as out:
                    out.write_table(rest)
                cols.append(pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=["block", "n_bytes", "doc_ids", "sizes", "digests", "data", "rest"][:len(cols)])

    spark = docs.sparkSession
    schema = "block long, n_bytes long, doc_ids array<long>, sizes array<long>, digests array<binary>, data binary" + (", rest binary" if carry else "")
    name = f"llm_blocks_{uuid.uuid4().hex}"
    source = narrow(docs, id_col, text_col)
    if carry:
        others = [c for c in docs.columns if c not in (id_col, text_col)]
        source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                             *[F.col(c).alias(f"c{k}") for k, c in enumerate(others)])
    out = source.mapInArrow(run, schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out.write.bucketBy(parts, "block").option("path", scratch_path(spark, "llm", "blocks")).saveAsTable(name)
    # the plan keeps files and layout; the catalog's entry would stay for good (the files are the folder's, not the table's)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names)}
            give_back()


def bucket_count(blocks: DataFrame) -> int:
    """Buckets that keys are dealt to, in proportion to the text."""
    total = blocks.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    return int(max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1))


def documents(blocks: DataFrame) -> DataFrame:
    """``block``, ``place``, ``doc_id``, ``size``, ``digest`` of every document."""
    return blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "sizes", "digests")).alias("place", "d")) \
        .select("block", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("size"), F.col("d.digests").alias("digest"))


def copies(blocks: DataFrame, min_bytes: int) -> DataFrame:
    """``block``, ``places`` and ``firsts``: texts of at least ``min_bytes`` that equal one with a smaller id, and that id."""
    docs = documents(blocks).where(F.col("size") >= min_bytes).withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    first = docs.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("top")).where("top > first").drop("top")
    pairs = docs.join(first, "digest").where("key > first")
    return pairs.groupBy("block").agg(F.collect_list(F.struct("place", "first")).alias("c")) \
        .select("block", F.col("c.place").alias("places"), F.col("c.first").alias("firsts"))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Range bucket of 64-bit keys: equal keys share it, and sorted keys come bucket by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_bucket(keys: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """(bucket, where) of sorted keys."""
    b = bucket_of(keys, n)
    cut = np.concatenate(([0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)])) if len(b) else np.zeros(1, np.int64)
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(b[s]), slice(s, e)


def key_entries(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The block's sorted keys, one that stands in several of its documents twice."""
    order = np.lexsort((doc, keys))
    k, d = keys[order], doc[order]
    if not len(k):
        return k
    new = np.concatenate(([True], k[1:] != k[:-1]))
    # the second document of a key
    other = np.concatenate(([False], (k[1:] == k[:-1]) & (d[1:] != d[:-1])))
    second = other & (np.cumsum(other) - np.maximum.accumulate(np.where(new, np.cumsum(other), 0)) == 1)
    return k[new | second]


def shared_keys(entries: DataFrame) -> DataFrame:
    """``block``, ``keys``, ``levels`` from rows of ``bucket, block, keys``: of each block its keys that several documents
    share, and for each as one byte how many entries it has, by powers of two (``HEAVY_LEVEL`` and more: above ``HEAVY``)."""
    def meet(table: pa.Table) -> pa.Table:
        give_back()
        own = [np.frombuffer(v.as_py(), dtype="<u8") for v in table.column("keys")]
        keys, counts = np.unique(np.concatenate(own), return_counts=True)
        keys, counts = keys[counts > 1], counts[counts > 1]
        blocks, out, levels = [], [], []
        for b, k in zip(table.column("block").to_pylist(), own):
            k = np.unique(k)
            at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
            hit = keys[at] == k if len(keys) else np.zeros(len(k), dtype=bool)
            if hit.any():
                blocks.append(b)
                out.append(k[hit].tobytes())
                levels.append(np.frexp(counts[at[hit]] - 1)[1].astype(np.uint8).tobytes())
        return pa.table([pa.array(blocks, pa.int64()), pa.array(out, pa.binary()), pa.array(levels, pa.binary())], names=["block", "keys", "levels"])

    return entries.groupBy("bucket").applyInArrow(meet, "block long, keys binary, levels binary") \
        .groupBy("block").agg(F.collect_list(F.struct("keys", "levels")).alias("k")) \
        .select("block", F.col("k.keys").alias("keys"), F.col("k.levels").alias("levels"))


def joined_keys(parts: list[bytes] | None, dtype: str = "<u8") -> np.ndarray:
    return np.concatenate([np.frombuffer(p, dtype=dtype) for p in parts]) if parts else np.zeros(0, dtype=dtype)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width], as long as x; places beyond the end count as the largest value."""
    top = np.iinfo(x.dtype).max
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        moved = np.full_like(out, top)
        moved[:max(0, len(out) - step)] = out[step:]
        out = np.minimum(out, moved)
        have += step
    return out


def sliding_max_back(x: np.ndarray, width: int) -> np.ndarray:
    """Maximum of x[i - width + 1:i + 1]; places before the start count as 0."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        moved = np.zeros_like(out)
        moved[step:] = out[:max(0, len(out) - step)]
        out = np.maximum(out, moved)
        have += step
    return out
