"""Shared helpers of the text operators: column selection, folds, blocks, stored tables."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

_LIBC = ctypes.CDLL(None)

#: bytes of text that a task holds at once (one longer document is a block of its own)
BLOCK_BYTES = 3 << 20


#: rows in an Arrow batch: documents are long, and a batch is held twice on its way to Python
BATCH_ROWS = "1000"


def small_batches(df: DataFrame) -> None:
    """Let the session send rows to Python in batches of ``BATCH_ROWS``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on between tasks, and what its allocators
    (Arrow's and the C library's) keep adds up with the other workers of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text; extra columns, whatever their names, play no part."""
    small_batches(docs)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts`` (NULL for a NULL id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(parts)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, and what later
    steps read no longer depends on the executor that computed it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(col: pa.Array) -> pa.Array:
    """A text column as its UTF-8 bytes, without decoding."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    return col.cast(pa.large_binary() if wide else pa.binary())


def row_blocks(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Whole rows in blocks of about ``max_bytes`` of the column ``text``, which comes as bytes."""
    parts: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        k = batch.schema.get_field_index(text)
        batch = pa.RecordBatch.from_arrays([_bytes(c) if j == k else c for j, c in enumerate(batch.columns)], names=batch.schema.names)
        at = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(k)), 0).to_pylist()):
            if held + n > max_bytes and (parts or i > at):
                yield pa.Table.from_batches(parts + [batch.slice(at, i - at)])
                parts, held, at = [], 0, i
                give_back()
            held += n
        if at < batch.num_rows:
            parts.append(batch.slice(at))
    if parts:
        yield pa.Table.from_batches(parts)
        del parts
        give_back()


def text_blocks(batches: Iterable[pa.RecordBatch], max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes | None]]]:
    """(ids, UTF-8 texts) of the rows in blocks of about ``max_bytes``; a longer text is a block alone.

    Texts are read from the column's buffer as bytes, without decoding."""
    ids: list = []
    texts: list[bytes | None] = []
    held = 0
    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), _bytes(batch.column(1))):
            t = v.as_py()
            n = len(t) if t else 0
            if texts and held + n > max_bytes:
                yield ids, texts
                ids, texts, held = [], [], 0
                give_back()
            ids.append(i)
            texts.append(t)
            held += n
    if texts:
        yield ids, texts
        del ids, texts
        give_back()
