"""Sharding by proportional stratified interleaving: every shard has the mixture of the whole table.

Within its source a row has a rank in a seeded shuffled order; its fractional rank is (rank - 1 + phase) / n,
with a seeded phase per source so that small sources do not meet at one place.  Rows sorted by fractional rank
are cut into runs of equal count: any run holds of each source its share of the table, to within a row or so
for each source's phase.

No task ever holds a source.  A row's place in the shuffled order is known from its draw (a digest), so the
order is split into cells by ranges of the draw; cells are counted first, their counts added up in order, and
rows are numbered within a cell.  The interleaved order is numbered the same way, by slices of the fraction.
The number of cells follows the session's shuffle partitions, with an upper bound on rows to a cell.

Edge cases: a NULL source is a source of its own, a NULL text is empty (size 1), a NULL id is an id like any
other; rows that agree in id and text are interchangeable, each gets its own slot; with fewer rows than shards
some shards are empty; an empty table gives no rows; other columns ride along only where ``carry`` names them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

#: rows in a cell at most (while there are no more than ``MAX_CELLS`` cells), cells per shuffle partition
CELL_ROWS, MAX_CELLS, CELLS_PER_PARTITION = 50_000, 1_000_000, 16
#: sources whose counts are broadcast (32 bytes each); more are joined by a shuffle
SMALL_SOURCES = 20_000


def _unit(hex_digest: Column) -> Column:
    """The first 32 bits of a digest as a fraction below 1; it grows with the digest."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _before(counts: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """``n_before``: rows in the cells that come earlier in their group (cells: at most ``MAX_CELLS``)."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, order, F.coalesce(F.sum("cell_rows").over(w), F.lit(0)).alias("n_before"))


def interleave(docs: DataFrame, shards: int = 16, by: str = "source", seed: str = "interleave", id_col: str = "doc_id", text_col: str = "text",
               carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``stratum`` (source), ``shard``, ``slot`` and ``carry``'s columns of every row.

    Shards differ by one row at most; slots of a shard count from 0 without gaps.  The same rows and seed give the same slots."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.col(by).cast("string").alias("stratum"),
                       F.struct(*[F.col(c) for c in carry]).alias("rest") if carry else F.lit(None).cast("int").alias("rest"))
    # stored text of a stratum: a NULL source is not the source ''
    named = F.when(F.col("stratum").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("stratum")))
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string")))
    rows = stored(rows.withColumn("stratum", named).withColumn("draw", F.unhex(draw)), "shard_rows")

    sources = stored(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "shard_sources")
    seen = sources.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("sources")).first()
    total = seen["rows"]
    cell_rows = min(CELL_ROWS, max(1, total // (CELLS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    cell_rows = max(cell_rows, math.ceil(total / MAX_CELLS))
    sources = sources.withColumn("cells", F.ceil(F.col("n") / cell_rows)) \
        .withColumn("phase", _unit(F.md5(F.concat(F.lit(f"{seed}:"), F.col("stratum")))))
    if seen["sources"] <= SMALL_SOURCES:
        sources = F.broadcast(sources)

    celled = rows.join(sources, "stratum").withColumn("cell", F.floor(_unit(F.hex("draw")) * F.col("cells")))
    before = _before(celled.groupBy("stratum", "cell").agg(F.count(F.lit(1)).alias("cell_rows")), ["stratum"], "cell")
    in_cell = F.row_number().over(Window.partitionBy("stratum", "cell").orderBy("draw", "doc_id", "size"))
    slices = max(1, math.ceil(total / cell_rows))
    fraction = (F.col("rank") - 1 + F.col("phase")) / F.col("n")
    ranked = celled.join(before, ["stratum", "cell"]).withColumn("rank", F.col("n_before") + in_cell).withColumn("fraction", fraction) \
        .withColumn("slice", F.least(F.floor(F.col("fraction") * slices), F.lit(slices - 1)))
    ranked = stored(ranked.select("doc_id", "size", "text_crc32", "stratum", "rank", "fraction", "slice", "rest"), "shard_ranks")

    counts = ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("cell_rows")).withColumn("all", F.lit(0))
    before = _before(counts, ["all"], "slice").drop("all")
    in_slice = F.row_number().over(Window.partitionBy("slice").orderBy("fraction", "stratum", "rank"))
    place = ranked.join(before, "slice").withColumn("place", F.col("n_before") + in_slice - 1)
    # exact: integer division, not a quotient of doubles
    shard = F.expr(f"(place * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    out = place.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
    source = F.when(F.col("stratum") != "", F.expr("substring(stratum, 2)"))
    return out.select("doc_id", "size", "text_crc32", source.alias("stratum"), F.col("shard").cast("int").alias("shard"), "slot",
                      *[F.col(f"rest.{c}").alias(c) for c in carry])


def write_shards(sharded: DataFrame, path: str, file_rows: int = 100_000) -> None:
    """Write the rows of ``interleave`` as Parquet, a folder for each shard, files of ``file_rows`` consecutive slots in order."""
    part = F.floor(F.col("slot") / file_rows)
    sharded.withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "part", "slot").drop("part") \
        .write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
