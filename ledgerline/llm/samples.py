"""Bounded, reproducible samples of labelled rows for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: characters of a labelled text that fitting takes at most, as windows from all over the text (scoring takes texts whole)
FIT_CHARS, FIT_WINDOWS = 200_000, 20
#: rows of all labels together that fitting takes at most, so that many labels have fewer rows each
FIT_ROWS = 20_000


def _order() -> Column:
    return F.xxhash64("doc_id")


def windowed(text: Column, seed: Column, chars: int | None = None, windows: int = FIT_WINDOWS) -> Column:
    """The text, or of one longer than ``chars`` that many characters: a window at a seeded place of each of ``windows`` equal parts."""
    chars = FIT_CHARS if chars is None else chars
    size = chars // windows
    part = F.floor(F.length(text) / windows)

    def cut(k: Column) -> Column:
        return F.substring(text, (k * part + F.pmod(F.xxhash64(seed, k), F.greatest(part - size, F.lit(1))) + 1).cast("int"), F.lit(size))
    drawn = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), cut), " ")
    return F.when(F.length(text) <= chars, text).otherwise(drawn)


def _thinned(rows: DataFrame, per_class: int) -> tuple[DataFrame, dict]:
    """Rows of each label cut by a hash of the id to about ``per_class`` (all rows of a smaller class), and
    the number of rows of each label before."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_class = min(per_class, max(1, FIT_ROWS // max(1, len(counts))))
    scale = 1 << 30
    bound = F.lit(scale)
    for label, n in counts.items():
        if n > per_class:
            # half as many again, since a hash does not cut evenly; the exact cut follows
            bound = F.when(F.col("label") == F.lit(label), F.lit(int(scale * min(1.0, 1.5 * per_class / n)))).otherwise(bound)
    return rows.where(F.pmod(_order(), F.lit(scale)) < bound), counts


def _cut(rows: list, per_class: int) -> list[tuple[str, object]]:
    rows.sort(key=lambda r: (r["o"], r["doc_id"], r["text"]))
    taken: dict = {}
    out = []
    for r in rows:
        if taken.get(r["label"], 0) < per_class:
            taken[r["label"]] = taken.get(r["label"], 0) + 1
            out.append((r["text"], r["label"]))
    return out


def by_column(docs: DataFrame, label: Column, allowed: Column, per_class: int) -> list[tuple[str, object]]:
    """At most ``per_class`` (text, label) of each label among the rows where ``allowed``; labels lie in ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), label.alias("label")) \
        .where(allowed & F.col("label").isNotNull() & F.col("text").isNotNull())
    rows = _thinned(rows.where("text <> ''"), per_class)[0].withColumn("text", windowed(F.col("text"), F.col("doc_id")))
    return _cut(rows.withColumn("o", _order()).collect(), per_class)


def by_labels(docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, per_class: int) -> tuple[list[tuple[str, int]], float | None]:
    """As ``by_column`` with 0/1 labels from a table of their own, and the share of label 1 among all allowed
    labels.  The label rows are cut first, so what is broadcast to fetch the texts is at most about
    1.5 x 2 x ``per_class`` ids."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .where(allowed & F.col("label").isin(0, 1)).dropDuplicates(["doc_id", "label"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), windowed(F.col("text"), F.col("doc_id")).alias("text")) \
        .where("text <> ''")
    few, counts = _thinned(rows, per_class)
    found = texts.join(F.broadcast(few), "doc_id")
    share = counts.get(1, 0) / sum(counts.values()) if counts else None
    return _cut(found.withColumn("o", _order()).collect(), per_class), share
