"""Bronze -> Silver wiring."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import dedup, normalize
from ledgerline.operators.joins import staged, staged_while
from ledgerline.plans import tables
from ledgerline.sources import testdata


def land_bronze(frames: dict[str, DataFrame], root: str, parallel: int = 3,
                files: int | None = None) -> dict[str, int]:
    """Publish each vendor's Bronze frame as its own snapshot table ``<root>/<vendor>``.

    The landings are independent jobs, submitted concurrently from the driver.
    ``files`` (optional) writes each table as that many equal-sized files, so the
    Silver job that reads it gets balanced tasks.
    """
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {v: pool.submit(tables.publish, df, f"{root.rstrip('/')}/{v}", note=v, files=files)
                   for v, df in frames.items()}
        return {v: f.result() for v, f in futures.items()}


def unified(bronze_a: DataFrame, bronze_b: DataFrame, bronze_c: DataFrame) -> DataFrame:
    """Normalise the three vendor Bronze frames and UNION ALL them (no dedup yet)."""
    return normalize.unify(normalize.vendor_a(bronze_a), normalize.vendor_b(bronze_b),
                           normalize.vendor_c(bronze_c))


def marked(bronze_a: DataFrame, bronze_b: DataFrame, bronze_c: DataFrame) -> DataFrame:
    """Every Silver line with ``_is_duplicate`` / ``_duplicate_reason`` (audit table)."""
    return dedup.mark_duplicates(unified(bronze_a, bronze_b, bronze_c))


def publish_silver(bronze_a: DataFrame, bronze_b: DataFrame, bronze_c: DataFrame, root: str,
                   **publish_kw) -> dict:
    """Build and publish the marked Silver table; the row count and duplicate census
    come from the write job itself (observed metrics), not from extra passes."""
    from ledgerline.operators.inspect import observed
    df, obs = observed(marked(bronze_a, bronze_b, bronze_c), "silver")
    version = tables.publish(df, root, note="silver_marked", **publish_kw)
    metrics = obs.get
    return {"version": version, "rows": metrics.get("rows"), "duplicates": metrics.get("duplicates")}


def silver(bronze_a: DataFrame, bronze_b: DataFrame, bronze_c: DataFrame) -> DataFrame:
    """One winning line per (order_id, line_number)."""
    return dedup.keep_best(unified(bronze_a, bronze_b, bronze_c))


def test_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified(*testdata.vendor_feeds(spark, sf_dir))


_STAGED: dict[tuple[str, str], DataFrame] = {}


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified lines, stored once per session and folder for jobs that use them several times."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        with testdata.facts_while(spark, sf_dir) as facts:
            _STAGED[key] = staged(unified(*testdata.vendor_feeds(spark, sf_dir, facts)), "lines")
    return _STAGED[key]


@contextmanager
def lines_while(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The unified lines for the jobs of the block: those staged in this session, or else staged for it and removed after."""
    held = _STAGED.get((spark.sparkContext.applicationId, sf_dir))
    if held is not None:
        yield held
        return
    with ExitStack() as lines, testdata.facts_while(spark, sf_dir) as facts:
        out = lines.enter_context(staged_while(unified(*testdata.vendor_feeds(spark, sf_dir, facts)), "lines"))
        kept = lines.pop_all()
    with kept:
        yield out


def test_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark_duplicates(staged_lines(spark, sf_dir), stage=False)


def test_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_best(test_unified(spark, sf_dir))
