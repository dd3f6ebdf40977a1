"""The README walk-through on real landing files derived from the sf0.001 tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold, maintenance
from ledgerline.plans import gold_jobs, silver, tables
from ledgerline.schemas import VENDOR_A_V1, VENDOR_A_V2, VENDOR_B_COLUMNS, VENDOR_C_COLUMNS
from ledgerline.sources import files, testdata

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_landing_to_gold_and_maintenance(spark, tmp_dir):
    land, root = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    facts = testdata.order_facts(spark, SF)
    fa = testdata.vendor_a_feed(facts)
    files.write_vendor_files(fa.filter(~F.col("_layout_v2")), f"{land}/vendor_a/v1", VENDOR_A_V1)
    files.write_vendor_files(fa.filter(F.col("_layout_v2")), f"{land}/vendor_a/v2", VENDOR_A_V2)
    files.write_vendor_files(testdata.vendor_b_feed(facts), f"{land}/vendor_b", VENDOR_B_COLUMNS, sep="|")
    files.write_vendor_files(testdata.vendor_c_feed(facts), f"{land}/vendor_c", VENDOR_C_COLUMNS,
                             sep="\t", quote='"', escape='"')
    rows = {}
    for v in ("vendor_a", "vendor_b", "vendor_c"):
        rows[v] = files.ingest(spark, f"{land}/{v}", v, f"{root}/bronze/{v}")
        assert files.ingest(spark, f"{land}/{v}", v, f"{root}/bronze/{v}") == 0     # nothing new
    bronze = [tables.read_appended(spark, f"{root}/bronze/{v}") for v in rows]
    assert sum(rows.values()) == facts.count() == sum(b.count() for b in bronze)

    census = silver.publish_silver(*bronze, f"{root}/silver_marked")
    marked = tables.read(spark, f"{root}/silver_marked")
    lines = marked.count()
    assert census["rows"] == lines > 6000 and 0 < census["duplicates"] < lines
    versions = gold_jobs.refresh_all(marked, f"{root}/gold")
    assert set(versions.values()) == {1} and len(versions) == 7
    gold_jobs.refresh_all(marked, f"{root}/gold")           # second run: published anew
    g = tables.read(spark, f"{root}/gold/daily_revenue_by_vendor")
    assert g.count() == gold.daily_revenue_by_vendor(dedup.keep_best(marked), audit=False).count()
    assert tables.read(spark, f"{root}/gold/product_by_revenue").count() == 10

    report = maintenance.compact(spark, f"{root}/silver_marked", zorder_by=["source_vendor", "order_timestamp"])
    assert report.first()["version_after"] == 2
    assert tables.read(spark, f"{root}/silver_marked").count() == lines
    assert maintenance.vacuum(spark, f"{root}/silver_marked", retention_hours=0, dry_run=False) == [1]
    assert tables.read(spark, f"{root}/silver_marked").count() == lines   # live version untouched
