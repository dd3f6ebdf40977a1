"""Driver contract and a small-scale oracle comparison (sf0.001)."""

import os

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"source_vendor", "order_date", "total_amount_usd", "order_count"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30


@pytest.mark.parametrize("name", ["daily_revenue_by_vendor", "mark_duplicates", "customer_purchase_frequency",
                                  "top10_products", "promo_analysis", "merge_null_keys", "csv_comma_scan",
                                  "tsv_json_scan", "daily_revenue_order_grain", "dedup_order_level", "json_parse_failures",
                                  "line_quality", "money_notations", "ingest_anti_join", "bronze_schema_evolution",
                                  "incremental_country_delta", "duplicates_from_delta_log", "bronze_preview",
                                  "inferred_types", "bucketed_batch_lines", "observed_silver_write"])
def test_query_matches_oracle(spark, name):
    import duckdb

    from tools.oracle_check import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SMOKE)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    want = res.fetchall()
    wcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(wcols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(wcols, want)[0]


def test_the_feed_decides_the_rules(spark):
    """The rules that the feed is made to exercise do change results."""
    q = E.queries()
    assert set(map(tuple, q["daily_revenue_order_grain"](spark, SMOKE).collect())) != \
        set(map(tuple, q["daily_revenue_by_vendor"](spark, SMOKE).collect()))
    assert q["dedup_order_level"](spark, SMOKE).count() < q["keep_best"](spark, SMOKE).count()
    assert q["json_parse_failures"](spark, SMOKE).first()["unparsed_line_items"] > 0
    quality = q["line_quality"](spark, SMOKE).collect()
    for c in ("null_order_timestamp", "null_product_sku", "unknown_currency"):
        assert any(r[c] > 0 for r in quality), c


def test_works_without_the_training_data_part(tmp_path):
    """In a copy without the llm folder's modules and the pipeline (a leftover ``__pycache__`` stays), all other queries are there."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "ledgerline"), tmp_path / "ledgerline",
                    ignore=lambda d, names: [n for n in names if n == "__pycache__" or os.path.basename(d) == "llm"])
    (tmp_path / "ledgerline" / "llm" / "__pycache__").mkdir()
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as E, sys\n"
            "assert E.__file__.startswith(sys.argv[1]), E.__file__\n"
            "assert 'keep_best' in E.queries() and 'pipeline' not in E.queries()\n"
            "assert not any(n.startswith('op') for n in E.queries()), list(E.queries())\n")
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
