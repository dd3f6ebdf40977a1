"""Registered queries (Spark) and their independent SQL oracles (DuckDB).

Every query reads the whole test tables (through ``sources.testdata``) and returns a
DataFrame; nondeterministic audit columns (``_updated_at``, arrival time, file and
row lineage) are left out of the compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import dedup, gold
from ledgerline.operators.joins import staged_while
from ledgerline.plans import oracle as O
from ledgerline.plans import silver as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Columns of a Silver line that are compared (lineage and arrival time are not).
LINE_COLUMNS = ["order_id", "line_number", "order_timestamp", "customer_email", "product_sku",
                "quantity", "unit_price_usd", "total_amount_usd", "discount_amt_usd",
                "payment_method", "country_code", "promo_code", "loyalty_points", "source_vendor",
                "source_currency", "exchange_rate", "vat_amount_usd", "payment_status",
                "line_total_usd"]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _sql(body: str) -> str:
    return O.marked_cte() + body


_LINE_SQL = ", ".join(LINE_COLUMNS)

# --- Silver -----------------------------------------------------------------


@register("unified_silver", _sql(f"SELECT {_LINE_SQL} FROM lines"))
def q_unified(spark, sf):
    return S.test_unified(spark, sf).select(*LINE_COLUMNS)


@register("mark_duplicates", _sql(f"SELECT {_LINE_SQL}, _is_duplicate, _duplicate_reason FROM marked"))
def q_mark(spark, sf):
    return S.test_marked(spark, sf).select(*LINE_COLUMNS, "_is_duplicate", "_duplicate_reason")


@register("keep_best", _sql(f"SELECT {_LINE_SQL} FROM silver"))
def q_keep(spark, sf):
    return S.test_silver(spark, sf).select(*LINE_COLUMNS)


@register("duplicate_census", _sql("SELECT _is_duplicate, COUNT(*) AS row_count FROM marked GROUP BY 1"))
def q_census(spark, sf):
    return dedup.duplicate_census(S.test_marked(spark, sf))


# --- Gold -------------------------------------------------------------------


@register("daily_revenue_by_vendor", _sql(O.revenue_sql(["source_vendor", "order_date"])))
def q_rev_vendor(spark, sf):
    return gold.daily_revenue_by_vendor(S.test_silver(spark, sf), audit=False)


@register("daily_product_revenue", _sql(O.revenue_sql(["product_sku", "order_date"])))
def q_rev_product(spark, sf):
    return gold.daily_product_revenue(S.test_silver(spark, sf), audit=False)


@register("daily_revenue_by_country",
          _sql(O.revenue_sql(["country_code", "order_date"], duplicate_count=False)))
def q_rev_country(spark, sf):
    return gold.daily_revenue_by_country(S.test_silver(spark, sf), audit=False)


@register("customer_purchase_frequency", _sql(
    f"SELECT customer_email, COUNT(order_id) AS order_count, "
    f"{O.money_sum('total_amount_usd')} AS total_amount_usd, "
    f"{O.money_sum('discount_amt_usd')} AS total_discount_usd, "
    f"{O.money_ratio('SUM(total_amount_usd)', 'COUNT(order_id)')} AS avg_order_value_usd "
    f"FROM silver GROUP BY ALL"))
def q_customer(spark, sf):
    return gold.customer_purchase_frequency(S.test_silver(spark, sf), audit=False)


@register("top10_products", _sql(
    f"SELECT product_sku, {O.money_sum('total_amount_usd')} AS total_amount_usd, "
    f"{O.money_sum('discount_amt_usd')} AS total_discount_usd FROM silver GROUP BY ALL "
    f"ORDER BY total_amount_usd DESC NULLS LAST, product_sku ASC NULLS LAST LIMIT 10"))
def q_top10(spark, sf):
    return gold.top_products(S.test_silver(spark, sf), n=10, audit=False)


@register("promo_analysis", _sql(
    f"SELECT promo_code, COUNT(order_id) AS usage_count, "
    f"{O.money_sum('discount_amt_usd')} AS total_discount_given_usd, "
    f"{O.money_sum('total_amount_usd')} AS total_revenue_with_promo_usd, "
    f"{O.money_ratio('SUM(total_amount_usd)', 'COUNT(total_amount_usd)')} AS avg_order_value_usd, "
    f"SUM(loyalty_points) AS total_loyalty_points_awarded "
    f"FROM silver WHERE promo_code IS NOT NULL GROUP BY ALL"))
def q_promo(spark, sf):
    return gold.promo_analysis(S.test_silver(spark, sf), audit=False)


@register("duplicate_analysis_report", _sql(
    "SELECT source_vendor, COUNT(*) AS total_rows, "
    "COUNT(CASE WHEN _is_duplicate THEN 1 END) AS duplicate_count, "
    "CAST(COALESCE(SUM(CASE WHEN _is_duplicate THEN total_amount_usd END), 0) AS DECIMAL(18,2)) "
    "AS revenue_impact_usd FROM marked GROUP BY ALL"))
def q_dup_report(spark, sf):
    return gold.duplicate_report(S.test_marked(spark, sf), audit=False)


@register("accuracy_metrics", _sql(
    "SELECT total_rows, duplicate_rows, reported_revenue_usd, actual_revenue_usd, "
    f"{O.cents_to_money(O.half_up_div('duplicate_rows * 10000', 'total_rows'))} AS duplicate_rate_pct, "
    f"{O.cents_to_money(O.half_up_div('CAST((reported_revenue_usd - actual_revenue_usd) * 100 AS HUGEINT) * 10000', 'CAST(actual_revenue_usd * 100 AS HUGEINT)'))} AS revenue_inflation_pct "
    "FROM (SELECT COUNT(*) AS total_rows, COUNT(CASE WHEN _is_duplicate THEN 1 END) AS duplicate_rows, "
    "CAST(SUM(total_amount_usd) AS DECIMAL(18,2)) AS reported_revenue_usd, "
    "CAST(SUM(CASE WHEN NOT _is_duplicate THEN total_amount_usd END) AS DECIMAL(18,2)) AS actual_revenue_usd "
    "FROM marked) t"))
def q_accuracy(spark, sf):
    return gold.accuracy_metrics(S.test_marked(spark, sf))


@register("daily_revenue_order_grain",
          _sql(O.revenue_sql(["source_vendor", "order_date"], grain="order")))
def q_rev_order_grain(spark, sf):
    return gold.daily_revenue_by_vendor(S.test_silver(spark, sf), grain="order", audit=False)


@register("status_filtered_revenue", _sql(O.revenue_sql(
    ["source_vendor", "order_date"], where="WHERE lower(payment_status) IN ('settled', 'completed')")))
def q_rev_status(spark, sf):
    return gold.daily_revenue_by_vendor(S.test_silver(spark, sf), statuses=["settled", "completed"],
                                        audit=False)


# --- Sources: landing files written from the test tables, read back -----------

def _landing(spark, name: str) -> str:
    from ledgerline.session import scratch_path
    return scratch_path(spark, "landing", name)


def _land_a(spark, sf):
    from ledgerline.schemas import VENDOR_A_V1, VENDOR_A_V2
    from ledgerline.sources import files, testdata
    feed = testdata.vendor_a_feed(testdata.order_facts(spark, sf))
    root = _landing(spark, "vendor_a")
    files.write_vendor_files(feed.filter(~F.col("_layout_v2")), f"{root}/v1", VENDOR_A_V1 + ["payment_status"])
    files.write_vendor_files(feed.filter(F.col("_layout_v2")), f"{root}/v2", VENDOR_A_V2 + ["payment_status"])
    return root


def _vendor_lines_sql(vendor: str) -> str:
    return _sql(f"SELECT {_LINE_SQL} FROM lines WHERE source_vendor = '{vendor}'")


@register("csv_comma_scan", _vendor_lines_sql("vendor_a"))
def q_csv_comma(spark, sf):
    """Vendor A: two header layouts in one folder, read per layout, normalised."""
    from ledgerline.operators import normalize
    from ledgerline.sources import files
    root = _land_a(spark, sf)
    return normalize.vendor_a(files.read_vendor_a(spark, f"{root}/*/*.csv")).select(*LINE_COLUMNS)


@register("csv_pipe_scan", _vendor_lines_sql("vendor_b"))
def q_csv_pipe(spark, sf):
    from ledgerline.operators import normalize
    from ledgerline.schemas import VENDOR_B_COLUMNS
    from ledgerline.sources import files, testdata
    feed = testdata.vendor_b_feed(testdata.order_facts(spark, sf))
    root = files.write_vendor_files(feed, _landing(spark, "vendor_b"), VENDOR_B_COLUMNS + ["payment_status"],
                                    sep="|")
    return normalize.vendor_b(files.read_vendor_b(spark, f"{root}/*.csv")).select(*LINE_COLUMNS)


@register("tsv_json_scan", _vendor_lines_sql("vendor_c"))
def q_tsv_json(spark, sf):
    from ledgerline.operators import normalize
    from ledgerline.schemas import VENDOR_C_COLUMNS
    from ledgerline.sources import files, testdata
    feed = testdata.vendor_c_feed(testdata.order_facts(spark, sf))
    root = files.write_vendor_files(feed, _landing(spark, "vendor_c"), VENDOR_C_COLUMNS,
                                    sep="\t", quote='"', escape='"')
    return normalize.vendor_c(files.read_vendor_c(spark, f"{root}/*.csv")).select(*LINE_COLUMNS)


@register("schema_drift_union", _sql(
    "SELECT order_id, customer_email, promo_code, loyalty_points, "
    "CASE WHEN promo_code IS NOT NULL THEN 'v2' ELSE 'v1' END AS layout "
    "FROM lines WHERE source_vendor = 'vendor_a'"))
def q_drift(spark, sf):
    """Old and new vendor A layouts under one glob: every value lands in its own column."""
    from ledgerline.sources import files
    root = _land_a(spark, sf)
    raw = files.read_vendor_a(spark, f"{root}/*/*.csv")
    return raw.select(
        "order_id",
        F.coalesce("email", "customer_email").alias("customer_email"),
        "promo_code",
        F.col("loyalty_points").try_cast("int").alias("loyalty_points"),
        F.when(F.col("email").isNotNull(), F.lit("v2")).otherwise(F.lit("v1")).alias("layout"))


@register("ingest_anti_join", _vendor_lines_sql("vendor_b"))
def q_ingest(spark, sf):
    """Three ingest runs over a growing landing folder: the second appends only the new files
    (a layout with moved columns and odd header names), the third nothing."""
    from ledgerline.operators import normalize
    from ledgerline.plans import tables
    from ledgerline.schemas import VENDOR_B_COLUMNS
    from ledgerline.sources import files, testdata
    feed = testdata.vendor_b_feed(testdata.order_facts(spark, sf))
    land, bronze = _landing(spark, "vendor_b_batches"), _landing(spark, "bronze_b")
    cols = VENDOR_B_COLUMNS + ["payment_status"]
    early = F.coalesce(F.col("_ingestion_timestamp") < F.lit("1998-01-01").cast("timestamp"), F.lit(True))
    files.write_vendor_files(feed.filter(early), f"{land}/batch=1", cols, sep="|")
    files.ingest(spark, land, "vendor_b", bronze)
    odd = feed.filter(~early).withColumnsRenamed({"order_id": "Order_ID", "vat_amount": " VAT_Amount"})
    files.write_vendor_files(odd, f"{land}/batch=2", [" VAT_Amount", *[c for c in cols[:0:-1] if c != "vat_amount"], "Order_ID"], sep="|")
    files.ingest(spark, land, "vendor_b", bronze)
    files.ingest(spark, land, "vendor_b", bronze)
    return normalize.vendor_b(tables.read_appended(spark, bronze)).select(*LINE_COLUMNS)


@register("ingest_manifest", _sql(
    "SELECT 1 AS run, count(*) AS rows, FALSE AS changed FROM facts WHERE vendor = 'vendor_a' AND coalesce(arrived < TIMESTAMP '1998-01-01', TRUE) "
    "UNION ALL SELECT 2, count(*), FALSE FROM facts WHERE vendor = 'vendor_a' AND arrived >= TIMESTAMP '1998-01-01' UNION ALL SELECT 3, 0, FALSE"))
def q_manifest(spark, sf):
    """Rows that three ingest runs over a growing landing folder append, known from the manifest alone."""
    from ledgerline.schemas import VENDOR_A_V2
    from ledgerline.sources import files, testdata
    feed = testdata.vendor_a_feed(testdata.order_facts(spark, sf))
    land, bronze = _landing(spark, "vendor_a_runs"), _landing(spark, "bronze_a_runs")
    early = F.coalesce(F.col("_ingestion_timestamp") < F.lit("1998-01-01").cast("timestamp"), F.lit(True))
    runs = []
    for k, part in enumerate((feed.filter(early), feed.filter(~early), None), start=1):
        if part is not None:
            files.write_vendor_files(part, f"{land}/batch={k}", VENDOR_A_V2 + ["payment_status"])
        got = files.ingest(spark, land, "vendor_a", bronze)
        runs.append((k, int(got), got.changed > 0))
    return spark.createDataFrame(runs, "run int, rows long, changed boolean")


@register("bronze_schema_evolution", _sql(
    "SELECT order_id, customer_email, promo_code, loyalty_points, "
    "CASE WHEN promo_code IS NOT NULL THEN 2 ELSE 1 END AS batch FROM lines WHERE source_vendor = 'vendor_a'"))
def q_evolution(spark, sf):
    """The old layout appended to Bronze, then the new one (a renamed column and three more): a read has
    every column of both, NULL where a batch had none."""
    from ledgerline.plans import tables
    from ledgerline.schemas import VENDOR_A_V1, VENDOR_A_V2
    from ledgerline.sources import testdata
    feed = testdata.vendor_a_feed(testdata.order_facts(spark, sf))
    bronze = _landing(spark, "bronze_a")
    tables.append(feed.filter(~F.col("_layout_v2")).select(*VENDOR_A_V1), bronze, 1)
    tables.append(feed.limit(0).select(*VENDOR_A_V2), bronze, "empty")
    tables.append(feed.filter(F.col("_layout_v2")).select(*VENDOR_A_V2), bronze, 2)
    return tables.read_appended(spark, bronze).select(
        "order_id", F.coalesce("email", "customer_email").alias("customer_email"), "promo_code",
        F.col("loyalty_points").try_cast("int").alias("loyalty_points"), F.col("_batch").cast("int").alias("batch"))


@register("money_notations", O.marked_cte() +
          "SELECT vendor AS source_vendor, CAST(partkey % 4 AS INTEGER) AS notation, COUNT(*) AS lines, "
          "CAST(SUM(CAST(amount_c AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,2)) AS amount "
          "FROM facts WHERE vendor <> 'vendor_c' GROUP BY ALL")
def q_money(spark, sf):
    """Amounts as the vendors write them (four notations each), parsed to exact decimals."""
    from ledgerline.functions.columns import with_money
    from ledgerline.sources import testdata
    facts = testdata.order_facts(spark, sf)
    out = None
    for feed, notation in ((testdata.vendor_a_feed, "dot"), (testdata.vendor_b_feed, "comma")):
        raw = feed(facts.withColumn("method", (F.col("partkey") % 4).cast("string")))
        part = with_money(raw.select("_source_vendor", "payment_method", "total_amount"), {"amount": "total_amount"}, notation)
        out = part if out is None else out.unionByName(part)
    return (out.groupBy(F.col("_source_vendor").alias("source_vendor"), F.col("payment_method").cast("int").alias("notation"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").cast("decimal(18,2)").alias("amount")))


# --- MERGE (upsert) ----------------------------------------------------------

_EARLY_TS = "1998-01-01"


def _early_silver(spark, sf):
    lines = S.test_unified(spark, sf)
    return dedup.keep_best(lines.filter(F.col("_ingestion_timestamp") < F.lit(_EARLY_TS).cast("timestamp")))


_REV_COLS = ["source_vendor", "order_date", "total_amount_usd", "order_count", "total_discount_usd",
             "avg_order_value_usd", "duplicate_count"]
_REV_KEYS = ["source_vendor", "order_date"]
_SUBSET = ["total_amount_usd", "order_count", "total_discount_usd"]


@register("merge_update_subset", _sql(O.upsert_sql(
    O.revenue_sql(_REV_KEYS, source="silver_early"), O.revenue_sql(_REV_KEYS), _REV_KEYS, _REV_COLS, _SUBSET)))
def q_merge_subset(spark, sf):
    """Gold built from early arrivals, then merged with a full rebuild, updating 3 measures."""
    from ledgerline.operators import merge
    target = gold.daily_revenue_by_vendor(_early_silver(spark, sf), audit=False)
    source = gold.daily_revenue_by_vendor(S.test_silver(spark, sf), audit=False)
    return merge.upsert(target, source, _REV_KEYS, update_cols=_SUBSET)


@register("merge_update_all", _sql(O.upsert_sql(
    O.revenue_sql(_REV_KEYS, source="silver_early"), O.revenue_sql(_REV_KEYS), _REV_KEYS, _REV_COLS)))
def q_merge_all(spark, sf):
    from ledgerline.operators import merge
    target = gold.daily_revenue_by_vendor(_early_silver(spark, sf), audit=False)
    source = gold.daily_revenue_by_vendor(S.test_silver(spark, sf), audit=False)
    return merge.upsert(target, source, _REV_KEYS)


_NULL_EMAIL = "CASE WHEN payment_method = 'paypal' THEN NULL ELSE customer_email END"
_CUST_COLS = ["customer_email", "order_count", "total_amount_usd", "total_discount_usd", "avg_order_value_usd"]


@register("merge_null_keys", _sql(O.upsert_sql(
    O.customer_sql(f"(SELECT * REPLACE ({_NULL_EMAIL} AS customer_email) FROM silver_early)"),
    O.customer_sql(f"(SELECT * REPLACE ({_NULL_EMAIL} AS customer_email) FROM silver)"),
    ["customer_email"], _CUST_COLS)))
def q_merge_null(spark, sf):
    """NULL business keys match NULL-safely: the merged table has one NULL-email row."""
    from ledgerline.operators import merge

    def anon(df):
        return df.withColumn("customer_email", F.when(F.col("payment_method") == "paypal", F.lit(None))
                             .otherwise(F.col("customer_email")))
    target = gold.customer_purchase_frequency(anon(_early_silver(spark, sf)), audit=False)
    source = gold.customer_purchase_frequency(anon(S.test_silver(spark, sf)), audit=False)
    return merge.upsert(target, source, ["customer_email"])


# --- Incremental and streaming ------------------------------------------------
#
# One path: batches are appended to Silver together with the deltas of all Gold tables.

_WAVES = ["1997-01-01", "1999-01-01"]


def _in_waves(lines) -> list:
    """Three consecutive arrival windows; lines without an arrival time come first."""
    ts = F.col("_ingestion_timestamp")
    cuts = [F.lit(w).cast("timestamp") for w in _WAVES]
    return [lines.filter(ts.isNull() | (ts < cuts[0])), lines.filter((ts >= cuts[0]) & (ts < cuts[1])), lines.filter(ts >= cuts[1])]


_MAINTAINED: dict[tuple[str, str], str] = {}


def _maintained(spark, sf) -> str:
    """Gold logs after three batches of arrivals, some of them folded after the second, and every batch appended
    once more at the end (earlier ones too).  One such lake per session and folder serves all its tables."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming import delta
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MAINTAINED:
        root = scratch_path(spark, "maintained")
        with S.lines_while(spark, sf) as lines:
            batches = _in_waves(lines)
            for i in (1, 2, 3, 2, 1, 3):
                fresh = delta.append_batch(root, batches[i - 1], delta.batch_name("all", i))
                if fresh and i == 2:
                    for log in ("vendor_day", "country_day"):
                        delta.fold(spark, root, log)
        _MAINTAINED[key] = root
    return _MAINTAINED[key]


@register("incremental_gold", _sql(O.revenue_sql(["source_vendor", "order_date"])))
def q_incremental(spark, sf):
    """Scheduled runs over growing data: each takes the landed batches that the control table does not
    list yet, appends them with their deltas, and only then lists them.  A run that finds nothing new is
    a no-op; the final Gold equals a full rebuild."""
    from ledgerline.plans import tables
    from ledgerline.session import scratch_path
    from ledgerline.streaming import delta, watermark
    root = scratch_path(spark, "incremental")
    for i, wave in enumerate(_in_waves(S.staged_lines(spark, sf)), start=1):
        tables.append(wave, f"{root}/arrivals", delta.batch_name("all", i))
    logs = {"vendor_day": delta.LOGS["vendor_day"]}
    for upto in (delta.batch_name("all", 1), delta.batch_name("all", 2), delta.batch_name("all", 2), None):
        for batch in watermark.pending(spark, f"{root}/arrivals", f"{root}/control", "gold", upto):
            lines = tables.read_appended(spark, f"{root}/arrivals", only=[batch])
            if lines is not None:
                delta.append_batch(f"{root}/lake", lines.drop(tables.BATCH_COL), batch, logs)
            watermark.advance(spark, f"{root}/control", "gold", [batch])
    return delta.present(delta.state(spark, f"{root}/lake", "vendor_day"), logs["vendor_day"].dims)


def _from_logs(table: str):
    def run(spark, sf):
        """A Gold table from the deltas of the batches; equals the full rebuild."""
        from ledgerline.streaming import delta
        return delta.gold_tables(spark, _maintained(spark, sf))[table]
    return run


for _name, _table, _body in (
        ("incremental_append_only", "daily_revenue_by_vendor", O.revenue_sql(["source_vendor", "order_date"])),
        ("incremental_gold_delta", "daily_product_revenue", O.revenue_sql(["product_sku", "order_date"])),
        ("incremental_country_delta", "daily_revenue_by_country",
         O.revenue_sql(["country_code", "order_date"], duplicate_count=False)),
        ("incremental_customer_delta", "customer_purchase_frequency", O.customer_sql())):
    register(_name, _sql(_body))(_from_logs(_table))
for _name, _table, _like in (("incremental_gold_delta_log", "daily_revenue_by_vendor", "daily_revenue_by_vendor"),
                             ("top10_from_delta_state", "product_by_revenue", "top10_products"),
                             ("promo_from_delta_log", "promo_analysis", "promo_analysis"),
                             ("duplicates_from_delta_log", "duplicate_analysis_report", "duplicate_analysis_report")):
    register(_name, ORACLE[_like])(_from_logs(_table))


_WAVE_SQL = ("CASE WHEN _ingestion_timestamp < TIMESTAMP '1997-01-01 00:00:00' THEN TIMESTAMP '2000-01-01 00:00:00' "
             "WHEN _ingestion_timestamp < TIMESTAMP '1999-01-01 00:00:00' THEN TIMESTAMP '2000-01-02 00:00:00' "
             "ELSE TIMESTAMP '2000-01-03 00:00:00' END")


def _streamed(spark, sf, name: str, vendors: tuple[str, ...]) -> str:
    """Landing files of ``vendors`` delivered in three waves; after each delivery every vendor's availableNow
    stream appends to one Silver and to the logs of all Gold tables.  A last round finds nothing new, and the
    first epoch of the first vendor is then replayed.  Copies delivered later win ties (ingestion time =
    processing time)."""
    from ledgerline.schemas import VENDOR_A_V1, VENDOR_A_V2, VENDOR_B_COLUMNS, VENDOR_C_COLUMNS
    from ledgerline.session import scratch_path
    from ledgerline.sources import files, testdata
    from ledgerline.streaming import stream
    root = scratch_path(spark, name)
    facts = testdata.order_facts(spark, sf)
    feeds = {"vendor_a": testdata.vendor_a_feed(facts), "vendor_b": testdata.vendor_b_feed(facts), "vendor_c": testdata.vendor_c_feed(facts)}

    def deliver(vendor, i, wave):
        land = f"{root}/landing/{vendor}/wave={i}"
        if vendor == "vendor_a":
            files.write_vendor_files(wave.filter(~F.col("_layout_v2")), f"{land}/v1", VENDOR_A_V1 + ["payment_status"])
            files.write_vendor_files(wave.filter(F.col("_layout_v2")), f"{land}/v2", VENDOR_A_V2 + ["payment_status"])
        elif vendor == "vendor_b":
            files.write_vendor_files(wave, f"{land}/v1", VENDOR_B_COLUMNS + ["payment_status"], sep="|")
        else:
            # the second delivery has its columns the other way round
            columns = VENDOR_C_COLUMNS[::-1] if i == 1 else VENDOR_C_COLUMNS
            files.write_vendor_files(wave, f"{land}/v1", columns, sep="\t", quote='"', escape='"')

    waves = {v: _in_waves(feeds[v]) for v in vendors}
    for i in range(4):
        for v in vendors:
            if i < 3:
                deliver(v, i, waves[v][i])
            land = f"{root}/landing/{v}/*/*/"
            stream.run_available(stream.files_stream(spark, land, max_files=100000), stream.make_batch_handler(f"{root}/lake", v), f"{root}/checkpoint/{v}")
    first = files.list_files(spark, f"{root}/landing/{vendors[0]}/wave=0/*/").select(F.col("path").alias("_source_file"))
    stream.make_batch_handler(f"{root}/lake", vendors[0])(first, 0)
    return f"{root}/lake"


def _stream_sql(vendors: tuple[str, ...], body) -> str:
    names = ", ".join(f"'{v}'" for v in vendors)
    return (O.marked_cte() + ", lines_s AS (SELECT * REPLACE (" + _WAVE_SQL +
            f" AS _ingestion_timestamp) FROM lines WHERE source_vendor IN ({names})), " +
            O.silver_ctes("marked_s", "silver_s", src="lines_s") + " " + body)


@register("stream_ingest_gold", _stream_sql(("vendor_c",), O.revenue_sql(
    ["country_code", "order_date"], duplicate_count=False, source="silver_s")))
def q_stream(spark, sf):
    """Vendor C TSV files with JSON columns through the stream into daily revenue by country."""
    from ledgerline.streaming import delta
    return delta.gold_tables(spark, _streamed(spark, sf, "stream_c", ("vendor_c",)))["daily_revenue_by_country"]


@register("stream_ingest_vendor_a", _stream_sql(("vendor_a",), O.revenue_sql(["source_vendor", "order_date"], source="silver_s")))
def q_stream_a(spark, sf):
    """Vendor A CSV files of both header layouts through the stream into daily revenue by vendor."""
    from ledgerline.streaming import delta
    return delta.gold_tables(spark, _streamed(spark, sf, "stream_a", ("vendor_a",)))["daily_revenue_by_vendor"]


@register("stream_all_vendors", _stream_sql(("vendor_a", "vendor_b", "vendor_c"), O.revenue_sql(
    ["source_vendor", "order_date"], source="silver_s")))
def q_stream_all(spark, sf):
    """Three vendor streams into one Silver and its Gold tables: late settled copies demote published winners,
    lines without an order id only add, and a replayed earlier epoch changes nothing."""
    from ledgerline.streaming import delta
    root = _streamed(spark, sf, "stream_all", ("vendor_a", "vendor_b", "vendor_c"))
    return delta.gold_tables(spark, root)["daily_revenue_by_vendor"]


# --- Maintenance, quality, lookups, inspection -------------------------------


def _published_silver(spark, sf, name: str, **kw) -> tuple[str, "DataFrame"]:
    from ledgerline.plans import tables
    from ledgerline.session import scratch_path
    root = scratch_path(spark, name)
    files = kw.pop("files", None)
    with S.lines_while(spark, sf) as lines, dedup.marked_while(lines, parts=files) as marked:
        tables.publish(marked, root, **kw)
    return root, tables.read(spark, root)


@register("table_health", _sql("SELECT CAST(16 AS BIGINT) AS num_files, COUNT(*) AS rows, 'ok' AS file_count_verdict FROM marked"))
def q_health(spark, sf):
    """File count and verdict of Silver published as 16 files, from the listing, next to its rows."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    root, silver = _published_silver(spark, sf, "health", files=16)
    health = maintenance.table_health(spark, tables.version_path(root, tables.latest_version(spark, root))).first()
    return silver.agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {c: F.lit(health[c]) for c in ("num_files", "file_count_verdict")})


@register("compact_report", _sql(
    "SELECT CAST(64 AS BIGINT) AS files_before, CAST(1 AS BIGINT) AS files_after, COUNT(*) AS rows, "
    "COUNT(CASE WHEN _is_duplicate THEN 1 END) AS duplicates FROM marked"))
def q_compact(spark, sf):
    """Silver published as many small files, then compacted into right-sized files: the report and the rows."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    root, _ = _published_silver(spark, sf, "compact", files=64)
    report = maintenance.compact(spark, root, target_bytes=1 << 40).first()
    rows = tables.read(spark, root).agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_is_duplicate"), 1)).alias("duplicates"))
    return rows.withColumns({c: F.lit(report[c]) for c in ("files_before", "files_after")})


@register("partitioned_compaction", _sql(
    "SELECT 'source_vendor' AS partitions, source_vendor, COUNT(*) AS lines FROM marked GROUP BY source_vendor"))
def q_compact_partitioned(spark, sf):
    """A table partitioned by vendor, compacted without naming the partition columns again: it stays partitioned."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    root, _ = _published_silver(spark, sf, "compact_parts", partition_by=["source_vendor"], rebalance=False)
    maintenance.compact(spark, root, zorder_by=["order_timestamp", "country_code"])
    parts = ",".join(tables.partition_columns(spark, tables.version_path(root, tables.latest_version(spark, root))))
    return (tables.read(spark, root).groupBy("source_vendor").agg(F.count(F.lit(1)).alias("lines"))
            .withColumn("partitions", F.lit(parts)))


@register("zorder_cluster", _sql(
    "SELECT country_code, CAST(32 AS BIGINT) AS files_before, TRUE AS fewer_after, COUNT(*) AS lines FROM marked "
    "WHERE country_code IN ('NATION_3', 'NATION_12', 'US') GROUP BY country_code"))
def q_zorder(spark, sf):
    """Files that a filter on one country has to open, before and after Z-order compaction on
    (order_timestamp, country_code, source_vendor); no row is lost."""
    from ledgerline.operators import maintenance
    from ledgerline.plans import tables
    root, silver = _published_silver(spark, sf, "zorder", files=32)
    size = maintenance.table_health(spark, tables.version_path(root, 1)).first()["size_bytes"]
    maintenance.compact(spark, root, target_bytes=max(1, size // 32), zorder_by=["order_timestamp", "country_code", "source_vendor"])
    countries = ("NATION_3", "NATION_12", "US")
    before, after = (maintenance.files_holding(spark, root, "country_code", countries, v) for v in (1, 2))
    rows = [(c, b, a < b) for c, b, a in zip(countries, before, after)]
    touched = spark.createDataFrame(rows, "country_code string, files_before long, fewer_after boolean")
    return tables.read(spark, root).groupBy("country_code").agg(F.count(F.lit(1)).alias("lines")).join(touched, "country_code")


@register("line_quality", _sql(
    "SELECT source_vendor, COUNT(*) AS lines, "
    "COUNT(CASE WHEN order_timestamp IS NULL THEN 1 END) AS null_order_timestamp, "
    "COUNT(CASE WHEN total_amount_usd IS NULL THEN 1 END) AS null_total_amount, "
    "COUNT(CASE WHEN product_sku IS NULL THEN 1 END) AS null_product_sku, "
    "COUNT(CASE WHEN customer_email IS NULL THEN 1 END) AS null_customer_email, "
    "COUNT(CASE WHEN source_currency IS NULL OR upper(source_currency) NOT IN ('USD','EUR','JPY','KRW') "
    "THEN 1 END) AS unknown_currency, "
    "COUNT(CASE WHEN total_amount_usd < 0 THEN 1 END) AS negative_amount FROM lines GROUP BY ALL"))
def q_quality(spark, sf):
    from ledgerline.operators import quality
    return quality.line_quality(S.test_unified(spark, sf))


@register("json_parse_failures", _sql(
    "SELECT COUNT(*) AS rows, COUNT(CASE WHEN partkey % 11 = 0 THEN 1 END) AS unparsed_line_items "
    "FROM facts WHERE vendor = 'vendor_c'"))
def q_json_fail(spark, sf):
    from ledgerline.operators import quality
    from ledgerline.sources import testdata
    return quality.json_parse_failures(testdata.vendor_c_feed(testdata.order_facts(spark, sf)))


@register("sku_lookup_join", _vendor_lines_sql("vendor_b"))
def q_sku_lookup(spark, sf):
    """Vendor B sends short product codes; the canonical SKU comes from the product
    master (``part``) through a lookup join: broadcast only if its size is checked
    small, otherwise a shuffle join; unmapped codes pass through."""
    from ledgerline.operators import normalize
    from ledgerline.sources import testdata
    feed = (testdata.vendor_b_feed(testdata.order_facts(spark, sf))
            .withColumn("product_code", F.regexp_replace("product_code", "^SKU-", "P")))
    part = testdata.table(spark, sf, "part")
    sku_map = part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"),
                          F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"))
    lines = normalize.vendor_b(feed, sku_map={})
    return normalize.map_sku(lines, sku_map, raw_col="product_sku").select(*LINE_COLUMNS)


@register("dedup_order_level", _sql(
    "SELECT " + _LINE_SQL + " FROM (SELECT *, row_number() OVER (PARTITION BY order_id, "
    "CASE WHEN order_id IS NULL THEN _rid * 10 + line_number END ORDER BY "
    "CASE payment_status WHEN 'settled' THEN 1 WHEN 'completed' THEN 2 ELSE 3 END ASC, "
    "_ingestion_timestamp DESC NULLS LAST, product_sku ASC NULLS FIRST, quantity ASC NULLS FIRST, "
    "total_amount_usd ASC NULLS FIRST, _source_file ASC NULLS FIRST) AS rn FROM lines) WHERE rn = 1"))
def q_dedup_order(spark, sf):
    """Documented variant: one row per order id, settled > completed > anything else,
    then the most recent update (arrival)."""
    from ledgerline.functions.columns import status_priority
    lines = S.test_unified(spark, sf)
    order = [(status_priority("payment_status", default=3), "asc"), ("_ingestion_timestamp", "desc"),
             ("product_sku", "asc"), ("quantity", "asc"), ("total_amount_usd", "asc"),
             ("_source_file", "asc"), ("_source_row", "asc")]
    return dedup.keep_best(lines, keys=["order_id"], order=order).select(*LINE_COLUMNS)


@register("bronze_preview", _sql(
    "SELECT order_id, CASE WHEN promo THEN customer END AS email, CASE WHEN promo THEN NULL ELSE customer END AS customer_email, "
    "CAST(qty AS VARCHAR) AS quantity FROM f2 WHERE vendor = 'vendor_a' AND order_id IS NOT NULL "
    "ORDER BY order_id, amount_c, qty, customer, l_returnflag LIMIT 10"))
def q_preview(spark, sf):
    """``SELECT ... ORDER BY ... LIMIT 10`` inspection of a Bronze feed (the limit is the feature)."""
    from ledgerline.operators.inspect import preview
    from ledgerline.sources import testdata
    facts = testdata.order_facts(spark, sf)
    feed = testdata.vendor_a_feed(facts.filter("order_id IS NOT NULL").withColumn("method", F.col("amount").cast("string")))
    by = feed.withColumns({"_a": F.col("payment_method").cast("decimal(18,2)"), "_q": F.col("quantity").cast("int")})
    return preview(by, 10, ["order_id", "_a", "_q"]).select("order_id", "email", "customer_email", "quantity")


@register("silver_partitioned_by_date", _sql(O.revenue_sql(["source_vendor", "order_date"])))
def q_partitioned(spark, sf):
    """Silver published with a date-only partition layout, read back through partition
    discovery; Gold computed from it."""
    from ledgerline.plans import tables
    from ledgerline.session import scratch_path
    root = scratch_path(spark, "by_date")
    silver = dedup.keep_best(S.test_unified(spark, sf)).withColumn("order_date", F.to_date("order_timestamp"))
    tables.publish(silver, root, partition_by=["order_date"], files=8)
    return gold.daily_revenue_by_vendor(tables.read(spark, root).drop("order_date"), audit=False)


# --- Per-vendor normalisers, FX and payment mapping, Gold create-or-merge --------


def _feed_lines(spark, sf, vendor: str):
    from ledgerline.operators import normalize
    from ledgerline.sources import testdata
    facts = testdata.order_facts(spark, sf)
    if vendor == "vendor_a":
        return normalize.vendor_a(testdata.vendor_a_feed(facts))
    if vendor == "vendor_b":
        return normalize.vendor_b(testdata.vendor_b_feed(facts))
    return normalize.vendor_c(testdata.vendor_c_feed(facts))


@register("normalize_vendor_a", _vendor_lines_sql("vendor_a"))
def q_norm_a(spark, sf):
    """US feed text (MM/dd/yyyy, USD, day-30 layout with promotions) -> canonical lines."""
    return _feed_lines(spark, sf, "vendor_a").select(*LINE_COLUMNS)


@register("normalize_vendor_b", _vendor_lines_sql("vendor_b"))
def q_norm_b(spark, sf):
    """EU feed text (dd-MM-yyyy, '€1.234,50' amounts, VAT) -> canonical USD lines."""
    return _feed_lines(spark, sf, "vendor_b").select(*LINE_COLUMNS)


@register("normalize_vendor_c", _vendor_lines_sql("vendor_c"))
def q_norm_c(spark, sf):
    """Asian feed (ISO timestamps, JSON customer / items / payment, JPY / KRW) -> canonical lines."""
    return _feed_lines(spark, sf, "vendor_c").select(*LINE_COLUMNS)


@register("fx_convert", _sql(
    "SELECT source_vendor, source_currency, exchange_rate, COUNT(*) AS lines, "
    "CAST(SUM(total_amount_usd) AS DECIMAL(18,2)) AS total_amount_usd, "
    "CAST(SUM(unit_price_usd) AS DECIMAL(18,2)) AS unit_price_usd, "
    "CAST(SUM(vat_amount_usd) AS DECIMAL(18,2)) AS vat_amount_usd FROM lines GROUP BY ALL"))
def q_fx(spark, sf):
    """USD conversion per vendor and currency (USD 1, EUR 0.92, JPY 150, KRW 1320)."""
    return (S.test_unified(spark, sf)
            .groupBy("source_vendor", "source_currency", "exchange_rate")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum("total_amount_usd").cast("decimal(18,2)").alias("total_amount_usd"),
                 F.sum("unit_price_usd").cast("decimal(18,2)").alias("unit_price_usd"),
                 F.sum("vat_amount_usd").cast("decimal(18,2)").alias("vat_amount_usd")))


@register("payment_map", _sql(
    "SELECT source_vendor, payment_method, COUNT(*) AS lines FROM lines GROUP BY ALL"))
def q_payment(spark, sf):
    """Payment methods after clean-up (google_pay/apple_pay -> mobile_wallet, carte_bancaire -> bank_card)."""
    return S.test_unified(spark, sf).groupBy("source_vendor", "payment_method").agg(
        F.count(F.lit(1)).alias("lines"))


def _gold_refreshed(table: str):
    def run(spark, sf):
        """The Gold refresh job run twice: the first run creates every Gold table from the early Silver, the
        second publishes a full rebuild of it; no key of the first run stays that the data no longer has."""
        from ledgerline.plans import tables
        return tables.read(spark, f"{_refreshed(spark, sf)}/{table}").drop("_updated_at")
    return run


_REFRESHED: dict[tuple[str, str], str] = {}


def _refreshed(spark, sf) -> str:
    from ledgerline.plans import gold_jobs
    from ledgerline.session import scratch_path
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REFRESHED:
        root = scratch_path(spark, "gold")
        with S.lines_while(spark, sf) as lines:
            lines = lines.select(*[c for c in lines.columns if c in gold_jobs.NEEDED])
            early = lines.filter(F.col("_ingestion_timestamp") < F.lit(_EARLY_TS).cast("timestamp"))
            for part in (early, lines):
                with ExitStack() as held:
                    with dedup.marked_while(part) as rows:
                        marked = held.enter_context(staged_while(rows, "marked"))
                    gold_jobs.refresh_all(marked, root)
        _REFRESHED[key] = root
    return _REFRESHED[key]


for _name, _table, _like in (
        ("gold_create_or_merge", "daily_revenue_by_vendor", "daily_revenue_by_vendor"),
        ("gold_refresh_product", "daily_product_revenue", "daily_product_revenue"),
        ("gold_refresh_country", "daily_revenue_by_country", "daily_revenue_by_country"),
        ("gold_refresh_customer", "customer_purchase_frequency", "customer_purchase_frequency"),
        ("gold_refresh_top10", "product_by_revenue", "top10_products"),
        ("gold_refresh_promo", "promo_analysis", "promo_analysis"),
        ("gold_refresh_duplicates", "duplicate_analysis_report", "duplicate_analysis_report")):
    register(_name, ORACLE[_like])(_gold_refreshed(_table))


# --- Stored Gold, merged batch by batch -----------------------------------------

_MERGED: dict[tuple[str, str], str] = {}


def _merged(spark, sf) -> str:
    """Arrivals in two batches merged into stored Silver and Gold, then both once more."""
    from ledgerline.plans import gold_merge
    from ledgerline.session import scratch_path
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MERGED:
        root = scratch_path(spark, "merged")
        with S.lines_while(spark, sf) as lines:
            first, second, late = _in_waves(lines)
            batches = {"early": first.unionByName(second), "late": late}
            for name in ("early", "late", "early", "late"):
                gold_merge.merge_batch(spark, root, batches[name], name, hashed=8)
        _MERGED[key] = root
    return _MERGED[key]


def _gold_merged(table: str):
    def run(spark, sf):
        """A stored Gold table after merges that rewrote only the partitions each batch touched; equals a rebuild."""
        from ledgerline.plans import gold_merge
        out = gold_merge.table(spark, _merged(spark, sf), table)
        return out.drop("_updated_at")
    return run


for _name, _table, _like in (
        ("gold_merge_vendor_day", "daily_revenue_by_vendor", "daily_revenue_by_vendor"),
        ("gold_merge_product_day", "daily_product_revenue", "daily_product_revenue"),
        ("gold_merge_country_day", "daily_revenue_by_country", "daily_revenue_by_country"),
        ("gold_merge_customer", "customer_purchase_frequency", "customer_purchase_frequency"),
        ("gold_merge_top10", "product_by_revenue", "top10_products"),
        ("gold_merge_promo", "promo_analysis", "promo_analysis")):
    register(_name, ORACLE[_like])(_gold_merged(_table))


from ledgerline.plans import registry_layout  # noqa: E402,F401  (registers its queries here)
