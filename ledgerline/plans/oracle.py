"""Independent SQL (DuckDB dialect) for every registered query.

The SQL recomputes the canonical Silver lines straight from the star-schema tables
- it never sees the vendor text formats - so a parsing or rounding slip on the Spark
side shows up as a mismatch.  DuckDB divides decimals in floating point, so every
rounded money value is computed on integer cents with explicit half-up rounding.
"""

from __future__ import annotations

# Fixed values of the contract, stated here on their own: a wrong constant in the code must show.
VENDOR_A, VENDOR_B, VENDOR_C = "vendor_a", "vendor_b", "vendor_c"
REGION_VENDOR = {"AMERICA": VENDOR_A, "ASIA": VENDOR_C}
RATE_100 = {"USD": 100, "EUR": 92, "JPY": 15000, "KRW": 132000}
STATUS_RANK = {"settled": 1, "completed": 2, "pending": 3}
OTHER_STATUS_RANK = 2
DUPLICATE_REASON = "Duplicate order - lower status priority or older timestamp"
PAYMENT_BY_SEGMENT = {
    VENDOR_A: {"AUTOMOBILE": "visa", "BUILDING": "mobile_wallet", "FURNITURE": "mobile_wallet",
               "HOUSEHOLD": "paypal", "MACHINERY": "mastercard"},
    VENDOR_B: {"AUTOMOBILE": "bank_card", "BUILDING": "visa", "FURNITURE": "paypal",
               "HOUSEHOLD": "bank_card", "MACHINERY": "sepa_debit"},
    VENDOR_C: {"AUTOMOBILE": "konbini", "BUILDING": "card", "FURNITURE": "card",
               "HOUSEHOLD": "konbini", "MACHINERY": "bank_transfer"},
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {expr} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def cents_to_money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def half_up_div(num: str, den: str) -> str:
    """round(num / den) half-up for num >= 0, den > 0 (integers)."""
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


def money_ratio(sum_expr: str, count_expr: str) -> str:
    """round(sum / count, 2) as DECIMAL(18,2), NULL for count 0 (sum >= 0)."""
    cents = f"CAST(({sum_expr}) * 100 AS HUGEINT)"
    return (f"CASE WHEN ({count_expr}) = 0 THEN NULL ELSE "
            f"{cents_to_money(half_up_div(cents, f'CAST(({count_expr}) AS HUGEINT)'))} END")


def _rate100(currency_expr: str) -> str:
    whens = " ".join(f"WHEN upper({currency_expr}) = {_q(k)} THEN {v}" for k, v in RATE_100.items())
    return f"CASE {whens} ELSE 100 END"


def _usd_cents(local_cents: str, rate100: str) -> str:
    return half_up_div(f"({local_cents}) * 100", rate100)


def _payment_final() -> str:
    parts = [f"WHEN vendor = {_q(vendor)} THEN {_case('c_mktsegment', final, _q('other'))}"
             for vendor, final in PAYMENT_BY_SEGMENT.items()]
    return "CASE " + " ".join(parts) + " END"


def _status_prio(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} = {_q(k)} THEN {v}" for k, v in STATUS_RANK.items())
    return f"CASE {whens} ELSE {OTHER_STATUS_RANK} END"


def lines_cte() -> str:
    """CTE ``lines``: every canonical line (before dedup), same columns as Spark."""
    vendor = _case("r.r_name", REGION_VENDOR, _q(VENDOR_B))
    status = ("CASE WHEN l.l_partkey % 17 = 0 THEN 'completed' WHEN l.l_partkey % 13 = 0 THEN 'on-hold' "
              "WHEN l.l_returnflag = 'R' THEN 'settled' WHEN l.l_returnflag = 'A' THEN 'completed' "
              "WHEN l.l_returnflag = 'N' THEN 'pending' ELSE 'completed' END")
    return f"""
facts AS (
  SELECT {vendor} AS vendor,
         row_number() OVER () AS _rid, l.l_partkey AS partkey,
         CASE WHEN l.l_partkey % 97 <> 0 THEN CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) END AS order_id,
         CASE WHEN l.l_partkey % 89 <> 0 THEN CAST(CAST(o.o_orderdate AS DATE) + CAST(l.l_suppkey % 3 AS INTEGER) AS TIMESTAMP) END AS order_ts,
         {status} AS status,
         c.c_name AS customer, n.n_name AS country, n.n_nationkey AS nationkey, c.c_mktsegment,
         'SKU-' || CAST(l.l_partkey AS VARCHAR) AS sku,
         CAST(l.l_quantity AS INTEGER) AS qty,
         CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 100 AS DECIMAL(38,0)) AS HUGEINT) AS amount_c,
         CAST(round(l.l_tax * 100) AS HUGEINT) AS tax100,
         CAST(round(l.l_discount * 100) AS INTEGER) AS pct,
         l.l_returnflag, CAST(l.l_shipdate AS TIMESTAMP) AS arrived
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
f2 AS (
  SELECT *,
         CASE WHEN qty > 0 THEN {half_up_div('amount_c', 'qty')} END AS unit_c,
         {half_up_div('amount_c * tax100', '100')} AS vat_c,
         CASE vendor WHEN {_q(VENDOR_A)} THEN 'USD' WHEN {_q(VENDOR_B)} THEN 'EUR'
              ELSE CASE WHEN partkey % 7 = 0 THEN 'SGD' WHEN partkey % 5 = 1 THEN CASE WHEN nationkey % 2 = 0 THEN 'jpy' ELSE 'krw' END
                        WHEN nationkey % 2 = 0 THEN 'JPY' ELSE 'KRW' END END AS currency,
         (vendor = {_q(VENDOR_A)} AND l_returnflag = 'R') AS promo,
         {_payment_final()} AS payment_method
  FROM facts
),
f3 AS (
  SELECT *, {_rate100('currency')} AS rate100 FROM f2
),
f4 AS (
  SELECT *,
         {_usd_cents('amount_c', 'rate100')} AS total_usd_c,
         {_usd_cents('unit_c', 'rate100')} AS unit_usd_c
  FROM f3
),
f5 AS (
  SELECT *, 1 AS line_no,
         CASE WHEN vendor = {_q(VENDOR_C)} AND partkey % 11 <= 2 THEN NULL ELSE sku END AS item_sku,
         CASE WHEN vendor = {_q(VENDOR_C)} AND partkey % 11 <= 2 THEN NULL ELSE qty END AS item_qty,
         CASE WHEN vendor = {_q(VENDOR_C)} AND partkey % 11 <= 2 THEN NULL ELSE unit_usd_c END AS item_unit_c FROM f4
  UNION ALL
  SELECT *, 2, sku || '-X', 1, unit_usd_c FROM f4 WHERE vendor = {_q(VENDOR_C)} AND partkey % 11 BETWEEN 3 AND 5
),
lines AS (
  SELECT _rid, order_id,
         line_no AS line_number,
         order_ts AS order_timestamp,
         customer AS customer_email,
         item_sku AS product_sku,
         item_qty AS quantity,
         {cents_to_money('item_unit_c')} AS unit_price_usd,
         {cents_to_money('total_usd_c')} AS total_amount_usd,
         CASE WHEN promo THEN {cents_to_money(half_up_div('unit_c * qty * pct', '100'))} END AS discount_amt_usd,
         payment_method,
         CASE WHEN vendor = {_q(VENDOR_A)} THEN 'US' ELSE country END AS country_code,
         CASE WHEN promo THEN 'SAVE' || CAST(pct AS VARCHAR) END AS promo_code,
         CASE WHEN promo THEN qty END AS loyalty_points,
         vendor AS source_vendor,
         currency AS source_currency,
         CAST(CAST(rate100 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS exchange_rate,
         CASE WHEN vendor = {_q(VENDOR_B)} THEN {cents_to_money(_usd_cents('vat_c', 'rate100'))} END AS vat_amount_usd,
         arrived AS _ingestion_timestamp,
         vendor || '/orders_' || strftime(arrived, '%Y%m%d') ||
           CASE WHEN vendor = {_q(VENDOR_C)} THEN '.tsv' ELSE '.csv' END AS _source_file,
         status AS payment_status,
         {cents_to_money('item_qty * item_unit_c')} AS line_total_usd
  FROM f5
)"""


RANK_ORDER = ("{prio} ASC, order_timestamp DESC NULLS LAST, _ingestion_timestamp DESC NULLS LAST, "
              "product_sku ASC NULLS FIRST, quantity ASC NULLS FIRST, total_amount_usd ASC NULLS FIRST, "
              "_source_file ASC NULLS FIRST")


def silver_ctes(marked: str = "marked", silver: str = "silver", where: str = "", src: str = "lines") -> str:
    """CTEs ``<marked>`` (lines + dedup flags) and ``<silver>`` (winners) over ``lines``."""
    order = RANK_ORDER.format(prio=_status_prio("payment_status"))
    return f"""{marked}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, line_number, CASE WHEN order_id IS NULL THEN _rid END ORDER BY {order}) AS _rn,
         count(*) OVER (PARTITION BY order_id, line_number, CASE WHEN order_id IS NULL THEN _rid END) AS _copies
  FROM {src} {where}
),
{marked} AS (
  SELECT * EXCLUDE (_rn, _copies), _rn > 1 AS _is_duplicate,
         CASE WHEN _rn > 1 AND _copies > 1 THEN {_q(DUPLICATE_REASON)} END AS _duplicate_reason
  FROM {marked}_ranked
),
{silver} AS (SELECT * FROM {marked} WHERE NOT _is_duplicate)"""


EARLY = "WHERE _ingestion_timestamp < TIMESTAMP '1998-01-01 00:00:00'"


def marked_cte() -> str:
    """CTEs ``lines``, ``marked``/``silver`` (all arrivals) and ``marked_early``/``silver_early``
    (lines that arrived before 1998)."""
    return (f"WITH {lines_cte()},\n{silver_ctes()},\n"
            f"{silver_ctes('marked_early', 'silver_early', EARLY)}\n")


def upsert_sql(target: str, source: str, keys: list[str], cols: list[str],
               update: list[str] | None = None) -> str:
    """SQL of MERGE target USING source ON keys (NULL-safe) UPDATE <update> INSERT *."""
    update = [c for c in cols if c not in keys] if update is None else update
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in keys or c not in update:
            sel.append(f"CASE WHEN t.__t THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN s.__s THEN s.{c} ELSE t.{c} END AS {c}")
    return (f"SELECT {', '.join(sel)} FROM (SELECT *, TRUE AS __t FROM ({target}) x) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS __s FROM ({source}) y) s ON {on}")


def money_sum(c: str) -> str:
    return f"CAST(SUM({c}) AS DECIMAL(18,2))"


def customer_sql(source: str = "silver") -> str:
    return (f"SELECT customer_email, COUNT(order_id) AS order_count, "
            f"{money_sum('total_amount_usd')} AS total_amount_usd, "
            f"{money_sum('discount_amt_usd')} AS total_discount_usd, "
            f"{money_ratio('SUM(total_amount_usd)', 'COUNT(order_id)')} AS avg_order_value_usd "
            f"FROM {source} GROUP BY ALL")


def revenue_sql(dims: list[str], duplicate_count: bool = True, source: str = "silver",
                grain: str = "row", where: str = "") -> str:
    dim_exprs = [("CAST(order_timestamp AS DATE) AS order_date" if d == "order_date" else d) for d in dims]
    extra = ", 0 AS duplicate_count" if duplicate_count else ""
    if grain == "order":
        inner_dims = ", ".join(dim_exprs)
        body = (f"(SELECT {inner_dims}, order_id, MAX(total_amount_usd) AS total_amount_usd, "
                f"SUM(discount_amt_usd) AS discount_amt_usd FROM {source} {where} "
                f"GROUP BY ALL) g")
        sel = ", ".join(dims)
        where = ""
    else:
        body = source
        sel = ", ".join(dim_exprs)
    return (f"SELECT {sel}, {money_sum('total_amount_usd')} AS total_amount_usd, "
            f"COUNT(order_id) AS order_count, {money_sum('discount_amt_usd')} AS total_discount_usd, "
            f"{money_ratio('SUM(total_amount_usd)', 'COUNT(order_id)')} AS avg_order_value_usd{extra} "
            f"FROM {body} {where} GROUP BY ALL")
