"""Canonical schemas and the fixed business values every layer shares."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)
PCT = T.DecimalType(9, 4)

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the business rules of the original pipeline;
# they are stated here once, in natural order, and used everywhere else.
# ---------------------------------------------------------------------------

VENDOR_A = "vendor_a"   # US storefront export, comma CSV, USD
VENDOR_B = "vendor_b"   # EU storefront export, pipe CSV, EUR text amounts + VAT
VENDOR_C = "vendor_c"   # Asian custom platform, TSV with JSON columns, JPY/KRW

VENDOR_A_COUNTRY = "US"
VENDOR_A_CURRENCY = "USD"
VENDOR_B_CURRENCY = "EUR"

# Units of local currency per 1 USD; unknown currencies convert at 1.0.
FX_RATES = {"USD": "1.0", "EUR": "0.92", "JPY": "150", "KRW": "1320"}
FX_DEFAULT_RATE = "1.0"

# Payment method clean-up per vendor.
PAYMENT_MAP_A = {"google_pay": "mobile_wallet", "apple_pay": "mobile_wallet"}
PAYMENT_MAP_B = {"carte_bancaire": "bank_card"}

# Vendor B short product codes -> canonical SKU; unmapped codes pass through.
SKU_MAP = {"WID500": "WIDGET-500", "GADX1": "GADGET-X1"}

# Dedup: lower wins.  Unknown or missing status ranks as "completed".
STATUS_PRIORITY = {"settled": 1, "completed": 2, "pending": 3}
STATUS_DEFAULT_PRIORITY = 2
STATUS_DEFAULT = "completed"
DUPLICATE_REASON = "Duplicate order - lower status priority or older timestamp"

# Date formats of the three feeds.
DATE_FORMAT_A = "MM/dd/yyyy"
DATE_FORMAT_B = "dd-MM-yyyy"
TS_FORMAT_C = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Table health thresholds.
FILES_BAD = 10000
FILES_WARN = 1000
FILE_SIZE_MIN = 128 * 1024 * 1024
FILE_SIZE_MAX = 256 * 1024 * 1024
VACUUM_RETENTION_HOURS = 168

# ---------------------------------------------------------------------------
# Canonical Silver order line.
# ---------------------------------------------------------------------------

CANONICAL = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("line_number", T.IntegerType()),
    T.StructField("order_timestamp", T.TimestampType()),
    T.StructField("customer_email", T.StringType()),
    T.StructField("product_sku", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price_usd", MONEY),
    T.StructField("total_amount_usd", MONEY),
    T.StructField("discount_amt_usd", MONEY),
    T.StructField("payment_method", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("promo_code", T.StringType()),
    T.StructField("loyalty_points", T.IntegerType()),
    T.StructField("source_vendor", T.StringType()),
    T.StructField("source_currency", T.StringType()),
    T.StructField("exchange_rate", RATE),
    T.StructField("vat_amount_usd", MONEY),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    # additions: carried status (dedup input), exact line value, row identity
    T.StructField("payment_status", T.StringType()),
    T.StructField("line_total_usd", MONEY),
    T.StructField("_source_row", T.LongType()),
])
CANONICAL_COLUMNS = [f.name for f in CANONICAL.fields]
ORDER_KEYS = ("order_id", "line_number")

# Landing-file column layouts.  Everything is read as text; Silver parses.
VENDOR_A_V1 = ["order_id", "order_date", "customer_email", "product_sku", "quantity",
               "unit_price", "total_amount", "payment_method"]
VENDOR_A_V2 = ["order_id", "order_date", "email", "product_sku", "quantity",
               "unit_price", "total_amount", "payment_method", "promo_code",
               "discount_pct", "loyalty_points"]
VENDOR_B_COLUMNS = ["order_id", "order_date", "customer_email", "product_code", "quantity",
                    "unit_price", "total_amount", "vat_amount", "payment_method", "country_code"]
VENDOR_C_COLUMNS = ["order_number", "created_at", "customer_info", "line_items", "payment_details"]

# JSON payloads of vendor C.  Amounts are decimals (fractions must not become NULL).
C_CUSTOMER = T.StructType([
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("country", T.StringType()),
])
C_ITEM = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("price", MONEY),
])
C_PAYMENT = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("status", T.StringType()),
])

LINEAGE = ["_source_file", "_ingestion_timestamp", "_source_vendor", "_source_row"]


def text_schema(columns: list[str]) -> T.StructType:
    """All-string schema for a landing file layout."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
