"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from ledgerline.functions.columns import (  # noqa: F401
    lookup, map_values, parse_ts, sort_columns, status_priority, to_usd, with_missing, with_money,
)
