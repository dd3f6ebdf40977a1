"""Column expressions shared by the normalisers, dedup and Gold jobs.

Everything here builds Catalyst expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import (
    MONEY, RATE, STATUS_DEFAULT, STATUS_DEFAULT_PRIORITY, STATUS_PRIORITY,
)

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_missing(df: DataFrame, columns: Mapping[str, object]) -> DataFrame:
    """Add every absent column as a typed NULL (or a typed default) in one projection.

    ``columns`` maps name -> DataType | type string | (type, default literal).
    """
    add = {}
    for name, spec in columns.items():
        if name in df.columns:
            continue
        dtype, default = (spec if isinstance(spec, tuple) else (spec, None))
        add[name] = F.lit(default).cast(dtype)
    return df.withColumns(add) if add else df


_SCIENTIFIC = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]+\s*$"
_WIDE = T.DecimalType(38, 10)


def money(df: DataFrame, c: ColumnLike, notation: str = "dot", dtype: T.DecimalType = MONEY) -> Column:
    """Exact decimal of a money value, rounded half-up; unparsable text -> NULL.

    ``notation`` says how the vendor writes numbers:

    * ``dot``   - the dot is the decimal point, commas are thousands marks
                  (``1,234.50`` -> 1234.50, ``24.990`` -> 24.99);
    * ``comma`` - a comma, where there is one, is the decimal point and dots are thousands marks;
                  without a comma a single dot is the decimal point and several are thousands marks
                  (``€1.234,50`` -> 1234.50, ``EUR 24,99`` -> 24.99, ``24.990`` -> 24.99,
                  ``€1.234.567`` -> 1234567).

    Currency signs, letters and blanks are dropped first; a minus may stand before or after the digits.  Numbers in scientific notation are taken
    as such only where the whole text is one; numeric columns are cast directly.
    """
    col = _col(c)
    if isinstance(df.select(col).schema[0].dataType, T.NumericType):
        return col.try_cast(dtype)
    raw = col.cast("string")
    return _money_value(raw, _money_digits(_money_kept(raw)), notation, dtype)


def _money_kept(raw: Column) -> Column:
    """Digits, marks and minus signs of a money text."""
    return F.regexp_replace(raw, r"[^0-9.,\-]", "")


def _money_digits(kept: Column) -> Column:
    """... with a minus behind them brought to the front."""
    return F.when(kept.endswith("-"), F.regexp_replace(kept, r"^([^-]+)-$", "-$1")).otherwise(kept)


def _money_value(raw: Column, digits: Column, notation: str, dtype: T.DecimalType) -> Column:
    if notation == "comma":
        text = F.when(digits.contains(","), F.translate(digits, ",.", ".")) \
            .when(digits.rlike("[.].*[.]"), F.translate(digits, ".", "")).otherwise(digits)
    elif notation == "dot":
        text = F.translate(digits, ",", "")
    else:
        raise ValueError(f"notation must be 'dot' or 'comma', not {notation!r}")
    scientific = (raw.contains("e") | raw.contains("E")) & raw.rlike(_SCIENTIFIC)
    return F.when(scientific, F.trim(raw)).otherwise(text).try_cast(_WIDE).try_cast(dtype)


def with_money(df: DataFrame, targets: Mapping[str, ColumnLike], notation: str = "dot",
               dtype: T.DecimalType = MONEY) -> DataFrame:
    """Add exact-decimal columns: ``targets`` maps new column -> source column (see ``money``).

    A text's digits are a column of a projection of their own: inside one expression each branch would
    search the text again, and the code generated for several amounts would be too long to be compiled."""
    texts = {k: _col(src).cast("string") for k, src in targets.items()
             if not isinstance(df.select(_col(src)).schema[0].dataType, T.NumericType)}
    stem = "_" * max(len(n) for n in df.columns)
    raw, kept, digits = ({k: f"{stem}{part}{i}" for i, k in enumerate(texts)} for part in ("raw", "kept", "digits"))
    out = (df.withColumns({raw[k]: text for k, text in texts.items()})
           .withColumns({kept[k]: _money_kept(F.col(raw[k])) for k in texts})
           .withColumns({digits[k]: _money_digits(F.col(kept[k])) for k in texts}))
    return out.withColumns({k: _money_value(F.col(raw[k]), F.col(digits[k]), notation, dtype) if k in texts else _col(src).try_cast(dtype)
                            for k, src in targets.items()}).drop(*raw.values(), *kept.values(), *digits.values())


def to_usd(amount: ColumnLike, rate: ColumnLike) -> Column:
    """Local amount / (local units per USD), exact decimal, HALF_UP to cents."""
    return (_col(amount).cast(MONEY) / _col(rate).cast(RATE)).cast(MONEY)


def parse_ts(c: ColumnLike, fmt: str) -> Column:
    """Tolerant timestamp parse: bad text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt))


def map_values(c: ColumnLike, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace values found in a small, fixed mapping; others pass through (or ``default``)."""
    col = _col(c)
    if not mapping:
        return col if default is None else default
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, col), col if default is None else default)


def lookup(c: ColumnLike, mapping: Mapping[str, str], dtype=None) -> Column:
    """Value of ``c`` in a small fixed mapping, NULL when absent."""
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(lit_map, _col(c))
    return out.cast(dtype) if dtype is not None else out


def status_priority(c: ColumnLike = "payment_status", default: int = STATUS_DEFAULT_PRIORITY) -> Column:
    """settled 1, completed 2, pending 3; anything else (incl. NULL) ranks ``default``
    (completed by default)."""
    s = F.lower(F.trim(_col(c)))
    expr = None
    for status, prio in STATUS_PRIORITY.items():
        expr = (F.when(s == status, F.lit(prio)) if expr is None
                else expr.when(s == status, F.lit(prio)))
    return expr.otherwise(F.lit(default))


def normalized_status(c: ColumnLike = "payment_status") -> Column:
    return F.coalesce(F.lower(F.trim(_col(c))), F.lit(STATUS_DEFAULT))


OrderSpec = tuple[ColumnLike, str]


def sort_columns(specs: Sequence[OrderSpec | ColumnLike]) -> list[Column]:
    """``specs`` as sort expressions with SQL default null placement."""
    out = []
    for spec in specs:
        c, direction = (spec if isinstance(spec, tuple) else (spec, "asc"))
        col = _col(c)
        out.append(col.desc_nulls_last() if direction.lower() == "desc" else col.asc_nulls_first())
    return out
