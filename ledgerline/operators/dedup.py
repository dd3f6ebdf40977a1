"""Duplicate marking by business priority, safe against hot keys.

The business rule: within one order line key, the best copy is the one with the best
payment status (settled > completed > pending, unknown = completed), then the latest
order timestamp, then the latest arrival.  Further tie-breaks make the choice total
and independent of input order: product, quantity, amount, then the source file, row and
line the copy came from.

A plain ``row_number() OVER (PARTITION BY key ...)`` over all rows sends every copy
of a key to one task; if one key holds a third of all rows, that task does a third
of the job.  Here:

* ``keep_best`` asks only for rank 1, which Spark plans as a *partial* group limit
  in every map task before the shuffle and a final one after it: a hot key reaches
  the reducer as one row per map task.
* ``mark_duplicates`` writes its input once, computes those winners from a narrow
  projection of it (keys, order columns, row identity), then left-joins all rows to
  them on key *plus* row identity.  The join key includes the identity, so a hot order key's rows hash to
  many partitions; no task ever holds a whole group.
* Rows with a NULL key part are never duplicates; they ride in the same plan as
  groups of one (no second branch, so the input is computed once).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import OrderSpec, sort_columns, status_priority
from ledgerline.operators.joins import portions_of, staged, staged_while
from ledgerline.schemas import DUPLICATE_REASON, ORDER_KEYS

FLAG_COLUMNS = ("_is_duplicate", "_duplicate_reason")
#: stored bytes of rows that are shuffled at once, and portions at most
PORTION_BYTES, MOST_PORTIONS = 2 << 30, 64
# the lines exploded from one source row share file and row: the line number tells them apart
IDENTITY = ("_source_file", "_source_row", "line_number")


def business_order(df: DataFrame) -> list[OrderSpec]:
    """Default total order of copies within a key (best first)."""
    order: list[OrderSpec] = [(status_priority("payment_status"), "asc"),
                              ("order_timestamp", "desc")]
    for c, d in [("_ingestion_timestamp", "desc"), ("product_sku", "asc"), ("quantity", "asc"),
                 ("total_amount_usd", "asc"), ("_source_file", "asc"), ("_source_row", "asc"), ("line_number", "asc")]:
        if c in df.columns:
            order.append((c, d))
    return order


def _any_null(keys: Sequence[str]):
    cond = None
    for k in keys:
        cond = F.col(k).isNull() if cond is None else (cond | F.col(k).isNull())
    return cond


def _groups(keys: Sequence[str], identity: Sequence[str]) -> list:
    """Window partition columns: the keys, plus - only for a row with a NULL key part -
    the row's own identity.  Such a row identifies no order, so it forms a group of
    one (never a duplicate), and NULL-key rows cannot pile up as one hot group."""
    return [F.col(k) for k in keys] + [F.when(_any_null(keys), F.struct(*identity)).alias("_solo")]


def _identity(df: DataFrame, identity: Sequence[str]) -> list[str]:
    ids = [c for c in identity if c in df.columns]
    if not ids:
        raise ValueError("dedup needs row identity columns, e.g. _source_file/_source_row")
    return ids


def mark_duplicates(df: DataFrame, keys: Sequence[str] = ORDER_KEYS,
                    order: Sequence[OrderSpec] | None = None,
                    identity: Sequence[str] = IDENTITY, stage: bool = True) -> DataFrame:
    """Keep every row; add ``_is_duplicate`` and ``_duplicate_reason``.

    The rows are used twice, so they are staged in the shared folder first (``stage=False``
    for rows that come straight from a stored table).

    Exactly one row per key is not a duplicate (the best by ``order``), provided the
    ``identity`` columns (source file, row within it, line within that) tell rows apart -
    which the Bronze readers and normalisers guarantee.  Rows with a NULL key part are never duplicates.
    """
    if stage:
        df = staged(df, "lines")
    return _marked(df, _winners(df, keys, order, identity), keys, identity)


@contextmanager
def marked_while(df: DataFrame, keys: Sequence[str] = ORDER_KEYS, order: Sequence[OrderSpec] | None = None,
                 identity: Sequence[str] = IDENTITY, parts: int | None = None) -> Iterator[list[DataFrame]]:
    """``mark_duplicates`` of stored rows, for the jobs of the block alone: its portions, to be written one after the other.

    The winners are staged while it lasts, so the files of their ranking are gone when the rows are shuffled to meet them;
    and the rows of a portion are shuffled alone, so these files do not grow with the table.
    ``parts``: the shuffle deals the rows to so many partitions for good, so they need no other before they are written."""
    n = min(portions_of(df, PORTION_BYTES), parts or MOST_PORTIONS, MOST_PORTIONS)
    with staged_while(_winners(df, keys, order, identity), "winners") as winners:
        columns = list(dict.fromkeys([*keys, *_identity(df, identity)]))
        out = []
        for k in range(n):
            own, won = (r if n == 1 else r.filter(F.pmod(F.xxhash64(*c), F.lit(n)) == k)
                        for r, c in ((df, columns), (winners, [f"_w{c}" for c in columns])))
            out.append(_marked(own, won, keys, identity, parts and parts // n + (k < parts % n)))
        yield out


def _winners(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec] | None, identity: Sequence[str]) -> DataFrame:
    """Keys and identity of the best row of every key, as ``_w<column>``."""
    keys, identity = list(keys), _identity(df, identity)
    order = list(order) if order is not None else business_order(df)
    w = Window.partitionBy(*_groups(keys, identity)).orderBy(*sort_columns(order))
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select(*[F.col(c).alias(f"_w{c}") for c in dict.fromkeys(keys + identity)]))


def _marked(df: DataFrame, winners: DataFrame, keys: Sequence[str], identity: Sequence[str], parts: int | None = None) -> DataFrame:
    cols, columns = df.columns, list(dict.fromkeys([*keys, *_identity(df, identity)]))
    if parts is None:
        winners, on = winners.withColumn("_won", F.lit(True)), None
        for c in columns:
            cond = df[c].eqNullSafe(winners[f"_w{c}"])
            on = cond if on is None else (on & cond)
        joined = df.join(winners, on, "left")
    else:
        # one struct (equal where NULLs meet NULLs): both sides are dealt by it, and the join takes them as they lie if they
        # are in no fewer partitions than its own would be; equally many of these make up each one asked for
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = -(-least // parts) * parts
        theirs = F.struct(*[F.col(f"_w{c}").alias(c) for c in columns])
        own = df.select(F.struct(*columns).alias("_own"), *[c for c in cols if c not in columns])
        joined = own.repartition(dealt, "_own").join(winners.select(theirs.alias("_won")).repartition(dealt, "_won"), F.col("_own") == F.col("_won"), "left") \
            .withColumns({c: F.col(f"_own.{c}") for c in columns}).coalesce(parts)
    dup = F.col("_won").isNull()
    # a row can only lose to another copy, so every duplicate has at least two copies
    return joined.select(*cols, dup.alias("_is_duplicate"),
                         F.when(dup, F.lit(DUPLICATE_REASON)).alias("_duplicate_reason"))


def keep_best(df: DataFrame, keys: Sequence[str] = ORDER_KEYS,
              order: Sequence[OrderSpec] | None = None,
              identity: Sequence[str] = IDENTITY, whole_keys: bool = False) -> DataFrame:
    """One row per key: the winner ``mark_duplicates`` would keep.

    Written as ``row_number() ... = 1`` over the total rank order.  Spark plans this
    as a *partial* WindowGroupLimit before the shuffle (each map task keeps only its
    best row per key) and a final one after it, so a hot key sends at most one row
    per map task through the exchange - the same map-side reduction an aggregate
    gets - while unused columns are still pruned below it.  Rows already marked
    (``_is_duplicate`` present) are simply filtered.  ``whole_keys``: no row has a NULL key part; the result
    lies by the keys alone and meets others of these keys without another exchange.
    """
    if "_is_duplicate" in df.columns:
        return df.filter(~F.col("_is_duplicate"))
    keys = list(keys)
    order = list(order) if order is not None else business_order(df)
    w = Window.partitionBy(*(keys if whole_keys else _groups(keys, _identity(df, identity)))).orderBy(*sort_columns(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def changed_winners(new: DataFrame, old: DataFrame, keys: Sequence[str] = ORDER_KEYS, untold: Sequence[str] = ()) -> DataFrame:
    """What the winners ``new`` of a batch change about the winners ``old``: new ones that win (``_wins`` true) and old
    ones that lose to them (false).  Both have a key once and no NULL in it; an old winner wins a tie, and one that stays,
    or that no new row meets, is left out.  A group has two rows at most.
    ``untold``: an old winner that stays but has a NULL in these columns is given as one that loses."""
    both = new.withColumn("_old", F.lit(False)).unionByName(old.withColumn("_old", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(*sort_columns([*business_order(both), ("_old", "desc")]))
    ranked = both.withColumns({"_wins": F.row_number().over(w) == 1, "_stays": F.first("_old").over(w)})
    out = ~F.col("_stays")
    if untold:
        out = out | (F.col("_wins") & _any_null(untold))
    return ranked.filter(out).withColumn("_wins", F.col("_wins") & ~F.col("_stays")).drop("_old", "_stays")


def with_copies(df: DataFrame, keys: Sequence[str] = ORDER_KEYS, identity: Sequence[str] = IDENTITY,
                salts: int = 64) -> DataFrame:
    """Add ``_copies``: how many rows share the row's key (1 for a row with a NULL key part).

    The counts are a partial aggregate: a hot key reaches the shuffle as one row per map task.  They are joined back on
    key *plus* a salt from the row's identity, and a key's count is repeated only for the salts (at most ``salts``) that
    its rows have; so the rows of a hot key meet its count in as many tasks.  Keys of one row are not joined at all.
    ``df`` is read twice: stage it, or read it from a table.
    """
    if not 1 <= salts <= 64:
        raise ValueError(f"salts must be 1 to 64, not {salts}")
    keys = list(keys)
    own = F.xxhash64(*_identity(df, identity))
    # the salt of a row without a complete key matches nothing and spreads such rows
    salted = df.withColumn("_salt", F.when(_any_null(keys), own).otherwise(F.pmod(own, F.lit(salts))))
    # the salts of a key as bits of one number: a hash aggregate, where a set of them would be sorted by key
    held = F.bit_or(F.expr("shiftleft(1L, cast(_salt as int))")).alias("_salts")
    counts = (salted.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), held)
              .filter(F.col("_copies") > 1)
              .withColumn("_salt", F.explode(F.expr(f"filter(sequence(0L, {salts - 1}L), s -> getbit(_salts, cast(s as int)) = 1)")))
              .drop("_salts"))
    joined = salted.join(counts, [*keys, "_salt"], "left")
    return joined.select(*df.columns, F.coalesce("_copies", F.lit(1)).cast("long").alias("_copies"))


def duplicate_census(marked: DataFrame) -> DataFrame:
    """Row count per ``_is_duplicate`` value."""
    return marked.groupBy("_is_duplicate").agg(F.count(F.lit(1)).alias("row_count"))
