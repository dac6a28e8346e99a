"""Top-1-per-group and first/last-value windows.

Windows shuffle once on their partition keys.  ``latest`` with a single
payload can be written as ``max_by`` (an aggregate with map-side partial
aggregation) -- cheaper under a hot key than a window, which must sort all
of the key's rows in one task; ``latest_by_aggregate`` offers that form.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column],
           tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row per ``keys`` under ``order``.

    ``tiebreak`` completes the order to a total one, so the pick is
    deterministic where the source order is arbitrary (W6).
    """
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_by_aggregate(df: DataFrame, keys: Sequence[str], order: Column, payload: Sequence[str]) -> DataFrame:
    """T2 as an aggregate: ``max_by`` keeps the payload of the greatest order
    value per key (ties resolved by the struct order of the payload)."""
    st = F.struct(order.alias("__o"), *[F.col(c) for c in payload])
    agg = df.groupBy(*keys).agg(F.max(st).alias("__m"))
    return agg.select(*keys, *[F.col(f"__m.{c}").alias(c) for c in payload])


def latest_ties_kept(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Rows whose ``date_col`` equals the group's maximum (ties kept),
    then DISTINCT.  The maximum is an aggregate (map-side combined, one row
    per key) joined back on (keys, date): a hot key is never one window
    partition, and AQE can split its side of the join."""
    mx = df.groupBy(*keys).agg(F.max(date_col).alias("__mx"))
    mx = mx.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__mx")
    cond = F.col(date_col) == F.col("__mx")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__k_{k}"))
    return df.join(mx, cond, "inner").drop("__mx", *[f"__k_{k}" for k in keys]).distinct()


def first_value(value: Column, keys: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """FIRST_VALUE with the default frame; NULLs respected."""
    return F.first(value, ignorenulls=False).over(Window.partitionBy(*keys).orderBy(*order))


def last_value_full(value: Column, keys: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """LAST_VALUE over ROWS UNBOUNDED PRECEDING..UNBOUNDED FOLLOWING."""
    w = (Window.partitionBy(*keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.last(value, ignorenulls=False).over(w)


def latest_load(df: DataFrame, load_col: str) -> DataFrame:
    """Rows whose load date equals the table's latest load
    (``WHERE load = (SELECT MAX(load) ...)``).  The maximum is a one-row
    global aggregate (partial per task), joined back by equality on the
    load value -- a broadcast of one row, no window over the whole table."""
    mx = df.agg(F.max(load_col).alias("__max_load"))
    return df.join(F.broadcast(mx), F.col(load_col) == F.col("__max_load"), "inner").drop("__max_load")


def latest_stored_load(history: DataFrame, load_col: str) -> DataFrame:
    """P10 / P11 over a table stored by load date: ``WHERE load = (SELECT MAX(load) ...)`` as a scalar subquery.

    The subquery is a predicate on the partition column, so Spark evaluates it before it lists the files of the outer
    scan and opens one folder, however many loads there are."""
    latest = history.agg(F.max(load_col)).scalar()
    return history.where(F.col(load_col) == latest)
