"""Successor-key resolution.

Accounts are re-issued; a map holds old id -> current id, where the
current id may be a real id, 0 (no successor) or NULL.  Three resolution
modes exist and differ exactly on those values:

* ``null``    -- ``COALESCE(successor, own)``: a 0 successor wins.
* ``zero``    -- own id when the successor is 0 or NULL, else the successor.
* ``inverse`` -- own id unless own id is 0/NULL, in which case the successor.

The map is one row per old id; at scale it is an account-sized table, so it
is *not* broadcast by force -- the join is left to the size-checked planner
(AQE turns it into a broadcast only when the runtime size is small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("null", "zero", "inverse")


def resolved_key(own: Column, successor: Column, mode: str) -> Column:
    if mode == "null":
        return F.coalesce(successor, own)
    if mode == "zero":
        return F.when(successor.isNull() | (successor == 0), own).otherwise(successor)
    if mode == "inverse":
        return F.when(own.isNull() | (own == 0), successor).otherwise(own)
    raise ValueError(f"mode must be one of {MODES}")


def resolve_key(df: DataFrame, successor_map: DataFrame, key: str = "account_id", mode: str = "zero",
                out: str | None = None, map_key: str = "account_id", map_successor: str = "successor_id") -> DataFrame:
    """Replace (or add as ``out``) ``key`` by its resolved current id.

    ``inverse`` mode only consults the map for rows whose own id is 0/NULL:
    those rows are split off (a selective, pushed-down filter) and joined,
    the rest pass through untouched -- the big side is never shuffled for a
    lookup that cannot change it.
    """
    if mode == "inverse":
        own = F.col(key)
        needs = own.isNull() | (own == 0)
        keep = df.where(~needs) if out is None else df.where(~needs).withColumn(out, own)
        fix = _resolve_join(df.where(needs), successor_map, key, mode, out, map_key, map_successor)
        return keep.unionByName(fix)
    return _resolve_join(df, successor_map, key, mode, out, map_key, map_successor)


def _resolve_join(df: DataFrame, successor_map: DataFrame, key: str, mode: str, out: str | None,
                  map_key: str, map_successor: str) -> DataFrame:
    m = successor_map.select(F.col(map_key).alias("__old"), F.col(map_successor).alias("__succ"))
    j = df.join(m, df[key] == m["__old"], "left")
    target = out or key
    return (j.withColumn(target, resolved_key(F.col(key) if out else df[key], F.col("__succ"), mode))
            .drop("__old", "__succ"))
