"""Query registry: ``register`` decorator, output normalisation, run parameters.

Registered queries: one per operator family, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built from the library
operators over the derived input shapes; ``ORACLE[name]`` is independent
ANSI SQL over the same parquet tables.  Output columns are named alike and
typed BIGINT / DOUBLE / VARCHAR / DATE on both sides (``finalize``).
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Integers -> bigint, decimals/floats -> double (exact sums are taken in
    decimal before this cast, so both engines produce the same double)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# Fixed run parameters of the registered queries (the data spans 1995-01..2001-11).
RUN_DATE_HISTORY = _dt.date(2001, 9, 1)     # day 1 + history flag -> full rebuild
HISTORY_START = _dt.date(1995, 1, 1)
OVERDRAFT_RUN_DATE = _dt.date(2001, 2, 15)  # closes January 2001
