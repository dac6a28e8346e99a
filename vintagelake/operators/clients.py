"""Client history (W4, W7, K25): many versions of a client row per account, one picked.

A version carries the source system that wrote it, the client id of the system
before it and its load date.  The store is partitioned by source system and load
month, so a reader opens the folders of one system up to the as-of date only.

The picks are aggregates with map-side combine (a ``max`` or ``min`` of a struct)
instead of ``ROW_NUMBER`` windows: an account with very many versions costs one
row per task, not one sort in one task.  Every pick is made total by the client
id, the smallest first, where the source leaves ties open.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_SYSTEM = 12        # FIXED VALUE: the one source system the facts read
PARTITIONS = ("source_system", "load_yyyymm")
PAYLOAD = ("client_id", "previous_id", "load_date", "client_open_date", "birth_date", "sex", "gender_code")
_NO_MONTH = 0             # versions without a load date
HISTORY = (("account_id", "bigint"), ("client_id", "bigint"), ("previous_id", "bigint"), ("load_date", "date"),
           ("client_open_date", "date"), ("birth_date", "date"), ("sex", "string"), ("gender_code", "int"),
           ("source_system", "int"), ("load_yyyymm", "int"))


def _load_month(day):
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(_NO_MONTH))


def write_versions(versions: DataFrame, path: str) -> None:
    """Append client versions to the store; a load of one month adds files to that month's folders only."""
    out = versions.withColumn("load_yyyymm", _load_month(F.col("load_date")).cast("int"))
    out.select(*[F.col(name).cast(kind) for name, kind in HISTORY]) \
        .write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{name} {kind}" for name, kind in HISTORY)).parquet(path)


def visible(history: DataFrame, source_system: int | None = SOURCE_SYSTEM, as_of: _dt.date | None = None) -> DataFrame:
    """Versions of one source system that were loaded by ``as_of``.

    Both bounds are literals on the store's partition columns, so folders are
    pruned before any file is opened; the exact date is checked on the rows.
    """
    if source_system is not None:
        history = history.where(F.col("source_system") == source_system)
    if as_of is not None:
        if "load_yyyymm" in history.columns:
            history = history.where(F.col("load_yyyymm") <= as_of.year * 100 + as_of.month)
        history = history.where(F.col("load_date").isNull() | (F.col("load_date") <= F.lit(as_of)))
    return history


def by_previous_id(history: DataFrame) -> DataFrame:
    """Per account the version with the highest previous id; those without one come last."""
    order = F.struct(F.col("previous_id").alias("o"), (-F.col("client_id")).alias("t"), *PAYLOAD)
    return _payload(history.groupBy("account_id").agg(F.max(order).alias("v")))


def by_load_date(history: DataFrame) -> DataFrame:
    """Per account the version loaded first; those without a load date come before the others."""
    order = F.struct(F.col("load_date").alias("o"), F.col("client_id").alias("t"), *PAYLOAD)
    return _payload(history.groupBy("account_id").agg(F.min(order).alias("v")))


def by_open_date(history: DataFrame) -> DataFrame:
    """Per account the version that opened first; those without an open date come last."""
    order = F.struct(F.col("client_open_date").isNull().alias("n"), F.col("client_open_date").alias("o"),
                     F.col("client_id").alias("t"), *PAYLOAD)
    return _payload(history.groupBy("account_id").agg(F.min(order).alias("v")))


def _payload(picked: DataFrame) -> DataFrame:
    return picked.select("account_id", *[F.col(f"v.{c}").alias(c) for c in PAYLOAD])


def picks(history: DataFrame, source_system: int = SOURCE_SYSTEM, as_of: _dt.date | None = None) -> DataFrame:
    """The three picks of each account side by side, from one pass over the versions."""
    h = visible(history, source_system, as_of)
    last = F.max(F.struct("previous_id", -F.col("client_id"), "client_id", "birth_date")).alias("p")
    first = F.min(F.struct("load_date", "client_id", "birth_date")).alias("l")
    opened = F.min(F.struct(F.col("client_open_date").isNull(), "client_open_date", "client_id", "birth_date")).alias("o")
    agg = h.groupBy("account_id").agg(F.count(F.lit(1)).alias("n_versions"), last, first, opened)
    cols = [F.col(f"{s}.{c}").alias(f"{name}_{c}") for s, name in (("p", "previous"), ("l", "load"), ("o", "open"))
            for c in ("client_id", "birth_date")]
    return agg.select("account_id", "n_versions", *cols)
