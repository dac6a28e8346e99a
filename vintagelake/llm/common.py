"""Shared helpers: word pattern, hash folds, staged tables, bounded samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintagelake.session import checkpoint_dir

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage: after a lost executor only the reading is repeated.
    """
    path = stage_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions inside hand tasks at most ``rows`` rows an Arrow batch, or fewer where the session says so."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with did (doc_id, null last) and th (hash of the text): rows equal in both are repeats."""
    return docs.withColumn("did", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))) \
        .withColumn("th", F.xxhash64("text"))


def attach(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, list[Column], Column]:
    """Join ``found`` (one row per did, th) to ``docs`` whatever its column names.

    Returns the join, the columns of ``docs`` in it, and a number 1, 2, ... that
    tells repeats of a row apart.  The number needs no further exchange.
    """
    base = keyed(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
                 .withColumns({"doc_id": F.col("in_doc_id"), "text": F.col("in_text")})).drop("doc_id", "text")
    window = Window.partitionBy("did", "th").orderBy("did", "th")
    return base.join(found, ["did", "th"], "left"), [F.col(f"in_{c}").alias(c) for c in docs.columns], \
        F.row_number().over(window)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))


def sample_rows(df: DataFrame, key: str, per_key: int, salt: str, id_col: str = "doc_id") -> DataFrame:
    """About ``per_key`` rows of each value of ``key``, chosen by a hash of the id.

    The rate of a key is ``per_key`` over its row count, so the sample has a
    bounded expected size, needs no ordering of a hot key, and is repeatable.
    """
    rates = df.groupBy(key).agg((F.lit(float(per_key)) / F.count(F.lit(1))).alias("_rate"))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.join(rates, key).filter(draw < F.col("_rate")).drop("_rate")
