"""Parquet table access with explicit column pruning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table; selecting ``columns`` up front keeps the parquet
    ReadSchema narrow even before Catalyst's own pruning kicks in."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
