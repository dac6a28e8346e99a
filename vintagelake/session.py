"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings that matter at scale: AQE re-plans joins/partition counts from
# runtime statistics, splits skewed shuffle partitions, and coalesces the
# small ones.  The broadcast threshold stays at Spark's size-checked default;
# operators never force a broadcast of a side whose size grows with the data.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files of staged DataFrames once they are unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


# HotSpot never compiles a method beyond 8,000 bytes of bytecode, it interprets it.  Spark fuses the rule ladders of a
# fact and the join before them into one such method; with this limit, which its documentation names for HotSpot, it
# evaluates them as a projection split into small methods instead.
CONF_METHOD_LIMIT, METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", "8000"


def compiled_ladders(spark: SparkSession) -> None:
    """Let long rule ladders run compiled, unless the session has set a limit of its own.

    A setting of the session, as a lazy frame is planned when its caller runs it."""
    if spark.conf.get(CONF_METHOD_LIMIT) == "65535":
        spark.conf.set(CONF_METHOD_LIMIT, METHOD_LIMIT)


def get_session(app: str = "vintagelake", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the AQE/skew settings above.

    ``master`` and ``shuffle_partitions`` are only set when given, so on a
    cluster the submitter's values win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: ``spark.checkpoint.dir`` from the session.

    Only when the cluster names none (local tests) a fresh scratch folder is
    created and registered.  Never a machine-local folder on a cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master or ""
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="vintagelake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SCOPES: list[list[str]] = []   # paths staged in the open scopes, the innermost last


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables staged inside are removed when the job ends, also when it fails.

    For jobs that write their result before they leave; a query that returns a lazy frame has no such end and keeps
    its tables.  Scopes nest: an inner job removes its own tables only."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame) -> DataFrame:
    """Materialise a DataFrame consumed by several branches of one plan
    (S3 staged tables): written as parquet below the shared
    ``spark.checkpoint.dir`` and read back.  Survives executor loss, cuts the
    lineage so the source is scanned once, and later filters and projections
    reach the staged scan.  Removed at the end of the enclosing ``stage_scope``."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, rows: Column | None = None) -> tuple[DataFrame, int]:
    """``stage`` with the number of rows written, or another aggregate of them.

    The count is observed while the rows are written, in the tasks that write them: no second job, and a repeated task
    counts once."""
    from pyspark.sql import functions as F
    seen = Observation()
    out = stage(df.observe(seen, (F.count(F.lit(1)) if rows is None else rows).alias("rows")))
    return out, seen.get["rows"]
