"""Scheduled jobs: build a mart for a run date and write it idempotently.

    python -m vintagelake.plans.jobs dispositions --sf-dir DIR --out DIR --run-date 2001-09-01 [--history]
    python -m vintagelake.plans.jobs month        --sf-dir DIR --out DIR --run-date 2001-09-01 [--backfill-from 1995-01-01]
    python -m vintagelake.plans.jobs publish      --sf-dir DIR --out DIR --month 200108
    python -m vintagelake.plans.jobs overdraft    --sf-dir DIR --out DIR --run-date 2001-02-15
    python -m vintagelake.plans.jobs cohort       --sf-dir DIR --out DIR --run-date 2001-09-01

Each job can be re-run for the same run date with the same result (window
rewrite by observation or origin month instead of blind appends).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintagelake.functions import periods as P
from vintagelake.operators import aggregates as G
from vintagelake.operators import overdraft
from vintagelake.plans import marts as M
from vintagelake.plans import schemas
from vintagelake.session import get_session, stage, stage_scope
from vintagelake.sources import catalog, sinks
from vintagelake.sources.versions import VersionedTable

ORIGIN_COL = "origin_yyyymm"


def fact_table(spark: SparkSession, out_dir: str, name: str, schema: T.StructType, partition_col: str = sinks.PARTITION_COL) -> VersionedTable:
    """A published table; readers take it through its manifest (``fact_table(...).read()``)."""
    return VersionedTable(spark, os.path.join(out_dir, name), schema, partition_col)


def _kept_rules(fact: DataFrame, name: str) -> DataFrame:
    """The fact, failing the write at a row that breaks one of its declared rules."""
    return catalog.checked(fact, schemas.REQUIRED[name], schemas.CHECKS[name])


def run_dispositions(spark: SparkSession, inp: M.Inputs, run_date: _dt.date, history: bool, out_dir: str,
                     history_start: _dt.date = _dt.date(2017, 1, 1)) -> list[int]:
    """E1 end to end (K2, K29, K30): stages for the window, control totals
    appended, then the closing window of the partitioned fact rewritten.

    Returns the months cleared without replacement.
    """
    start, end = P.period_window(run_date, history, history_start)
    target = fact_table(spark, out_dir, "dispositions", schemas.dispositions())
    target.create()
    with stage_scope(spark):
        fact, stages = M.dispositions_stages(inp, start, end, run_date)
        stages.append(M.target_step(target.read(), start, end))
        ts = _dt.datetime.combine(run_date, _dt.time(0, 0))
        sinks.append(sinks.control_totals(spark, stages, "DISPOSITIONS", ts), os.path.join(out_dir, "control_totals"))
        return target.rewrite(_kept_rules(fact, "dispositions"), *P.period_window(run_date, False, history_start))


def run_dispositions_month(spark: SparkSession, inp: M.Inputs, run_date: _dt.date, out_dir: str,
                           history_start: _dt.date = _dt.date(2017, 1, 1)) -> list[int]:
    """E1 month by month (K14, K28): the closing month's ledger joins the stored state, and only the closing month's
    snapshots meet the vintages.

    The state holds the ledger's monthly facts by own account, before keys are resolved, so a later successor map
    applies to old months as in a full rebuild.  A run scans one month of the ledger and of the snapshots, however long
    the history; its month of the fact equals that of ``run_dispositions`` with full history.  Months before the first
    run come from ``backfill_ledger_state``.
    """
    first, last = P.period_window(run_date, False, history_start)
    state = fact_table(spark, out_dir, "ledger_state", schemas.ledger_state(), ORIGIN_COL)
    target = fact_table(spark, out_dir, "dispositions", schemas.dispositions())
    target.create()
    with stage_scope(spark):
        _store_ledger(state, inp, first, last)
        own = state.read(months=(history_start.year * 100 + history_start.month, last.year * 100 + last.month)).drop(ORIGIN_COL)
        fact, stages = M.dispositions_stages(inp, history_start, last, run_date, own, (first, last))
        stages.append(M.target_step(target.read(months=(first.year * 100 + first.month, last.year * 100 + last.month)), first, last))
        ts = _dt.datetime.combine(run_date, _dt.time(0, 0))
        sinks.append(sinks.control_totals(spark, stages, "DISPOSITIONS", ts), os.path.join(out_dir, "control_totals"))
        return target.rewrite(_kept_rules(fact, "dispositions"), first, last)


def backfill_ledger_state(spark: SparkSession, inp: M.Inputs, start: _dt.date, end: _dt.date, out_dir: str) -> None:
    """The state of the months from ``start`` to ``end``, from one scan of the ledger."""
    _store_ledger(fact_table(spark, out_dir, "ledger_state", schemas.ledger_state(), ORIGIN_COL), inp, start, end)


def _store_ledger(state: VersionedTable, inp: M.Inputs, first: _dt.date, last: _dt.date) -> None:
    own = G.own_monthly_facts(inp.ledger, first, last)
    state.rewrite(own.withColumn(ORIGIN_COL, F.col("year") * 100 + F.col("month")), first, last)


def publish_dispositions(spark: SparkSession, out_dir: str, yyyymm: int) -> list[int]:
    """Publish one month of the fact to the master table, by the sink's column list."""
    schema = schemas.dispositions()
    fact = fact_table(spark, out_dir, "dispositions", schema).read(months=(yyyymm, yyyymm))
    return fact_table(spark, out_dir, "dispositions_master", schema).publish(fact, yyyymm)


def run_overdraft(spark: SparkSession, inp: M.Inputs, run_date: _dt.date, out_dir: str,
                  excluded: Sequence[int] = (), web_stores: Sequence[str] = ()) -> list[int]:
    """The closed month's episodes join the stored ones, and all stored
    episodes meet that month's snapshot.  The source appends (a re-run
    duplicates, Q4); here the origin month of the episodes and the
    observation month of the fact are rewritten instead."""
    start, _ = P.previous_month(run_date)
    month = start.year * 100 + start.month
    with stage_scope(spark):
        new = overdraft.overdraft_episodes(inp.auth_events, inp.manual_auths, inp.snapshots, inp.successor_map, run_date,
                                           excluded)
        new = new.withColumn(ORIGIN_COL, F.col("origin_year") * 100 + F.col("origin_month"))
        episodes = fact_table(spark, out_dir, "overdraft_episodes", new.schema, ORIGIN_COL)
        episodes.rewrite(new, start, start)
        fact = M.overdraft_mart(inp, run_date, excluded, web_stores, episodes.read(months=(0, month)))
        return fact_table(spark, out_dir, "overdraft", schemas.overdraft()).rewrite(_kept_rules(fact, "overdraft"), start, start)


def run_cohort(spark: SparkSession, inp: M.Inputs, run_date: _dt.date, out_dir: str, product: int, brand: int,
               since: _dt.date, stores: Sequence[str] | None, with_applications: bool, name: str) -> None:
    """Full rebuild (CREATE OR REPLACE) of a cohort mart and its view."""
    df = M.cohort_mart(inp, product, brand, since, stores, run_date, with_applications)
    df = sinks.conform(_kept_rules(df, "cohort"), schemas.cohort(with_applications))
    path = os.path.join(out_dir, name)
    sinks.overwrite(df, path, partition_by=[], sort_by=["account_id", "year", "month"])
    sinks.create_view(spark.read.parquet(path), f"v_{name}")


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vintagelake.plans.jobs")
    ap.add_argument("job", choices=["dispositions", "month", "publish", "overdraft", "cohort"])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", type=_dt.date.fromisoformat)
    # full history by default: with the closing month's origins only, the rewrite would drop older vintages
    ap.add_argument("--history", action=argparse.BooleanOptionalAction, default=True)
    ap.add_argument("--exclude-account", type=int, nargs="*", default=[])
    ap.add_argument("--web-store", nargs="*", default=[])
    ap.add_argument("--store", nargs="*", help="stores of the cohort (all if absent)")
    ap.add_argument("--product", type=int, default=110)
    ap.add_argument("--brand", type=int, default=200)
    ap.add_argument("--with-applications", action="store_true")
    ap.add_argument("--name", default="cohort")
    ap.add_argument("--history-start", type=_dt.date.fromisoformat, default=_dt.date(2017, 1, 1))
    ap.add_argument("--month", type=int)
    ap.add_argument("--backfill-from", type=_dt.date.fromisoformat, help="store the ledger's months from then on first")
    a = ap.parse_args(argv)
    spark = get_session("vintagelake-job")
    if a.job == "publish":
        print(publish_dispositions(spark, a.out, a.month))
        return
    inp = M.Inputs.load(spark, a.sf_dir, pin=True)
    if a.job == "dispositions":
        print(run_dispositions(spark, inp, a.run_date, a.history, a.out, a.history_start))
    elif a.job == "month":
        if a.backfill_from:
            backfill_ledger_state(spark, inp, a.backfill_from, P.previous_month(a.run_date)[1], a.out)
        print(run_dispositions_month(spark, inp, a.run_date, a.out, a.history_start))
    elif a.job == "overdraft":
        print(run_overdraft(spark, inp, a.run_date, a.out, a.exclude_account, a.web_store))
    else:
        run_cohort(spark, inp, a.run_date, a.out, a.product, a.brand, a.history_start, a.store, a.with_applications, a.name)


if __name__ == "__main__":
    main()
