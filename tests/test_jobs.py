"""End-to-end jobs: build, control totals, idempotent rewrite, publish."""

import datetime as dt
import os
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from vintagelake.plans import jobs
from vintagelake.plans import marts as M
from vintagelake.plans import schemas
from vintagelake.session import checkpoint_dir

SF = "/root/testdata/sf0.001"


def test_dispositions_job_is_idempotent_and_publishes(spark):
    out = os.path.join(checkpoint_dir(spark), "jobs", uuid.uuid4().hex)
    inp = M.Inputs.load(spark, SF)
    run = dt.date(2001, 8, 1)          # day 1, monthly: rewrites July 2001
    jobs.run_dispositions(spark, inp, run, True, out, dt.date(1995, 1, 1))
    fact = jobs.fact_table(spark, out, "dispositions", schemas.dispositions())
    staged = {n for n in os.listdir(checkpoint_dir(spark)) if n.startswith("stage-")}
    first = sorted(map(tuple, fact.read().collect()), key=str)
    jobs.run_dispositions(spark, inp, run, True, out, dt.date(1995, 1, 1))
    second = sorted(map(tuple, fact.read().collect()), key=str)
    # the jobs remove what they stage
    assert {n for n in os.listdir(checkpoint_dir(spark)) if n.startswith("stage-")} <= staged
    assert first == second and len(first) > 0
    months = {r.obs_yyyymm for r in fact.read().select("obs_yyyymm").distinct().collect()}
    assert months == {200107}
    ct = spark.read.parquet(os.path.join(out, "control_totals"))
    assert ct.count() == 16                   # 8 rows x 2 runs (control rows are appended, as in the source)
    targets = sorted(r.row_count for r in ct.where("table_name = 'DISPOSITIONS'").collect())
    assert targets == [0, len(first)]         # the target is counted before its window is rewritten
    assert fact.read().schema["amount"].dataType == schemas.dispositions()["amount"].dataType
    jobs.publish_dispositions(spark, out, 200107)
    assert jobs.fact_table(spark, out, "dispositions_master", schemas.dispositions()).read().count() == len(first)


def test_month_by_month_equals_full_rebuilds(spark, tmp_path):
    """Six monthly runs over a stored state against a full rebuild of each month."""
    out = os.path.join(checkpoint_dir(spark), "jobs", uuid.uuid4().hex)
    inp, since = M.Inputs.load(spark, SF), dt.date(1995, 1, 1)
    # snapshots as a warehouse keeps them: a folder per month
    path = os.path.join(out, "snapshots")
    inp.snapshots.write.partitionBy("year", "month").parquet(path)
    stored = replace(inp, snapshots=spark.read.parquet(path).select(inp.snapshots.columns))
    jobs.backfill_ledger_state(spark, stored, since, dt.date(2001, 1, 31), out)
    runs = [dt.date(2001, m, 1) for m in range(3, 9)]
    for run in runs:
        jobs.run_dispositions_month(spark, stored, run, out, since)
    table = jobs.fact_table(spark, out, "dispositions", schemas.dispositions())
    got = table.read().drop("load_date")
    full = M.dispositions_mart(inp, since, dt.date(2001, 7, 31), runs[-1]).drop("load_date")
    full = full.where("obs_yyyymm BETWEEN 200102 AND 200107")
    assert sorted(map(str, got.collect())) == sorted(map(str, full.select(got.columns).collect())) and got.count() > 50
    month = (dt.date(2001, 7, 1), dt.date(2001, 7, 31))
    plan = M.dispositions_mart(stored, since, month[1], runs[-1], observed=month)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and path in x)
    assert "year" in scan.split("PartitionFilters")[1] and "2001" in scan.split("PartitionFilters")[1]


def control_rows(inp, window=(dt.date(1995, 1, 1), dt.date(2001, 8, 31))):
    fact, stages = M.dispositions_stages(inp, *window, dt.date(2001, 9, 1))
    return fact, {step[:2]: rows for step, _, rows in stages}


def test_control_totals_find_a_repeated_dimension_key(spark):
    inp = M.Inputs.load(spark, SF)
    fact, good = control_rows(inp)
    assert good["04"] == good["05"] == good["06"] == fact.count() > 0
    latest = inp.zone_history.where("load_date = '2001-01-31'")
    # the same stores twice in the latest load, with another name: rows 04 and 05 differ; where the fact shows the
    # name both rows stay, elsewhere the DISTINCT makes them one
    other = latest.withColumn("zone_desc", F.lit("Another"))
    fact, bad = control_rows(replace(inp, zone_history=inp.zone_history.unionByName(other)))
    assert bad["04"] == good["04"] < bad["06"] < bad["05"] and bad["06"] == fact.count()
    # an exact repetition: the DISTINCT that it calls for brings the fact back
    fact, twice = control_rows(replace(inp, zone_history=inp.zone_history.unionByName(latest)))
    assert twice["05"] > twice["04"] == twice["06"] == good["06"] == fact.count()


def test_overdraft_and_cohort_jobs(spark):
    out = os.path.join(checkpoint_dir(spark), "jobs", uuid.uuid4().hex)
    inp = M.Inputs.load(spark, "/root/testdata/sf0.01")
    for _ in range(2):
        jobs.run_overdraft(spark, inp, dt.date(2001, 2, 15), out)
    od = jobs.fact_table(spark, out, "overdraft", schemas.overdraft()).read().drop("load_date")  # the run that wrote a row
    assert od.count() == M.overdraft_mart(inp, dt.date(2001, 2, 15)).count()
    # the next months' runs add later observations of the stored episodes, as one backfill would
    for run in (dt.date(2001, 3, 15), dt.date(2001, 4, 15), dt.date(2001, 5, 15), dt.date(2001, 6, 15)):
        jobs.run_overdraft(spark, inp, run, out)
    od = jobs.fact_table(spark, out, "overdraft", schemas.overdraft()).read().drop("load_date")  # the run that wrote a row
    back = M.overdraft_mart(inp, dt.date(2001, 6, 15), since=dt.date(2001, 1, 1)).select(od.columns)
    rows = sorted(map(str, od.collect()))
    assert rows == sorted(map(str, back.collect()))
    assert od.where("vintage_offset >= 1").count() > 0
    jobs.run_cohort(spark, inp, dt.date(2001, 9, 1), out, 110, 200, dt.date(1995, 2, 1), None, False, "cohort")
    assert spark.sql("SELECT count(*) FROM v_cohort").first()[0] == M.cohort_mart(
        inp, 110, 200, dt.date(1995, 2, 1), None, dt.date(2001, 9, 1)).count()
