"""Plan shape: no cartesian products, filters and projections reach the
parquet scans, the ledger is scanned once per mart."""

import datetime as dt
import os
import re
import uuid

import pytest

import __spark_entry__ as E
from vintagelake.operators import aggregates as G
from vintagelake.operators import panel
from vintagelake.plans import marts as M
from vintagelake.session import checkpoint_dir
from vintagelake.sources import analogues as A

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n != "window_rewrite"))
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_ledger_window_filter_pushed_and_columns_pruned(spark):
    p = _plan(E.queries()["signed_monthly_base"](spark, SF))
    scans = [l for l in p.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert scans
    for s in scans:
        assert "GreaterThanOrEqual(l_shipdate" in s              # the window reaches the scan
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", s).group(1)
        assert "l_quantity" not in cols and "l_tax" not in cols and "l_discount" not in cols


def _scans(plan: str, table: str) -> list[str]:
    return [l for l in plan.splitlines() if "FileScan parquet" in l and table in l]


def test_dispositions_scans_ledger_once(spark):
    inp = M.Inputs.load(spark, SF)
    facts = G.ledger_monthly_facts(inp.ledger, inp.successor_map, dt.date(1995, 1, 1), dt.date(2001, 8, 31))
    assert len(_scans(_plan(facts), "lineitem")) == 1
    p = _plan(E.queries()["dispositions_mart"](spark, SF))
    assert not _scans(p, "lineitem") and _scans(p, "stage-")     # the facts come from their staged table


def test_year_bound_reaches_a_stored_table(spark):
    path = os.path.join(checkpoint_dir(spark), "test_plans", uuid.uuid4().hex)
    A.indicators(spark, "/root/testdata/sf0.001").write.parquet(path)
    p = _plan(G.indicator_pivot(spark.read.parquet(path), since_yyyymm=199801))
    assert "GreaterThanOrEqual(year,1998)" in p


def test_unique_origins_take_no_counts(spark):
    acc = A.accounts(spark, SF)
    origins, snaps = panel.origins_from_accounts(acc), A.snapshots(spark, SF, acc)
    once, counted = (_plan(panel.vintage_delinquency(origins, snaps, unique_origins=u)).count("Exchange")
                     for u in (True, False))
    assert once < counted


def test_overdraft_events_are_read_and_aggregated_once_before_the_map(spark):
    """One scan of the events, and the successor map meets one row per own account-month."""
    import datetime as dt

    from vintagelake.operators import overdraft
    from vintagelake.plans import marts as M
    inp = M.Inputs.load(spark, SF)
    state = overdraft.merged_state(overdraft.event_state(overdraft.decided_events(
        inp.auth_events, dt.date(2001, 2, 15)), "account_id"), inp.successor_map)
    plan = overdraft.overdrafts_of_state(state)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_type") and plan.count("Join") == 1
    scans = [line for line in plan.splitlines() if "Relation" in line and "user_id" in line]
    assert len(scans) == 1
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    aggregates = [i for i, x in enumerate(lines) if "Aggregate" in x]
    assert len(aggregates) == 2 and aggregates[0] < join < aggregates[1]


def test_latest_stored_load_opens_one_folder(spark):
    """The scalar subquery is evaluated before the outer scan lists its files."""
    from pyspark.sql import functions as F

    from vintagelake.operators import windows
    path = os.path.join(checkpoint_dir(spark), "loads", uuid.uuid4().hex)
    rows = spark.range(600).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias("load_date"))
    rows.repartition("load_date").write.partitionBy("load_date").parquet(path)
    df = windows.latest_stored_load(spark.read.parquet(path), "load_date")
    assert sorted(r.id for r in df.collect()) == list(range(11, 600, 12))
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves() if "Adaptive" in plan.getClass().getName() else plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "FileSourceScanExec" in leaves.apply(i).getClass().getName()]
    assert [x.metrics().apply("numPartitions").value() for x in scans] == [1]
    assert [x.metrics().apply("numFiles").value() for x in scans] == [1]


@pytest.mark.parametrize("name", ["dispositions_mart", "dispositions_net_mart"])
def test_fact_rows_are_copied_by_two_projections_at_most(spark, name):
    """Each projection above the vintage join copies every row of the expanded fact."""
    lines = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert 1 <= sum("Project" in x for x in lines[:join]) <= 2


def test_netted_mart_meets_its_hot_keys_as_a_stored_table(spark):
    """Hot keys are known before the expansion is planned, and the initial state is derived once."""
    lines = E.queries()["dispositions_net_mart"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in lines if "__o" in x and "count(1)" in x]
    assert not [x for x in lines if "min(struct(year" in x]


def test_netted_base_sums_its_cells_once(spark):
    plan = E.queries()["net_monthly_base"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Relation" in x and "l_linenumber" in x]) == 1
