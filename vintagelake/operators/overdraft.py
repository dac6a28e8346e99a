"""Overdraft episodes of a closed month.

Chain: authorisation events of the month (decision 1 approve / 2 decline,
excluded accounts and unit-amount probes removed) -> one state per own
account-month (last approved limit, last processing id, section and decision
counts, exposure) -> resolved account, states merged -> approved only -> full
join with manual releases -> origin class 1-7 -> closing snapshot attached,
unmatched dropped.

The events are scanned once and aggregated once, with map-side combine, before
anything is joined; every later step has one row per account-month.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions import ruleset as R
from vintagelake.functions.periods import previous_month
from vintagelake.operators.aggregates import manual_auth_monthly
from vintagelake.operators.keys import resolve_key
from vintagelake.operators.windows import first_value, last_value_full

KEYS = ["account_id", "year", "month"]


def in_months(first: _dt.date, last: _dt.date) -> Column:
    """Rows whose (year, month) lies between the months of two dates; the year bound reaches the scan."""
    return (F.col("year").between(first.year, last.year)
            & (F.col("year") * 100 + F.col("month")).between(first.year * 100 + first.month, last.year * 100 + last.month))


def decided_events(events: DataFrame, run_date: _dt.date, excluded: Sequence[int] = (),
                   since: _dt.date | None = None) -> DataFrame:
    """K18 part 1: the previous month's decided events (decision 1/2, unit amounts and excluded accounts removed) by
    their own account, with year, month and exposure (balance + amount).  ``since`` starts earlier, for a backfill of
    several months."""
    start, end = previous_month(run_date)
    start = since or start
    e = events.where(F.col("decision").isin("1", "2") & (F.col("auth_amount") != 1)
                     & (F.col("proc_date") >= F.lit(start)) & (F.col("proc_date") <= F.lit(end)))
    if excluded:
        e = e.where(~F.col("account_id").isin(list(excluded)))
    return e.withColumns({"year": F.year("proc_date"), "month": F.month("proc_date"),
                          "exposure": F.col("auth_balance") + F.col("auth_amount")})


def closed_month_events(events: DataFrame, successor_map: DataFrame, run_date: _dt.date,
                        excluded: Sequence[int] = (), since: _dt.date | None = None) -> DataFrame:
    """``decided_events`` resolved to the current account (``track_id``), event by event."""
    return resolve_key(decided_events(events, run_date, excluded, since), successor_map, key="account_id",
                       out="track_id", mode="null")


def event_state(ev: DataFrame, key: str) -> DataFrame:
    """All that an account-month's events tell, in one aggregate whose results merge again (``merged_state``).

    The latest approved limit and the latest processing id are maxima of (date, event id, value); sections, decisions
    and amounts are counts and sums.  So the events are read once and combined before they are shuffled, by their own
    account, and only one row per account-month meets the successor map."""
    approved = F.col("decision") == "1"
    at = [F.col("proc_date"), F.col("event_id")]
    return ev.groupBy(key, "year", "month").agg(
        F.max(F.when(approved, F.struct(*at, "auth_limit"))).alias("last_approved"),
        F.max(F.struct(*at, "spid")).alias("last"),
        F.count_if(F.col("section") == 0).alias("n_zero"),
        F.count_if(F.col("section").isin(1, 2, 3)).alias("n_main"),
        F.count_if(approved).alias("n_approved"),
        F.count_if(F.col("decision") == "2").alias("n_declined"),
        F.max(F.when(approved, F.col("exposure"))).alias("max_exposure"),
        F.sum(F.when(approved, F.col("auth_amount"))).alias("amount_total"))


def merged_state(state: DataFrame, successor_map: DataFrame) -> DataFrame:
    """States by own account (``account_id``) merged into those of the resolved account (``track_id``)."""
    s = resolve_key(state, successor_map, key="account_id", out="track_id", mode="null")
    largest, total = ("last_approved", "last", "max_exposure"), ("n_zero", "n_main", "n_approved", "n_declined", "amount_total")
    return s.groupBy("track_id", "year", "month").agg(*[F.max(c).alias(c) for c in largest],
                                                      *[F.sum(c).alias(c) for c in total])


def overdrafts_of_state(state: DataFrame) -> DataFrame:
    """Account-months with an approved event: excess (max exposure - last approved limit), section mix and counts."""
    out = state.where(F.col("n_approved") > 0)
    return out.select(
        "track_id", "year", "month", F.lit("1").alias("decision"), "max_exposure", "amount_total",
        F.col("n_approved").alias("n_events"), F.col("last_approved.auth_limit").alias("last_limit"),
        F.col("last.spid").alias("last_spid"), "n_approved", "n_declined",
        R.SECTION_MIX.column(n_zero="n_zero", n_main="n_main").alias("section_mix"),
        (F.col("max_exposure") - F.col("last_approved.auth_limit")).alias("excess"))


def month_attributes(ev: DataFrame) -> DataFrame:
    """W8 / W9 per account-month, as aggregates:

    * ``last_limit`` -- FIRST_VALUE(limit of approved rows) ordered approved
      first, latest date first: the limit of the latest approved event, NULL
      when the month has only declines.  ``max_by`` with a NULL ordering key
      for declines (ignored by ``max_by``).
    * ``last_spid`` -- LAST_VALUE(spid) over the full frame ordered by date:
      the processing id of the latest event.

    Same-day ties are arbitrary in the source order; the event id completes
    it.  Aggregates combine map-side, so an account-month that collects many
    accounts (every id resolved onto one successor) never lands whole in one
    task, as a window partition would.
    """
    approved = F.col("decision") == "1"
    order = F.struct("proc_date", "event_id")
    return ev.groupBy("track_id", "year", "month").agg(
        F.max_by(F.col("auth_limit"), F.when(approved, order)).alias("last_limit"),
        F.max_by(F.col("spid"), order).alias("last_spid"))


def window_attributes(ev: DataFrame) -> DataFrame:
    """The same attributes as ``month_attributes`` written as the source's
    window functions (W8 default frame, W9 full frame) on every event row --
    kept for reference and tests; the marts use the aggregate form."""
    part = ["track_id", F.trunc("proc_date", "MM")]
    approved = F.col("decision") == "1"
    return ev.withColumns({
        "last_limit": first_value(F.when(approved, F.col("auth_limit")), part,
                                  [F.when(approved, 0).otherwise(1).asc(), F.col("proc_date").desc(),
                                   F.col("event_id").desc()]),
        "last_spid": last_value_full(F.col("spid"), part, [F.col("proc_date").asc(), F.col("event_id").asc()]),
    })


def section_mix(ev: DataFrame) -> DataFrame:
    """3 = both section 0 and sections 1-3 seen, 1 = only 0, 2 = only 1-3."""
    g = ev.groupBy("track_id", "year", "month").agg(
        F.count_if(F.col("section") == 0).alias("n_zero"),
        F.count_if(F.col("section").isin(1, 2, 3)).alias("n_main"))
    return g.select("track_id", "year", "month", R.SECTION_MIX.column(n_zero="n_zero", n_main="n_main").alias("section_mix"))


def approvals_declines(ev: DataFrame) -> DataFrame:
    """Approved and declined counts per account-month."""
    d = F.col("decision")
    return ev.groupBy("track_id", "year", "month").agg(
        F.countDistinct("track_id").alias("n_accounts"),
        F.sum(F.when(d == "1", 1).otherwise(0)).alias("n_approved"),
        F.sum(F.when(d == "2", 1).otherwise(0)).alias("n_declined"))


def auto_overdrafts(ev: DataFrame) -> DataFrame:
    """Approved automatic overdrafts of resolved events, by one aggregate over them."""
    return overdrafts_of_state(event_state(ev, "track_id"))


def merge_manual(auto: DataFrame, manual_monthly: DataFrame) -> DataFrame:
    """Full outer join of automatic and manual overdrafts on the
    account-month; keys merged; origin class 1-7 (R19) from the month's
    approved count, the manual count and the section mix."""
    a = auto.alias("a")
    m = manual_monthly.select(F.col("account_id").alias("m_id"), F.col("year").alias("m_year"),
                              F.col("month").alias("m_month"), "manual_amount", "manual_count").alias("m")
    j = a.join(m, (F.col("a.track_id") == F.col("m_id")) & (F.col("a.year") == F.col("m_year"))
               & (F.col("a.month") == F.col("m_month")), "full")
    return j.select(
        F.when(F.col("a.track_id").isNull(), F.col("m_id")).otherwise(F.col("a.track_id")).alias("account_id"),
        F.when(F.col("a.year").isNull(), F.col("m_year")).otherwise(F.col("a.year")).alias("origin_year"),
        F.when(F.col("a.month").isNull(), F.col("m_month")).otherwise(F.col("a.month")).alias("origin_month"),
        F.col("last_spid").alias("spid"), F.col("last_limit").alias("limit_auth"),
        F.col("max_exposure").alias("balance_auth"), F.col("amount_total").alias("amount_auth"),
        F.col("excess").alias("overdraft_amount"), F.col("section_mix").alias("section"),
        F.col("n_approved").alias("n_approved"), F.col("n_declined"),
        (F.col("n_events") + F.col("n_declined")).alias("n_decided"),
        F.col("manual_count"),
        (F.coalesce(F.col("n_events"), F.lit(0)) + F.coalesce(F.col("manual_count"), F.lit(0))).alias("total_approved"),
        F.col("manual_amount"),
        (F.coalesce(F.col("amount_total"), F.lit(0)) + F.coalesce(F.col("manual_amount"), F.lit(0))).alias("total_amount"),
        R.OVERDRAFT_ORIGIN.column(auto=F.col("n_approved"), manual=F.col("manual_count"),
                                  section=F.col("section_mix")).alias("origin_class"))


def closing_snapshot(snapshots: DataFrame, successor_map: DataFrame, run_date: _dt.date,
                     families: Sequence[int] = R.FAMILIES_ALL, since: _dt.date | None = None) -> DataFrame:
    """K21 part 1: the closed month's snapshot, resolved ids, open states only
    (``NOT IN ('T')`` also drops NULL states)."""
    closed, _ = previous_month(run_date)
    s = snapshots.where(in_months(since or closed, closed) & F.col("product").isin(list(families)) & ~F.col("state").isin("T"))
    s = resolve_key(s.select("account_id", "year", "month", "product", "balance", "credit_limit"),
                    successor_map, mode="null")
    return s.select("account_id", "year", "month", "product",
                    F.when(F.col("credit_limit") < F.col("balance"), 1).otherwise(0).alias("over_limit"),
                    F.col("balance").alias("closing_balance"))


def attach_closing(merged: DataFrame, closing: DataFrame) -> DataFrame:
    """K21 part 2: left join the closing snapshot, DISTINCT, keep matched."""
    c = closing.select(F.col("account_id").alias("c_id"), F.col("year").alias("c_year"),
                       F.col("month").alias("c_month"), "over_limit", "product", "closing_balance")
    j = merged.join(c, (merged.account_id == c.c_id) & (merged.origin_year == c.c_year)
                    & (merged.origin_month == c.c_month), "left")
    return j.drop("c_id", "c_year", "c_month").distinct().where(F.col("product").isNotNull())


def overdraft_episodes(events: DataFrame, manual: DataFrame, snapshots: DataFrame, successor_map: DataFrame,
                       run_date: _dt.date, excluded: Sequence[int] = (), since: _dt.date | None = None) -> DataFrame:
    """K18-K21 end to end: overdraft episodes of the month before ``run_date``
    (of every month from ``since`` to it: the same rows as a run per month)."""
    state = merged_state(event_state(decided_events(events, run_date, excluded, since), "account_id"), successor_map)
    start, _ = previous_month(run_date)
    nxt = (start.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    merged = merge_manual(overdrafts_of_state(state), manual_auth_monthly(manual, successor_map, since or start, nxt))
    return attach_closing(merged, closing_snapshot(snapshots, successor_map, run_date, since=since))
