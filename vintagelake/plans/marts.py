"""End-to-end marts (E1-E3) composed from the operators.

* ``enriched_snapshot`` -- K27: the account-month snapshot with twelve
  enrichment dimensions (cards, client id, interest pivot, write-off /
  forgiveness, segments, zones, demographics, RFM, income, digital flag).
* ``dispositions_mart`` -- E1: cash-advance vintage fact (K9 base x
  snapshots, bands, score tree, enrichment, final flattening).
* ``overdraft_mart`` -- E2: overdraft episodes x later snapshots with the
  overdraft-form labels.
* ``cohort_mart`` -- E3: new-account cohort x monthly snapshots.

Each returns a lazy DataFrame; writing (window rewrite, publish, control
totals) is done by :mod:`vintagelake.plans.jobs` with the sinks module.

Plan shape: every enrichment dimension is aggregated to its join key
before the join (no fan-out, map-side combine); account-month dimensions
are joined first and account-only ones after, so consecutive joins share a
shuffle; store and zone dimensions are bounded by the number of stores and
are left to the size-checked broadcast planner.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vintagelake.functions import periods as P
from vintagelake.functions import ruleset as R
from vintagelake.operators import aggregates as G
from vintagelake.operators import clients, enrich, keys, overdraft, panel, windows
from vintagelake.operators.enrich import Dim
from vintagelake.sources import analogues as A
from vintagelake.session import compiled_ladders, stage, stage_counted

AM = ["account_id", "year", "month"]


@dataclass
class Inputs:
    """The derived input shapes of one scale factor."""

    accounts: DataFrame
    successor_map: DataFrame
    snapshots: DataFrame
    ledger: DataFrame
    cards: DataFrame
    indicators: DataFrame
    clients: DataFrame
    stores: DataFrame
    zone_history: DataFrame
    macro_old: DataFrame
    macro_new: DataFrame
    client_segments: DataFrame
    rfm: DataFrame
    income: DataFrame
    auth_events: DataFrame
    manual_auths: DataFrame
    applications: DataFrame
    client_history: DataFrame
    policies: DataFrame

    @staticmethod
    def load(spark: SparkSession, sf_dir: str, pin: bool = False) -> "Inputs":
        """``pin`` stages the account dimension, from which most other shapes derive: for plans that read many of them."""
        acc = A.accounts(spark, sf_dir)
        if pin:
            acc = stage(acc)
        return Inputs(acc, A.successor_map(spark, sf_dir), A.snapshots(spark, sf_dir, acc),
                      A.ledger(spark, sf_dir, acc), A.cards(spark, sf_dir), A.indicators(spark, sf_dir, acc),
                      A.clients(acc), A.stores(spark, sf_dir), A.zone_history(spark, sf_dir),
                      A.macro_segments(spark, sf_dir, "old"), A.macro_segments(spark, sf_dir, "new"),
                      A.client_segments(spark, sf_dir), A.rfm_segments(spark, sf_dir), A.inferred_income(spark, sf_dir),
                      A.auth_events(spark, sf_dir), A.manual_auths(spark, sf_dir),
                      A.applications(spark, sf_dir, acc), A.client_history(spark, sf_dir), A.policies(spark, sf_dir))


def digital_ids(cards: DataFrame) -> DataFrame:
    """Digital-channel users: free-text card numbers, parsed with SAFE_CAST."""
    text = cards.select(F.when(F.col("card_no") % 4 == 0, F.col("account_id").cast("string"))
                        .otherwise(F.concat(F.lit("X"), F.col("account_id").cast("string"))).alias("card_text"))
    return enrich.parse_account_ids(text, "card_text")


def latest_client_segment(segments: DataFrame) -> DataFrame:
    """One segment per account-month, highest segment value first."""
    return windows.latest_by_aggregate(segments, AM, F.col("segment_client"), ["segment_client"])


def segment_and_client(segments: DataFrame) -> DataFrame:
    """W1 with the unified client id of the picked row; ties by the larger id."""
    return windows.latest_by_aggregate(segments, AM, F.struct("segment_client", "client_uid"),
                                       ["segment_client", "client_uid"])


def monthly_income(income: DataFrame) -> DataFrame:
    """Inferred income aggregated to the account-month join key (the
    source can hold several observations per month -- joining it raw would
    fan out the base)."""
    return (income.groupBy("account_id", F.year("follow_date").alias("year"), F.month("follow_date").alias("month"))
            .agg(F.max("income").alias("income")))


CLIENT_COLUMNS = ("client_id", "previous_id", "client_open_date")
MACRO_SPLIT = (enrich.MACRO_FIRST, enrich.MACRO_SECOND)


def enriched_snapshot(inp: Inputs, run_date: _dt.date, macro_split: tuple = MACRO_SPLIT) -> DataFrame:
    """Prepared snapshot plus twelve left-joined dimensions."""
    base = panel.prepare_snapshot(inp.snapshots).select(
        "account_id", "year", "month", "product", "store_id", "balance", "credit_limit", "util_ratio",
        "limit_band", "balance_band")
    ym = {"account_id": "account_id", "year": "year", "month": "month"}
    acc_on = {"account_id": "account_id"}
    pivot = G.indicator_pivot(inp.indicators, with_total=False)
    txn = G.txn_monthly(inp.ledger)
    seg = enrich.segment_history(inp.macro_old, inp.macro_new, *macro_split).select(*AM, "segment_official")
    dims = [
        Dim(pivot, ym, ["int_fin", "int_mor", "int_msi"], {"int_fin": 0, "int_mor": 0, "int_msi": 0}, unique=True),
        Dim(txn, ym, ["write_off_amount", "write_off_count", "write_off_date", "forgiveness_amount",
                      "forgiveness_count"],
            {"write_off_amount": 0, "write_off_count": 0, "forgiveness_amount": 0, "forgiveness_count": 0},
            unique=True),
        Dim(latest_client_segment(inp.client_segments), ym, ["segment_client"], unique=True),
        Dim(seg, ym, ["segment_official"], unique=True),
        Dim(inp.rfm, ym, ["rfm"], unique=True),
        Dim(monthly_income(inp.income), ym, ["income"], unique=True),
        Dim(G.card_counts(inp.cards), acc_on, ["n_addon", "n_primary"], {"n_addon": 0, "n_primary": 0},
            unique=True),
        Dim(G.unified_customer(inp.cards), acc_on, ["client_uid"], unique=True),
        Dim(clients.by_load_date(clients.visible(inp.client_history)).select("account_id", "sex", "birth_date"), acc_on,
            ["sex", "birth_date"], unique=True),
        Dim(digital_ids(inp.cards).withColumn("digital_flag", F.lit("1")), acc_on, ["digital_flag"],
            {"digital_flag": "0"}, unique=True),
        Dim(inp.stores, {"store_id": "store_id"}, ["zone_code"], unique=True),
        Dim(enrich.zone_normalise(inp.zone_history), {"store_id": "store_id"}, ["zone", "zone_id"], unique=True),
    ]
    out = enrich.demographic_labels(enrich.star_join(base, dims), run_date)
    return out.withColumn("macro_segment", enrich.macro_segment_label(F.col("segment_official"))).drop(
        "segment_official")


# ---------------------------------------------------------------------------
# E1 dispositions
# ---------------------------------------------------------------------------
def fact_panel(base: DataFrame, snap: DataFrame, hot: DataFrame) -> DataFrame:
    """Vintage panel of the dispositions facts, with the months that many labels read set once per origin and snapshot."""
    base = base.withColumns({
        "origin_yyyymm": P.yyyymm("origin_year", "origin_month"),
        "mob_origin": P.month_offset(F.year("open_date"), F.month("open_date"), F.col("origin_year"), F.col("origin_month")),
    })
    return panel.vintage_panel(base, snap.withColumn("obs_yyyymm", P.yyyymm("year", "month")), hot=hot)


def fact_labels(p: DataFrame, risk: R.RuleTable, load_date: _dt.date) -> DataFrame:
    """Offsets, bands, labels and flags of the dispositions facts over their enriched panel (``fact_panel``).

    In two steps, as each is a projection that copies every row of the expanded panel: first what other labels read more
    than once, then all the others.
    """
    compiled_ladders(p.sparkSession)
    open_y, open_m = F.year("open_date"), F.month("open_date")
    zone_in = F.when(F.col("product").isin(100, 110), F.col("zone_code")).otherwise(F.col("zone"))
    p = p.withColumns({
        "mob": P.month_offset(open_y, open_m, F.col("year"), F.col("month")),
        # the snapshot's own product rules its balance, risk, node and rate; the ledger's rules the rest
        "node": R.SCORE_TREE_NODE.column(period="obs_yyyymm", product="obs_product", brand="brand", mob="mob_origin",
                                         score="score"),
        "zone_raw": zone_in,
        "age": P.age_from_yyyymm("obs_yyyymm", P.yyyymm(F.year("birth_date"), F.month("birth_date"))),
    })
    wo, fg, interest = F.col("write_off_rows") > 0, F.col("forgiveness_rows") > 0, F.col("int_fin").isNotNull()
    horizon = P.horizon_bucket("vintage_offset", 3)
    return p.withColumns({
        "mob_band": R.MOB_BAND.column(mob="mob"),
        "horizon": P.horizon_bucket("vintage_offset", 4),
        "util_band": R.UTILISATION_BAND.column(ratio="util_ratio"),
        "limit_band": R.LIMIT_BAND_PUBLISHED.column(product="product", amount="credit_limit"),
        "balance_band": R.AMOUNT_BAND.column(product="obs_product", amount="balance"),
        "delinquency": R.DELINQUENCY_LABEL.column(level="level"),
        "flag_30": R.FLAG_30.column(level="level"),
        "flag_90": R.FLAG_90.column(level="level"),
        "risk_level": risk.column(product="obs_product", period="obs_yyyymm", score="score"),
        "node_label": R.NODE_LABEL.column(product="product", period="obs_yyyymm", node="node"),
        "rate_tier": R.RATE_TIER_SINGLE.column(product="obs_product", rate="rate"),
        "paper_channel": R.STATEMENT_CHANNEL_SHORT.column(flag="stmt_flag"),
        "cosecha": F.when(F.col("origin_year") < 2009, F.lit(2009)).otherwise(F.col("origin_yyyymm")),
        "has_balance": F.when(F.col("balance") > 0, 1).otherwise(0),
        "opening_band": F.when(F.col("product").isin(110, 100),
                               R.OPENING_YEAR_BAND.column(product="product", open_year=open_y))
        .when(F.col("product").isin(210, 200) & (open_y >= 2018), open_y.cast("string")).otherwise(F.lit("NO")),
        "int_total": F.col("int_fin") + F.col("int_mor"),
        # account 0 (no account) never counts as one with a write-off
        "write_off_flag": F.when(wo & (F.col("account_id") != 0), 1).otherwise(0),
        "forgiveness_flag": F.when(fg & (F.col("account_id") != 0), 1).otherwise(0),
        "write_off_horizon": F.when(wo, horizon).otherwise(F.lit("OTRO")),
        "write_off_offset": F.when(wo, F.col("vintage_offset")),
        "interest_horizon": F.when(interest, horizon).otherwise(F.lit("OTRO")),
        "instalment_horizon": F.when(interest, horizon).otherwise(F.lit("OTRO")),
        # a set without a row of its codes is absent, also where the other set has some
        **{c: F.when(wo, F.col(c)) for c in ("write_off_amount", "write_off_rows")},
        **{c: F.when(fg, F.col(c)) for c in ("forgiveness_amount", "forgiveness_rows")},
        "macro_segment": enrich.macro_segment_label(F.col("segment_official")),
        # after the join: an account without a client row of the source system has the label of no code
        "sex": R.SEX_FROM_CODE.column(gen="gender_code"),
        "age_band": R.AGE_BAND_FACT.column(age="age"),
        "zone_label": R.ZONE_LABEL_FACT.column(product="product", zone="zone_raw", store="store_id"),
        "load_date": F.lit(load_date),
    })


@dataclass
class DispositionsParts:
    """Staged inputs of the dispositions fact, where a job has them already, and what it observes of the panel."""

    facts: DataFrame
    base: DataFrame
    cards: DataFrame
    client_uids: DataFrame
    panel_rows: Observation


def dispositions_mart(inp: Inputs, start: _dt.date, end: _dt.date, load_date: _dt.date,
                      parts: DispositionsParts | None = None,
                      observed: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """Cash-advance vintage fact for the window [start, end].

    ``observed`` keeps the rows of some observation months only: the filter reaches the snapshots and every source
    keyed by month, so a stored month is pruned to its folder.

    ``facts`` (``ledger_monthly_facts``) feeds both the cash-advance base and
    the write-off/forgiveness dimension; it is staged (checkpointed) so the
    ledger -- the largest input -- is scanned and shuffled once.
    """
    facts = parts.facts if parts else stage(G.ledger_monthly_facts(inp.ledger, inp.successor_map, start, end))
    base = parts.base if parts else G.cash_advance_base(facts, inp.accounts)
    # only a job that observes the panel tells the copies of a row apart
    copies = ("__snap_first", "__base_first") if parts else (None, None)
    def seen(df):
        return df if observed is None else df.where(overdraft.in_months(*observed))

    # the window bounds the ledger only: every observation month on or after the origin counts
    snap = keys.resolve_key(
        seen(inp.snapshots).select(
            "account_id", "year", "month", F.col("product").alias("obs_product"), "brand", "state", "store_id",
            "balance", "credit_limit", "rate", "level", "score", "stmt_flag", "totalero_flag"),
        inp.successor_map, mode="inverse")
    bal, lim = F.col("balance"), F.col("credit_limit")
    snap = snap.withColumns({
        "util_ratio": panel.utilisation_nonpositive(bal, lim),
    })
    hot = panel.hot_keys(base, snap)

    # Enrichment BEFORE the vintage expansion: account-month dimensions are
    # keyed like the snapshot rows (account, observation month) and join
    # there; account dimensions join the base.  The expanded panel -- the
    # largest dataset of the job -- is then never shuffled again.
    ym = {"account_id": "account_id", "year": "year", "month": "month"}
    acc_on = {"account_id": "account_id"}
    months = (F.col("year") * 100 + F.col("month")).between(start.year * 100 + start.month,
                                                             end.year * 100 + end.month)
    pivot = G.resolve_and_sum(
        G.indicator_pivot(seen(inp.indicators.where(months)), with_total=False).select(
            *AM, "int_fin", "int_mor", F.col("int_msi_any").alias("int_msi")),
        inp.successor_map, "zero", AM, ["int_fin", "int_mor", "int_msi"])
    codes = G.code_sets_from_facts(seen(facts))
    fees = G.commissions(seen(inp.indicators))
    seg = seen(enrich.segment_of_latest_date(inp.macro_old))
    # the zone name as it stands in the latest load, not cleaned
    zones = windows.latest_load(inp.zone_history, "load_date").select("store_id", F.col("zone_desc").alias("zone"))
    demo = clients.by_load_date(clients.visible(inp.client_history)).select(
        "account_id", "birth_date", "gender_code")
    snap = enrich.star_join(snap, [
        # absent amounts and counts stay NULL
        Dim(pivot, ym, ["int_fin", "int_mor", "int_msi"], unique=True),
        Dim(codes, ym, ["write_off_amount", "write_off_rows", "forgiveness_amount", "forgiveness_rows"],
            unique=True),
        Dim(fees, ym, ["fee_amount"], unique=True),
        Dim(seg, ym, ["segment_official"], unique=True),
        Dim(latest_client_segment(seen(inp.client_segments)), ym, ["segment_client"], unique=True),
        Dim(inp.stores, {"store_id": "store_id"}, ["zone_code"], unique=True),
        Dim(zones, {"store_id": "store_id"}, ["zone"], unique=True),
    ], copies[0])
    base = enrich.star_join(base, [
        Dim(parts.cards if parts else G.card_counts(inp.cards), acc_on, ["n_addon", "n_primary"], unique=True),
        Dim(parts.client_uids if parts else G.unified_customer(inp.cards), acc_on, ["client_uid"], unique=True),
        Dim(digital_ids(inp.cards).withColumn("digital_flag", F.lit("1")), acc_on, ["digital_flag"],
            {"digital_flag": "0"}, unique=True),
        Dim(demo, acc_on, ["birth_date", "gender_code"], unique=True),
    ], copies[1])

    p = fact_panel(base, snap, hot)
    if parts:
        p = p.observe(parts.panel_rows, F.count_if(F.col(copies[0]) & F.col(copies[1])).alias("panel"),
                      F.count(F.lit(1)).alias("enriched"))
    e = fact_labels(p, R.RISK_EFFECTIVE, load_date)
    # The reference ends with SELECT DISTINCT; here every input is unique on its
    # key (base per account/product/origin/plan, resolved snapshot per
    # account-month, dimensions per key), so the rows are already distinct and
    # the 60-column DISTINCT -- a full shuffle of the fact -- is dropped.
    return e.select(*DISPOSITIONS_COLUMNS)


DISPOSITIONS_COLUMNS = [
    "account_id", "product", "origin_year", "origin_month", "origin_yyyymm", "plan", "channel", "n_txn", "amount",
    "open_date", "year", "month", "obs_yyyymm", "vintage_offset", "mob", "mob_origin", "mob_band", "horizon",
    "state", "balance", "credit_limit", "util_ratio", "util_band", "limit_band", "balance_band", "level",
    "delinquency", "flag_30", "flag_90", "score", "risk_level", "node", "node_label", "rate", "rate_tier",
    "paper_channel", "cosecha", "has_balance", "opening_band", "n_addon", "n_primary", "client_uid", "int_fin",
    "int_mor", "int_total", "int_msi", "fee_amount", "digital_flag", "macro_segment", "write_off_flag",
    "write_off_amount", "write_off_rows", "forgiveness_flag", "forgiveness_amount", "forgiveness_rows",
    "age", "age_band", "sex", "zone_label", "brand", "store_id", "zone_raw", "totalero_flag", "segment_client",
    "write_off_horizon", "write_off_offset", "interest_horizon", "instalment_horizon", "load_date",
]


def dispositions_stages(inp: Inputs, start: _dt.date, end: _dt.date, load_date: _dt.date, own_facts: DataFrame | None = None,
                        observed: tuple[_dt.date, _dt.date] | None = None) -> tuple[DataFrame, list[tuple[str, str, DataFrame | int]]]:
    """The staged fact of E1 and the (step, table, rows) of its control totals.

    Each staged table is evaluated once and counted while it is written.  The panel is counted in the evaluation of the
    fact: its rows are those not made by a repeated dimension key, the enriched rows are all.  The two are equal unless a
    dimension breaks its key; only then is the fact's DISTINCT worth its shuffle, and the last count comes after it.
    ``own_facts`` are stored ledger facts of the window by own account, in place of a scan of the ledger.
    """
    if own_facts is None:
        own_facts = G.own_monthly_facts(inp.ledger, start, end)
    facts = stage(G.resolved_facts(own_facts, inp.successor_map))
    cards, n_cards = stage_counted(G.card_counts(inp.cards))
    uids, n_uids = stage_counted(G.unified_customer(inp.cards))
    base, n_base = stage_counted(G.cash_advance_base(facts, inp.accounts))
    seen = Observation()
    fact, n_fact = stage_counted(dispositions_mart(inp, start, end, load_date, DispositionsParts(facts, base, cards, uids, seen),
                                                     observed))
    n_panel, n_enriched = seen.get["panel"], seen.get["enriched"]
    if n_enriched > n_panel:
        fact, n_fact = stage_counted(fact.distinct())
    return fact, [
        ("01 TMP_1_CARD_COUNTS", "TMP_1_CARD_COUNTS", n_cards),
        ("02 TMP_2_UNIFIED_CLIENT", "TMP_2_UNIFIED_CLIENT", n_uids),
        ("02 TMP_3_BASE", "TMP_3_BASE", n_base),
        ("03 TMP_3_BASE", "TMP_3_BASE", n_base),
        ("04 TMP_4_PANEL", "TMP_4_PANEL", n_panel),
        ("05 TMP_5_ENRICHED", "TMP_5_ENRICHED", n_enriched),
        ("06 TMP_6_FACT", "TMP_6_FACT", n_fact),
    ]


def target_step(target: DataFrame, start: _dt.date, end: _dt.date) -> tuple[str, str, DataFrame]:
    """The last control row: what the target holds of the window before the rewrite."""
    months = F.col("obs_yyyymm").between(start.year * 100 + start.month, end.year * 100 + end.month)
    return "07 DISPOSITIONS", "DISPOSITIONS", target.where(months)


# ---------------------------------------------------------------------------
# E2 overdraft
# ---------------------------------------------------------------------------
# FIXED VALUES: the overdraft fact's zone labels and its store exceptions.
OVERDRAFT_ZONES = (("VAD", "Canal Digital"), ("1", "1. Metro Sur"), ("2", "2. Metro Norte"), ("3", "3. Centro"),
                   ("4", "4. Occidente"), ("5", "5. Golfo"), ("6", "6. Noreste"), ("7", "7. Bajio"),
                   ("8", "8. Noroeste"), ("9", "9. Sureste"))
OVERDRAFT_DIGITAL_STORES = ("0782", "0039")
OVERDRAFT_OTHER_STORES = ("0687", "0024", "0329", "0778")
WEB_PURCHASE_CODES = (1, 101)


def overdraft_zone(product, store, zone_name, zone_code):
    """Zone label of the overdraft fact: zone name for the bank-card families, zone code for the store cards."""
    card, by_code = product.isin(210, 200, 220), F.create_map(*[F.lit(x) for pair in OVERDRAFT_ZONES for x in pair])
    return (F.when(card & store.isin(*OVERDRAFT_DIGITAL_STORES), "Canal Digital")
            .when(card & store.isin(*OVERDRAFT_OTHER_STORES), "Otro").when(card, zone_name)
            .when(product.isin(100, 110), F.coalesce(F.try_element_at(by_code, zone_code), F.lit("Otro")))
            .otherwise("Otro"))


def overdraft_mart(inp: Inputs, run_date: _dt.date, excluded: Sequence[int] = (), web_stores: Sequence[str] = (),
                   episodes: DataFrame | None = None, since: _dt.date | None = None,
                   web_codes: Sequence[int] = WEB_PURCHASE_CODES, web_since: _dt.date | None = None,
                   macro_split: tuple = MACRO_SPLIT) -> DataFrame:
    """Every stored overdraft episode x its account's snapshot of the
    closed month, with overdraft-form labels.

    ``episodes`` is the stored episode table (all origin months); absent, the
    episodes are built from the events.  ``since`` starts a backfill: it gives
    the rows that a run for each month from then on would have appended.
    """
    closed, last = P.previous_month(run_date)
    first = since or closed
    if episodes is None:
        episodes = overdraft.overdraft_episodes(inp.auth_events, inp.manual_auths, inp.snapshots, inp.successor_map,
                                                run_date, excluded, since)
    # the episodes feed the panel and every dimension's key filter:
    # staged once (a small table) so the episode chain runs once
    ep = stage(episodes.select("account_id", "origin_year", "origin_month", "product", *EPISODE_COLUMNS).distinct())
    keys_ = ep.select("account_id").distinct()
    seen = overdraft.in_months(first, last)

    def resolved(df):
        """Rows of the episodes' accounts, by resolved id: resolved first, so that old ids count too."""
        return keys.resolve_key(df, inp.successor_map, mode="zero").join(keys_, "account_id", "left_semi")

    # One snapshot per resolved account-month; the state filter comes after the pick
    snap = windows.latest(resolved(inp.snapshots.where(seen)), AM,
                          [F.col("state").asc_nulls_first(), F.col("product").desc_nulls_last(),
                           F.col("brand").desc_nulls_last()],
                          [F.col(c).asc_nulls_first() for c in SNAPSHOT_TIES])
    snap = panel.prepare_snapshot(snap).withColumnRenamed("product", "obs_product")
    acc = inp.accounts.select(F.col("account_id").alias("a_id"), "open_date")
    # one snapshot and one episode per account-month: no key is hot
    p = panel.vintage_panel(ep, snap.where(~F.col("state").isin("T")), salt_buckets=1)
    p = p.join(acc, p.account_id == acc.a_id, "left").drop("a_id")
    mob_origin = P.month_offset(F.year("open_date"), F.month("open_date"), F.col("origin_year"), F.col("origin_month"))
    p = p.withColumns({
        "mob_origin": mob_origin,
        "cd2": R.CD2_FLAG.column(level="level"),
        "cd2_plus": R.ENTRY_FLAG.column(level="level"),
        "mob_cd2": F.when(F.col("level") == 2, F.col("vintage_offset")).otherwise(F.lit(0)),
        "pay_max": enrich.payment_code_max(F.col("pay_history")),
        "util_band": R.UTILISATION_BAND.column(ratio="util_ratio"),
        "delinquency": R.DELINQUENCY_LABEL.column(level="level"),
        "statement": R.STATEMENT_CHANNEL.column(flag=F.trim("stmt_flag")),
        "rate_tier": R.RATE_TIER.column(product="obs_product", rate="rate"),
        "vintage_text": F.when((F.col("origin_year") < 2009) | F.col("origin_year").isNull(), F.lit("<2009"))
        .otherwise(F.concat(F.col("origin_year").cast("string"), F.lpad(F.col("origin_month").cast("string"), 2, "0"))),
        "has_balance": F.when(F.col("balance") > 0, F.lit("0")).otherwise(F.lit("1")),
        "horizon": P.horizon_bucket("vintage_offset", 3),
    })
    p = p.withColumns({
        "level_2": R.TREE_LEVEL_2.column(product="product", mob="mob_origin"),
        "level_3": R.TREE_LEVEL_3.column(product="product", score="score"),
        "node_id": R.TREE_NODE_ID.column(product="product", mob="mob_origin", score="score"),
    })
    p = p.withColumns({
        "mob": P.month_offset(F.year("open_date"), F.month("open_date"), F.col("year"), F.col("month")),
        "risk_level": R.RISK_OVERDRAFT.column(product="product", origin=P.yyyymm("origin_year", "origin_month"),
                                              obs="obs_yyyymm", score="score"),
        "flag_30": R.FLAG_30_TEXT.column(level="level"),
        "flag_90": R.FLAG_90_TEXT.column(level="level"),
    })
    p = p.withColumns({"mob_band": R.MOB_BAND_OVERDRAFT.column(mob="mob"),
                       "mob_band_numbered": R.MOB_BAND_NUMBERED.column(mob="mob_origin")})
    ym = {"account_id": "account_id", "year": "year", "month": "month"}
    acc_on = {"account_id": "account_id"}
    led = inp.ledger.where(F.col("txn_date").between(F.lit(first), F.lit(last)))
    pivot = resolved(G.indicator_pivot(inp.indicators.where(seen), with_total=False)).groupBy(*AM).agg(
        *[F.sum(c).alias(c) for c in ("int_fin", "int_mor", "int_msi")])
    sums = ["write_off_amount", "write_off_count", "forgiveness_amount", "forgiveness_count"]
    txn = resolved(G.txn_monthly(led)).groupBy(*AM).agg(*[F.sum(c).alias(c) for c in sums],
                                                        F.max("write_off_date").alias("write_off_date"))
    rfm = resolved(inp.rfm.where(seen)).groupBy(*AM).agg(F.max("rfm").alias("rfm"))
    macro = enrich.segment_history(inp.macro_old, inp.macro_new, *macro_split).select(
        *AM, F.col("segment_official").alias("macro_segment_code"))
    demo = clients.by_previous_id(clients.visible(inp.client_history).join(keys_, "account_id", "left_semi")).select(
        "account_id", "birth_date", "gender_code", *CLIENT_COLUMNS)
    web = G.online_months(inp.ledger.join(keys_, "account_id", "left_semi"), web_stores, web_codes, web_since)
    dims = [
        Dim(pivot, ym, ["int_fin", "int_mor", "int_msi"], {"int_fin": 0, "int_mor": 0, "int_msi": 0}, unique=True),
        Dim(txn, ym, [*sums, "write_off_date"], dict.fromkeys(sums, 0), unique=True),
        Dim(segment_and_client(resolved(inp.client_segments.where(seen))).select(
            *AM, "segment_client", "client_uid", F.col("year").alias("segment_year"), F.col("month").alias("segment_month")),
            ym, ["segment_client", "client_uid", "segment_year", "segment_month"], unique=True),
        Dim(rfm, ym, ["rfm"], unique=True),
        Dim(macro, ym, ["macro_segment_code"], unique=True),
        Dim(monthly_income(inp.income), ym, ["income"], unique=True),
        # the web purchase counts in the month of the overdraft
        Dim(web.withColumn("web_flag", F.lit(1)),
            {"account_id": "account_id", "origin_year": "year", "origin_month": "month"}, ["web_flag"],
            {"web_flag": 0}, unique=True),
        Dim(digital_ids(inp.cards).withColumn("digital_flag", F.lit("1")), acc_on, ["digital_flag"],
            {"digital_flag": "0"}, unique=True),
        Dim(G.card_counts(inp.cards, distinct=True), acc_on, ["n_addon", "n_primary"],
            {"n_addon": 0, "n_primary": 0}, unique=True),
        Dim(demo, acc_on, ["birth_date", "gender_code", *CLIENT_COLUMNS], unique=True),
        Dim(enrich.insured_ids(inp.policies, accounts=keys_).withColumn("insured_flag", F.lit(1)), acc_on, ["insured_flag"],
            {"insured_flag": 0}, unique=True),
        Dim(enrich.zone_normalise(inp.zone_history), {"store_id": "store_id"}, ["zone", "zone_id"], unique=True),
        Dim(inp.stores, {"store_id": "store_id"}, ["zone_code", "state_code"], unique=True),
    ]
    p = enrich.star_join(p, dims)
    p = p.withColumns({
        "gender": R.GENDER_FROM_CODE.column(gen="gender_code"),
        "age": F.col("origin_year") - F.year("birth_date"),
        "age_band": R.AGE_BAND_OVERDRAFT.column(age=F.col("origin_year") - F.year("birth_date")),
        "origin_yyyymm": P.yyyymm("origin_year", "origin_month"),
        "rate_level": R.RATE_LEVEL.column(rate="rate"),
        # the write-off counts in the month of the snapshot
        "write_off_horizon": F.when(F.col("write_off_date").isNotNull(), F.col("horizon")).otherwise(F.lit("OTRO")),
        "total_label": F.lit("1. TOTAL"),
        "node_age_label": F.lit("2. 2 AL 5"),
        "off_flag": F.lit("0"),
        "load_date": F.lit(run_date),
        **{c: F.lit(None).cast(kind) for c, kind in OVERDRAFT_NULLS.items()},
        "int_total": F.col("int_fin") + F.col("int_mor"),
        "zone_label": overdraft_zone(F.col("product"), F.col("store_id"), F.col("zone"), F.col("zone_code")),
    })
    return p.select(*OVERDRAFT_COLUMNS)


# columns of the stored episode that the fact passes on
EPISODE_COLUMNS = ["origin_class", "overdraft_amount", "total_amount", "total_approved", "section", "spid", "limit_auth",
                   "balance_auth", "amount_auth", "n_approved", "n_declined", "n_decided", "manual_count", "manual_amount",
                   "over_limit", "closing_balance"]
# columns of the published fact that nothing fills, with their types
OVERDRAFT_NULLS = {
    "current_account": "decimal(38,9)", "original_account": "decimal(38,9)", "source_system": "int", "last_purchase_date": "date",
    "employee_number": "decimal(38,9)", "strategy_key": "decimal(38,9)", "txn_count": "decimal(38,9)",
    "track_account": "decimal(38,9)", "score_text": "string", "client_age": "int", "client_gender": "int", "sex": "string",
    "run_load_date": "int", "open_year_band": "int"}
SNAPSHOT_TIES = ["store_id", "balance", "credit_limit", "rate", "level", "score", "stmt_flag", "pay_history"]


OVERDRAFT_COLUMNS = [
    "account_id", "origin_year", "origin_month", "origin_class", "overdraft_amount", "total_amount",
    "total_approved", "section", "year", "month", "obs_yyyymm", "vintage_offset", "horizon", "product", "balance",
    "credit_limit", "util_ratio", "util_band", "limit_band", "balance_band", "level", "delinquency", "cd2",
    "cd2_plus", "mob_cd2", "mob_origin", "level_2", "level_3", "node_id", "pay_max", "statement", "rate_tier",
    "vintage_text", "has_balance", "zone", "zone_id", "mob", "risk_level", "flag_30", "flag_90", "mob_band",
    "mob_band_numbered", "int_fin", "int_mor", "int_total", "int_msi", "write_off_amount", "write_off_count",
    "forgiveness_amount", "forgiveness_count", "web_flag", "digital_flag", "gender", "age_band",
    "obs_product", "state", "brand", "store_id", "headroom", "segment_client", "rfm", "macro_segment_code", "income",
    "n_addon", "n_primary", "zone_label", "state_code", "insured_flag", "spid", "limit_auth", "balance_auth", "amount_auth",
    "n_approved", "n_declined", "n_decided", "manual_count", "manual_amount", "over_limit", "closing_balance", "origin_yyyymm",
    "open_date", "rate", "rate_level", "score", "totalero_flag", "client_uid", "segment_year", "segment_month", "client_id",
    "previous_id", "client_open_date", "birth_date", "gender_code", "age", "write_off_date", "write_off_horizon", "total_label",
    "node_age_label", "off_flag", "load_date", *OVERDRAFT_NULLS,
]


# ---------------------------------------------------------------------------
# E3 cohort
# ---------------------------------------------------------------------------
def cohort_mart(inp: Inputs, product: int, brand: int, since: _dt.date, stores: Sequence[str] | None,
                run_date: _dt.date, with_applications: bool = False) -> DataFrame:
    """Cohort of new accounts x monthly snapshots of the same brand from
    the opening month (state 'T' and NULL states dropped), cohort-variant
    labels.  The second cohort also carries the application status (K26) and
    the load date."""
    coh = panel.cohort(inp.accounts, inp.clients, product, brand, since, stores)
    coh = coh.select("account_id", F.col("open_year").alias("origin_year"), F.col("open_month").alias("origin_month"),
                     F.col("store_id").alias("open_store"), "sex", "birth_date",
                     P.calendar_years(F.lit(run_date), F.col("birth_date")).alias("age"))
    since_yyyymm = since.year * 100 + since.month
    snap = panel.prepare_snapshot(inp.snapshots.where(F.col("brand") == brand), since_yyyymm,
                                  R.AMOUNT_BAND_COHORT, R.AMOUNT_BAND_COHORT)
    p = panel.vintage_panel(coh, snap.where(~F.col("state").isin("T")), unique_origins=True)
    # dimension sources restricted to the cohort's accounts before aggregating
    keys_ = coh.select("account_id").distinct()
    pivot = G.indicator_pivot(inp.indicators.join(keys_, "account_id", "left_semi"), since_yyyymm=since_yyyymm,
                              with_total=False)
    txn = G.txn_monthly(inp.ledger.join(keys_, "account_id", "left_semi"), since=_dt.date(since.year, since.month, 1))
    # the cohorts read one generation of the macro segments, their code as it stands
    macro = enrich.segment_latest(inp.macro_old.join(keys_, "account_id", "left_semi")).select(
        *AM, F.col("segment_official").alias("macro_segment_code"))
    ym = {"account_id": "account_id", "year": "year", "month": "month"}
    dims = [
        Dim(pivot, ym, ["int_fin", "int_mor", "int_msi"], {"int_fin": 0, "int_mor": 0, "int_msi": 0}, unique=True),
        Dim(txn, ym, ["write_off_amount", "write_off_count", "write_off_date", "forgiveness_amount",
                      "forgiveness_count"],
            {"write_off_amount": 0, "write_off_count": 0, "forgiveness_amount": 0, "forgiveness_count": 0},
            unique=True),
        Dim(segment_and_client(inp.client_segments.join(keys_, "account_id", "left_semi")), ym,
            ["segment_client", "client_uid"], unique=True),
        Dim(macro, ym, ["macro_segment_code"], unique=True),
        Dim(inp.rfm, ym, ["rfm"], unique=True),
        Dim(monthly_income(inp.income), ym, ["income"], unique=True),
        Dim(digital_ids(inp.cards).withColumn("digital_flag", F.lit(1)), {"account_id": "account_id"},
            ["digital_flag"], {"digital_flag": 0}, unique=True),
        Dim(inp.stores, {"open_store": "store_id"}, ["zone_code"], unique=True),
    ]
    e = enrich.star_join(p, dims)
    e = e.withColumns({
        "int_total": F.col("int_fin") + F.col("int_mor"),
        "entry_flag": R.ENTRY_FLAG.column(level="level"),
        "risk_letter": R.RISK_LETTERS.column(score="score"),
        "delinquency": R.DELINQUENCY_LABEL.column(level="level"),
        "util_band": R.UTILISATION_BAND.column(ratio="util_ratio"),
        "zone_label": R.ZONE_LABEL_COHORT.column(product="product", zone="zone_code"),
        "gender": R.GENDER_FROM_LETTER.column(sex="sex"),
        "flag_30": R.FLAG_30.column(level="level"),
        "flag_90": R.FLAG_90.column(level="level"),
        "age_band": R.AGE_BAND_COHORT.column(age="age"),
        "rate_tier": R.RATE_TIER_COHORT.column(product="product", rate="rate"),
    })
    if with_applications:
        e = enrich.attach_application(e, inp.applications, 100, brand, since).withColumn("load_date", F.lit(run_date))
        return e.select(*COHORT_COLUMNS, "app_status", "app_status_desc", "load_date")
    return e.select(*COHORT_COLUMNS)


COHORT_COLUMNS = [
    "account_id", "origin_year", "origin_month", "open_store", "year", "month", "obs_yyyymm", "vintage_offset",
    "product", "state", "balance", "credit_limit", "headroom", "util_ratio", "util_band", "limit_band",
    "balance_band", "level", "entry_flag", "delinquency", "flag_30", "flag_90", "score", "risk_letter", "rate",
    "rate_tier", "zone_label", "segment_client", "rfm", "income", "gender", "age", "age_band", "digital_flag",
    "int_fin", "int_mor", "int_total", "int_msi", "write_off_amount", "write_off_count", "write_off_date",
    "forgiveness_amount", "forgiveness_count", "client_uid", "macro_segment_code",
]


# ---------------------------------------------------------------------------
# E1' dispositions, netted variant
# ---------------------------------------------------------------------------
def dispositions_net_mart(inp: Inputs, start: _dt.date, end: _dt.date, load_date: _dt.date) -> DataFrame:
    """E1 variant over the netted cash-advance base (K10): one statement,
    older risk ladder, raw zone names, and the initial state of each vintage
    (first observation of the account's origin month, W10/W11).

    The netted base repeats an account-month's totals once per store; the
    fact carries no store, so those identical rows are removed *before* the
    panel expansion (the source removes them at the end by grouping on every
    column -- same rows, far less data through the join).
    """
    # the ledger's one pass: the base and the write-off / forgiveness sets read its cells
    cells = stage(G.ledger_cells(inp.ledger, start, end))
    net = G.net_base_from_cells(cells, inp.successor_map)
    base = (net.drop("store_id").distinct()
            .withColumnsRenamed({"year": "origin_year", "month": "origin_month"}))
    acc = inp.accounts.select(F.col("account_id").alias("a_id"), "open_date")
    base = base.join(acc, base.account_id == acc.a_id, "left").drop("a_id")
    base = base.withColumn("channel", R.CHANNEL.column(plan="plan"))
    snap = keys.resolve_key(
        inp.snapshots.select(
            "account_id", "year", "month", F.col("product").alias("obs_product"), "brand", "state", "store_id",
            "balance", "credit_limit", "rate", "level", "score", "stmt_flag", "totalero_flag"),
        inp.successor_map, mode="null").distinct()
    # both feed the counts of hot keys, the initial state and the panel: derived once
    base, snap = stage(base), stage(snap)
    # a few rows, known before the expansion is planned: neither side is exchanged by account to meet them
    hot = stage(panel.hot_keys(base, snap))
    snap = snap.withColumn("util_ratio", panel.utilisation_nonpositive(F.col("balance"), F.col("credit_limit")))
    is110 = F.col("product").isin(110)
    keep = (is110 & ~F.col("state").isin("T")) | ~is110
    # Initial state of each vintage (first observation month; ties -- two old
    # ids resolved onto one account -- broken by the values themselves),
    # attached to the base before the expansion.  The order's prefix (month, then the origin's product/plan/code) is fixed
    # per origin and month, so only the smallest snapshot tail of each
    # account-month can win -- per eligibility class (family 110 skips state
    # 'T' and NULL).  Reducing the snapshots to <= 2 rows per account-month
    # first keeps the first-observation join small even for a key that
    # collects many accounts.
    tail = ["score", "level", "state", "brand", "totalero_flag", "obs_product"]

    state_kept = ~F.col("state").isin("T")
    s_red = snap.groupBy("account_id", "year", "month").agg(
        F.min(F.struct("year", "month", *tail)).alias("other"),
        F.min(F.when(state_kept, F.struct("year", "month", *tail))).alias("110"))
    s_red = s_red.select("account_id", F.explode(F.create_map(F.lit("other"), "other", F.lit("110"), "110")).alias("__cls", "__r"))
    o_cls = base.select("account_id", "origin_year", "origin_month", "product", "plan", "code").withColumn(
        "__cls", F.when(F.col("product") == 110, F.lit("110")).when(F.col("product").isNotNull(), F.lit("other")))
    # the earliest month from the origin on is the last one met by a walk back through the account's months
    walk = s_red.where("__r IS NOT NULL").select("account_id", "__cls", P.yyyymm("__r.year", "__r.month").alias("__at"),
                                                F.lit(1).alias("__side"), "__r") \
        .unionByName(o_cls.select("account_id", "__cls", P.yyyymm("origin_year", "origin_month").alias("__at"),
                                  F.lit(2).alias("__side"),
                                  F.struct("origin_year", "origin_month", "product", "plan", "code").alias("__o")),
                     allowMissingColumns=True).where("account_id IS NOT NULL AND __cls IS NOT NULL AND __at IS NOT NULL")
    back = Window.partitionBy("account_id", "__cls").orderBy(F.col("__at").desc(), "__side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = walk.withColumn("__r", F.last("__r", ignorenulls=True).over(back)).where("__side = 2 AND __r IS NOT NULL")
    # brand, state, flag and segment start per account, origin month and product;
    # the risk starts per account and origin month, from the smallest of them
    order = ["year", "month", "product", "plan", "code"] + tail
    first = stage(j.groupBy("account_id", F.col("__o.origin_year").alias("origin_year"),
                            F.col("__o.origin_month").alias("origin_month"), F.col("__o.product").alias("product"))
                  .agg(F.min(F.struct(*[F.col(f"__r.{c}") if c in ("year", "month") or c in tail else F.col(f"__o.{c}")
                                        for c in order])).alias("__first")))
    risk = (first.groupBy("account_id", "origin_year", "origin_month").agg(F.min("__first").alias("__risk"))
            .select("account_id", "origin_year", "origin_month",
                    R.RISK_LEGACY.column(product="__risk.obs_product", period=P.yyyymm("__risk.year", "__risk.month"),
                                         score="__risk.score").alias("initial_risk")))
    first = first.select("account_id", "origin_year", "origin_month", "product",
                         *[F.col(f"__first.{c}").alias(f"first_{c}") for c in order])
    seg = enrich.segment_of_latest_date(inp.macro_old)
    fseg = seg.select(F.col("account_id").alias("__a"), F.col("year").alias("__y"), F.col("month").alias("__m"),
                      "segment_official")
    first = first.join(fseg, (first.account_id == fseg.__a) & (first.first_year == fseg.__y)
                       & (first.first_month == fseg.__m), "left")
    first = first.select(
        "account_id", "origin_year", "origin_month", "product",
        F.col("first_brand").alias("initial_brand"), F.col("first_state").alias("initial_state"),
        F.col("first_totalero_flag").alias("initial_totalero_flag"),
        enrich.macro_segment_label(F.col("segment_official")).alias("initial_macro_segment"))
    base = (base.join(first, ["account_id", "origin_year", "origin_month", "product"], "left")
            .join(risk, ["account_id", "origin_year", "origin_month"], "left"))
    # enrichment before the expansion (see dispositions_mart)
    ym = {"account_id": "account_id", "year": "year", "month": "month"}
    acc_on = {"account_id": "account_id"}
    # the interest of this variant is the closing month's only
    pivot = G.resolve_and_sum(
        G.indicator_pivot(inp.indicators.where((F.col("year") == end.year) & (F.col("month") == end.month)),
                          with_total=False).select(*AM, "int_fin", "int_mor", F.col("int_msi_any").alias("int_msi")),
        inp.successor_map, "zero", AM, ["int_fin", "int_mor", "int_msi"])
    codes = G.code_sets_from_cells(cells, inp.successor_map)
    zones = windows.latest_load(inp.zone_history, "load_date").select("store_id", F.col("zone_desc").alias("zone"))
    demo = clients.by_load_date(clients.visible(inp.client_history)).select(
        "account_id", "birth_date", "gender_code")
    snap = enrich.star_join(snap, [
        Dim(pivot, ym, ["int_fin", "int_mor", "int_msi"], unique=True),
        Dim(codes, ym, ["write_off_amount", "write_off_rows", "forgiveness_amount", "forgiveness_rows"],
            unique=True),
        Dim(G.commissions(inp.indicators), ym, ["fee_amount"], unique=True),
        Dim(seg, ym, ["segment_official"], unique=True),
        Dim(latest_client_segment(inp.client_segments), ym, ["segment_client"], unique=True),
        Dim(inp.stores, {"store_id": "store_id"}, ["zone_code"], unique=True),
        Dim(zones, {"store_id": "store_id"}, ["zone"], unique=True),
    ])
    base = enrich.star_join(base, [
        Dim(G.card_counts(inp.cards), acc_on, ["n_addon", "n_primary"], unique=True),
        Dim(G.unified_customer(inp.cards), acc_on, ["client_uid"], unique=True),
        Dim(digital_ids(inp.cards).withColumn("digital_flag", F.lit("1")), acc_on, ["digital_flag"],
            {"digital_flag": "0"}, unique=True),
        Dim(demo, acc_on, ["birth_date", "gender_code"], unique=True),
    ])
    p = fact_panel(base, snap, hot).where(keep)
    e = fact_labels(p, R.RISK_LEGACY, load_date)
    return e.select(*NET_COLUMNS)


NET_COLUMNS = [
    "account_id", "product", "plan", "code", "origin_year", "origin_month", "origin_yyyymm", "channel", "amount",
    "n_txn", "open_date", "year", "month", "obs_yyyymm", "vintage_offset", "mob_origin", "state", "balance",
    "credit_limit", "util_ratio", "util_band", "balance_band", "level", "delinquency", "flag_30", "flag_90", "score",
    "risk_level", "node", "node_label", "paper_channel", "zone_label", "macro_segment", "digital_flag",
    "initial_risk", "initial_brand", "initial_state", "initial_totalero_flag", "initial_macro_segment", "load_date",
    "mob", "mob_band", "horizon", "limit_band", "rate", "rate_tier", "cosecha", "has_balance", "opening_band", "brand",
    "store_id", "totalero_flag", "n_addon", "n_primary", "client_uid", "int_fin", "int_mor", "int_total", "int_msi",
    "fee_amount", "segment_client", "write_off_flag", "write_off_amount", "write_off_rows", "forgiveness_flag",
    "forgiveness_amount", "forgiveness_rows", "write_off_horizon", "write_off_offset", "interest_horizon",
    "instalment_horizon", "age", "age_band", "sex", "zone_raw",
]
