"""Queries over rule tables (R1-R18), periods (K2), keys (K1) and snapshots (K4).

Effective-dated ladders switch at 2022-2026 periods while the data spans
1995-2001, so those queries re-base the observation period by a fixed
number of years (``*_SHIFT``) -- a query parameter, applied the same way in
the oracle -- to reach every effective-dated branch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vintagelake.functions import periods as P
from vintagelake.functions import ruleset as R
from vintagelake.operators import enrich, keys, panel
from vintagelake.plans.registry import HISTORY_START, register
from vintagelake.sources import analogues as A
from vintagelake.sources.tables import read_table

RISK_SHIFT = 25      # 1995..2001 -> 2020..2026
TREE_SHIFT = 21      # 1995..2001 -> 2016..2022
VINTAGE_SHIFT = 10   # 1995..2001 -> 2005..2011


def _snap(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    return acc, A.snapshots(spark, sf_dir, acc)


# ---------------------------------------------------------------------------
# K2 period windows, evaluated for every order date as a run date
# ---------------------------------------------------------------------------
def _period_window(history: bool):
    def q(spark, sf_dir):
        d = A.read_table(spark, sf_dir, "orders", ["o_orderdate"]).select(
            F.col("o_orderdate").cast("date").alias("run_date")).distinct()
        s, e = P.period_window_cols("run_date", history, HISTORY_START)
        return d.select("run_date", s.alias("window_start"), e.alias("window_end"))
    return q


def _period_window_sql(history: bool) -> str:
    day1_start = f"DATE '{HISTORY_START.isoformat()}'" if history else \
        "CAST(date_trunc('month', run_date - INTERVAL 1 DAY) AS DATE)"
    return f"""
SELECT run_date,
       CASE WHEN day(run_date) = 1 THEN {day1_start} ELSE CAST(date_trunc('month', run_date) AS DATE) END
         AS window_start,
       CASE WHEN day(run_date) = 1 THEN last_day(CAST(run_date - INTERVAL 1 DAY AS DATE)) ELSE last_day(run_date) END
         AS window_end
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)
"""


register("period_window_history", _period_window_sql(True))(_period_window(True))
register("period_window_month", _period_window_sql(False))(_period_window(False))


# ---------------------------------------------------------------------------
# K1 successor-key resolution over the snapshot keys
# ---------------------------------------------------------------------------
_RESOLVE_SQL = {
    "null": "COALESCE(m.successor_id, s.account_id)",
    "zero": "CASE WHEN m.successor_id IS NULL OR m.successor_id = 0 THEN s.account_id ELSE m.successor_id END",
    "inverse": "CASE WHEN s.account_id IS NULL OR s.account_id = 0 THEN m.successor_id ELSE s.account_id END",
}


def _resolve(mode: str):
    def q(spark, sf_dir):
        _, snaps = _snap(spark, sf_dir)
        s = snaps.select("account_id", "year", "month")
        return keys.resolve_key(s, A.successor_map(spark, sf_dir), mode=mode, out="resolved_id")
    return q


for _m in keys.MODES:
    register(f"resolve_key_{_m}", A.sql_with("accounts", "snapshots", "successor_map") + f"""
SELECT s.account_id, CAST(s.year AS BIGINT) AS year, CAST(s.month AS BIGINT) AS month,
       {_RESOLVE_SQL[_m]} AS resolved_id
FROM snapshots s LEFT JOIN successor_map m ON m.account_id = s.account_id
""")(_resolve(_m))


# ---------------------------------------------------------------------------
# K4 snapshot preparation: period key, headroom, utilisation, bands
# ---------------------------------------------------------------------------
def snapshot_utilisation(spark, sf_dir):
    _, snaps = _snap(spark, sf_dir)
    s = panel.prepare_snapshot(snaps)
    return s.select("account_id", "year", "month", "obs_yyyymm", "headroom", "util_ratio",
                    R.UTILISATION_BAND.column(ratio="util_ratio").alias("util_band"),
                    "limit_band", "balance_band")


_UTIL_SQL = ("CASE WHEN credit_limit IS NULL OR credit_limit = 0 THEN -1.0 "
             "ELSE CAST(balance AS DOUBLE) / CAST(credit_limit AS DOUBLE) END")

register("snapshot_utilisation", A.sql_with("accounts", "snapshots", extra={
    "u": f"SELECT *, {_UTIL_SQL} AS util_ratio FROM snapshots"}) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(year * 100 + month AS BIGINT) AS obs_yyyymm,
       CAST(credit_limit - balance AS DOUBLE) AS headroom, util_ratio,
       {R.UTILISATION_BAND.sql(ratio='util_ratio')} AS util_band,
       {R.AMOUNT_BAND.sql(product='product', amount='credit_limit')} AS limit_band,
       {R.AMOUNT_BAND.sql(product='product', amount='balance')} AS balance_band
FROM u
""")(snapshot_utilisation)


def band_limit(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    return s.select("account_id", "year", "month",
                    R.LIMIT_BAND_PUBLISHED.column(product="product", amount="credit_limit").alias("limit_band"),
                    R.AMOUNT_BAND_COHORT.column(product="product", amount="credit_limit").alias("limit_band_cohort"))


register("band_limit", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       {R.LIMIT_BAND_PUBLISHED.sql(product='product', amount='credit_limit')} AS limit_band,
       {R.AMOUNT_BAND_COHORT.sql(product='product', amount='credit_limit')} AS limit_band_cohort
FROM snapshots
""")(band_limit)


def band_balance(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    return s.select("account_id", "year", "month",
                    R.AMOUNT_BAND.column(product="product", amount="balance").alias("balance_band"),
                    R.AMOUNT_BAND_COHORT.column(product="product", amount="balance").alias("balance_band_cohort"))


register("band_balance", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       {R.AMOUNT_BAND.sql(product='product', amount='balance')} AS balance_band,
       {R.AMOUNT_BAND_COHORT.sql(product='product', amount='balance')} AS balance_band_cohort
FROM snapshots
""")(band_balance)


def _with_mob(spark, sf_dir):
    acc, s = _snap(spark, sf_dir)
    a = acc.select(F.col("account_id").alias("a_id"), "open_date")
    s = s.join(a, s.account_id == a.a_id, "left").drop("a_id")
    return s.withColumn("mob", P.month_offset(F.year("open_date"), F.month("open_date"), F.col("year"), F.col("month")))


_MOB_SQL_CTE = {"sm": """SELECT s.*, a.open_date AS open_date_a,
                               (s.year - year(a.open_date)) * 12 + (s.month - month(a.open_date)) AS mob
                        FROM snapshots s LEFT JOIN accounts a ON a.account_id = s.account_id"""}


def band_mob(spark, sf_dir):
    s = _with_mob(spark, sf_dir)
    return s.select("account_id", "year", "month", "mob", R.MOB_BAND.column(mob="mob").alias("mob_band"))


register("band_mob", A.sql_with("accounts", "snapshots", extra=_MOB_SQL_CTE) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(mob AS BIGINT) AS mob,
       {R.MOB_BAND.sql(mob='mob')} AS mob_band
FROM sm
""")(band_mob)


def band_age(spark, sf_dir):
    acc, s = _snap(spark, sf_dir)
    c = A.clients(acc).select(F.col("account_id").alias("c_id"), "birth_date")
    s = s.join(c, s.account_id == c.c_id, "left")
    obs = P.yyyymm("year", "month")
    birth = P.yyyymm(F.year("birth_date"), F.month("birth_date"))
    age = P.age_from_yyyymm(obs, birth)
    return s.select("account_id", "year", "month", age.alias("age"),
                    R.AGE_BAND_COHORT.column(age=age).alias("age_band_cohort"),
                    R.AGE_BAND_FACT.column(age=age).alias("age_band_fact"))


register("band_age", A.sql_with("accounts", "snapshots", "clients", extra={
    "sa": """SELECT s.account_id, s.year, s.month,
                    CASE WHEN floor(((s.year * 100 + s.month) - (year(c.birth_date) * 100 + month(c.birth_date))) / 100) < 0
                         THEN 0
                         ELSE floor(((s.year * 100 + s.month) - (year(c.birth_date) * 100 + month(c.birth_date))) / 100)
                    END AS age
             FROM snapshots s LEFT JOIN clients c ON c.account_id = s.account_id"""}) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(age AS BIGINT) AS age,
       {R.AGE_BAND_COHORT.sql(age='age')} AS age_band_cohort,
       {R.AGE_BAND_FACT.sql(age='age')} AS age_band_fact
FROM sa
""")(band_age)


def opening_year_band(product, open_date):
    """R15 with the family-200/210 branch: the opening year itself from 2018."""
    y = F.year(open_date)
    return (F.when(F.col(product).isin(110, 100), R.OPENING_YEAR_BAND.column(product=product, open_year=y))
            .when(F.col(product).isin(210, 200) & (y >= 2018), y.cast("string"))
            .otherwise(F.lit("NO")))


def band_opening_year(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    shifted = F.add_months("open_date", 12 * TREE_SHIFT)
    return acc.select("account_id", opening_year_band("product", "open_date").alias("opening_band"),
                      opening_year_band("product", shifted).alias("opening_band_shifted"))


def _opening_sql(d: str) -> str:
    return (f"CASE WHEN product IN (110, 100) THEN "
            f"{R.OPENING_YEAR_BAND.sql(product='product', open_year=f'year({d})')} "
            f"WHEN product IN (210, 200) AND year({d}) >= 2018 THEN CAST(year({d}) AS VARCHAR) ELSE 'NO' END")


register("band_opening_year", A.sql_with("accounts") + f"""
SELECT account_id, {_opening_sql('open_date')} AS opening_band,
       {_opening_sql(f'CAST(open_date + INTERVAL {TREE_SHIFT} YEAR AS DATE)')} AS opening_band_shifted
FROM accounts
""")(band_opening_year)


# ---------------------------------------------------------------------------
# R4-R6 delinquency labels and flags
# ---------------------------------------------------------------------------
def delinquency_flags(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    lv = "level"
    return s.select("account_id", "year", "month", "level",
                    R.DELINQUENCY_LABEL.column(level=lv).alias("delinquency"),
                    R.FLAG_30.column(level=lv).alias("flag_30"), R.FLAG_90.column(level=lv).alias("flag_90"),
                    R.ENTRY_FLAG.column(level=lv).alias("entry_flag"), R.CD2_FLAG.column(level=lv).alias("cd2"))


register("delinquency_flags", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(level AS BIGINT) AS level,
       {R.DELINQUENCY_LABEL.sql(level='level')} AS delinquency,
       CAST({R.FLAG_30.sql(level='level')} AS BIGINT) AS flag_30,
       CAST({R.FLAG_90.sql(level='level')} AS BIGINT) AS flag_90,
       CAST({R.ENTRY_FLAG.sql(level='level')} AS BIGINT) AS entry_flag,
       CAST({R.CD2_FLAG.sql(level='level')} AS BIGINT) AS cd2
FROM snapshots
""")(delinquency_flags)


# ---------------------------------------------------------------------------
# R7 risk levels, R8 rate tiers
# ---------------------------------------------------------------------------
def risk_level_effective_dated(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    period = P.yyyymm(F.col("year") + RISK_SHIFT, "month")
    return s.select("account_id", "year", "month", period.alias("period"), "score",
                    R.RISK_EFFECTIVE.column(product="product", period=period, score="score").alias("risk_level"))


register("risk_level_effective_dated", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST((year + {RISK_SHIFT}) * 100 + month AS BIGINT) AS period, CAST(score AS BIGINT) AS score,
       {R.RISK_EFFECTIVE.sql(product='product', period=f'((year + {RISK_SHIFT}) * 100 + month)', score='score')}
         AS risk_level
FROM snapshots
""")(risk_level_effective_dated)


def risk_level_letters(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    return s.select("account_id", "year", "month", "score", R.RISK_LETTERS.column(score="score").alias("risk_letter"))


register("risk_level_letters", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(score AS BIGINT) AS score,
       {R.RISK_LETTERS.sql(score='score')} AS risk_letter
FROM snapshots
""")(risk_level_letters)


def rate_tier(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    return s.select("account_id", "year", "month", "rate",
                    R.RATE_TIER.column(product="product", rate="rate").alias("rate_tier"),
                    R.RATE_TIER_COHORT.column(product="product", rate="rate").alias("rate_tier_cohort"),
                    R.RATE_TIER_SINGLE.column(product="product", rate="rate").alias("rate_tier_single"))


register("rate_tier", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(rate AS DOUBLE) AS rate,
       {R.RATE_TIER.sql(product='product', rate='rate')} AS rate_tier,
       {R.RATE_TIER_COHORT.sql(product='product', rate='rate')} AS rate_tier_cohort,
       {R.RATE_TIER_SINGLE.sql(product='product', rate='rate')} AS rate_tier_single
FROM snapshots
""")(rate_tier)


# ---------------------------------------------------------------------------
# R11 zones, K24 zone normaliser, R12 statement channel, R14 vintage label
# ---------------------------------------------------------------------------
def zone_clean(spark, sf_dir):
    return enrich.zone_normalise(A.zone_history(spark, sf_dir))


_ZONE_CLEAN_SQL = f"""
SELECT store_id, store_desc,
       CASE WHEN zone_desc IS NULL THEN 'Otro'
            ELSE COALESCE({R.ZONE_NAME_CLEAN.sql(zone='zone_desc', zone_trimmed='trim(zone_desc)')}, zone_desc)
       END AS zone,
       CASE WHEN zone_desc IS NULL THEN '13' ELSE {R.ZONE_ID.sql(zone='zone_desc')} END AS zone_id
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY year DESC, month DESC) AS rn FROM zone_history)
WHERE rn = 1"""

register("zone_clean", A.sql_with("zone_history") + _ZONE_CLEAN_SQL)(zone_clean)


def zone_label(spark, sf_dir):
    acc, s = _snap(spark, sf_dir)
    st = A.stores(spark, sf_dir).select(F.col("store_id").alias("st_id"), "zone_code")
    zn = enrich.zone_normalise(A.zone_history(spark, sf_dir)).select(F.col("store_id").alias("z_id"), "zone")
    j = s.join(st, s.store_id == st.st_id, "left").join(zn, s.store_id == zn.z_id, "left")
    zone_in = F.when(F.col("product").isin(100, 110), F.col("zone_code")).otherwise(F.col("zone"))
    return j.select("account_id", "year", "month", "store_id",
                    R.ZONE_LABEL_FACT.column(product="product", zone=zone_in, store="store_id").alias("zone_fact"),
                    R.ZONE_LABEL_COHORT.column(product="product", zone="zone_code").alias("zone_cohort"))


register("zone_label", A.sql_with("accounts", "snapshots", "stores", "zone_history", extra={
    "zn": _ZONE_CLEAN_SQL,
    "j": """SELECT s.*, st.zone_code, zn.zone,
                   CASE WHEN s.product IN (100, 110) THEN st.zone_code ELSE zn.zone END AS zone_in
            FROM snapshots s LEFT JOIN stores st ON st.store_id = s.store_id
            LEFT JOIN zn ON zn.store_id = s.store_id"""}) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, store_id,
       {R.ZONE_LABEL_FACT.sql(product='product', zone='zone_in', store='store_id')} AS zone_fact,
       {R.ZONE_LABEL_COHORT.sql(product='product', zone='zone_code')} AS zone_cohort
FROM j
""")(zone_label)


def statement_channel(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    return s.select("account_id", "year", "month", "stmt_flag",
                    R.STATEMENT_CHANNEL.column(flag=F.trim("stmt_flag")).alias("channel_trimmed"),
                    R.STATEMENT_CHANNEL_SHORT.column(flag="stmt_flag").alias("channel_raw"))


register("statement_channel", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, stmt_flag,
       {R.STATEMENT_CHANNEL.sql(flag='trim(stmt_flag)')} AS channel_trimmed,
       {R.STATEMENT_CHANNEL_SHORT.sql(flag='stmt_flag')} AS channel_raw
FROM snapshots
""")(statement_channel)


def vintage_label_text(year, month):
    """R14 text form: '<2009' (also NULL year) or YYYYMM with zero-padded month."""
    return (F.when((year < 2009) | year.isNull(), F.lit("<2009"))
            .otherwise(F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"))))


def vintage_label_int(year, month):
    """R14 integer form: 2009 for years before 2009, else YYYYMM."""
    return F.when(year < 2009, F.lit(2009)).otherwise(P.yyyymm(year, month))


def vintage_label(spark, sf_dir):
    acc = A.accounts(spark, sf_dir).where(F.col("open_date").isNotNull())
    y = F.year("open_date") + VINTAGE_SHIFT
    m = F.month("open_date")
    return acc.select("account_id", vintage_label_text(y, m).alias("vintage_text"),
                      vintage_label_int(y, m).alias("vintage_int"))


register("vintage_label", A.sql_with("accounts") + f"""
SELECT account_id,
       CASE WHEN year(open_date) + {VINTAGE_SHIFT} < 2009 OR open_date IS NULL THEN '<2009'
            ELSE CAST(year(open_date) + {VINTAGE_SHIFT} AS VARCHAR) || right('0' || CAST(month(open_date) AS VARCHAR), 2)
       END AS vintage_text,
       CAST(CASE WHEN year(open_date) + {VINTAGE_SHIFT} < 2009 THEN 2009
                 ELSE (year(open_date) + {VINTAGE_SHIFT}) * 100 + month(open_date) END AS BIGINT) AS vintage_int
FROM accounts WHERE open_date IS NOT NULL
""")(vintage_label)


# ---------------------------------------------------------------------------
# R16-R18 score tree
# ---------------------------------------------------------------------------
def _tree_base(spark, sf_dir):
    s = _with_mob(spark, sf_dir)
    return s.withColumn("period", P.yyyymm(F.col("year") + TREE_SHIFT, "month"))


def score_tree_node(spark, sf_dir):
    s = _tree_base(spark, sf_dir)
    return s.select("account_id", "year", "month", "period", "mob", "score",
                    R.SCORE_TREE_NODE.column(period="period", product="product", brand="brand", mob="mob",
                                             score="score").alias("node"))


_TREE_CTE = {**_MOB_SQL_CTE, "tb": f"SELECT *, (year + {TREE_SHIFT}) * 100 + month AS period FROM sm"}
_NODE_SQL = R.SCORE_TREE_NODE.sql(period="period", product="product", brand="brand", mob="mob", score="score")

register("score_tree_node", A.sql_with("accounts", "snapshots", extra=_TREE_CTE) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(period AS BIGINT) AS period,
       CAST(mob AS BIGINT) AS mob, CAST(score AS BIGINT) AS score, CAST({_NODE_SQL} AS BIGINT) AS node
FROM tb
""")(score_tree_node)


def score_tree_label(spark, sf_dir):
    s = _tree_base(spark, sf_dir)
    node = R.SCORE_TREE_NODE.column(period="period", product="product", brand="brand", mob="mob", score="score")
    s = s.withColumn("node", node)
    return (s.groupBy("product", "period", "node")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("node_label", R.NODE_LABEL.column(product="product", period="period", node="node")))


register("score_tree_label", A.sql_with("accounts", "snapshots", extra={
    **_TREE_CTE, "n": f"SELECT product, period, {_NODE_SQL} AS node FROM tb"}) + f"""
SELECT CAST(product AS BIGINT) AS product, CAST(period AS BIGINT) AS period, CAST(node AS BIGINT) AS node,
       CAST(count(*) AS BIGINT) AS n_rows,
       {R.NODE_LABEL.sql(product='product', period='period', node='node')} AS node_label
FROM n GROUP BY product, period, node
""")(score_tree_label)


def tree_levels(spark, sf_dir):
    s = _with_mob(spark, sf_dir)
    return s.select("account_id", "year", "month",
                    R.TREE_LEVEL_2.column(product="product", mob="mob").alias("level_2"),
                    R.TREE_LEVEL_3.column(product="product", score="score").alias("level_3"),
                    R.TREE_NODE_ID.column(product="product", mob="mob", score="score").alias("node_id"))


register("tree_levels", A.sql_with("accounts", "snapshots", extra=_MOB_SQL_CTE) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       {R.TREE_LEVEL_2.sql(product='product', mob='mob')} AS level_2,
       {R.TREE_LEVEL_3.sql(product='product', score='score')} AS level_3,
       CAST({R.TREE_NODE_ID.sql(product='product', mob='mob', score='score')} AS BIGINT) AS node_id
FROM sm
""")(tree_levels)


# ---------------------------------------------------------------------------
# R7 overdraft form (origin and observation periods) and the older nested form
# ---------------------------------------------------------------------------
def risk_level_overdraft(spark, sf_dir):
    acc, s = _snap(spark, sf_dir)
    a = acc.select(F.col("account_id").alias("a_id"), "open_date")
    s = s.join(a, s.account_id == a.a_id, "left")
    origin = P.yyyymm(F.year("open_date") + RISK_SHIFT, F.month("open_date"))
    obs = P.yyyymm(F.col("year") + RISK_SHIFT, "month")
    return s.select("account_id", "year", "month", origin.alias("origin"), obs.alias("obs"), "score",
                    R.RISK_OVERDRAFT.column(product="product", origin=origin, obs=obs, score="score")
                    .alias("risk_level"))


register("risk_level_overdraft", A.sql_with("accounts", "snapshots", extra={
    "ro": f"""SELECT s.*, (year(a.open_date) + {RISK_SHIFT}) * 100 + month(a.open_date) AS origin,
                     (s.year + {RISK_SHIFT}) * 100 + s.month AS obs
              FROM snapshots s LEFT JOIN accounts a ON a.account_id = s.account_id"""}) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(origin AS BIGINT) AS origin,
       CAST(obs AS BIGINT) AS obs, CAST(score AS BIGINT) AS score,
       {R.RISK_OVERDRAFT.sql(product='product', origin='origin', obs='obs', score='score')} AS risk_level
FROM ro
""")(risk_level_overdraft)


def risk_level_legacy(spark, sf_dir):
    _, s = _snap(spark, sf_dir)
    period = P.yyyymm(F.col("year") + RISK_SHIFT, "month")
    return s.select("account_id", "year", "month", "score",
                    R.RISK_LEGACY.column(product="product", period=period, score="score").alias("risk_level"))


register("risk_level_legacy", A.sql_with("accounts", "snapshots") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(score AS BIGINT) AS score,
       {R.RISK_LEGACY.sql(product='product', period=f'((year + {RISK_SHIFT}) * 100 + month)', score='score')}
         AS risk_level
FROM snapshots
""")(risk_level_legacy)


# ---------------------------------------------------------------------------
# R9 / R10 / R5 overdraft-fact variants
# ---------------------------------------------------------------------------
def band_mob_variants(spark, sf_dir):
    s = _with_mob(spark, sf_dir)
    return s.select("account_id", "year", "month", R.MOB_BAND_OVERDRAFT.column(mob="mob").alias("mob_band_od"),
                    R.MOB_BAND_NUMBERED.column(mob="mob").alias("mob_band_numbered"),
                    R.FLAG_30_TEXT.column(level="level").alias("flag_30"),
                    R.FLAG_90_TEXT.column(level="level").alias("flag_90"))


register("band_mob_variants", A.sql_with("accounts", "snapshots", extra=_MOB_SQL_CTE) + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       {R.MOB_BAND_OVERDRAFT.sql(mob='mob')} AS mob_band_od, {R.MOB_BAND_NUMBERED.sql(mob='mob')} AS mob_band_numbered,
       {R.FLAG_30_TEXT.sql(level='level')} AS flag_30, {R.FLAG_90_TEXT.sql(level='level')} AS flag_90
FROM sm
""")(band_mob_variants)


def band_age_overdraft(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    c = A.clients(acc).select(F.col("account_id").alias("c_id"), "birth_date", "gender_code")
    j = acc.join(c, acc.account_id == c.c_id, "left")
    age = P.calendar_years("open_date", "birth_date")
    return j.select("account_id", age.alias("age"), R.AGE_BAND_OVERDRAFT.column(age=age).alias("age_band"),
                    R.GENDER_FROM_CODE.column(gen="gender_code").alias("gender"),
                    R.SEX_FROM_CODE.column(gen="gender_code").alias("sex"))


register("band_age_overdraft", A.sql_with("accounts", "clients", extra={
    "ag": """SELECT a.account_id, year(a.open_date) - year(c.birth_date) AS age, c.gender_code
             FROM accounts a LEFT JOIN clients c ON c.account_id = a.account_id"""}) + f"""
SELECT account_id, CAST(age AS BIGINT) AS age, {R.AGE_BAND_OVERDRAFT.sql(age='age')} AS age_band,
       {R.GENDER_FROM_CODE.sql(gen='gender_code')} AS gender, {R.SEX_FROM_CODE.sql(gen='gender_code')} AS sex
FROM ag
""")(band_age_overdraft)


# ---------------------------------------------------------------------------
# R8 lettered rate tier; F2 / F3 date and time of day in a zone
# ---------------------------------------------------------------------------
RATES_SEEN = sorted({rate for rule in R.RATE_LEVEL.rules for _, _, rates in rule.tests for rate in rates})


def rate_tier_letters(spark, sf_dir):
    """The lettered tiers; every snapshot takes one of the tabled rates or one beside it."""
    s = A.snapshots(spark, sf_dir)
    at = (F.col("account_id") + F.col("level") * 7) % len(RATES_SEEN)
    rate = F.element_at(F.array(*[F.lit(x).cast("decimal(18,2)") for x in RATES_SEEN]), (at + 1).cast("int"))
    rate = F.when(F.col("score") % 4 == 0, rate + F.lit("0.01").cast("decimal(18,2)")).otherwise(rate)
    return s.select("account_id", "year", "month", rate.cast("decimal(18,2)").alias("rate")).withColumn(
        "rate_level", R.RATE_LEVEL.column(rate="rate"))


register("rate_tier_letters", A.sql_with("accounts", "snapshots", extra={
    "rated": f"""SELECT account_id, year, month,
                        CAST([{', '.join(f"CAST('{x}' AS DECIMAL(18,2))" for x in RATES_SEEN)}]
                             [(account_id + level * 7) % {len(RATES_SEEN)} + 1]
                             + CASE WHEN score % 4 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(18,2)) AS rate
                 FROM snapshots"""}) + """
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(rate AS DOUBLE) AS rate,
       CASE WHEN rate IN (66.00, 64.00, 64.50, 65.50, 68.00, 85, 84, 84.5, 85.5) THEN 'F.T5'
            WHEN rate IN (61.20, 62.20, 62.70, 63.70, 66.20, 80, 80.5, 81.5) THEN 'E.T4'
            WHEN rate IN (53.11, 54.86, 55.36, 56.36, 58.86, 77.42, 77.6, 78.1, 79.1) THEN 'D.T3'
            WHEN rate IN (42.04, 45.54, 46.04, 47.04, 49.54, 69.83, 70.33, 71.33) THEN 'C.T2'
            WHEN rate IN (31.39, 32.39, 32.89, 33.89, 36.39, 60.36, 60.86, 61.86) THEN 'B.T1'
            WHEN rate IN (14.99, 15.49, 16.49, 18.99) THEN 'A.T0'
            WHEN rate IN (26.56, 27.43, 27.68, 28.18, 29.43, 38.71, 38.8, 39.05, 39.55) THEN 'G.Empleados'
            ELSE 'H.Otros' END AS rate_level
FROM rated
""")(rate_tier_letters)

ZONE = "America/Mexico_City"


def local_clock(spark, sf_dir):
    """Date and time of day of every event, as a clock in the zone shows them."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    at = F.col("ts").cast("timestamp_ntz")
    return e.select("event_id", P.today_in(ZONE, at).alias("local_date"), P.time_of_day_in(ZONE, at).alias("local_time"))


register("local_clock", f"""
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS DATE) AS local_date,
       strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}', '%H:%M:%S') AS local_time
FROM events
""")(local_clock)
