"""Queries over windows, aggregates, ledger bases, cards and the overdraft chain."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from vintagelake.functions import periods as P
from vintagelake.functions import ruleset as R
from vintagelake.functions.rules import sql_literal
from vintagelake.operators import aggregates as G
from vintagelake.operators import clients, enrich, overdraft, panel, windows
from vintagelake.plans.registry import HISTORY_START, OVERDRAFT_RUN_DATE, RUN_DATE_HISTORY, register
from vintagelake.session import checkpoint_dir
from vintagelake.sources import analogues as A

WINDOW_START, WINDOW_END = P.period_window(RUN_DATE_HISTORY, True, HISTORY_START)
EXCLUDED_ACCOUNTS = (5, 17, 33, 64, 101, 250, 999, 1203)
WEB_STORES = ("0039", "0042", "0077")
OD_START, OD_END = P.previous_month(OVERDRAFT_RUN_DATE)


def _sql_in(values) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


def _d(d: _dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


# ---------------------------------------------------------------------------
# K5 / W1-W7 / J10 / T2 top-1 per group
# ---------------------------------------------------------------------------
def latest_row_window(spark, sf_dir):
    s = A.snapshots(spark, sf_dir)
    top = windows.latest(s, ["account_id"], [F.col("year").desc(), F.col("month").desc()])
    return top.select("account_id", "year", "month", "level", "score")


register("latest_row_window", A.sql_with("accounts", "snapshots") + """
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(level AS BIGINT) AS level, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY year DESC, month DESC) AS rn FROM snapshots)
WHERE rn = 1
""")(latest_row_window)


def latest_row_ties_kept(spark, sf_dir):
    led = A.ledger(spark, sf_dir).select("account_id", F.year("txn_date").alias("year"),
                                         F.month("txn_date").alias("month"), "txn_date", "store_id")
    return windows.latest_ties_kept(led, ["account_id", "year", "month"], "txn_date")


register("latest_row_ties_kept", A.sql_with("accounts", "ledger", extra={
    "l": "SELECT account_id, year(txn_date) AS year, month(txn_date) AS month, txn_date, store_id FROM ledger"}) + """
SELECT DISTINCT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, txn_date, store_id
FROM (SELECT *, max(txn_date) OVER (PARTITION BY account_id, year, month) AS mx FROM l)
WHERE txn_date = mx
""")(latest_row_ties_kept)


def latest_segment_max_by(spark, sf_dir):
    seg = A.macro_segments(spark, sf_dir, "old").unionByName(A.macro_segments(spark, sf_dir, "new"))
    return windows.latest_by_aggregate(seg, ["account_id"], F.struct("segment_date", "ref_id"),
                                       ["segment_official", "segment_date"])


register("latest_segment_max_by", A.sql_with("macro_old", "macro_new") + """
SELECT account_id, CAST(segment_official AS BIGINT) AS segment_official, segment_date
FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY segment_date DESC, ref_id DESC) AS rn
      FROM (SELECT * FROM macro_old UNION ALL SELECT * FROM macro_new))
WHERE rn = 1
""")(latest_segment_max_by)


# ---------------------------------------------------------------------------
# K6 indicator pivot, K7 write-off/forgiveness, K8 commissions
# ---------------------------------------------------------------------------
def conditional_pivot(spark, sf_dir):
    return G.indicator_pivot(A.indicators(spark, sf_dir), since_yyyymm=199801)


register("conditional_pivot", A.sql_with("accounts", "indicators") + """
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(sum(CASE WHEN indicator = 'INTERESES_FIN' THEN amount ELSE 0 END) AS DOUBLE) AS int_fin,
       CAST(sum(CASE WHEN indicator = 'INTERESES_MOR' THEN amount ELSE 0 END) AS DOUBLE) AS int_mor,
       CAST(sum(CASE WHEN indicator LIKE 'MSI%' THEN amount ELSE 0 END) AS DOUBLE) AS int_msi,
       CAST(sum(CASE WHEN indicator LIKE '%MSI%' THEN amount ELSE 0 END) AS DOUBLE) AS int_msi_any,
       CAST(sum(CASE WHEN indicator = 'INTERESES_FIN' THEN amount ELSE 0 END)
            + sum(CASE WHEN indicator = 'INTERESES_MOR' THEN amount ELSE 0 END) AS DOUBLE) AS int_total
FROM indicators WHERE year >= 1998 AND year * 100 + month >= 199801
GROUP BY account_id, year, month
""")(conditional_pivot)


def _txn_monthly_sql(positive: bool) -> str:
    wo, fg = _sql_in(R.WRITE_OFF_CODES), _sql_in(R.FORGIVENESS_CODES)
    pos = " AND amount > 0" if positive else ""
    return A.sql_with("accounts", "ledger") + f"""
SELECT account_id, CAST(year(txn_date) AS BIGINT) AS year, CAST(month(txn_date) AS BIGINT) AS month,
       CAST(sum(CASE WHEN code IN {wo} THEN amount ELSE 0 END) AS DOUBLE) AS write_off_amount,
       CAST(count(CASE WHEN code IN {wo}{pos} THEN 1 END) AS BIGINT) AS write_off_count,
       max(CASE WHEN code IN {wo} THEN txn_date END) AS write_off_date,
       CAST(sum(CASE WHEN code IN {fg} THEN amount ELSE 0 END) AS DOUBLE) AS forgiveness_amount,
       CAST(count(CASE WHEN code IN {fg}{pos} THEN 1 END) AS BIGINT) AS forgiveness_count
FROM ledger WHERE txn_date >= DATE '1998-01-01'
GROUP BY account_id, year(txn_date), month(txn_date)
"""


def _txn_monthly(positive: bool):
    def q(spark, sf_dir):
        return G.txn_monthly(A.ledger(spark, sf_dir), since=_dt.date(1998, 1, 1), count_positive=positive)
    return q


register("txn_monthly_codes", _txn_monthly_sql(True))(_txn_monthly(True))
register("txn_monthly_codes_all", _txn_monthly_sql(False))(_txn_monthly(False))


def commission_monthly(spark, sf_dir):
    return G.commissions(A.indicators(spark, sf_dir))


register("commission_monthly", A.sql_with("accounts", "indicators") + """
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(sum(amount) AS DOUBLE) AS fee_amount
FROM indicators WHERE indicator = 'COMISION' GROUP BY account_id, year, month
""")(commission_monthly)


# ---------------------------------------------------------------------------
# K9 / K10 cash-advance bases
# ---------------------------------------------------------------------------
def signed_monthly_base(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    return G.signed_monthly_base(A.ledger(spark, sf_dir, acc), A.successor_map(spark, sf_dir), acc,
                                 WINDOW_START, WINDOW_END)


_QUAL_SQL = R.QUALIFYING_TXN.sql(code="code", product="product", plan="plan")
_SIGNED_SQL = f"""CASE WHEN code IN {_sql_in(R.CASH_ADVANCE_REVERSALS)} THEN -amount
     WHEN code IN {_sql_in(R.CASH_ADVANCE_CODES)} THEN amount
     WHEN plan IN (20003, 20004) AND code IN (12, 122) AND product IN (200, 210) THEN amount
     WHEN plan IN (20003) AND code IN (72, 282) AND product IN (200, 210) THEN -amount
     ELSE 0 END"""
SIGNED_BASE_CTES = {
    "lb": f"""SELECT CASE WHEN m.successor_id IS NULL OR m.successor_id = 0 THEN l.account_id ELSE m.successor_id END
                       AS account_id, l.product, l.txn_date, l.code, l.amount, l.plan
              FROM ledger l LEFT JOIN successor_map m ON m.account_id = l.account_id
              WHERE l.txn_date BETWEEN {_d(WINDOW_START)} AND {_d(WINDOW_END)}
                AND l.code IN {_sql_in(R.LEDGER_FILTER_CODES)} AND l.product IN {_sql_in(R.LEDGER_FILTER_FAMILIES)}
                AND l.plan IN {_sql_in(R.LEDGER_FILTER_PLANS)}""",
    "gb": f"""SELECT account_id, product, year(txn_date) AS origin_year, month(txn_date) AS origin_month, plan,
                     sum({_QUAL_SQL}) AS n_txn, sum({_SIGNED_SQL}) AS amount
              FROM lb GROUP BY account_id, product, year(txn_date), month(txn_date), plan""",
    "sb": f"""SELECT gb.*, a.open_date, {R.CHANNEL.sql(plan='gb.plan')} AS channel
              FROM gb LEFT JOIN accounts a ON a.account_id = gb.account_id""",
}

register("signed_monthly_base", A.sql_with("accounts", "ledger", "successor_map", extra=SIGNED_BASE_CTES) + """
SELECT account_id, CAST(product AS BIGINT) AS product, CAST(origin_year AS BIGINT) AS origin_year,
       CAST(origin_month AS BIGINT) AS origin_month, CAST(plan AS BIGINT) AS plan, CAST(n_txn AS BIGINT) AS n_txn,
       CAST(amount AS DOUBLE) AS amount, open_date, channel
FROM sb
""")(signed_monthly_base)


def net_monthly_base(spark, sf_dir):
    return G.net_monthly_base(A.ledger(spark, sf_dir), A.successor_map(spark, sf_dir), WINDOW_START, WINDOW_END)


_NET_CODES = R.NET_BASE_CODES + R.NET_BASE_REVERSALS
# The oracle keeps the many-to-many self-join of the original formulation.
NET_BASE_CTES = {
    "b": f"""SELECT COALESCE(m.successor_id, l.account_id) AS track, l.product, year(l.txn_date) AS y,
                    month(l.txn_date) AS mo, l.plan, l.code, l.store_id,
                    CASE WHEN l.code IN {_sql_in(R.NET_BASE_REVERSALS)} THEN -l.amount
                         WHEN l.code IN {_sql_in(R.NET_BASE_CODES)} THEN l.amount ELSE 0 END AS sa,
                    CASE WHEN l.code IN {_sql_in(R.NET_BASE_REVERSALS)} THEN -1
                         WHEN l.code IN {_sql_in(R.NET_BASE_CODES)} THEN 1 ELSE 0 END AS sn
             FROM ledger l LEFT JOIN successor_map m ON m.account_id = l.account_id
             WHERE l.txn_date BETWEEN {_d(WINDOW_START)} AND {_d(WINDOW_END)} AND l.plan IN (20002, 20003, 20004)
               AND l.code IN {_sql_in(_NET_CODES)} AND l.product IN (110, 100, 210, 200)""",
    "media": "SELECT plan, y, mo, product, track, store_id, sum(sn) AS trn, sum(sa) AS monto FROM b GROUP BY ALL",
    "cta": "SELECT y, mo, product, track, store_id, count(track) AS total FROM media WHERE monto > 0 GROUP BY ALL",
    "agg": """SELECT a.y, a.product, a.mo, a.store_id, a.track, sum(b.monto) AS monto, sum(b.trn) AS trn
              FROM cta a JOIN media b ON a.track = b.track AND a.y = b.y AND a.mo = b.mo GROUP BY ALL""",
    "pick": """SELECT track, y, mo, plan, code FROM (
                 SELECT *, row_number() OVER (PARTITION BY track, y, mo ORDER BY plan, code, product) AS rn
                 FROM (SELECT DISTINCT track, y, mo, product, plan, code FROM b)) WHERE rn = 1"""}
register("net_monthly_base", A.sql_with("accounts", "ledger", "successor_map", extra=NET_BASE_CTES) + """
SELECT agg.track AS account_id, CAST(agg.product AS BIGINT) AS product, CAST(pick.plan AS BIGINT) AS plan,
       CAST(pick.code AS BIGINT) AS code, CAST(agg.y AS BIGINT) AS year, CAST(agg.mo AS BIGINT) AS month,
       agg.store_id, CAST(agg.monto AS DOUBLE) AS amount, CAST(agg.trn AS BIGINT) AS n_txn
FROM agg JOIN pick ON pick.track = agg.track AND pick.y = agg.y AND pick.mo = agg.mo
""")(net_monthly_base)


# ---------------------------------------------------------------------------
# K12 / K13 cards
# ---------------------------------------------------------------------------
_CARD_UNION_SQL = A.sql_with("cards") + f"""
SELECT account_id, CAST(sum(n_addon) AS BIGINT) AS n_addon, CAST(sum(n_primary) AS BIGINT) AS n_primary
FROM (SELECT account_id, 0 AS n_primary, count(card_no) AS n_addon FROM cards
      WHERE holder_flag IN ('1', ' ') AND card_state NOT IN {_sql_in(R.CARD_DEAD_STATES)} GROUP BY account_id
      UNION ALL
      SELECT account_id, count(card_no) AS n_primary, 0 AS n_addon FROM cards
      WHERE holder_flag = '0' AND card_state NOT IN {_sql_in(R.CARD_DEAD_STATES)} GROUP BY account_id)
GROUP BY account_id
"""
register("card_counts_one_pass", _CARD_UNION_SQL)(lambda spark, d: G.card_counts(A.cards(spark, d)))
register("card_counts_union", _CARD_UNION_SQL)(lambda spark, d: G.card_counts_union(A.cards(spark, d)))
register("unified_customer", A.sql_with("cards") + """
SELECT account_id, client_uid
FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY card_no) AS rn FROM cards) WHERE rn = 1
""")(lambda spark, d: G.unified_customer(A.cards(spark, d)))


# ---------------------------------------------------------------------------
# K17 online months, J9/K16 membership flags, K22 payment codes, K23 segments
# ---------------------------------------------------------------------------
register("online_months", A.sql_with("accounts", "ledger") + f"""
SELECT DISTINCT account_id, CAST(year(txn_date) AS BIGINT) AS year, CAST(month(txn_date) AS BIGINT) AS month
FROM ledger WHERE store_id IN {_sql_in(WEB_STORES)} AND section <> '0936'
""")(lambda spark, d: G.online_months(A.ledger(spark, d), WEB_STORES))


def membership_flags(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    snaps = A.snapshots(spark, sf_dir, acc).select("account_id", "year", "month")
    led = A.ledger(spark, sf_dir, acc)
    wo = led.where(F.col("code").isin(list(R.WRITE_OFF_CODES))).select(
        "account_id", F.year("txn_date").alias("year"), F.month("txn_date").alias("month"))
    web = G.online_months(led, WEB_STORES)
    c = A.cards(spark, sf_dir)
    text = c.select(F.when(F.col("card_no") % 4 == 0, F.col("account_id").cast("string"))
                    .otherwise(F.concat(F.lit("X"), F.col("account_id").cast("string"))).alias("card_text"))
    digital = enrich.parse_account_ids(text, "card_text")
    k = ["account_id", "year", "month"]
    out = enrich.membership_flag(snaps, wo, k, k, "write_off_flag")
    out = enrich.membership_flag(out, web, k, k, "web_flag")
    out = enrich.membership_flag(out, digital, ["account_id"], ["account_id"], "digital_flag", as_string=True)
    return out


register("membership_flags", A.sql_with("accounts", "snapshots", "ledger", "cards", extra={
    "wo": f"""SELECT DISTINCT account_id, year(txn_date) AS year, month(txn_date) AS month FROM ledger
              WHERE code IN {_sql_in(R.WRITE_OFF_CODES)}""",
    "web": f"""SELECT DISTINCT account_id, year(txn_date) AS year, month(txn_date) AS month FROM ledger
               WHERE store_id IN {_sql_in(WEB_STORES)} AND section <> '0936'""",
    "dig": """SELECT DISTINCT CAST(TRY_CAST(CASE WHEN card_no % 4 = 0 THEN CAST(account_id AS VARCHAR)
                                               ELSE 'X' || CAST(account_id AS VARCHAR) END AS DECIMAL(38,0)) AS BIGINT)
                AS account_id FROM cards"""}) + """
SELECT s.account_id, CAST(s.year AS BIGINT) AS year, CAST(s.month AS BIGINT) AS month,
       CAST(CASE WHEN wo.account_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS write_off_flag,
       CAST(CASE WHEN web.account_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS web_flag,
       CASE WHEN dig.account_id IS NULL THEN '0' ELSE '1' END AS digital_flag
FROM snapshots s
LEFT JOIN wo ON wo.account_id = s.account_id AND wo.year = s.year AND wo.month = s.month
LEFT JOIN web ON web.account_id = s.account_id AND web.year = s.year AND web.month = s.month
LEFT JOIN dig ON dig.account_id = s.account_id
""")(membership_flags)


def payment_code_max(spark, sf_dir):
    s = A.snapshots(spark, sf_dir)
    return s.select("account_id", "year", "month", "pay_history",
                    enrich.payment_code_max(F.col("pay_history")).alias("pay_max"))


register("payment_code_max", A.sql_with("accounts", "snapshots") + """
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, pay_history,
       CAST(list_max([TRY_CAST(substr(pay_history, 1, 1) AS INTEGER), TRY_CAST(substr(pay_history, 2, 1) AS INTEGER),
                      TRY_CAST(substr(pay_history, 3, 1) AS INTEGER), TRY_CAST(substr(pay_history, 4, 1) AS INTEGER),
                      TRY_CAST(substr(pay_history, 5, 1) AS INTEGER), TRY_CAST(substr(pay_history, 6, 1) AS INTEGER)])
            AS BIGINT) AS pay_max
FROM snapshots
""")(payment_code_max)


# the derived generations meet in 1998; SQL of the two, each cut at its own side
MACRO_SPLIT = (_dt.date(1995, 3, 1), _dt.date(1998, 1, 1))
MACRO_BOTH = f"""(SELECT * FROM macro_old WHERE segment_date BETWEEN {_d(MACRO_SPLIT[0])} AND {_d(MACRO_SPLIT[1] - _dt.timedelta(days=1))}
                  UNION ALL SELECT * FROM macro_new WHERE segment_date >= {_d(MACRO_SPLIT[1])})"""


def segment_history_union(spark, sf_dir):
    # the whole older generation: no first day, so every order gives its row once, from the generation of its date
    seg = enrich.segment_history(A.macro_segments(spark, sf_dir, "old"), A.macro_segments(spark, sf_dir, "new"),
                                 first=None, second=MACRO_SPLIT[1])
    return seg.select("account_id", "year", "month", "segment_date", "segment_official",
                      enrich.macro_segment_label(F.col("segment_official")).alias("macro_segment"))


register("segment_history_union", A.sql_with("macro_old", "macro_new") + f"""
SELECT account_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, segment_date,
       CAST(segment_official AS BIGINT) AS segment_official,
       CASE WHEN segment_official IN (0, 99) OR segment_official IS NULL THEN 'No clasificado'
            ELSE CAST(segment_official AS VARCHAR) END AS macro_segment
FROM (SELECT *, row_number() OVER (PARTITION BY account_id, year, month ORDER BY segment_date DESC, ref_id ASC) AS rn
      FROM (SELECT *, year(segment_date) AS year, month(segment_date) AS month
            FROM (SELECT * FROM macro_old WHERE segment_date < {_d(MACRO_SPLIT[1])}
                  UNION ALL SELECT * FROM macro_new WHERE segment_date >= {_d(MACRO_SPLIT[1])})))
WHERE rn = 1
""")(segment_history_union)


def exclusion_list(spark, sf_dir):
    s = A.snapshots(spark, sf_dir)
    s = s.where(~F.col("account_id").isin(list(EXCLUDED_ACCOUNTS)) & ~F.col("state").isin("T"))
    return s.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.countDistinct("account_id").alias("n_accounts"))


register("exclusion_list", A.sql_with("accounts", "snapshots") + f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts
FROM snapshots WHERE account_id NOT IN {_sql_in(EXCLUDED_ACCOUNTS)} AND state NOT IN ('T')
GROUP BY year, month
""")(exclusion_list)


# ---------------------------------------------------------------------------
# K3 cohort, K14 vintage panel, K15 horizon, W10/W11 initial state
# ---------------------------------------------------------------------------
COHORT_PRODUCT, COHORT_BRAND, COHORT_SINCE = 110, 200, _dt.date(1995, 2, 1)
COHORT_STORES = tuple(f"{i:04d}" for i in range(10, 40))


def cohort_new_accounts(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    return panel.cohort(acc, A.clients(acc), COHORT_PRODUCT, COHORT_BRAND, COHORT_SINCE, COHORT_STORES)


COHORT_CTE = {"coh": f"""
    SELECT a.account_id, a.product, a.brand, a.open_date, a.store_id, year(a.open_date) AS open_year,
           month(a.open_date) AS open_month, c.sex, c.birth_date,
           year(a.open_date) * 100 + month(a.open_date) AS open_yyyymm
    FROM accounts a LEFT JOIN clients c
      ON a.account_id = c.account_id AND a.brand = c.logo AND a.open_date = c.client_open_date
    WHERE a.brand = {COHORT_BRAND} AND a.product = {COHORT_PRODUCT} AND a.open_date >= {_d(COHORT_SINCE)}
      AND a.store_id IN {_sql_in(COHORT_STORES)}"""}

register("cohort_new_accounts", A.sql_with("accounts", "clients", extra=COHORT_CTE) + """
SELECT account_id, CAST(product AS BIGINT) AS product, CAST(brand AS BIGINT) AS brand, open_date, store_id,
       CAST(open_year AS BIGINT) AS open_year, CAST(open_month AS BIGINT) AS open_month, sex, birth_date,
       CAST(open_yyyymm AS BIGINT) AS open_yyyymm
FROM coh
""")(cohort_new_accounts)


def _base_origins(spark, sf_dir):
    """Origins of the dispositions panel: account-months with a cash advance."""
    b = signed_monthly_base(spark, sf_dir)
    return b.select("account_id", "origin_year", "origin_month").distinct()


def vintage_panel(spark, sf_dir):
    s = A.snapshots(spark, sf_dir).select("account_id", "year", "month", "level")
    return panel.vintage_panel(_base_origins(spark, sf_dir), s)


_ORIGINS_SQL = {**SIGNED_BASE_CTES, "org": "SELECT DISTINCT account_id, origin_year, origin_month FROM sb",
                "vp": """SELECT o.account_id, o.origin_year, o.origin_month, s.year, s.month, s.level,
                                (s.year - o.origin_year) * 12 + (s.month - o.origin_month) AS vintage_offset
                         FROM org o JOIN snapshots s ON s.account_id = o.account_id
                         WHERE (s.year - o.origin_year) * 12 + (s.month - o.origin_month) >= 0"""}

register("vintage_panel", A.sql_with("accounts", "ledger", "successor_map", "snapshots", extra=_ORIGINS_SQL) + """
SELECT account_id, CAST(origin_year AS BIGINT) AS origin_year, CAST(origin_month AS BIGINT) AS origin_month,
       CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(level AS BIGINT) AS level,
       CAST(vintage_offset AS BIGINT) AS vintage_offset
FROM vp
""")(vintage_panel)


def horizon_bucket(spark, sf_dir):
    p = vintage_panel(spark, sf_dir)
    return (p.groupBy("vintage_offset").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("vintage_offset", P.horizon_bucket("vintage_offset", 3).alias("horizon_3"),
                    P.horizon_bucket("vintage_offset", 4).alias("horizon_4"), "n_rows"))


def _horizon_sql(col: str, years: int) -> str:
    return "CASE " + " ".join(f"WHEN {col} <= {12 * y} THEN 'Y{y}'" for y in range(1, years + 1)) + " ELSE 'OTRO' END"


register("horizon_bucket", A.sql_with("accounts", "ledger", "successor_map", "snapshots", extra=_ORIGINS_SQL) + f"""
SELECT CAST(vintage_offset AS BIGINT) AS vintage_offset, {_horizon_sql('vintage_offset', 3)} AS horizon_3,
       {_horizon_sql('vintage_offset', 4)} AS horizon_4, CAST(count(*) AS BIGINT) AS n_rows
FROM vp GROUP BY vintage_offset
""")(horizon_bucket)


def initial_state(spark, sf_dir):
    """State of each vintage at its first observation month, as
    ``first_observation`` (an aggregate over a narrow panel, no window)."""
    s = panel.prepare_snapshot(A.snapshots(spark, sf_dir)).select(
        "account_id", "year", "month", "level", "score", "limit_band", "util_ratio")
    f = panel.first_observation(_base_origins(spark, sf_dir), s,
                                ["year", "month", "level", "score", "limit_band", "util_ratio"])
    return f.select("account_id", "origin_year", "origin_month", F.col("first_level").alias("initial_level"),
                    F.col("first_score").alias("initial_score"), F.col("first_limit_band").alias("initial_limit_band"),
                    R.UTILISATION_BAND.column(ratio="first_util_ratio").alias("initial_util_band"))


_UTIL_RATIO_SQL = ("CASE WHEN s.credit_limit IS NULL OR s.credit_limit = 0 THEN -1.0 "
                   "ELSE CAST(s.balance AS DOUBLE) / CAST(s.credit_limit AS DOUBLE) END")
register("initial_state", A.sql_with("accounts", "ledger", "successor_map", "snapshots", extra={
    **{k: v for k, v in _ORIGINS_SQL.items() if k != "vp"},
    "vp2": f"""SELECT o.account_id, o.origin_year, o.origin_month, s.year, s.month, s.level, s.score,
                      {R.AMOUNT_BAND.sql(product='s.product', amount='s.credit_limit')} AS limit_band,
                      {R.UTILISATION_BAND.sql(ratio=f'({_UTIL_RATIO_SQL})')} AS util_band
               FROM org o JOIN snapshots s ON s.account_id = o.account_id
               WHERE (s.year - o.origin_year) * 12 + (s.month - o.origin_month) >= 0"""}) + """
SELECT DISTINCT account_id, CAST(origin_year AS BIGINT) AS origin_year, CAST(origin_month AS BIGINT) AS origin_month,
       CAST(first_value(level) OVER w AS BIGINT) AS initial_level,
       CAST(first_value(score) OVER w AS BIGINT) AS initial_score,
       first_value(limit_band) OVER w AS initial_limit_band,
       first_value(util_band) OVER w AS initial_util_band
FROM vp2
WINDOW w AS (PARTITION BY account_id, origin_year, origin_month ORDER BY year, month)
""")(initial_state)


# ---------------------------------------------------------------------------
# K18-K21 overdraft chain
# ---------------------------------------------------------------------------
def _events(spark, sf_dir):
    return overdraft.closed_month_events(A.auth_events(spark, sf_dir), A.successor_map(spark, sf_dir),
                                         OVERDRAFT_RUN_DATE, EXCLUDED_ACCOUNTS)


def od_ctes(start: _dt.date, end: _dt.date) -> dict[str, str]:
    """The overdraft chain over the months from ``start`` to ``end``."""
    return {
    "e": f"""SELECT ev.*, COALESCE(m.successor_id, ev.account_id) AS track_id,
                    year(ev.proc_date) AS year, month(ev.proc_date) AS month,
                    ev.auth_balance + ev.auth_amount AS exposure
             FROM auth_events ev LEFT JOIN successor_map m ON m.account_id = ev.account_id
             WHERE ev.decision IN ('1', '2') AND ev.auth_amount <> 1
               AND ev.proc_date >= {_d(start)} AND ev.proc_date <= {_d(end)}
               AND ev.account_id NOT IN {_sql_in(EXCLUDED_ACCOUNTS)}""",
    "w": """SELECT *,
               first_value(CASE WHEN decision = '1' THEN auth_limit END) OVER (
                 PARTITION BY track_id, date_trunc('month', proc_date)
                 ORDER BY CASE WHEN decision = '1' THEN 0 ELSE 1 END ASC, proc_date DESC, event_id DESC)
                 AS last_limit,
               last_value(spid) OVER (
                 PARTITION BY track_id, date_trunc('month', proc_date) ORDER BY proc_date ASC, event_id ASC
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_spid
            FROM e""",
    "sec": f"""SELECT track_id, year, month,
                      {R.SECTION_MIX.sql(n_zero='count_if(section = 0)', n_main='count_if(section IN (1, 2, 3))')}
                        AS section_mix
               FROM w GROUP BY track_id, year, month""",
    "apr": """SELECT track_id, year, month, count(DISTINCT track_id) AS n_accounts,
                     sum(CASE WHEN decision = '1' THEN 1 ELSE 0 END) AS n_approved,
                     sum(CASE WHEN decision = '2' THEN 1 ELSE 0 END) AS n_declined
              FROM w GROUP BY track_id, year, month""",
    "a2": """SELECT track_id, year, month, last_spid, last_limit, decision, max(exposure) AS max_exposure,
                    sum(auth_amount) AS amount_total, count(*) AS n_events
             FROM w GROUP BY track_id, year, month, last_spid, last_limit, decision""",
    "a3": """SELECT DISTINCT a2.*, a2.max_exposure - a2.last_limit AS excess, sec.section_mix,
                    apr.n_approved, apr.n_declined
             FROM a2 LEFT JOIN sec ON sec.track_id = a2.track_id AND sec.year = a2.year AND sec.month = a2.month
             LEFT JOIN apr ON apr.track_id = a2.track_id AND apr.year = a2.year AND apr.month = a2.month
             WHERE a2.decision = '1'""",
    "man": f"""SELECT COALESCE(m.successor_id, x.account_id) AS account_id, year(x.auth_date) AS year,
                      month(x.auth_date) AS month, sum(x.released_amount) AS manual_amount, count(*) AS manual_count
               FROM manual_auths x LEFT JOIN successor_map m ON m.account_id = x.account_id
               WHERE x.auth_date >= {_d(start)} AND x.auth_date < {_d(end + _dt.timedelta(days=1))}
               GROUP BY ALL""",
    "mrg": f"""SELECT CASE WHEN a3.track_id IS NULL THEN man.account_id ELSE a3.track_id END AS account_id,
                      CASE WHEN a3.year IS NULL THEN man.year ELSE a3.year END AS origin_year,
                      CASE WHEN a3.month IS NULL THEN man.month ELSE a3.month END AS origin_month,
                      a3.last_spid AS spid, a3.last_limit AS limit_auth, a3.max_exposure AS balance_auth,
                      a3.amount_total AS amount_auth, a3.excess AS overdraft_amount, a3.section_mix AS section,
                      a3.n_approved, a3.n_declined, a3.n_events + a3.n_declined AS n_decided, man.manual_count,
                      COALESCE(a3.n_events, 0) + COALESCE(man.manual_count, 0) AS total_approved,
                      man.manual_amount,
                      COALESCE(a3.amount_total, 0) + COALESCE(man.manual_amount, 0) AS total_amount,
                      {R.OVERDRAFT_ORIGIN.sql(auto='a3.n_approved', manual='man.manual_count', section='a3.section_mix')}
                        AS origin_class
               FROM a3 FULL JOIN man ON a3.track_id = man.account_id AND a3.year = man.year AND a3.month = man.month""",
    }


OD_CTES = od_ctes(OD_START, OD_END)
OD_SQL_WITH = A.sql_with("auth_events", "manual_auths", "successor_map", "accounts", "snapshots", extra=OD_CTES)
_MRG_COLS = """account_id, CAST(origin_year AS BIGINT) AS origin_year, CAST(origin_month AS BIGINT) AS origin_month,
       spid, CAST(limit_auth AS DOUBLE) AS limit_auth, CAST(balance_auth AS DOUBLE) AS balance_auth,
       CAST(amount_auth AS DOUBLE) AS amount_auth, CAST(overdraft_amount AS DOUBLE) AS overdraft_amount,
       CAST(section AS BIGINT) AS section, CAST(n_approved AS BIGINT) AS n_approved,
       CAST(n_declined AS BIGINT) AS n_declined, CAST(n_decided AS BIGINT) AS n_decided,
       CAST(manual_count AS BIGINT) AS manual_count, CAST(total_approved AS BIGINT) AS total_approved,
       CAST(manual_amount AS DOUBLE) AS manual_amount, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(origin_class AS BIGINT) AS origin_class"""


def events_first_conditional(spark, sf_dir):
    return overdraft.month_attributes(_events(spark, sf_dir)).select("track_id", "year", "month", "last_limit")


register("events_first_conditional", OD_SQL_WITH + """
SELECT DISTINCT track_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(last_limit AS DOUBLE) AS last_limit FROM w
""")(events_first_conditional)


def events_last_full_frame(spark, sf_dir):
    return overdraft.month_attributes(_events(spark, sf_dir)).select("track_id", "year", "month", "last_spid")


register("events_last_full_frame", OD_SQL_WITH + """
SELECT DISTINCT track_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, last_spid FROM w
""")(events_last_full_frame)

register("section_mix", OD_SQL_WITH + """
SELECT track_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(section_mix AS BIGINT) AS section_mix FROM sec
""")(lambda spark, d: overdraft.section_mix(_events(spark, d)))

register("approvals_declines", OD_SQL_WITH + """
SELECT track_id, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(n_accounts AS BIGINT) AS n_accounts, CAST(n_approved AS BIGINT) AS n_approved,
       CAST(n_declined AS BIGINT) AS n_declined FROM apr
""")(lambda spark, d: overdraft.approvals_declines(_events(spark, d)))


def overdraft_auto_manual(spark, sf_dir):
    nxt = OD_END + _dt.timedelta(days=1)
    man = G.manual_auth_monthly(A.manual_auths(spark, sf_dir), A.successor_map(spark, sf_dir), OD_START, nxt)
    return overdraft.merge_manual(overdraft.auto_overdrafts(_events(spark, sf_dir)), man)


register("overdraft_auto_manual", OD_SQL_WITH + f"SELECT {_MRG_COLS} FROM mrg")(overdraft_auto_manual)


def overdraft_closing(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    return overdraft.overdraft_episodes(A.auth_events(spark, sf_dir), A.manual_auths(spark, sf_dir),
                                        A.snapshots(spark, sf_dir, acc), A.successor_map(spark, sf_dir),
                                        OVERDRAFT_RUN_DATE, EXCLUDED_ACCOUNTS)


def od_closing_ctes(start: _dt.date, end: _dt.date) -> dict[str, str]:
    return {"cl": f"""SELECT COALESCE(m.successor_id, s.account_id) AS account_id, s.year, s.month, s.product,
                           CASE WHEN s.credit_limit < s.balance THEN 1 ELSE 0 END AS over_limit,
                           s.balance AS closing_balance
                    FROM snapshots s LEFT JOIN successor_map m ON m.account_id = s.account_id
                    WHERE s.year * 100 + s.month BETWEEN {start.year * 100 + start.month} AND {end.year * 100 + end.month}
                      AND s.product IN {_sql_in(R.FAMILIES_ALL)} AND s.state NOT IN ('T')""",
                   "ep": """SELECT DISTINCT mrg.*, cl.over_limit, cl.product, cl.closing_balance
                    FROM mrg LEFT JOIN cl ON cl.account_id = mrg.account_id AND cl.year = mrg.origin_year
                      AND cl.month = mrg.origin_month
                    WHERE cl.product IS NOT NULL"""}


OD_CLOSING_CTES = od_closing_ctes(OD_START, OD_END)
OD_EPISODES_SQL = A.sql_with("auth_events", "manual_auths", "successor_map", "accounts", "snapshots",
                             extra={**OD_CTES, **OD_CLOSING_CTES})
register("overdraft_closing", OD_EPISODES_SQL + f"""
SELECT {_MRG_COLS}, CAST(over_limit AS BIGINT) AS over_limit, CAST(product AS BIGINT) AS product,
       CAST(closing_balance AS DOUBLE) AS closing_balance
FROM ep
""")(overdraft_closing)


# ---------------------------------------------------------------------------
# P11 equality to a scalar subquery: the latest load of the zone table
# ---------------------------------------------------------------------------
def zone_latest_load(spark, sf_dir):
    z = windows.latest_load(A.zone_history(spark, sf_dir), "load_date")
    return z.select("store_id", "store_desc", "zone_desc", "load_date")


register("zone_latest_load", A.sql_with("zone_history") + """
SELECT store_id, store_desc, zone_desc, load_date FROM zone_history
WHERE load_date = (SELECT max(load_date) FROM zone_history)
""")(zone_latest_load)


def zone_store_latest_load(spark, sf_dir):
    """P11 on a store with one folder per load: the scan opens the latest one only."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/zone-loads-{uuid.uuid4().hex}"
    A.zone_history(spark, sf_dir).write.partitionBy("load_date").parquet(path)
    z = windows.latest_stored_load(spark.read.parquet(path), "load_date")
    return z.select("store_id", "store_desc", "zone_desc", "load_date")


register("zone_store_latest_load", A.sql_with("zone_history") + """
SELECT store_id, store_desc, zone_desc, load_date FROM zone_history
WHERE load_date = (SELECT max(load_date) FROM zone_history)
""")(zone_store_latest_load)


# ---------------------------------------------------------------------------
# W4, W7, K25 client history; K16 insured accounts
# ---------------------------------------------------------------------------
CLIENTS_AS_OF = _dt.date(1999, 6, 30)


def client_picks(spark, sf_dir):
    """Which version each rule picks, beside the one that opened first."""
    return clients.picks(A.client_history(spark, sf_dir))


_PICK_SQL = """
SELECT c.account_id, c.n_versions, p.client_id AS previous_client_id, p.birth_date AS previous_birth_date,
       l.client_id AS load_client_id, l.birth_date AS load_birth_date, o.client_id AS open_client_id,
       o.birth_date AS open_birth_date
FROM (SELECT account_id, count(*) AS n_versions FROM h GROUP BY account_id) c
JOIN (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY previous_id DESC NULLS LAST, client_id) = 1) p
  USING (account_id)
JOIN (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY load_date ASC NULLS FIRST, client_id) = 1) l
  USING (account_id)
JOIN (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY client_open_date NULLS LAST, client_id) = 1) o
  USING (account_id)
"""
register("client_picks", A.sql_with("client_history", extra={
    "h": "SELECT * FROM client_history WHERE source_system = 12"}) + _PICK_SQL)(client_picks)


def client_store_as_of(spark, sf_dir):
    """The same picks from the stored history as it stood on a day: folders of other systems and later loads stay closed."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/client-history-{uuid.uuid4().hex}"
    clients.write_versions(A.client_history(spark, sf_dir), path)
    return clients.picks(clients.read_versions(spark, path), as_of=CLIENTS_AS_OF)


register("client_store_as_of", A.sql_with("client_history", extra={
    "h": f"""SELECT * FROM client_history
             WHERE source_system = 12 AND (load_date IS NULL OR load_date <= {_d(CLIENTS_AS_OF)})"""}) + _PICK_SQL)(
    client_store_as_of)


def insured_accounts(spark, sf_dir):
    """Every account with its insured flag."""
    acc = A.accounts(spark, sf_dir).select("account_id", "product", "brand")
    return enrich.membership_flag(acc, enrich.insured_ids(A.policies(spark, sf_dir)), ["account_id"], ["account_id"], "insured_flag")


register("insured_accounts", A.sql_with("accounts", "policies") + """
SELECT a.account_id, CAST(product AS BIGINT) AS product, CAST(brand AS BIGINT) AS brand,
       CAST(CASE WHEN p.id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS insured_flag
FROM accounts a LEFT JOIN (
  SELECT DISTINCT TRY_CAST(external_id AS DECIMAL(38,0)) AS id FROM policies
  WHERE business_line = 'Polizas Internas' AND policy_state IN ('Activado', 'Activado por migracion', 'Reactivado')) p
  ON p.id = a.account_id
""")(insured_accounts)
