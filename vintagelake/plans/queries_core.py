"""Core queries: vintage panel and delinquency, cohorts, keys, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from vintagelake.functions import periods as P
from vintagelake.functions import ruleset as R
from vintagelake.operators import panel
from vintagelake.plans.registry import register
from vintagelake.sources import analogues as A
from vintagelake.sources.tables import read_table

_F30_SQL = R.FLAG_30.sql(level="s.level")
_F90_SQL = R.FLAG_90.sql(level="s.level")


def _horizon_sql(col: str, years: int = 4) -> str:
    whens = " ".join(f"WHEN {col} <= {12 * y} THEN 'Y{y}'" for y in range(1, years + 1))
    return f"CASE {whens} ELSE 'OTRO' END"


VINTAGE_DELINQUENCY_SQL = A.sql_with("accounts", "snapshots", extra={
    "origins": """SELECT account_id, CAST(year(open_date) AS INTEGER) AS oy, CAST(month(open_date) AS INTEGER) AS om
                  FROM accounts WHERE open_date IS NOT NULL""",
    "panel": f"""SELECT o.oy * 100 + o.om AS vintage, (s.year - o.oy) * 12 + (s.month - o.om) AS mob,
                        {_F30_SQL} AS f30, {_F90_SQL} AS f90
                 FROM origins o JOIN snapshots s ON s.account_id = o.account_id
                 WHERE (s.year - o.oy) * 12 + (s.month - o.om) >= 0""",
}) + f"""
SELECT CAST(vintage AS BIGINT) AS vintage, CAST(mob AS BIGINT) AS mob, {_horizon_sql('mob')} AS horizon,
       CAST(count(*) AS BIGINT) AS n_accounts, CAST(sum(f30) AS BIGINT) AS n_30, CAST(sum(f90) AS BIGINT) AS n_90,
       CAST(sum(f30) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate_30
FROM panel GROUP BY vintage, mob
"""


def vintage_delinquency(spark, sf_dir):
    acc = A.accounts(spark, sf_dir)
    snaps = A.snapshots(spark, sf_dir, acc)
    return panel.vintage_delinquency(panel.origins_from_accounts(acc), snaps, unique_origins=True)


register("vintage_delinquency", VINTAGE_DELINQUENCY_SQL)(vintage_delinquency)


def parse_dates(spark, sf_dir):
    """Eight-digit dates parsed from text, one in ten unreadable, and the month's first day."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    digits = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("x"), digits)).otherwise(digits)
    parsed = o.select(F.col("o_orderkey").cast("long").alias("order_id"), P.parse_yyyymmdd(text).alias("order_date"))
    return parsed.withColumn("order_month", P.month_start("order_date"))


register("parse_dates", """
SELECT CAST(o_orderkey AS BIGINT) AS order_id,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS order_month
FROM orders
""")(parse_dates)
