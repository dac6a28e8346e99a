"""Cohorts, snapshot preparation and vintage panels.

A *vintage panel* pairs every origin (account, origin month) with the same
account's later snapshots: one row per (account, origin month, observation
month) with offset >= 0.  It is an equi-join on the account key plus a
month-offset predicate, so Spark plans a sort-merge (or, when one side is
small at runtime, broadcast-hash) join on the account -- never a cartesian
product.  The expansion per account is bounded by the months it has on
book; prune both sides to the reporting window and to the needed columns
before the join.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions import ruleset as R
from vintagelake.functions.periods import calendar_years, horizon_bucket, month_offset, yyyymm


def cohort(accounts: DataFrame, clients: DataFrame, product: int, brand: int, since: _dt.date,
           stores: Sequence[str] | None = None) -> DataFrame:
    """K3: new accounts of one product/brand opened on or after ``since``.

    The client attributes come from a left join keyed by (account, logo,
    open date) -- a date-keyed join (J3): a client row dated differently
    leaves the attributes NULL instead of dropping the account.
    """
    a = accounts.where((F.col("brand") == brand) & (F.col("product") == product)
                       & (F.col("open_date") >= F.lit(since)))
    if stores is not None:
        a = a.where(F.col("store_id").isin(list(stores)))
    c = clients.select(F.col("account_id").alias("c_id"), F.col("logo").alias("c_logo"),
                       F.col("client_open_date").alias("c_open"), "sex", "birth_date")
    j = a.join(c, (a.account_id == c.c_id) & (a.brand == c.c_logo) & (a.open_date == c.c_open), "left")
    y, m = F.year("open_date"), F.month("open_date")
    return j.select("account_id", "product", "brand", "open_date", "store_id",
                    y.alias("open_year"), m.alias("open_month"), "sex", "birth_date",
                    yyyymm(y, m).alias("open_yyyymm"))


def utilisation(balance: Column, limit: Column) -> Column:
    """Balance / limit in double; -1 when the limit is NULL or 0."""
    return (F.when(limit.isNull() | (limit == 0), F.lit(-1.0))
            .otherwise(F.try_divide(balance.cast("double"), limit.cast("double"))))


def utilisation_nonpositive(balance: Column, limit: Column) -> Column:
    """F16 variant: -1 when the limit is <= 0, else balance / limit."""
    return F.when(limit <= 0, F.lit(-1.0)).otherwise(F.try_divide(balance.cast("double"), limit.cast("double")))


def prepare_snapshot(snap: DataFrame, since_yyyymm: int | None = None,
                     limit_band=R.AMOUNT_BAND, balance_band=R.AMOUNT_BAND) -> DataFrame:
    """K4: period key, headroom, utilisation and the per-snapshot bands.

    Bands are computed once per snapshot row (before any panel expansion).
    ``since_yyyymm`` is applied as (year >= y) AND (yyyymm >= since) so the
    year bound reaches the scan as a pushed filter.
    """
    s = snap
    if since_yyyymm is not None:
        s = s.where((F.col("year") >= since_yyyymm // 100) & (yyyymm("year", "month") >= since_yyyymm))
    bal, lim = F.col("balance"), F.col("credit_limit")
    return s.withColumns({
        "obs_yyyymm": yyyymm("year", "month"),
        "headroom": (lim - bal),
        "util_ratio": utilisation(bal, lim),
        "limit_band": limit_band.column(product="product", amount=lim),
        "balance_band": balance_band.column(product="product", amount=bal),
    })


def origins_from_accounts(accounts: DataFrame, date_col: str = "open_date") -> DataFrame:
    """Origin set keyed (account, origin month) from an opening date."""
    return (accounts.where(F.col(date_col).isNotNull())
            .select("account_id", F.year(date_col).alias("origin_year"), F.month(date_col).alias("origin_month")))


# Hot-key salting of the vintage join (see ``vintage_panel``): a key whose
# origins x snapshots come to HOT_KEY_ROWS or more is spread over as many
# tasks as keep each below that.  CONF_HOT_KEY_ROWS sets another size per
# session, CONF_SALT_BUCKETS a fixed number of tasks.
HOT_KEY_ROWS = 200_000
CONF_SALT_BUCKETS = "vintagelake.panel.saltBuckets"
CONF_HOT_KEY_ROWS = "vintagelake.panel.hotKeyRows"


def hot_keys(origins: DataFrame, snaps: DataFrame, key: str = "account_id", salt_buckets: int | None = None,
             hot_rows: int | None = None) -> DataFrame:
    """(__hot_key, __buckets, __split): the keys with ``hot_rows`` panel rows or
    more, the tasks to spread them over, and the side to split (the longer one,
    'o' or 's').  Two counts with map-side combine, joined on the key."""
    conf = origins.sparkSession.conf
    fixed = salt_buckets if salt_buckets is not None else conf.get(CONF_SALT_BUCKETS, None)
    t = hot_rows if hot_rows is not None else int(conf.get(CONF_HOT_KEY_ROWS, str(HOT_KEY_ROWS)))
    n_o = origins.groupBy(F.col(key).alias("__hot_key")).agg(F.count(F.lit(1)).alias("__o"))
    n_s = snaps.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__s"))
    both = n_o.join(n_s, F.col("__hot_key") == F.col("__k")).where(F.col("__o") * F.col("__s") >= t)
    # no more buckets than rows to spread
    sized = F.least(F.ceil(F.col("__o") * F.col("__s") / F.lit(t)), F.greatest("__o", "__s"))
    return both.select("__hot_key", (F.lit(int(fixed)) if fixed is not None else sized).cast("int").alias("__buckets"),
                       F.when(F.col("__o") > F.col("__s"), "o").otherwise("s").alias("__split"))


def _salted(df: DataFrame, hot: DataFrame, key: str, side: str) -> DataFrame:
    """``df`` with __salt: one bucket per row of the split side, every bucket
    for the rows of the other, 0 for keys that are not hot.  The bucket is a
    hash of the row, so a retried task rebuilds the same ones."""
    bucket = F.array(F.pmod(F.hash(*[F.col(c) for c in df.columns]), F.col("__buckets")))
    salts = (F.when(F.col("__split") == side, bucket)
             .when(F.col("__split").isNotNull(), F.sequence(F.lit(0), F.col("__buckets") - 1))
             .otherwise(F.array(F.lit(0))))
    return (df.join(hot, df[key] == hot["__hot_key"], "left").withColumn("__salt", F.explode(salts))
            .drop("__hot_key", "__buckets", "__split"))


def vintage_panel(origins: DataFrame, snaps: DataFrame, key: str = "account_id",
                  origin_year: str = "origin_year", origin_month: str = "origin_month",
                  obs_year: str = "year", obs_month: str = "month",
                  salt_buckets: int | None = None, hot_rows: int | None = None,
                  hot: DataFrame | None = None, unique_origins: bool = False) -> DataFrame:
    """Origins x later snapshots of the same account.

    Written as an inner equi-join on ``key`` with the offset predicate in the
    join condition (the reference's left join is made inner by its WHERE).
    Adds ``vintage_offset`` (months from origin to observation).

    Skew: the output of one key is (its origins) x (its snapshots), so a key
    that collects many accounts (e.g. every old id resolved to successor 0)
    explodes inside one task -- a blow-up in the join *output* that AQE's
    input-size skew detection cannot see.  Hot keys (``hot_keys``) are salted:
    the rows of their longer side are spread over the key's buckets and those
    of the other side replicated per bucket; every (origin, snapshot) pair is
    still produced exactly once.  Pass ``hot`` (from the plain inputs) when a
    side carries joined enrichment, so the counts do not drag the joins along;
    pass ``unique_origins`` when no key has a second origin: nothing multiplies
    then, and no counts are taken.
    """
    o, s, cond_extra = origins, snaps, None
    if not unique_origins and salt_buckets != 1:
        if hot is None:
            hot = hot_keys(origins, snaps, key, salt_buckets, hot_rows)
        o, s = _salted(origins, hot, key, "o"), _salted(snaps, hot, key, "s")
        cond_extra = F.col("o.__salt") == F.col("s.__salt")
    o, s = o.alias("o"), s.alias("s")
    off = month_offset(F.col(f"o.{origin_year}"), F.col(f"o.{origin_month}"),
                       F.col(f"s.{obs_year}"), F.col(f"s.{obs_month}"))
    cond = (F.col(f"o.{key}") == F.col(f"s.{key}")) & (off >= 0)
    if cond_extra is not None:
        cond = cond & cond_extra
    j = o.join(s, cond, "inner")
    s_cols = [F.col(f"s.{c}") for c in snaps.columns if c != key and c not in origins.columns]
    return j.select(F.col(f"o.{key}").alias(key), *[F.col(f"o.{c}") for c in origins.columns if c != key],
                    *s_cols, off.alias("vintage_offset"))


def first_observation(origins: DataFrame, snaps: DataFrame, order: Sequence[str], key: str = "account_id",
                      origin_year: str = "origin_year", origin_month: str = "origin_month",
                      where: Column | None = None) -> DataFrame:
    """The first panel row of every vintage under ``order``
    (ascending, NULLs first), one row per (key, origin month).

    Computed as ``min(struct(order))`` over a *narrow* panel (keys and order
    columns only): a hash aggregate with map-side combine, instead of a
    window that would shuffle and fully sort the wide expanded panel.  Join
    the result onto the origins before the wide expansion.
    """
    p = vintage_panel(origins, snaps, key, origin_year, origin_month)
    if where is not None:
        p = p.where(where)
    g = p.groupBy(key, origin_year, origin_month).agg(F.min(F.struct(*order)).alias("__first"))
    return g.select(key, origin_year, origin_month, *[F.col(f"__first.{c}").alias(f"first_{c}") for c in order])


def vintage_delinquency(origins: DataFrame, snaps: DataFrame, years: int = 4,
                        unique_origins: bool = False) -> DataFrame:
    """Flagship: 30+/90+ delinquency rate by vintage (origin YYYYMM) and offset.

    The panel is aggregated straight away; the group key (vintage, offset)
    has a small cardinality, so the partial (map-side) aggregate shrinks the
    expansion to a few rows per task before the shuffle.
    """
    p = vintage_panel(origins, snaps.select("account_id", "year", "month", "level"), unique_origins=unique_origins)
    p = p.withColumns({
        "vintage": yyyymm("origin_year", "origin_month").cast("long"),
        "f30": R.FLAG_30.column(level="level"),
        "f90": R.FLAG_90.column(level="level"),
    })
    agg = (p.groupBy("vintage", F.col("vintage_offset").cast("long").alias("mob"))
           .agg(F.count(F.lit(1)).alias("n_accounts"), F.sum("f30").cast("long").alias("n_30"),
                F.sum("f90").cast("long").alias("n_90")))
    return agg.select("vintage", "mob", horizon_bucket("mob", years).alias("horizon"), "n_accounts", "n_30", "n_90",
                      (F.col("n_30").cast("double") / F.col("n_accounts").cast("double")).alias("rate_30"))


def age_at(run_date: _dt.date, birth: str = "birth_date") -> Column:
    """Age by calendar-year boundaries at a run date."""
    return calendar_years(F.lit(run_date), F.col(birth))
