"""Enrichment: membership flags, lookups and the wide star join (J9, J12,
K16, K22-K27, K31).

Star joins are chains of LEFT joins onto one base; each right side must be
unique on its join key or it silently multiplies base rows (the fan-out
quirk).  ``star_join`` therefore aggregates/deduplicates every dimension to
its key first; ``assert_unique`` is the test-side check.  Dimensions are
not force-broadcast: most are account-sized and grow with the data, so the
size-checked planner (AQE) decides per join at runtime.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.functions import ruleset as R
from vintagelake.operators.windows import latest


def membership_flag(base: DataFrame, ids: DataFrame, base_keys: Sequence[str], id_keys: Sequence[str],
                    out: str, as_string: bool = False) -> DataFrame:
    """1 when the base key appears in ``ids`` (left join to the
    DISTINCT ids, IS NULL -> 0)."""
    d = ids.select(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(id_keys)]).distinct()
    d = d.withColumn("__hit", F.lit(1))
    cond = None
    for i, k in enumerate(base_keys):
        c = base[k] == d[f"__m{i}"]
        cond = c if cond is None else cond & c
    j = base.join(d, cond, "left")
    flag = F.when(F.col("__hit").isNull(), F.lit(0)).otherwise(F.lit(1))
    flag = flag.cast("string") if as_string else flag
    return j.withColumn(out, flag).drop("__hit", *[f"__m{i}" for i in range(len(id_keys))])


def parse_account_ids(df: DataFrame, col: str, out: str = "account_id") -> DataFrame:
    """SAFE_CAST of free-text card numbers; unparsable rows give NULL."""
    return df.select(F.expr(f"try_cast({col} AS DECIMAL(38,0))").cast("long").alias(out)).distinct()


def payment_code_max(history: Column, positions: int = 6) -> Column:
    """Max of the first ``positions`` one-char payment codes,
    ignoring characters that do not parse as numbers (``array_max`` skips
    the NULLs ``try_cast`` leaves)."""
    arr = F.array(*[F.substring(history, i, 1) for i in range(1, positions + 1)])
    return F.array_max(F.transform(arr, lambda x: x.try_cast("int")))


# FIXED VALUES: the first day read of each generation of the macro segments
MACRO_FIRST, MACRO_SECOND = _dt.date(2019, 1, 1), _dt.date(2023, 1, 1)


def segment_history(old: DataFrame, new: DataFrame, first: _dt.date | None = MACRO_FIRST,
                    second: _dt.date = MACRO_SECOND) -> DataFrame:
    """K23 / U1 + W2: the older generation of the macro segments before ``second`` (and from ``first``), the newer
    from then on; per account-month the latest row of its source (ties by a stable reference id).

    The dates do not overlap and months do not cross ``second`` (the first of a month), so the two picks are united
    without another exchange and no account-month comes from both."""
    if second.day != 1:
        raise ValueError("the generations change on the first of a month")
    day = F.col("segment_date")
    older = old.where(day < F.lit(second))
    if first is not None:
        older = older.where(day >= F.lit(first))
    return segment_latest(older).unionByName(segment_latest(new.where(day >= F.lit(second))))


def segment_of_latest_date(source: DataFrame) -> DataFrame:
    """J10 on one source without date bounds: the rows of the latest date of each account-month.

    The source keeps ties of that date, which would multiply the fact (Q7); here the smallest code of the tied ones
    stays.  One aggregate with map-side combine in place of the self-join."""
    keys = ["account_id", F.year("segment_date").alias("year"), F.month("segment_date").alias("month")]
    top = source.groupBy(*keys).agg(F.max(F.struct("segment_date", -F.col("segment_official"), "segment_official")).alias("s"))
    return top.select("account_id", "year", "month", F.col("s.segment_official").alias("segment_official"))


def segment_latest(u: DataFrame) -> DataFrame:
    """The latest macro-segment row per account-month."""
    u = u.withColumns({"year": F.year("segment_date"), "month": F.month("segment_date")})
    return latest(u, ["account_id", "year", "month"], [F.col("segment_date").desc()], [F.col("ref_id").asc()])


def macro_segment_label(seg: Column) -> Column:
    """0, 99 or NULL -> 'No clasificado', else the code as text."""
    return (F.when(seg.isin(list(R.MACRO_SEGMENT_UNCLASSIFIED)) | seg.isNull(), F.lit("No clasificado"))
            .otherwise(seg.cast("string")))


def zone_normalise(history: DataFrame) -> DataFrame:
    """Latest zone row per store, zone name cleaned and zone id.

    The id matches the *raw* name, so accented spellings keep id 13 even
    though the cleaned name is unaccented.
    """
    z = latest(history, ["store_id"], [F.col("year").desc(), F.col("month").desc()])
    raw = F.col("zone_desc")
    clean = (F.when(raw.isNull(), F.lit("Otro"))
             .otherwise(F.coalesce(R.ZONE_NAME_CLEAN.column(zone=raw, zone_trimmed=F.trim(raw)), raw)))
    zid = F.when(raw.isNull(), F.lit("13")).otherwise(R.ZONE_ID.column(zone=raw))
    return z.select("store_id", "store_desc", clean.alias("zone"), zid.alias("zone_id"))


def demographic_labels(joined: DataFrame, run_date) -> DataFrame:
    """Gender label and age at the run date, from sex and birth date of the joined client version.

    The label is set after the join: an account without a client row gets the label of an unknown sex."""
    return joined.withColumns({"gender": R.GENDER_FROM_LETTER.column(sex="sex"),
                               "age": F.year(F.lit(run_date)) - F.year("birth_date")}).drop("sex", "birth_date")


# FIXED VALUES: what counts as an insured account
INSURED_LINE = "Polizas Internas"
INSURED_STATES = ("Activado", "Activado por migracion", "Reactivado")


def insured_ids(policies: DataFrame, line: str = INSURED_LINE, states: Sequence[str] = INSURED_STATES,
                accounts: DataFrame | None = None) -> DataFrame:
    """Accounts with a policy in force of the internal line, parsed from free text.

    Line and state reach the scan as pushed filters.  With ``accounts`` (the few accounts of a panel) the policies are
    reduced by a semi join before the DISTINCT; where the session enables runtime filters, Spark builds its Bloom filter
    from the accounts and applies it at the policies' scan, so other accounts' rows are never shuffled."""
    ids = policies.where((F.col("business_line") == line) & F.col("policy_state").isin(*states)) \
        .select(F.expr("try_cast(external_id AS DECIMAL(38,0))").cast("long").alias("account_id"))
    ids = ids.where(F.col("account_id").isNotNull())
    if accounts is not None:
        ids = ids.join(accounts, "account_id", "left_semi")
    return ids.distinct()


def attach_application(base: DataFrame, apps: DataFrame, org: int, logo: int, since) -> DataFrame:
    """Application status of the account.  The source can hold several
    applications per account; joining it raw would multiply the base rows,
    so it is reduced to the latest application per account first."""
    a = apps.where((F.col("org") == org) & (F.col("logo") == logo) & (F.col("app_date") >= F.lit(since)))
    a = latest(a, ["account_id"], [F.col("app_date").desc()], [F.col("app_id").desc()]).select(
        F.col("account_id").alias("__app_id"), "app_status", "app_status_desc")
    return base.join(a, base.account_id == a.__app_id, "left").drop("__app_id")


@dataclass
class Dim:
    """One star-join dimension: ``df`` joined on ``on`` (base col -> dim col)."""

    df: DataFrame
    on: dict
    columns: Sequence[str] = field(default_factory=tuple)
    defaults: dict = field(default_factory=dict)
    unique: bool = False   # True when df is already one row per key (e.g. aggregated on it)


def star_join(base: DataFrame, dims: Sequence[Dim], first_copy: str | None = None) -> DataFrame:
    """Chained LEFT joins; each dimension not already unique on its
    key is reduced by DISTINCT on key + payload, so the base row count cannot
    grow unless a key carries two different payloads (``assert_unique``).

    Order the dimensions by join key: consecutive joins on the same keys
    reuse one shuffle of the base.

    ``first_copy`` names a flag for control totals: true on one of the rows that
    a base row became, so the flagged rows count the base and all rows count the
    join.  The rows of a key are numbered behind the exchange that the join
    needs anyway.
    """
    out = base if first_copy is None else base.withColumn(first_copy, F.lit(True))
    for i, d in enumerate(dims):
        pref = f"__d{i}_"
        right = d.df.select(*[F.col(v).alias(pref + v) for v in d.on.values()], *d.columns)
        if not d.unique:
            right = right.distinct()
        if first_copy is not None:
            on = [pref + v for v in d.on.values()]
            right = right.withColumn(f"{pref}n", F.row_number().over(Window.partitionBy(*on).orderBy(*d.columns)))
        cond = None
        for bk, dk in d.on.items():
            c = out[bk] == right[pref + dk]
            cond = c if cond is None else cond & c
        out = out.join(right, cond, "left").drop(*[pref + v for v in d.on.values()])
        if first_copy is not None:
            out = out.withColumn(first_copy, F.col(first_copy) & F.coalesce(F.col(f"{pref}n") == 1, F.lit(True))).drop(f"{pref}n")
        for col, default in d.defaults.items():
            out = out.withColumn(col, F.coalesce(F.col(col), F.lit(default)))
    return out


def assert_unique(df: DataFrame, keys: Sequence[str]) -> int:
    """Number of keys that occur more than once (0 when unique).  An action;
    call it from tests or control steps, not inside a transformation."""
    return df.groupBy(*keys).count().where(F.col("count") > 1).count()
