"""Grouped aggregates of the marts.

All of them aggregate with built-in functions, so Spark plans a partial
(map-side) HashAggregate before the shuffle: the exchange carries one row
per group per task, not the raw rows, which is what keeps a hot account
from landing its full row count on one reducer.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.functions import ruleset as R
from vintagelake.functions.periods import yyyymm
from vintagelake.operators.keys import resolve_key


AM_KEYS = ["account_id", "year", "month"]


def _in(col: str | Column, values) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(list(values))


def resolve_and_sum(partial: DataFrame, successor_map: DataFrame, mode: str, keys: Sequence[str],
                    sums: Sequence[str]) -> DataFrame:
    """Successor-key resolution AFTER a partial aggregate by the own id.

    Sums and counts are decomposable: aggregating by the own account first
    (map-side combined), resolving the much smaller result and summing again
    by the resolved account gives the same totals as resolving every raw row
    -- but only account-month-sized data meets the account-sized map.
    """
    r = resolve_key(partial, successor_map, mode=mode)
    return r.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def conditional_sum(amount: Column, cond: Column) -> Column:
    """A3: ``SUM(CASE WHEN cond THEN amount ELSE 0 END)``."""
    return F.sum(F.when(cond, amount).otherwise(F.lit(0)))


def indicator_pivot(ind: DataFrame, keys: Sequence[str] = ("account_id", "year", "month"),
                    since_yyyymm: int | None = None, with_total: bool = True) -> DataFrame:
    """K6: interest (financing, late), instalment interest pivot per key.

    Instalment indicators match by *prefix* (``LIKE 'MSI%'``) here; the
    enrichment variant of the dispositions fact matches *contains*
    (``contains_msi``) -- they are not interchangeable.
    """
    if since_yyyymm is not None:
        ind = ind.where((F.col("year") >= since_yyyymm // 100) & (yyyymm("year", "month") >= since_yyyymm))
    amt, i = F.col("amount"), F.col("indicator")
    g = ind.groupBy(*keys).agg(
        conditional_sum(amt, i == "INTERESES_FIN").alias("int_fin"),
        conditional_sum(amt, i == "INTERESES_MOR").alias("int_mor"),
        conditional_sum(amt, i.startswith("MSI")).alias("int_msi"),
        conditional_sum(amt, i.contains("MSI")).alias("int_msi_any"))
    if with_total:
        g = g.withColumn("int_total", F.col("int_fin") + F.col("int_mor"))
    return g


def txn_monthly(ledger: DataFrame, since: _dt.date | None = None, count_positive: bool = True,
                write_off=R.WRITE_OFF_CODES, forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """K7: write-off / forgiveness amounts, counts and last write-off date per
    account-month in ONE scan of the ledger.

    ``count_positive=True`` counts only rows with amount > 0 (COUNT(CASE ...
    END) form); False counts every code row, zero amounts included (the
    ``COUNT(CASE ... ELSE 0 END)`` form).
    """
    if since is not None:
        ledger = ledger.where(F.col("txn_date") >= F.lit(since))
    code, amt = F.col("code"), F.col("amount")
    wo, fg = _in(code, write_off), _in(code, forgiveness)

    def cnt(c: Column) -> Column:
        return F.count(F.when(c & (amt > 0), F.lit(1))) if count_positive else F.count(F.when(c, F.lit(1)))

    return (ledger.groupBy("account_id", F.year("txn_date").alias("year"), F.month("txn_date").alias("month"))
            .agg(conditional_sum(amt, wo).alias("write_off_amount"), cnt(wo).alias("write_off_count"),
                 F.max(F.when(wo, F.col("txn_date"))).alias("write_off_date"),
                 conditional_sum(amt, fg).alias("forgiveness_amount"), cnt(fg).alias("forgiveness_count")))


def code_sets_monthly(ledger: DataFrame, successor_map: DataFrame, start: _dt.date, end: _dt.date,
                      write_off=R.WRITE_OFF_CODES, forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """K7 two-set form of the dispositions fact: write-off and forgiveness
    amount and row count (``COUNT(CASE ... ELSE 0 END)``: zero amounts count)
    per resolved (``zero`` mode) account-month of the window -- one scan of
    the ledger for both code sets, aggregated to the join key."""
    led = ledger.where(F.col("txn_date").between(F.lit(start), F.lit(end))
                       & _in("code", tuple(write_off) + tuple(forgiveness)))
    code, amt = F.col("code"), F.col("amount")
    wo, fg = _in(code, write_off), _in(code, forgiveness)
    part = (led.groupBy("account_id", F.year("txn_date").alias("year"), F.month("txn_date").alias("month"))
            .agg(conditional_sum(amt, wo).alias("write_off_amount"), F.count(F.when(wo, 1)).alias("write_off_rows"),
                 conditional_sum(amt, fg).alias("forgiveness_amount"),
                 F.count(F.when(fg, 1)).alias("forgiveness_rows")))
    return resolve_and_sum(part, successor_map, "zero", AM_KEYS,
                           ["write_off_amount", "write_off_rows", "forgiveness_amount", "forgiveness_rows"])


def signed_amount(code: Column, amount: Column, product: Column, plan: Column) -> Column:
    """A4 / K9 signed cash-advance amount: reversals negative, debits positive;
    store-family codes only through the listed plans."""
    return (F.when(_in(code, R.CASH_ADVANCE_REVERSALS), -amount)
            .when(_in(code, R.CASH_ADVANCE_CODES), amount)
            .when(_in(plan, (20003, 20004)) & _in(code, R.CASH_ADVANCE_STORE_CODES) & _in(product, R.FAMILIES_STORE),
                  amount)
            .when(_in(plan, (20003,)) & _in(code, R.CASH_ADVANCE_STORE_REVERSALS) & _in(product, R.FAMILIES_STORE),
                  -amount)
            .otherwise(F.lit(0)))


def signed_monthly_base(ledger: DataFrame, successor_map: DataFrame, accounts: DataFrame,
                        start: _dt.date, end: _dt.date) -> DataFrame:
    """K9: cash-advance base per (account, product, origin month, open date,
    plan): gross qualifying count and signed amount.  Reversals reduce the
    amount but not the count; code 22 passes the filter and adds 0."""
    led = ledger.where(F.col("txn_date").between(F.lit(start), F.lit(end))
                       & _in("code", R.LEDGER_FILTER_CODES) & _in("product", R.LEDGER_FILTER_FAMILIES)
                       & _in("plan", R.LEDGER_FILTER_PLANS))
    led = led.withColumns({
        "n_flag": R.QUALIFYING_TXN.column(code="code", product="product", plan="plan"),
        "signed": signed_amount(F.col("code"), F.col("amount"), F.col("product"), F.col("plan")),
    })
    acc = accounts.select(F.col("account_id").alias("a_id"), "open_date")
    part = (led.groupBy("account_id", "product", F.year("txn_date").alias("origin_year"),
                        F.month("txn_date").alias("origin_month"), "plan")
            .agg(F.sum("n_flag").cast("long").alias("n_txn"), F.sum("signed").alias("amount")))
    g = resolve_and_sum(part, successor_map, "zero",
                        ["account_id", "product", "origin_year", "origin_month", "plan"], ["n_txn", "amount"])
    # the open date is a function of the account: attach after aggregating
    g = g.join(acc, g.account_id == acc.a_id, "left").drop("a_id")
    return g.withColumn("channel", R.CHANNEL.column(plan="plan"))


LEDGER_FACTS = ("base_rows", "n_txn", "amount", "write_off_amount", "write_off_rows", "forgiveness_amount", "forgiveness_rows")


def ledger_monthly_facts(ledger: DataFrame, successor_map: DataFrame, start: _dt.date, end: _dt.date,
                         write_off=R.WRITE_OFF_CODES, forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """``own_monthly_facts`` by resolved account (``zero`` mode)."""
    return resolved_facts(own_monthly_facts(ledger, start, end, write_off, forgiveness), successor_map)


def resolved_facts(own: DataFrame, successor_map: DataFrame) -> DataFrame:
    """Facts by own account, as computed or as stored by month, summed per resolved account."""
    return resolve_and_sum(own, successor_map, "zero", ["account_id", "product", "year", "month", "plan"], list(LEDGER_FACTS))


def own_monthly_facts(ledger: DataFrame, start: _dt.date, end: _dt.date,
                      write_off=R.WRITE_OFF_CODES, forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """One scan of the ledger window feeding both the cash-advance
    base (K9) and the write-off / forgiveness sets (K7): conditional
    aggregates per (account, product, month, plan).  ``cash_advance_base`` and
    ``code_sets_from_facts`` derive from it, so the largest table is read and
    shuffled once (the two consumers share the aggregate's exchange)."""
    code, product, plan = F.col("code"), F.col("product"), F.col("plan")
    base_rows = (_in(code, R.LEDGER_FILTER_CODES) & _in(product, R.LEDGER_FILTER_FAMILIES)
                 & _in(plan, R.LEDGER_FILTER_PLANS))
    sets = _in(code, tuple(write_off) + tuple(forgiveness))
    led = ledger.where(F.col("txn_date").between(F.lit(start), F.lit(end)) & (base_rows | sets))
    amt = F.col("amount")
    in_base = (_in(code, R.LEDGER_FILTER_CODES) & _in(product, R.LEDGER_FILTER_FAMILIES)
               & _in(plan, R.LEDGER_FILTER_PLANS))
    wo, fg = _in(code, write_off), _in(code, forgiveness)
    qual = R.QUALIFYING_TXN.column(code="code", product="product", plan="plan")
    part = (led.groupBy("account_id", "product", F.year("txn_date").alias("year"),
                        F.month("txn_date").alias("month"), "plan")
            .agg(F.count(F.when(in_base, 1)).alias("base_rows"),
                 F.sum(F.when(in_base, qual)).cast("long").alias("n_txn"),
                 F.sum(F.when(in_base, signed_amount(code, amt, product, plan))).alias("amount"),
                 conditional_sum(amt, wo).alias("write_off_amount"), F.count(F.when(wo, 1)).alias("write_off_rows"),
                 conditional_sum(amt, fg).alias("forgiveness_amount"),
                 F.count(F.when(fg, 1)).alias("forgiveness_rows")))
    return part


def cash_advance_base(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """K9 from ``ledger_monthly_facts`` (same rows as ``signed_monthly_base``)."""
    g = facts.where(F.col("base_rows") > 0).select(
        "account_id", "product", F.col("year").alias("origin_year"), F.col("month").alias("origin_month"), "plan",
        "n_txn", "amount")
    acc = accounts.select(F.col("account_id").alias("a_id"), "open_date")
    g = g.join(acc, g.account_id == acc.a_id, "left").drop("a_id")
    return g.withColumn("channel", R.CHANNEL.column(plan="plan"))


def code_sets_from_facts(facts: DataFrame) -> DataFrame:
    """K7 two-set form from ``ledger_monthly_facts`` (same rows as
    ``code_sets_monthly``): rolled up from (product, plan) to the account-month."""
    g = facts.where((F.col("write_off_rows") + F.col("forgiveness_rows")) > 0)
    return g.groupBy("account_id", "year", "month").agg(
        F.sum("write_off_amount").alias("write_off_amount"), F.sum("write_off_rows").alias("write_off_rows"),
        F.sum("forgiveness_amount").alias("forgiveness_amount"),
        F.sum("forgiveness_rows").alias("forgiveness_rows"))


NET_PRODUCTS = (110, 100, 210, 200)   # FIXED VALUES


def ledger_cells(ledger: DataFrame, start: _dt.date, end: _dt.date, write_off=R.WRITE_OFF_CODES,
                 forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """One pass over the ledger window for the netted mart: amount and rows per (own account, product, month, plan,
    code, store) of the codes that the netted base (K10) or the write-off / forgiveness sets (K7) read.

    Signs and code sets are functions of the cell's key, so both derive from these cells and the ledger, the largest
    table, is read and shuffled once.  Aggregated before any key is resolved."""
    code = F.col("code")
    in_net = _in("plan", R.LEDGER_FILTER_PLANS) & _in("code", R.NET_BASE_CODES + R.NET_BASE_REVERSALS) \
        & _in("product", NET_PRODUCTS)
    sets = _in(code, tuple(write_off) + tuple(forgiveness))
    led = ledger.where(F.col("txn_date").between(F.lit(start), F.lit(end)) & (in_net | sets))
    return (led.groupBy("account_id", "product", F.year("txn_date").alias("year"), F.month("txn_date").alias("month"),
                        "plan", "code", "store_id")
            .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_rows")))


def code_sets_from_cells(cells: DataFrame, successor_map: DataFrame, write_off=R.WRITE_OFF_CODES,
                         forgiveness=R.FORGIVENESS_CODES) -> DataFrame:
    """K7 two-set form from ``ledger_cells`` (same rows as ``code_sets_monthly``)."""
    code, wo, fg = F.col("code"), _in("code", write_off), _in("code", forgiveness)
    part = (cells.where(_in(code, tuple(write_off) + tuple(forgiveness))).groupBy(*AM_KEYS)
            .agg(conditional_sum(F.col("amount"), wo).alias("write_off_amount"),
                 conditional_sum(F.col("n_rows"), wo).cast("long").alias("write_off_rows"),
                 conditional_sum(F.col("amount"), fg).alias("forgiveness_amount"),
                 conditional_sum(F.col("n_rows"), fg).cast("long").alias("forgiveness_rows")))
    return resolve_and_sum(part, successor_map, "zero", AM_KEYS,
                           ["write_off_amount", "write_off_rows", "forgiveness_amount", "forgiveness_rows"])


def net_monthly_base(ledger: DataFrame, successor_map: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Netted cash-advance base (``net_base_from_cells``) of the ledger window."""
    return net_base_from_cells(ledger_cells(ledger, start, end), successor_map)


def net_base_from_cells(cells: DataFrame, successor_map: DataFrame) -> DataFrame:
    """Netted cash-advance base.

    Net amount and net count (+1 debit, -1 reversal) per (plan, month,
    product, account, store); keep the (month, product, account, store)
    cells with a positive net on some plan; give each kept cell the whole
    account-month's totals (all plans, stores and products, so totals repeat
    per store); attach one plan/code row of the account-month.

    The cells are summed once; totals and the first plan/code row come from a
    window over the few summed cells of an account-month, so nothing is joined
    back.
    """
    code = F.col("code")
    sign = F.when(_in(code, R.NET_BASE_REVERSALS), F.lit(-1)).otherwise(F.lit(1))
    part = cells.where(_in("plan", R.LEDGER_FILTER_PLANS) & _in("code", R.NET_BASE_CODES + R.NET_BASE_REVERSALS)
                       & _in("product", NET_PRODUCTS))
    part = part.select("account_id", "product", "year", "month", "plan", "code", "store_id",
                       (F.when(_in(code, R.NET_BASE_REVERSALS), -F.col("amount")).otherwise(F.col("amount"))).alias("sgn_amt"),
                       (sign * F.col("n_rows")).alias("sgn_n"))
    # resolution (null mode) on the sums by the own id
    own = part.groupBy("account_id", "product", "year", "month", "plan", "store_id").agg(
        F.sum("sgn_n").alias("n"), F.sum("sgn_amt").alias("net"), F.min("code").alias("code"))
    led = resolve_key(own, successor_map, mode="null")
    media = (led.groupBy("plan", "year", "month", "product", "account_id", "store_id")
             .agg(F.sum("n").alias("n"), F.sum("net").alias("net"), F.min("code").alias("code")))
    # the cells of an account-month, of any account, are at most one for each plan, product and store
    cells_of = Window.partitionBy("account_id", "year", "month")
    first = F.min(F.struct("plan", "code", "product")).over(cells_of)
    kept = media.select("account_id", "product", "year", "month", "store_id", "net",
                        F.sum("net").over(cells_of).alias("amount"), F.sum("n").over(cells_of).cast("long").alias("n_txn"),
                        first.alias("_p")).where((F.col("net") > 0) & F.col("account_id").isNotNull())
    return kept.select("account_id", "product", F.col("_p.plan").alias("plan"), F.col("_p.code").alias("code"), "year",
                       "month", "store_id", "amount", "n_txn").distinct()


def _live_cards(cards: DataFrame) -> DataFrame:
    return cards.where(~_in("card_state", R.CARD_DEAD_STATES))


def card_counts(cards: DataFrame, distinct: bool = False) -> DataFrame:
    """K12 / A11 in one pass: add-on and primary live-card counts per account
    (``distinct``: every card number once)."""
    if distinct:
        cards = _live_cards(cards).select("account_id", "holder_flag", "card_state", "card_no") \
            .dropDuplicates(["account_id", "holder_flag", "card_no"])
    c = _live_cards(cards).where(_in("holder_flag", R.CARD_ADDON_FLAGS + R.CARD_PRIMARY_FLAGS))
    h = F.col("holder_flag")
    return c.groupBy("account_id").agg(
        F.count(F.when(_in(h, R.CARD_ADDON_FLAGS), F.col("card_no"))).alias("n_addon"),
        F.count(F.when(_in(h, R.CARD_PRIMARY_FLAGS), F.col("card_no"))).alias("n_primary"))


def card_counts_union(cards: DataFrame) -> DataFrame:
    """U2 form: UNION ALL of zero-padded partial counts, then re-aggregate."""
    live = _live_cards(cards)
    addon = (live.where(_in("holder_flag", R.CARD_ADDON_FLAGS)).groupBy("account_id")
             .agg(F.lit(0).cast("long").alias("n_primary"), F.count("card_no").alias("n_addon")))
    prim = (live.where(_in("holder_flag", R.CARD_PRIMARY_FLAGS)).groupBy("account_id")
            .agg(F.count("card_no").alias("n_primary"), F.lit(0).cast("long").alias("n_addon")))
    return (addon.unionByName(prim).groupBy("account_id")
            .agg(F.sum("n_addon").alias("n_addon"), F.sum("n_primary").alias("n_primary")))


def unified_customer(cards: DataFrame) -> DataFrame:
    """One client id per account -- from its lowest-numbered card (the
    reference's pick is arbitrary; a total order makes it deterministic)."""
    return (cards.groupBy("account_id")
            .agg(F.min_by("client_uid", F.struct("card_no", "client_uid")).alias("client_uid")))


def commissions(fees: DataFrame, indicator: str = "COMISION") -> DataFrame:
    """K8: fee amount per account-month for one indicator."""
    return (fees.where(F.col("indicator") == indicator).groupBy("account_id", "year", "month")
            .agg(F.sum("amount").alias("fee_amount")))


ONLINE_OTHER_SECTION = "0936"   # FIXED VALUE


def online_months(ledger: DataFrame, web_stores: Sequence[str], codes: Sequence[int] | None = None,
                  since: _dt.date | None = None, other_section: str | None = ONLINE_OTHER_SECTION) -> DataFrame:
    """Distinct account-months with a purchase (``codes``) at a web store from ``since`` on, outside one section
    (a purchase without a section is left out, as ``<>`` does)."""
    if other_section is not None:
        ledger = ledger.where(F.col("section") != other_section)
    if codes is not None:
        ledger = ledger.where(_in("code", codes))
    if since is not None:
        ledger = ledger.where(F.col("txn_date") >= F.lit(since))
    return (ledger.where(_in("store_id", web_stores))
            .select("account_id", F.year("txn_date").alias("year"), F.month("txn_date").alias("month")).distinct())


def manual_auth_monthly(manual: DataFrame, successor_map: DataFrame, month_start: _dt.date,
                        next_month: _dt.date) -> DataFrame:
    """Manual limit releases of one closed month per resolved account."""
    m = manual.where((F.col("auth_date") >= F.lit(month_start)) & (F.col("auth_date") < F.lit(next_month)))
    part = (m.groupBy("account_id", F.year("auth_date").alias("year"), F.month("auth_date").alias("month"))
            .agg(F.sum("released_amount").alias("manual_amount"), F.count(F.lit(1)).alias("manual_count")))
    return resolve_and_sum(part, successor_map, "null", AM_KEYS, ["manual_amount", "manual_count"])
