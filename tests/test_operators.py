"""Operators on small hand-made frames holding the edge rows of FIXTURES.md."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from vintagelake.operators import aggregates as G
from vintagelake.operators import enrich, keys, overdraft, panel, windows

MAP_SCHEMA = "account_id long, successor_id long"


def _map(spark):
    # valid successor, 0, NULL; account 4 is absent
    return spark.createDataFrame([(1, 10), (2, 0), (3, None)], MAP_SCHEMA)


def test_resolve_key_modes(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (0,), (None,)], "account_id long")
    m = spark.createDataFrame([(1, 10), (2, 0), (3, None), (0, 77)], MAP_SCHEMA)
    got = {}
    for mode in keys.MODES:
        rows = keys.resolve_key(df, m, mode=mode, out="r").collect()
        got[mode] = sorted(((r.account_id, r.r) for r in rows), key=lambda t: (t[0] is None, t[0] or 0))
    assert got["null"] == [(0, 77), (1, 10), (2, 0), (3, 3), (4, 4), (None, None)]
    assert got["zero"] == [(0, 77), (1, 10), (2, 2), (3, 3), (4, 4), (None, None)]
    assert got["inverse"] == [(0, 77), (1, 1), (2, 2), (3, 3), (4, 4), (None, None)]


def test_latest_and_ties(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 5), "a"), (1, dt.date(2024, 1, 9), "b"),
                                (1, dt.date(2024, 1, 9), "c"), (2, dt.date(2024, 1, 1), "d")],
                               "k long, d date, v string")
    top = windows.latest(df, ["k"], [F.col("d").desc()], [F.col("v").asc()])
    assert sorted((r.k, r.v) for r in top.collect()) == [(1, "b"), (2, "d")]
    ties = windows.latest_ties_kept(df, ["k"], "d")
    assert sorted((r.k, r.v) for r in ties.collect()) == [(1, "b"), (1, "c"), (2, "d")]
    agg = windows.latest_by_aggregate(df, ["k"], F.struct("d", "v"), ["v"])
    assert sorted((r.k, r.v) for r in agg.collect()) == [(1, "c"), (2, "d")]


def test_card_counts_blank_sensitive(spark):
    cards = spark.createDataFrame([
        (1, 1, "0", "N "), (1, 2, "1", "N "), (1, 3, " ", "F "), (1, 4, "1", "F"),   # 'F' dead, 'F ' live
        (2, 5, "0", "A "), (2, 6, "0", "A"), (3, 7, "2", "N "), (4, 8, "1", None)],
        "account_id long, card_no long, holder_flag string, card_state string")
    one = {r.account_id: (r.n_addon, r.n_primary) for r in G.card_counts(cards).collect()}
    union = {r.account_id: (r.n_addon, r.n_primary) for r in G.card_counts_union(cards).collect()}
    assert one == union == {1: (2, 1), 2: (0, 1)}


def test_txn_monthly_count_forms(spark):
    led = spark.createDataFrame([
        (1, dt.date(2024, 1, 3), 505, D("10.00")), (1, dt.date(2024, 1, 4), 505, D("0.00")),
        (1, dt.date(2024, 1, 9), 307, D("5.00")), (1, dt.date(2024, 1, 9), 12, D("99.00"))],
        "account_id long, txn_date date, code int, amount decimal(18,2)")
    pos = G.txn_monthly(led, count_positive=True).first()
    allr = G.txn_monthly(led, count_positive=False).first()
    assert (pos.write_off_count, allr.write_off_count) == (1, 2)   # quirk Q5: zero amounts count
    assert pos.write_off_amount == D("10.00") and pos.write_off_date == dt.date(2024, 1, 4)
    assert (pos.forgiveness_amount, pos.forgiveness_count) == (D("5.00"), 1)


def test_signed_base_reversals_and_store_codes(spark):
    led = spark.createDataFrame([
        (1, 100, dt.date(2024, 1, 2), 2, D("100"), 20002),     # debit, counts
        (1, 100, dt.date(2024, 1, 3), 62, D("30"), 20002),     # reversal: amount down, count unchanged
        (1, 100, dt.date(2024, 1, 3), 22, D("50"), 20002),     # passes the filter, adds 0
        (5, 200, dt.date(2024, 1, 4), 12, D("40"), 20003),     # store family via plan 20003
        (5, 200, dt.date(2024, 1, 5), 72, D("15"), 20003),     # store reversal
        (5, 100, dt.date(2024, 1, 5), 12, D("15"), 20003),     # code 12 in family 100: filtered in, adds 0
        (6, 200, dt.date(2024, 1, 5), 2, D("7"), 99999)],      # plan outside the list
        "account_id long, product int, txn_date date, code int, amount decimal(18,2), plan int")
    acc = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (5, dt.date(2021, 6, 1))], "account_id long, open_date date")
    m = spark.createDataFrame([], MAP_SCHEMA)
    b = G.signed_monthly_base(led, m, acc, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    got = sorted((r.account_id, r.product, r.plan, r.n_txn, r.amount, r.channel) for r in b.collect())
    assert got == [(1, 100, 20002, 1, D("70"), "ATM"), (5, 100, 20003, 0, D("0"), "POS"),
                   (5, 200, 20003, 1, D("25"), "POS")]
    facts = G.ledger_monthly_facts(led, m, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    b2 = sorted((r.account_id, r.product, r.plan, r.n_txn, r.amount) for r in G.cash_advance_base(facts, acc).collect())
    assert b2 == [t[:5] for t in got]


def test_net_base_repeats_totals_per_store(spark):
    led = spark.createDataFrame([
        (1, 100, dt.date(2024, 1, 2), 2, D("100"), 20002, "0001"),
        (1, 100, dt.date(2024, 1, 3), 2, D("50"), 20003, "0002"),
        (1, 100, dt.date(2024, 1, 4), 62, D("80"), 20003, "0002")],   # store 0002 nets to -30: not kept
        "account_id long, product int, txn_date date, code int, amount decimal(18,2), plan int, store_id string")
    out = G.net_monthly_base(led, spark.createDataFrame([], MAP_SCHEMA), dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    rows = [(r.store_id, r.amount, r.n_txn, r.plan, r.code) for r in out.collect()]
    assert rows == [("0001", D("70"), 1, 20002, 2)]


def _events(spark):
    rows = [
        # account 1: approvals on two days, a decline, sections 0 and 1-3 -> mix 3
        (1, 1, dt.date(2024, 1, 5), "S1", D("1000"), D("900"), D("50"), 0, "1"),
        (2, 1, dt.date(2024, 1, 9), "S2", D("1200"), D("1100"), D("60"), 2, "1"),
        (3, 1, dt.date(2024, 1, 20), "S3", D("1300"), D("100"), D("5"), None, "2"),
        # account 2: only declines -> last limit NULL
        (4, 2, dt.date(2024, 1, 7), "S4", D("500"), D("10"), D("5"), 0, "2"),
        # excluded account and a unit-amount probe
        (5, 99, dt.date(2024, 1, 7), "S5", D("500"), D("10"), D("5"), 0, "1"),
        (6, 1, dt.date(2024, 1, 8), "S6", D("800"), D("10"), D("1"), 0, "1"),
        # other month
        (7, 1, dt.date(2023, 12, 30), "S7", D("9"), D("9"), D("9"), 0, "1")]
    return spark.createDataFrame(rows, "event_id long, account_id long, proc_date date, spid string, "
                                       "auth_limit decimal(18,2), auth_balance decimal(18,2), "
                                       "auth_amount decimal(18,2), section int, decision string")


def test_overdraft_chain(spark):
    ev = overdraft.closed_month_events(_events(spark), spark.createDataFrame([], MAP_SCHEMA),
                                       dt.date(2024, 2, 10), excluded=[99])
    attrs = {r.track_id: (r.last_limit, r.last_spid) for r in overdraft.month_attributes(ev).collect()}
    assert attrs == {1: (D("1200"), "S3"), 2: (None, "S4")}
    # the aggregate form equals the source's window functions on every row
    win = {r.track_id: (r.last_limit, r.last_spid) for r in overdraft.window_attributes(ev)
           .select("track_id", "last_limit", "last_spid").distinct().collect()}
    assert win == attrs
    auto = {r.track_id: r for r in overdraft.auto_overdrafts(ev).collect()}
    assert set(auto) == {1}
    a = auto[1]
    assert (a.n_events, a.n_approved, a.n_declined, a.section_mix) == (2, 2, 1, 3)
    assert a.max_exposure == D("1160") and a.excess == D("-40")
    manual = spark.createDataFrame([(3, 2024, 1, D("70"), 2), (1, 2024, 1, D("10"), 1)],
                                   "account_id long, year int, month int, manual_amount decimal(18,2), "
                                   "manual_count long")
    merged = {r.account_id: r for r in overdraft.merge_manual(overdraft.auto_overdrafts(ev), manual).collect()}
    assert merged[1].origin_class == 6 and merged[1].total_approved == 3
    assert merged[3].origin_class == 7 and merged[3].spid is None      # manual only (full join)
    assert merged[1].n_decided == 3


def test_closing_snapshot_not_in_drops_null_state(spark):
    snaps = spark.createDataFrame([
        (1, 2024, 1, 100, "A", D("10"), D("5")), (2, 2024, 1, 100, "T", D("1"), D("1")),
        (3, 2024, 1, 100, None, D("1"), D("1")), (4, 2024, 1, 999, "A", D("1"), D("1"))],
        "account_id long, year int, month int, product int, state string, balance decimal(18,4), "
        "credit_limit decimal(18,2)")
    c = overdraft.closing_snapshot(snaps, spark.createDataFrame([], MAP_SCHEMA), dt.date(2024, 2, 1))
    assert [(r.account_id, r.over_limit) for r in c.collect()] == [(1, 1)]


def test_vintage_panel_offsets_non_negative(spark):
    origins = spark.createDataFrame([(1, 2023, 11), (1, 2024, 2)], "account_id long, origin_year int, origin_month int")
    snaps = spark.createDataFrame([(1, 2023, 10, 1), (1, 2023, 12, 3), (1, 2024, 2, 5), (2, 2024, 1, 0)],
                                  "account_id long, year int, month int, level int")
    p = panel.vintage_panel(origins, snaps)
    got = sorted((r.origin_year, r.origin_month, r.year, r.month, r.vintage_offset) for r in p.collect())
    assert got == [(2023, 11, 2023, 12, 1), (2023, 11, 2024, 2, 3), (2024, 2, 2024, 2, 0)]


def test_cohort_date_keyed_join_keeps_account(spark):
    acc = spark.createDataFrame([(1, 110, 200, "1122", dt.date(2025, 8, 1)), (2, 110, 200, "9999", dt.date(2025, 8, 1)),
                                 (3, 110, 200, "1122", dt.date(2025, 6, 1))],
                                "account_id long, product int, brand int, store_id string, open_date date")
    cli = spark.createDataFrame([(1, 200, dt.date(2025, 8, 2), "F", dt.date(1990, 1, 1), 2)],
                                "account_id long, logo int, client_open_date date, sex string, birth_date date, "
                                "gender_code int")
    c = panel.cohort(acc, cli, 110, 200, dt.date(2025, 7, 17), ["1122"]).collect()
    assert [(r.account_id, r.sex, r.open_yyyymm) for r in c] == [(1, None, 202508)]


def test_payment_code_max_and_zone_normaliser(spark):
    df = spark.createDataFrame([("1X3Z20",), ("XXXXXX",), (None,)], "h string")
    assert [r[0] for r in df.select(enrich.payment_code_max(F.col("h"))).collect()] == [3, None, None]
    hist = spark.createDataFrame([
        ("0001", "a", "Bajío", 2024, 1), ("0001", "a", "Metro Sur", 2023, 12),
        ("0002", "b", None, 2024, 1), ("0003", "c", "  ", 2024, 1), ("0004", "d", "Omnicanal", 2024, 1),
        ("0005", "e", "NULL", 2024, 1), ("0006", "f", "Golfo", 2024, 1)],
        "store_id string, store_desc string, zone_desc string, year int, month int")
    z = {r.store_id: (r.zone, r.zone_id) for r in enrich.zone_normalise(hist).collect()}
    # quirk Q22: accented raw names keep id 13 although the cleaned name is unaccented
    assert z == {"0001": ("Bajio", "13"), "0002": ("Otro", "13"), "0003": ("Otro", "13"),
                 "0004": ("Canal Digital", "13"), "0005": ("Otro", "13"), "0006": ("Golfo", "11")}


def test_indicator_prefix_vs_contains(spark):
    ind = spark.createDataFrame([(1, 2024, 1, "MSI_X", D("5")), (1, 2024, 1, "X_MSI", D("7")),
                                 (1, 2024, 1, "INTERESES_FIN", D("1"))],
                                "account_id long, year int, month int, indicator string, amount decimal(18,2)")
    r = G.indicator_pivot(ind).first()
    assert (r.int_msi, r.int_msi_any, r.int_fin, r.int_total) == (D("5"), D("12"), D("1"), D("1"))


def test_star_join_does_not_fan_out(spark):
    base = spark.createDataFrame([(1,), (2,)], "account_id long")
    dup = spark.createDataFrame([(1, "x"), (1, "x"), (3, "y")], "account_id long, v string")
    out = enrich.star_join(base, [enrich.Dim(dup, {"account_id": "account_id"}, ["v"], {"v": "none"})])
    assert sorted((r.account_id, r.v) for r in out.collect()) == [(1, "x"), (2, "none")]
    assert enrich.assert_unique(out, ["account_id"]) == 0
    assert enrich.assert_unique(dup, ["account_id"]) == 1


def test_membership_flag_and_parse(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "account_id long")
    text = spark.createDataFrame([("1",), ("00002",), ("X3",), (None,)], "t string")
    ids = enrich.parse_account_ids(text, "t")
    out = enrich.membership_flag(base, ids, ["account_id"], ["account_id"], "flag", as_string=True)
    assert sorted((r.account_id, r.flag) for r in out.collect()) == [(1, "1"), (2, "1"), (3, "0")]


def test_salted_vintage_panel_equals_plain(spark):
    origins = spark.createDataFrame([(0, 2023, m) for m in range(1, 13)] + [(1, 2023, 5), (2, 2024, 1)],
                                    "account_id long, origin_year int, origin_month int")
    snaps = spark.createDataFrame([(0, y, m, y * 100 + m) for y in (2023, 2024) for m in range(1, 13)]
                                  + [(1, 2023, 6, 1), (2, 2023, 12, 2), (2, 2024, 2, 3)],
                                  "account_id long, year int, month int, v int")
    plain = sorted(tuple(r) for r in panel.vintage_panel(origins, snaps, salt_buckets=1).collect())
    salted_df = panel.vintage_panel(origins, snaps, salt_buckets=5, hot_rows=10)
    salted = sorted(tuple(r) for r in salted_df.collect())
    assert salted == plain and len(plain) == sum(24 - (m - 1) for m in range(1, 13)) + 1 + 1
    assert salted_df.columns == ["account_id", "origin_year", "origin_month", "year", "month", "v", "vintage_offset"]


def test_hot_keys_from_both_sides(spark):
    origins = spark.createDataFrame([(7, 2023, 1 + i % 12, i) for i in range(300)] + [(8, 2023, 1, 0)],
                                    "account_id long, origin_year int, origin_month int, o int")
    snaps = spark.createDataFrame([(7, 2024, 1, 0), (7, 2024, 2, 0)] + [(8, 2024, 1, i) for i in range(90)],
                                  "account_id long, year int, month int, s int")
    hot = panel.hot_keys(origins, snaps, hot_rows=100).collect()
    assert [tuple(r) for r in hot] == [(7, 6, "o")]        # many origins, few snapshots: the origins are split
    plain = panel.vintage_panel(origins, snaps, salt_buckets=1).collect()
    assert sorted(plain) == sorted(panel.vintage_panel(origins, snaps, hot_rows=100).collect())
    assert len(plain) == 690


def test_latest_load_keeps_ties(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 2, 1)), ("c", dt.date(2024, 2, 1))],
                               "k string, load date")
    assert sorted(r.k for r in windows.latest_load(df, "load").collect()) == ["b", "c"]


def test_time_zone_helpers(spark):
    from vintagelake.functions import periods as P
    r = spark.range(1).select(P.today_in("America/Mexico_City").alias("d"),
                              P.time_of_day_in("America/Mexico_City").alias("t")).first()
    assert isinstance(r.d, dt.date) and len(r.t) == 8 and r.t[2] == ":"
