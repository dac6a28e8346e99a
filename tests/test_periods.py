import datetime as dt

from pyspark.sql import functions as F

from vintagelake.functions import periods as P


def test_period_window_driver():
    # day 1 + history: full rebuild to the previous month end
    assert P.period_window(dt.date(2026, 7, 1), True) == (dt.date(2017, 1, 1), dt.date(2026, 6, 30))
    # day 1, monthly: the previous month
    assert P.period_window(dt.date(2026, 7, 1), False) == (dt.date(2026, 6, 1), dt.date(2026, 6, 30))
    # mid-month: the current month to its end
    assert P.period_window(dt.date(2026, 2, 15), False) == (dt.date(2026, 2, 1), dt.date(2026, 2, 28))
    # January day 1 rolls back into December of the previous year
    assert P.period_window(dt.date(2024, 1, 1), False) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))
    assert P.previous_month(dt.date(2024, 1, 15)) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))


def test_period_window_columns_match_driver(spark):
    days = [dt.date(2026, 7, 1), dt.date(2026, 2, 15), dt.date(2024, 1, 1), dt.date(2024, 3, 31)]
    df = spark.createDataFrame([(d,) for d in days], "run_date date")
    for hist in (True, False):
        s, e = P.period_window_cols("run_date", hist)
        got = {r[0]: (r[1], r[2]) for r in df.select("run_date", s, e).collect()}
        assert got == {d: P.period_window(d, hist) for d in days}


def test_calendar_arithmetic(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), dt.date(2000, 12, 31))], "a date, b date")
    r = df.select(P.calendar_years("a", "b").alias("y"),
                  P.month_offset(F.year("b"), F.month("b"), F.year("a"), F.month("a")).alias("m"),
                  P.yyyymm(F.year("a"), F.month("a")).alias("p")).first()
    assert (r.y, r.m, r.p) == (1, 1, 200101)


def test_age_from_yyyymm_clamps_and_keeps_null(spark):
    df = spark.createDataFrame([(202401, 199001), (202401, 202502), (202401, None)], "o int, b int")
    got = [r[0] for r in df.select(P.age_from_yyyymm("o", "b")).collect()]
    assert got == [34, 0, None]


def test_horizon_bucket(spark):
    df = spark.createDataFrame([(v,) for v in (0, 12, 13, 36, 37, 48, 49, None)], "o int")
    got = [r[0] for r in df.select(P.horizon_bucket("o", 3)).collect()]
    assert got == ["Y1", "Y1", "Y2", "Y3", "OTRO", "OTRO", "OTRO", "OTRO"]
    got4 = [r[0] for r in df.select(P.horizon_bucket("o", 4)).collect()]
    assert got4 == ["Y1", "Y1", "Y2", "Y3", "Y4", "Y4", "OTRO", "OTRO"]


def test_closed_month_filter_is_a_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 31),), (dt.date(2024, 2, 1),),
                                (dt.date(2023, 12, 31),)], "d date")
    got = sorted(r[0] for r in df.where(P.closed_month_filter("d", dt.date(2024, 2, 10))).collect())
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 31)]
