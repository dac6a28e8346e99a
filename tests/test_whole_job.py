"""Queries read the whole of their input: small tables with rows that a cut would lose."""

import datetime as dt

import __spark_entry__ as E


def test_segment_history_union_keeps_the_first_months(spark, tmp_path):
    days = [dt.datetime(1995, 1, 10), dt.datetime(1995, 2, 28), dt.datetime(1997, 12, 31), dt.datetime(1998, 1, 1)]
    spark.createDataFrame([(i, 7, day) for i, day in enumerate(days, 1)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    out = E.queries()["segment_history_union"](spark, str(tmp_path))
    assert sorted((r.segment_date, r.segment_official) for r in out.collect()) == [
        (day.date(), i % 7 * 33 + (1 if day.year >= 1998 else 0)) for i, day in enumerate(days, 1)]
