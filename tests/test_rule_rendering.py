"""Every rule table renders to the same first match in Spark (Column, nested
where configured) and in SQL (flat CASE, evaluated by DuckDB) over a grid
of boundary values, NULLs included."""

import itertools
from decimal import Decimal as D

import duckdb
import pytest

from vintagelake.functions import ruleset as R
from vintagelake.functions.rules import RuleTable

# candidate values per input name: (spark type, duckdb type, values)
VALUES = {
    "product": ("int", "INTEGER", [100, 110, 200, 210, 220, None]),
    "period": ("int", "INTEGER", [202201, 202202, 202203, 202204, 202206, 202207, 202308, 202309, 202402, 202602, None]),
    "origin": ("int", "INTEGER", [202201, 202202, 202204, 202308, 202309, 202602, None]),
    "obs": ("int", "INTEGER", [202201, 202202, 202602, None]),
    "brand": ("int", "INTEGER", [100, 200, 999, None]),
    "mob": ("int", "INTEGER", [-1, 0, 6, 7, 11, 12, 24, 35, 48, 60, 61, 71, 72, 84, 85, 120, None]),
    "score": ("double", "DOUBLE", [-1.0, 0.0, 374.0, 375.0, 406.0, 449.5, 455.0, 526.0, 661.5, 714.5, 715.0, 783.0,
                                   800.0, 900.0, 953.0, None]),
    "level": ("int", "INTEGER", [0, 1, 2, 3, 5, 8, 9, None]),
    "age": ("int", "INTEGER", [17, 18, 20, 21, 24, 29, 30, 37, 45, 50, 60, None]),
    "amount": ("double", "DOUBLE", [-5.0, 1999.99, 2000.0, 4000.0, 14999.5, 20000.0, 50000.0, None]),
    "ratio": ("double", "DOUBLE", [-1.0, 0.2, 0.2001, 0.5, 0.85, 0.86, None]),
    "rate": ("decimal(18,2)", "DECIMAL(18,2)", [D("36.39"), D("61.20"), D("80.00"), D("0.00"), D("85.00"), D("1.00"),
                                                None]),
    "gen": ("int", "INTEGER", [1, 2, 3, None]),
    "sex": ("string", "VARCHAR", ["M", "F", "X", None]),
    "zone": ("string", "VARCHAR", ["1", "9", "VAD", "OTRO", "Sur", "Bajío", "Pacífico", "NULL", "", "VDA", None]),
    "zone_trimmed": ("string", "VARCHAR", ["", "x", None]),
    "store": ("string", "VARCHAR", ["0782", "0001", None]),
    "flag": ("string", "VARCHAR", ["0", "1", " 1", "2", "M", "O", "H", None]),
    "open_year": ("int", "INTEGER", [2009, 2010, 2016, 2020, 2022, 2023, None]),
    "node": ("int", "INTEGER", [0, 1, 5, 9, 13, 16, None]),
    "plan": ("int", "INTEGER", [20002, 20003, 20004, 1, None]),
    "code": ("int", "INTEGER", [2, 12, 122, 72, 1, None]),
    "auto": ("long", "BIGINT", [0, 3, None]),
    "manual": ("long", "BIGINT", [0, 2, None]),
    "section": ("int", "INTEGER", [1, 2, 3, None]),
    "n_zero": ("long", "BIGINT", [0, 1]),
    "n_main": ("long", "BIGINT", [0, 1]),
}

TABLES = {name: obj for name, obj in vars(R).items() if isinstance(obj, RuleTable)}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_spark_and_sql_render_the_same_first_match(spark, name):
    table = TABLES[name]
    inputs = list(table.inputs)
    assert inputs, f"{name} declares no inputs"
    rows = [(i, *combo) for i, combo in enumerate(itertools.product(*[VALUES[n][2] for n in inputs]))]
    schema = ", ".join(["id long"] + [f"{n} {VALUES[n][0]}" for n in inputs])
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, schema)
           .select("id", table.column(**{n: n for n in inputs})).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, " + ", ".join(f"{n} {VALUES[n][1]}" for n in inputs) + ")")
    con.executemany(f"INSERT INTO t VALUES ({', '.join('?' for _ in range(len(inputs) + 1))})", rows)
    want = dict(con.execute(f"SELECT id, {table.sql(**{n: n for n in inputs})} FROM t").fetchall())
    diff = [(rows[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not diff, diff[:5]
