"""Rule tables: boundaries (cut -1/0/+1, NULL, negative, off-list product),
first-match quirks, and the score tree's structural properties."""

from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F

from vintagelake.functions import ruleset as R
from vintagelake.functions.rules import Rule, RuleTable


def _eval(spark, table, schema, rows, **inputs):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(table.column(**inputs)).collect()]


def test_amount_band_boundaries(spark):
    rows = [(100, D(v)) for v in ("3999.99", "4000", "7499", "7500", "49999.99", "50000", "-5")]
    rows += [(200, D(v)) for v in ("1999", "2000", "14999", "15000", "20000")]
    rows += [(230, D("100")), (None, D("100")), (100, None)]
    got = _eval(spark, R.AMOUNT_BAND, "product int, amount decimal(18,2)", rows, product="product", amount="amount")
    assert got == ["1.-4,000", "2.-4,000-7,499", "2.-4,000-7,499", "3.-7,500-9,999", "7.-30,000-49,999",
                   "8.-50,000+", "1.-4,000",
                   "1.-0-1,999", "2.-2,000-3,999", "5.-12,000 -14,999", "6.-15,000-17,999", "8.->=20,000",
                   "OTRO", "OTRO", "OTRO"]
    pub = _eval(spark, R.LIMIT_BAND_PUBLISHED, "product int, amount decimal(18,2)",
                [(110, D("50000")), (210, D("20000"))], product="product", amount="amount")
    assert pub == ["50,000+", ">=20,000"]
    # cohort variant: family 100 only, so 110 reads OTRO (quirk Q11)
    coh = _eval(spark, R.AMOUNT_BAND_COHORT, "product int, amount decimal(18,2)",
                [(100, D("5000")), (110, D("5000"))], product="product", amount="amount")
    assert coh == ["2.-4,001-7,499", "OTRO"]


def test_utilisation_band_sentinel_and_null(spark):
    got = _eval(spark, R.UTILISATION_BAND, "r double", [(-1.0,), (0.2,), (0.2000001,), (0.85,), (0.86,), (None,)],
                ratio="r")
    assert got == ["A.1-20", "A.1-20", "B.21-25", "I.76-85", "J.86+", "J.86+"]


def test_delinquency_and_flags(spark):
    rows = [(v,) for v in (None, 0, 1, 2, 3, 4, 5, 8, 9)]
    assert _eval(spark, R.DELINQUENCY_LABEL, "l int", rows, level="l") == [
        "8.-210_DIAS", "0.-CTAS_VIG", "0.-CTAS_VIG", "1.-1-29 DIAS", "2.-30_DIAS", "3.-60_DIAS", "4.-90_DIAS",
        "7.-180_DIAS", "8.-210_DIAS"]
    assert _eval(spark, R.FLAG_30, "l int", rows, level="l") == [0, 0, 0, 0, 1, 1, 1, 1, 1]
    assert _eval(spark, R.FLAG_90, "l int", rows, level="l") == [0, 0, 0, 0, 0, 0, 1, 1, 1]
    assert _eval(spark, R.ENTRY_FLAG, "l int", rows, level="l") == [0, 0, 0, 1, 1, 1, 1, 1, 1]


def test_risk_letters_null_reads_lowest_risk(spark):
    # quirk Q18: with an ELSE, a NULL score lands in the lowest-risk letter
    got = _eval(spark, R.RISK_LETTERS, "s int", [(0,), (455,), (456,), (661,), (662,), (None,), (-3,)], score="s")
    assert got == ["F. No calificado", "E. Very high", "D. High", "B. Low", "A. Very low", "A. Very low",
                   "E. Very high"]


def test_risk_effective_dated(spark):
    rows = [(100, 202201, 405), (100, 202202, 405), (100, 202602, 437), (100, 202602, 438),
            (110, 202203, 953), (110, 202204, 662), (200, 202402, 750), (200, 202401, 300), (210, 202204, -1),
            (220, 202401, 500), (100, 202201, None)]
    got = _eval(spark, R.RISK_EFFECTIVE, "p int, per int, s int", rows, product="p", period="per", score="s")
    assert got == ["1.VERY HIGH", "1.VERY HIGH", "1.VERY HIGH", "2.HIGH", "5.VERY LOW", "5.VERY LOW",
                   None,  # Q12: gap 715..783 for family 200
                   None,  # family 200 before 202402: no rule
                   "0.NO CALIFICADO", None, None]


def test_rate_tier_decimal_membership(spark):
    rows = [(100, D("36.39")), (110, D("61.20")), (100, D("0")), (200, D("80.00")), (210, D("85.00")),
            (100, D("36.38")), (None, D("36.39"))]
    got = _eval(spark, R.RATE_TIER, "p int, r decimal(18,2)", rows, product="p", rate="r")
    # 80.00 sits in T4 and T5: first match (T4) wins -- quirk Q8
    assert got == ["T1", "T4", "TASA CORPORATIVO", "T4", "T5", "Otros", "Otros"]
    single = _eval(spark, R.RATE_TIER_SINGLE, "p int, r decimal(18,2)",
                   [(100, D("61.2")), (200, D("77.42")), (200, D("61.2")), (None, D("14.99"))],
                   product="p", rate="r")
    assert single == ["T4", "T3", "OTRO", "OTRO"]


def test_age_bands(spark):
    got = _eval(spark, R.AGE_BAND_COHORT, "a int", [(17,), (18,), (20,), (21,), (29,), (30,), (60,), (None,)],
                age="a")
    assert got == [None, "18-20", "18-20", "21-24", "25-29", "30-37", "60 +", None]
    got = _eval(spark, R.AGE_BAND_FACT, "a int", [(29,), (30,), (49,), (50,), (None,)], age="a")
    assert got == ["30", "30-35", "45-50", "50+", "Sin clasificar"]


def test_mob_band_and_tree_levels(spark):
    got = _eval(spark, R.MOB_BAND, "m int", [(6,), (7,), (60,), (61,), (None,), (-2,)], mob="m")
    assert got == ["A.0M-6M", "B.7M-12M", "F.49M-60M", "G.61M+", "0.- NO CLASIFICADO", "A.0M-6M"]
    # quirk Q17: 48 lands in band 2 although the label reads "12 A 47"
    lv = _eval(spark, R.TREE_LEVEL_2, "p int, m int", [(100, 48), (100, 49), (110, 119), (110, -1)],
               product="p", mob="m")
    assert lv == ["2.DE 12 A 47", "3.MAYOR O IGUAL A 48", "3.DE 60 A 119", None]


def test_overdraft_origin_and_section_mix(spark):
    rows = [(3, None, None), (3, None, 1), (3, None, 2), (3, None, 3), (3, 2, 1), (3, 2, 2), (3, 2, 3),
            (3, 2, None), (None, 2, None), (None, None, None), (0, None, None)]
    got = _eval(spark, R.OVERDRAFT_ORIGIN, "a int, m int, s int", rows, auto="a", manual="m", section="s")
    assert got == [1, 2, 3, 1, 4, 5, 6, 6, 7, None, None]
    mix = _eval(spark, R.SECTION_MIX, "z long, n long", [(1, 1), (1, 0), (0, 2), (0, 0)], n_zero="z", n_main="n")
    assert mix == [3, 1, 2, None]


def test_zone_label_fact(spark):
    rows = [(100, "3", "0001"), (110, "VAD", "0001"), (100, "OTRO", "0001"), (100, "12", "0001"),
            (200, "Sur", "0782"), (220, "Sur", "0001"), (210, "Nada", "0001"), (None, "1", "0001")]
    got = _eval(spark, R.ZONE_LABEL_FACT, "p int, z string, s string", rows, product="p", zone="z", store="s")
    assert got == ["03. Centro", "10. Vtas a Distancia", "13.- OTRO", "11. OTRO", "15.- ONLINE", "12.- Sur",
                   "13.- OTRO", "13.- OTRO"]


# ---------------------------------------------------------------------------
# Score tree (R17) properties
# ---------------------------------------------------------------------------
def _tree_grid(spark):
    scores = spark.range(-10, 2100).select((F.col("id") / 2).alias("score"))      # -5 .. 1049.5 step 0.5
    mobs = spark.range(-3, 131).select(F.col("id").cast("int").alias("mob"))
    periods = spark.createDataFrame([(p,) for p in (202201, 202202, 202203, 202204, 202206, 202207, 202401)],
                                    "period int")
    prods = spark.createDataFrame([(100,), (110,)], "product int")
    return scores.crossJoin(mobs).crossJoin(periods).crossJoin(prods).withColumn("brand", F.lit(100))


def test_score_tree_dead_rules_and_node_zero(spark):
    g = _tree_grid(spark).withColumn(
        "node", R.SCORE_TREE_NODE.column(period="period", product="product", brand="brand", mob="mob",
                                         score="score"))
    # node 0 never occurs (all '<cut -> 0' rules are shadowed) ...
    assert g.where(F.col("node") == 0).count() == 0
    # ... and exactly 12 of the 84 rules can never be the first match:
    # render the same tests with the rule index as value and count the hits
    assert len(R.SCORE_TREE_NODE.rules) == 84
    indexed = RuleTable("idx", tuple(Rule(r.tests, i) for i, r in enumerate(R.SCORE_TREE_NODE.rules)), None, "int")
    hit = (g.select(indexed.column(period="period", product="product", brand="brand", mob="mob", score="score")
                    .alias("i")).where("i IS NOT NULL").distinct().count())
    assert 84 - hit == 12
    # fall-through between tiers: >=202207, MOB 7..12, score < 375 -> node 3
    r = g.where("product = 110 AND period = 202401 AND mob = 10 AND score = 300").first()
    assert r.node == 3
    # fractional score between two integer cuts in a last tier -> NULL
    r = g.where("product = 100 AND period = 202201 AND mob = 49 AND score = 449.5").first()
    assert r.node is None


def test_nested_rendering_equals_flat(spark):
    flat = RuleTable("flat", R.SCORE_TREE_NODE.rules, None, "int")
    g = _tree_grid(spark).where("mob % 7 = 0")
    cols = dict(period="period", product="product", brand="brand", mob="mob", score="score")
    diff = g.where(~R.SCORE_TREE_NODE.column(**cols).eqNullSafe(flat.column(**cols))).count()
    assert diff == 0
    rflat = RuleTable("rflat", R.RISK_EFFECTIVE.rules, None, "string")
    h = g.withColumn("p3", F.col("period"))
    d2 = h.where(~R.RISK_EFFECTIVE.column(product="product", period="p3", score="score")
                 .eqNullSafe(rflat.column(product="product", period="p3", score="score"))).count()
    assert d2 == 0


@pytest.mark.parametrize("table,inputs,schema,rows", [
    (R.AMOUNT_BAND, dict(product="p", amount="a"), "p INTEGER, a DECIMAL(18,2)",
     [(100, D("3999")), (200, D("12000")), (230, D("1")), (None, None)]),
    (R.SCORE_TREE_NODE, dict(period="per", product="p", brand="b", mob="m", score="s"),
     "per INTEGER, p INTEGER, b INTEGER, m INTEGER, s DOUBLE",
     [(202201, 100, 100, 10, 410.0), (202401, 110, 200, 100, 917.5), (202205, 110, 120, 50, None)]),
])
def test_sql_rendering_matches_spark(spark, table, inputs, schema, rows):
    sp = _eval(spark, table, schema.replace("INTEGER", "int").replace("DECIMAL", "decimal").replace(
        "DOUBLE", "double"), rows, **inputs)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({schema})")
    con.executemany(f"INSERT INTO t VALUES ({', '.join('?' for _ in rows[0])})", rows)
    dk = [r[0] for r in con.execute(f"SELECT {table.sql(**inputs)} FROM t").fetchall()]
    assert sp == dk
