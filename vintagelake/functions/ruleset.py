"""Rule data (R1-R23): banding, scoring and labelling ladders.

FIXED VALUES.  Every code, cut point and label below must equal the
business definitions the marts reproduce; they are stated as plain data in
their natural order (first match wins, top to bottom).  Variants that
differ are kept as separate tables on purpose.
"""

from __future__ import annotations

from decimal import Decimal as D

from vintagelake.functions.rules import Rule, RuleTable, ladder, lookup

# ---------------------------------------------------------------------------
# Product families, code sets, plans
# ---------------------------------------------------------------------------
FAMILIES_REVOLVING = (100, 110)
FAMILIES_STORE = (200, 210)
FAMILIES_ALL = (100, 110, 210, 200, 220, 230)
SCORE_TREE_BRANDS = (100, 120, 300, 500, 600, 200)

WRITE_OFF_CODES = tuple(range(502, 518))          # 502..517 inclusive
FORGIVENESS_CODES = (307, 407, 763, 764)
CASH_ADVANCE_CODES = (2, 102, 122, 320, 1002, 1102, 2002, 2102)
CASH_ADVANCE_REVERSALS = (62, 262, 420, 1062, 1262)
CASH_ADVANCE_STORE_CODES = (12, 122)              # families 200/210, plans 20003/20004
CASH_ADVANCE_STORE_REVERSALS = (72, 282)          # families 200/210, plan 20003
LEDGER_FILTER_CODES = (420, 2, 62, 102, 262, 320, 1002, 1062, 1102, 1262, 2002, 2102, 22, 282, 122, 72, 12)
LEDGER_FILTER_FAMILIES = (100, 110, 210, 200)
LEDGER_FILTER_PLANS = (20002, 20004, 20003)
NET_BASE_CODES = (2, 12, 102, 122, 320, 1002, 1102, 2002, 2102)
NET_BASE_REVERSALS = (62, 262, 420, 1062, 1262)

# Card states that do not count as live (trailing blanks are significant).
CARD_DEAD_STATES = ('A ', 'B ', 'C ', 'E ', 'F', 'H ', 'J ', 'K ', 'O ', 'P ', 'Q ', 'S ', 'U ', 'X ', 'Y ', 'Z')
CARD_ADDON_FLAGS = ('1', ' ')
CARD_PRIMARY_FLAGS = ('0',)

ONLINE_STORES = ("0782", "0039")

# ---------------------------------------------------------------------------
# K11 channel from plan code
# ---------------------------------------------------------------------------
CHANNEL = lookup("channel", "plan", [((20002,), "ATM"), ((20003,), "POS"), ((20004,), "DIGITAL")],
                 otherwise="POS")

# ---------------------------------------------------------------------------
# R1 / R2 limit and balance bands
# ---------------------------------------------------------------------------
_REV_BANDS = [(4000, "1.-4,000"), (7500, "2.-4,000-7,499"), (10000, "3.-7,500-9,999"),
              (15000, "4.-10,000-14,999"), (20000, "5.-15,000-19,999"), (30000, "6.-20,000-29,999"),
              (50000, "7.-30,000-49,999")]
_STORE_BANDS = [(2000, "1.-0-1,999"), (4000, "2.-2,000-3,999"), (8000, "3.-4,000-7,999"),
                (12000, "4.-8,000-11,999"), (15000, "5.-12,000 -14,999"), (18000, "6.-15,000-17,999"),
                (20000, "7.-18,000-19,999")]


def _amount_band(name: str, rev_top: str, store_top: str, rev_families=FAMILIES_REVOLVING,
                 store_families=FAMILIES_STORE, rev_bands=_REV_BANDS) -> RuleTable:
    rules = []
    for cut, label in rev_bands:
        rules.append(Rule((("product", "in", rev_families), ("amount", "<", cut)), label))
    rules.append(Rule((("product", "in", rev_families), ("amount", ">=", 50000)), rev_top))
    if store_families:
        for cut, label in _STORE_BANDS:
            rules.append(Rule((("product", "in", store_families), ("amount", "<", cut)), label))
        rules.append(Rule((("product", "in", store_families), ("amount", ">=", 20000)), store_top))
    return RuleTable(name, tuple(rules), "OTRO", "string", ("product", "amount"))


# Full form (limit and balance, stage form): top labels 8.-50,000+ / 8.->=20,000.
AMOUNT_BAND = _amount_band("amount_band", "8.-50,000+", "8.->=20,000")
# Published limit band of the dispositions fact: top labels 50,000+ / >=20,000.
LIMIT_BAND_PUBLISHED = _amount_band("limit_band_published", "50,000+", ">=20,000")
# Cohort variant: family 100 only, second label reads 4,001-7,499.
_COHORT_BANDS = [(4000, "1.-4,000"), (7500, "2.-4,001-7,499")] + _REV_BANDS[2:]
AMOUNT_BAND_COHORT = _amount_band("amount_band_cohort", "8.-50,000+", "", rev_families=(100,),
                                  store_families=(), rev_bands=_COHORT_BANDS)

# ---------------------------------------------------------------------------
# R3 utilisation band (ratio; -1 sentinel lands in A, NULL in J)
# ---------------------------------------------------------------------------
UTILISATION_BAND = ladder("utilisation_band", "ratio", [
    ("<=", 0.20, "A.1-20"), ("<=", 0.25, "B.21-25"), ("<=", 0.30, "C.26-30"), ("<=", 0.35, "D.31-35"),
    ("<=", 0.40, "E.36-40"), ("<=", 0.45, "F.41-45"), ("<=", 0.50, "G.46-50"), ("<=", 0.75, "H.51-75"),
    ("<=", 0.85, "I.76-85")], otherwise="J.86+")

# ---------------------------------------------------------------------------
# R4 delinquency label, R5 30+/90+ flags, R6 entry / CD2
# ---------------------------------------------------------------------------
DELINQUENCY_LABEL = lookup("delinquency_label", "level", [
    ((0, 1), "0.-CTAS_VIG"), ((2,), "1.-1-29 DIAS"), ((3,), "2.-30_DIAS"), ((4,), "3.-60_DIAS"),
    ((5,), "4.-90_DIAS"), ((6,), "5.-120_DIAS"), ((7,), "6.-150_DIAS"), ((8,), "7.-180_DIAS")],
    otherwise="8.-210_DIAS")
FLAG_30 = lookup("flag_30", "level", [((3, 4, 5, 6, 7, 8, 9), 1)], otherwise=0, output_type="int")
FLAG_90 = lookup("flag_90", "level", [((5, 6, 7, 8, 9), 1)], otherwise=0, output_type="int")
ENTRY_FLAG = ladder("entry_flag", "level", [(">=", 2, 1)], otherwise=0, output_type="int")
CD2_FLAG = ladder("cd2_flag", "level", [("=", 2, 1)], otherwise=0, output_type="int")

# ---------------------------------------------------------------------------
# R7 risk level from score
# ---------------------------------------------------------------------------
RISK_LETTERS = ladder("risk_letters", "score", [
    ("=", 0, "F. No calificado"), ("<", 456, "E. Very high"), ("<", 526, "D. High"),
    ("<", 604, "C. Medium"), ("<", 662, "B. Low")], otherwise="A. Very low")

_LEVELS = ("1.VERY HIGH", "2.HIGH", "3.MEDIUM", "4.LOW", "5.VERY LOW")


def _risk_block(product: int, period_tests: tuple, cuts: tuple, top_op: str, top: float) -> list:
    """Four upper cuts (op, value) for levels 1-4, then level 5 by ``top_op top``."""
    base = (("product", "=", product),) + period_tests
    rules = [Rule(base + (("score", op, v),), lbl) for (op, v), lbl in zip(cuts, _LEVELS)]
    rules.append(Rule(base + (("score", top_op, top),), _LEVELS[4]))
    return rules


_CUTS_NEW = (("<=", 455), ("<=", 525), ("<=", 603), ("<=", 661))
# Effective-dated, dispositions form: period = observation YYYYMM; no ELSE.
RISK_EFFECTIVE = RuleTable("risk_effective", tuple(
    [Rule((("product", "in", (100, 110, 200, 210)), ("score", "<=", 0)), "0.NO CALIFICADO")]
    + _risk_block(100, (("period", "<=", 202201),), (("<=", 405), ("<=", 426), ("<=", 450), ("<=", 467)), ">=", 468)
    + _risk_block(100, (("period", "between", (202202, 202601)),), _CUTS_NEW, ">", 661)
    + _risk_block(100, (("period", ">=", 202602),), (("<", 438), ("<", 519), ("<", 567), ("<", 654)), ">=", 654)
    + _risk_block(110, (("period", "<=", 202203),), (("<=", 856), ("<=", 894), ("<=", 929), ("<=", 952)), ">=", 953)
    + _risk_block(110, (("period", ">=", 202204),), _CUTS_NEW, ">", 661)
    + _risk_block(210, (("period", ">=", 202204),), _CUTS_NEW, ">", 661)
    + _risk_block(200, (("period", ">=", 202402),), (("<=", 451), ("<=", 531), ("<=", 637), ("<=", 714)), ">", 783)
), None, "string", ("product", "period", "score"), nest_prefix=2)

# Overdraft form: the period is the ORIGIN month, except the family-100
# 202202..202601 block whose lower bound tests the OBSERVATION month (levels
# 2-5); families 200/210 use reversed numbering in nested ladders whose ELSE
# is ''; anything else reads '0.NO CALIFICADO'.
_LOW_NUM = ("5.VERY HIGH", "4.HIGH", "3.MEDIUM", "2.LOW", "1.VERY LOW")


def _reversed_block(guard: tuple, cuts: tuple, top_op: str, top: float) -> list:
    rules = [Rule(guard + (("score", "=", 0),), "0.NO CALIFICADO"),
             Rule(guard + (("score", "is_null"),), "0.NO CALIFICADO")]
    rules += [Rule(guard + (("score", op, v),), lbl) for (op, v), lbl in zip(cuts, _LOW_NUM)]
    rules.append(Rule(guard + (("score", top_op, top),), _LOW_NUM[4]))
    rules.append(Rule(guard, ""))          # the nested CASE's ELSE: no fall-through
    return rules


_OLD_STORE_CUTS = (("<", 452), ("<", 532), ("<", 638), ("<", 715))
RISK_OVERDRAFT = RuleTable("risk_overdraft", tuple(
    [Rule((("product", "in", (100, 110, 200, 210)), ("score", "<=", 0)), "0.NO CALIFICADO")]
    + [Rule((("product", "=", 100), ("score", op, v), ("origin", "<=", 202201)), lbl) for (op, v), lbl in
       zip((("<=", 405), ("<=", 426), ("<=", 450), ("<=", 467), (">=", 468)), _LEVELS)]
    + [Rule((("product", "=", 110), ("score", op, v), ("origin", "<=", 202203)), lbl) for (op, v), lbl in
       zip((("<=", 856), ("<=", 894), ("<=", 929), ("<=", 952), (">=", 953)), _LEVELS)]
    + [Rule((("product", "=", 100), ("score", "<=", 455), ("origin", ">=", 202202), ("origin", "<", 202602)),
            _LEVELS[0])]
    + [Rule((("product", "=", 100), ("score", op, v), ("obs", ">=", 202202), ("origin", "<", 202602)), lbl)
       for (op, v), lbl in zip((("<=", 525), ("<=", 603), ("<=", 661), (">", 661)), _LEVELS[1:])]
    + [Rule((("product", "=", 110), ("score", op, v), ("origin", ">=", 202204)), lbl) for (op, v), lbl in
       zip((("<=", 455), ("<=", 525), ("<=", 603), ("<=", 661), (">", 661)), _LEVELS)]
    + [Rule((("product", "=", 100), ("score", op, v), ("origin", ">=", 202602)), lbl) for (op, v), lbl in
       zip((("<", 438), ("<", 519), ("<", 567), ("<", 654), (">=", 654)), _LEVELS)]
    + _reversed_block((("product", "=", 210), ("origin", "<=", 202308)), _OLD_STORE_CUTS, ">=", 715)
    + _reversed_block((("product", "=", 210), ("origin", ">=", 202309)),
                      (("<=", 455), ("<=", 525), ("<=", 603), ("<=", 661)), ">=", 662)
    + _reversed_block((("product", "=", 200),), _OLD_STORE_CUTS, ">=", 715)
), "0.NO CALIFICADO", "string", ("product", "origin", "obs", "score"))

# Older nested form (dates as periods): only score = 0 is unclassified, no
# fall-through between the product/period blocks, no ELSE (NULL).
_LEGACY_ZERO = "0.No calificado"


def _legacy_block(guard: tuple, cuts: tuple, top_op: str, top: float) -> list:
    rules = [Rule(guard + (("score", "=", 0),), _LEGACY_ZERO)]
    rules += [Rule(guard + (("score", op, v),), lbl) for (op, v), lbl in zip(cuts, _LEVELS)]
    rules.append(Rule(guard + (("score", top_op, top),), _LEVELS[4]))
    return rules


RISK_LEGACY = RuleTable("risk_legacy", tuple(
    _legacy_block((("product", "=", 100), ("period", "<=", 202201)),
                  (("<=", 405), ("<=", 426), ("<=", 450), ("<=", 467)), ">=", 468)
    + _legacy_block((("product", "=", 100), ("period", ">=", 202202)), _CUTS_NEW, ">", 661)
    + _legacy_block((("product", "=", 110), ("period", "<=", 202203)),
                    (("<=", 856), ("<=", 894), ("<=", 929), ("<=", 952)), ">=", 953)
    + _legacy_block((("product", "=", 110), ("period", ">=", 202204)), _CUTS_NEW, ">", 661)
    + _legacy_block((("product", "=", 210), ("period", ">=", 202204)), _CUTS_NEW, ">", 661)
    + _legacy_block((("product", "=", 200), ("period", ">=", 202402)),
                    (("<=", 451), ("<=", 531), ("<=", 637), ("<=", 714)), ">", 783)
), None, "string", ("product", "period", "score"))

# ---------------------------------------------------------------------------
# R8 rate tier (decimal membership; 80.00 sits in T4 and T5 -> T4 wins)
# ---------------------------------------------------------------------------
_RATES_REV = [
    ("T1", (36.39, 33.89, 32.89, 32.39, 31.39, 29.49, 27.99, 25.99)),
    ("T2", (49.54, 47.04, 46.04, 45.54, 42.04, 39.49, 37.99, 33.99)),
    ("T3", (58.86, 56.36, 55.36, 54.86, 53.11, 55, 49.89, 48.39, 44.39)),
    ("T4", (66.20, 63.70, 62.70, 62.20, 61.2, 57.49, 55.99, 51.99)),
    ("T5", (68, 65.5, 64.5, 64, 66, 65.49, 63.99, 59.99)),
    ("TASA EMPL", (29.43, 28.18, 27.68, 27.43, 26.55, 24.95, 24.20, 22.20)),
    ("T0", (14.99, 15.49, 16.49, 18.99)),
]
_RATES_STORE = [
    ("T1", (48.99, 56.70, 60.36, 60.86, 61.86)),
    ("T2", (55.99, 65.60, 69.83, 70.33, 71.33)),
    ("T3", (63.99, 75.00, 77.42, 77.60, 78.10, 79.10)),
    ("T4", (72.00, 80.00, 80.50, 81.50)),
    ("T5", (80.00, 85.00, 84.00, 84.50, 85.50)),
    ("TASA EMPL", (32.00, 37.50, 38.71, 38.80, 39.05, 39.55, 29.43)),
]


def _rate_rules(families, table):
    return [Rule((("product", "in", families), ("rate", "in", tuple(D(str(x)) for x in vals))), tier)
            for tier, vals in table]


RATE_TIER = RuleTable("rate_tier", tuple(
    _rate_rules((100, 110), _RATES_REV)
    + [Rule((("product", "in", (100, 110)), ("rate", "=", D(0))), "TASA CORPORATIVO")]
    + _rate_rules((200, 210), _RATES_STORE)), "Otros", "string", ("product", "rate"))
RATE_TIER_COHORT = RuleTable("rate_tier_cohort", tuple(
    _rate_rules((100, 110), _RATES_REV) + _rate_rules((200, 210), _RATES_STORE)),
    "Otros", "string", ("product", "rate"))
# FIXED VALUES: the lettered form, by the rate alone.
_RATES_LETTERED = [
    ("F.T5", (66.00, 64.00, 64.50, 65.50, 68.00, 85, 84, 84.5, 85.5)),
    ("E.T4", (61.20, 62.20, 62.70, 63.70, 66.20, 80, 80.5, 81.5)),
    ("D.T3", (53.11, 54.86, 55.36, 56.36, 58.86, 77.42, 77.6, 78.1, 79.1)),
    ("C.T2", (42.04, 45.54, 46.04, 47.04, 49.54, 69.83, 70.33, 71.33)),
    ("B.T1", (31.39, 32.39, 32.89, 33.89, 36.39, 60.36, 60.86, 61.86)),
    ("A.T0", (14.99, 15.49, 16.49, 18.99)),
    ("G.Empleados", (26.56, 27.43, 27.68, 28.18, 29.43, 38.71, 38.8, 39.05, 39.55)),
]
RATE_LEVEL = RuleTable("rate_level", tuple(
    Rule((("rate", "in", tuple(D(str(x)) for x in vals)),), tier) for tier, vals in _RATES_LETTERED),
    "H.Otros", "string", ("rate",))
# Single-value form: not in 200/210 (family test is negative), else OTRO.
RATE_TIER_SINGLE = RuleTable("rate_tier_single", tuple(
    [Rule((("product", "not_in", (200, 210)), ("rate", "=", D(v))), t) for v, t in
     [("14.99", "T0"), ("26.55", "Empleado"), ("31.39", "T1"), ("42.04", "T2"), ("53.11", "T3"),
      ("61.2", "T4"), ("66", "T5")]]
    + [Rule((("product", "not_in", (100, 110)), ("rate", "=", D(v))), t) for v, t in
       [("38.71", "Empleado"), ("77.42", "T3"), ("80", "T4"), ("85", "T5")]]), "OTRO", "string",
    ("product", "rate"))

# ---------------------------------------------------------------------------
# R9 months-on-book band, R10 age bands
# ---------------------------------------------------------------------------
MOB_BAND = ladder("mob_band", "mob", [
    ("<=", 6, "A.0M-6M"), ("<=", 12, "B.7M-12M"), ("<=", 24, "C.13M-24M"), ("<=", 36, "D.25M-36M"),
    ("<=", 48, "E.37M-48M"), ("<=", 60, "F.49M-60M"), (">=", 61, "G.61M+")], otherwise="0.- NO CLASIFICADO")
# Overdraft variants: NULL falls to the last band; numbered labels.
MOB_BAND_OVERDRAFT = ladder("mob_band_overdraft", "mob", [
    ("<=", 6, "A.0M-6M"), ("<=", 12, "B.7M-12M"), ("<=", 24, "C.13M-24M"), ("<=", 36, "D.25M-36M"),
    ("<=", 48, "E.37M-48M"), ("<=", 60, "F.49M-60M")], otherwise="G.61M+")
MOB_BAND_NUMBERED = ladder("mob_band_numbered", "mob", [
    ("<=", 6, "1. 0-6 Meses"), ("<=", 12, "2. 7-12 Meses"), ("<=", 24, "3. 13-24 Meses"),
    ("<=", 36, "4. 25-36 Meses"), ("<=", 48, "5. 37-48 Meses"), ("<=", 60, "6. 49-60 Meses")],
    otherwise="7. 61+ Meses")
AGE_BAND_OVERDRAFT = RuleTable("age_band_overdraft", (
    Rule.of("<21", ("age", "<", 21)),
    Rule.of("21-24", ("age", ">=", 21), ("age", "<=", 24)),
    Rule.of("25-29", ("age", ">=", 25), ("age", "<=", 29)),
    Rule.of("30-37", ("age", ">", 29), ("age", "<=", 37)),
    Rule.of("38-44", ("age", ">", 37), ("age", "<=", 44)),
    Rule.of("45-59", ("age", ">", 44), ("age", "<=", 59)),
    Rule.of("60 +", ("age", ">=", 60))), None, "string", ("age",))
FLAG_30_TEXT = lookup("flag_30_text", "level", [((3, 4, 5, 6, 7, 8, 9), "1")], otherwise="0")
FLAG_90_TEXT = lookup("flag_90_text", "level", [((5, 6, 7, 8, 9), "1")], otherwise="0")
AGE_BAND_COHORT = RuleTable("age_band_cohort", (
    Rule.of("18-20", ("age", ">=", 18), ("age", "<=", 20)),
    Rule.of("21-24", ("age", ">", 20), ("age", "<=", 24)),
    Rule.of("25-29", ("age", ">=", 25), ("age", "<=", 29)),
    Rule.of("30-37", ("age", ">", 29), ("age", "<=", 37)),
    Rule.of("38-44", ("age", ">", 37), ("age", "<=", 44)),
    Rule.of("45-59", ("age", ">", 44), ("age", "<=", 59)),
    Rule.of("60 +", ("age", ">=", 60))), None, "string", ("age",))
AGE_BAND_FACT = ladder("age_band_fact", "age", [
    ("<", 30, "30"), ("<", 35, "30-35"), ("<", 45, "35-45"), ("<", 50, "45-50"), (">=", 50, "50+")],
    otherwise="Sin clasificar")

# ---------------------------------------------------------------------------
# R11 zone labels and the zone-name normaliser
# ---------------------------------------------------------------------------
_ZONE_CODES = ("1", "2", "3", "4", "5", "6", "7", "8", "9")
_ZONE_FACT_REV = ["01. Metro Sur", "02. Metro Norte", "03. Centro", "04. Occidente", "05. Golfo",
                  "06. Noreste", "07. Bajio", "08. Noroeste", "09. Sureste"]
_ZONE_FACT_STORE = [("Centro Norte", "08.- Centro Norte"), ("Sur", "12.- Sur"), ("Centro Sur", "10.- Centro Sur"),
                    ("Metro Centro", "04.- Metro Centro"), ("Golfo", "11.- Golfo"), ("Occidente", "06.- Occidente"),
                    ("Metro Oriente", "02.- Metro Oriente"), ("Metro Norte", "03.- Metro Norte"), ("Norte", "09.- Norte"),
                    ("Metro Sur", "01.- Metro Sur"), ("Bajio", "05.- Bajio"), ("Pacifico", "07.- Pacificio"),
                    ("VDA", "14.- VAD")]
ZONE_LABEL_FACT = RuleTable("zone_label_fact", tuple(
    [Rule((("product", "in", (110, 100)), ("zone", "=", code)), lbl) for code, lbl in zip(_ZONE_CODES, _ZONE_FACT_REV)]
    + [Rule((("product", "in", (110, 100)), ("zone", "=", "VAD")), "10. Vtas a Distancia"),
       Rule((("product", "in", (110, 100)), ("zone", "not_in", ("OTRO", "VAD") + _ZONE_CODES)), "11. OTRO"),
       Rule((("product", "in", (210, 200, 220)), ("store", "in", ONLINE_STORES)), "15.- ONLINE")]
    + [Rule((("product", "in", (210, 200, 220)), ("zone", "=", name)), lbl) for name, lbl in _ZONE_FACT_STORE]
), "13.- OTRO", "string", ("product", "zone", "store"))
_ZONE_COHORT = ["1. Metro Sur", "2. Metro Norte", "3. Centro", "4. Occidente", "5. Golfo", "6. Noreste",
                "7. Bajio", "8. Noroeste", "9. Sureste"]
ZONE_LABEL_COHORT = RuleTable("zone_label_cohort", tuple(
    [Rule((("product", "in", (100, 110)), ("zone", "not_in", ("OTRO", "VAD") + _ZONE_CODES)), "Otro"),
     Rule((("product", "in", (100, 110)), ("zone", "=", "VAD")), "Canal Digital")]
    + [Rule((("product", "in", (100, 110)), ("zone", "=", c)), lbl) for c, lbl in zip(_ZONE_CODES, _ZONE_COHORT)]
), "Otro", "string", ("product", "zone"))

ZONE_NAME_CLEAN = RuleTable("zone_name_clean", (
    Rule.of("Otro", ("zone_trimmed", "=", "")),
    Rule.of("Otro", ("zone", "in", ("NULL", "null", "Sin Identificar"))),
    Rule.of("Pacifico", ("zone", "=", "Pacífico")),
    Rule.of("Otro", ("zone", "=", "Cierre")),
    Rule.of("Canal Digital", ("zone", "=", "Omnicanal")),
    Rule.of("Bajio", ("zone", "=", "Bajío")),
), None, "string", ("zone", "zone_trimmed"))  # NULL and ELSE handled by the caller (coalesce)
ZONE_ID = lookup("zone_id", "zone", [
    (("Metro Sur",), "1"), (("Metro Oriente",), "2"), (("Metro Norte",), "3"), (("Metro Centro",), "4"),
    (("Bajio",), "5"), (("Occidente",), "6"), (("Pacifico",), "7"), (("Centro Norte",), "8"), (("Norte",), "9"),
    (("Centro Sur",), "10"), (("Golfo",), "11"), (("Sur",), "12")], otherwise="13")

# ---------------------------------------------------------------------------
# R12 statement channel, R13 gender
# ---------------------------------------------------------------------------
STATEMENT_CHANNEL = lookup("statement_channel", "flag", [
    (("0",), "0. DOMICILIO"), (("1",), "1. PAPERLESS"), (("2",), "2. EMAIL - DOMICILIO"),
    (("3",), "3. PAPERLESS + BANNER PAPERLESS"), (("M",), "4. MORATORIO"), (("R",), "5. REVISION"),
    (("O", "H"), "6. ERRORES")], otherwise="Sin Clasificar")      # applied to the trimmed flag
STATEMENT_CHANNEL_SHORT = lookup("statement_channel_short", "flag", [
    (("0",), "IMPRESO"), (("1",), "PAPERLESS"), (("2",), "PAPERLESS E IMPRESO")], otherwise="OTRO")  # untrimmed
GENDER_FROM_LETTER = lookup("gender_letter", "sex", [(("M",), "MASCULINO"), (("F",), "FEMENINO")],
                            otherwise="SIN GENERO")
GENDER_FROM_CODE = lookup("gender_code", "gen", [((1,), "MASCULINO"), ((2,), "FEMENINO")], otherwise="SIN GENERO")
SEX_FROM_CODE = lookup("sex_code", "gen", [((1,), "M"), ((2,), "F")], otherwise="0")

# ---------------------------------------------------------------------------
# R15 opening-year band (the NULL-date branch is handled via year IS NULL)
# ---------------------------------------------------------------------------
OPENING_YEAR_BAND = RuleTable("opening_year_band", (
    Rule.of("<2009", ("product", "in", (110, 100)), ("open_year", "<", 2010)),
    Rule.of("<2009", ("product", "in", (110, 100)), ("open_year", "is_null")),
    Rule.of("2010 - 2015", ("product", "in", (110, 100)), ("open_year", "between", (2010, 2015))),
    Rule.of("2016 - 2019", ("product", "in", (110, 100)), ("open_year", "between", (2016, 2019))),
    Rule.of("2020", ("product", "in", (110, 100)), ("open_year", "=", 2020)),
    Rule.of("2021", ("product", "in", (110, 100)), ("open_year", "=", 2021)),
    Rule.of("2022", ("product", "in", (110, 100)), ("open_year", "=", 2022)),
), "NO", "string", ("product", "open_year"))  # 200/210 >= 2018 -> the year itself (see operators)

# ---------------------------------------------------------------------------
# R16 tree levels
# ---------------------------------------------------------------------------
TREE_LEVEL_2 = RuleTable("tree_level_2", (
    Rule.of("1.DE 0 A 11", ("product", "=", 100), ("mob", "between", (0, 11))),
    Rule.of("2.DE 12 A 47", ("product", "=", 100), ("mob", "between", (12, 48))),
    Rule.of("3.MAYOR O IGUAL A 48", ("product", "=", 100), ("mob", ">=", 48)),
    Rule.of("1.DE 0 A 11", ("product", "=", 110), ("mob", "between", (0, 11))),
    Rule.of("2.DE 12 A 59", ("product", "=", 110), ("mob", "between", (12, 59))),
    Rule.of("3.DE 60 A 119", ("product", "=", 110), ("mob", "between", (60, 119))),
    Rule.of("4.MAYOR O IGUAL A 120", ("product", "=", 110), ("mob", ">=", 120)),
), None, "string", ("product", "mob"))
TREE_LEVEL_3 = RuleTable("tree_level_3", (
    Rule.of("1.MENOR O IGUAL A 379", ("product", "=", 100), ("score", "between", (0, 379))),
    Rule.of("2.DE 380 A 399", ("product", "=", 100), ("score", "<=", 399)),
    Rule.of("3.DE 400 A 419", ("product", "=", 100), ("score", "<=", 419)),
    Rule.of("4.DE 420 A 449", ("product", "=", 100), ("score", "<=", 449)),
    Rule.of("5.MAYOR O IGUAL A 450", ("product", "=", 100), ("score", ">=", 450)),
    Rule.of("1.MENOR O IGUAL A 799", ("product", "=", 110), ("score", "between", (0, 799))),
    Rule.of("2.DE 800 A 849", ("product", "=", 110), ("score", "<=", 849)),
    Rule.of("3.DE 850 A 884", ("product", "=", 110), ("score", "<=", 884)),
    Rule.of("4.DE 885 A 899", ("product", "=", 110), ("score", "<=", 899)),
    Rule.of("5.DE 900 A 919", ("product", "=", 110), ("score", "<=", 919)),
    Rule.of("6.DE 920 A 934", ("product", "=", 110), ("score", "<=", 934)),
    Rule.of("7.MAYOR O IGUAL A 935", ("product", "=", 110), ("score", ">=", 935)),
), None, "string", ("product", "score"))
TREE_NODE_ID = RuleTable("tree_node_id", (
    Rule.of(1, ("product", "=", 100), ("mob", "between", (0, 11))),
    Rule.of(2, ("product", "=", 100), ("score", "<=", 399)),
    Rule.of(3, ("product", "=", 100), ("score", "<=", 419)),
    Rule.of(4, ("product", "=", 100), ("score", "<=", 449)),
    Rule.of(5, ("product", "=", 100), ("score", ">=", 450)),
), 6, "int", ("product", "mob", "score"))


# ---------------------------------------------------------------------------
# R17 score-tree node: (product, period test) -> MOB tiers -> score rules.
# Each tier: (MOB test, [(score test, node), ...]).  Evaluated top to bottom.
# ---------------------------------------------------------------------------
def _tier(mob_test, *score_rules):
    return mob_test, score_rules


SCORE_TREE_SPEC = [
    (100, ("period", "<=", 202202), [
        _tier(("mob", "<=", 6), (None, 14)),
        _tier(("mob", "<=", 48), (("between", (406, 417)), 1), (("<=", 436), 2), (("<=", 449), 3),
              (("<=", 463), 4), ((">=", 464), 5), (("<", 406), 0)),
        _tier(("mob", "<=", 84), (("between", (406, 417)), 6), (("<=", 436), 7), (("<=", 449), 8),
              ((">=", 450), 9), (("<", 406), 0)),
        _tier(("mob", ">=", 85), (("between", (400, 419)), 10), (("<=", 435), 11), (("<=", 444), 12),
              ((">=", 445), 13), (("<", 400), 0)),
    ]),
    (100, ("period", ">=", 202203), [
        _tier(("mob", "<=", 6), (None, 14)),
        _tier(("mob", "<=", 48), (("between", (382, 418)), 1), (("<=", 477), 2), (("<=", 527), 3),
              (("<=", 590), 4), ((">=", 591), 5), (("<", 382), 0)),
        _tier(("mob", "<=", 84), (("between", (382, 418)), 6), (("<=", 477), 7), (("<=", 527), 8),
              ((">=", 528), 9), (("<", 382), 0)),
        _tier(("mob", ">=", 85), (("between", (368, 423)), 10), (("<=", 474), 11), (("<=", 508), 12),
              ((">=", 509), 13), (("<", 368), 0)),
    ]),
    (110, ("period", "<=", 202203), [
        _tier(("mob", "<=", 6), (None, 14)),
        _tier(("mob", "<=", 35), (("between", (840, 859)), 1), (("<=", 883), 2), (("<=", 889), 3),
              ((">=", 890), 4), (("<", 840), 0)),
        _tier(("mob", "<=", 71), (("between", (840, 859)), 5), (("<=", 883), 6), (("<=", 933), 7),
              ((">=", 934), 8), (("<", 840), 0)),
        _tier(("mob", ">=", 72), (("<=", 819), 9), (("<=", 833), 10), (("<=", 883), 11), (("<=", 917), 12),
              ((">=", 918), 13), (("<", 800), 0)),
    ]),
    (110, ("period", "<=", 202206), [
        _tier(("mob", "<=", 6), (None, 17)),
        _tier(("mob", "<=", 35), (("between", (375, 443)), 1), (("<=", 526), 2), (("<=", 553), 3),
              ((">=", 554), 4), (("<", 375), 0)),
        _tier(("mob", "<=", 71), (("between", (375, 443)), 6), (("<=", 526), 7), (("<=", 704), 8),
              ((">=", 705), 9), (("<", 375), 5)),
        _tier(("mob", ">=", 72), (("between", (375, 413)), 11), (("<=", 460), 12), (("<=", 480), 13),
              (("<=", 540), 14), (("<=", 583), 15), ((">=", 584), 16), (("<", 375), 10)),
    ]),
    (110, ("period", ">=", 202207), [
        _tier(("mob", "<=", 6), (None, 15)),
        _tier(("mob", "<=", 12), (("between", (375, 525)), 1), ((">=", 526), 2)),
        _tier(("mob", "<=", 24), (("<", 375), 3), (("between", (375, 525)), 4), (("between", (526, 603)), 5),
              ((">=", 604), 6)),
        _tier(("mob", "<=", 72), (("<", 375), 7), (("between", (375, 525)), 8), (("between", (526, 603)), 9),
              ((">=", 604), 10)),
        _tier(("mob", ">", 72), (("<", 375), 11), (("between", (375, 525)), 12), (("between", (526, 603)), 13),
              ((">=", 604), 14)),
    ]),
]


def _score_tree_rules():
    rules = []
    for product, period_test, tiers in SCORE_TREE_SPEC:
        head = (("period",) + period_test[1:], ("product", "=", product), ("brand", "in", SCORE_TREE_BRANDS))
        for mob_test, score_rules in tiers:
            for score_test, node in score_rules:
                tests = head + (mob_test,)
                if score_test is not None:
                    tests = tests + (("score",) + score_test,)
                rules.append(Rule(tests, node))
    return tuple(rules)


SCORE_TREE_NODE = RuleTable("score_tree_node", _score_tree_rules(), None, "int",
                            ("period", "product", "brand", "mob", "score"), nest_prefix=3)

# R18 node -> MOB label
NODE_LABEL = RuleTable("node_label", (
    Rule.of("Sin Minimo", ("product", "=", 100), ("node", "=", 0)),
    Rule.of("A. 7-48 meses", ("period", "<=", 202202), ("product", "=", 100), ("node", "in", (1, 2, 3, 4, 5))),
    Rule.of("B. 49-84 meses", ("period", "<=", 202202), ("product", "=", 100), ("node", "in", (6, 7, 8, 9))),
    Rule.of("C. 85+ meses", ("period", "<=", 202202), ("product", "=", 100), ("node", "in", (10, 11, 12, 13))),
    Rule.of("A. 7-48 meses", ("period", ">=", 202203), ("product", "=", 100), ("node", "in", (1, 2, 3, 4, 5))),
    Rule.of("B. 49-84 meses", ("period", ">=", 202203), ("product", "=", 100), ("node", "in", (6, 7, 8, 9))),
    Rule.of("C. 85+ meses", ("period", ">=", 202203), ("product", "=", 100), ("node", "in", (10, 11, 12, 13))),
    Rule.of("A. 7-35 meses", ("period", "<=", 202203), ("product", "=", 110), ("node", "in", (1, 2, 3, 4))),
    Rule.of("B. 36-71 meses", ("period", "<=", 202203), ("product", "=", 110), ("node", "in", (5, 6, 7, 8))),
    Rule.of("C. 72+ meses", ("period", "<=", 202203), ("product", "=", 110), ("node", "in", (9, 10, 11, 12, 13))),
    Rule.of("A. 7-35 meses", ("period", ">=", 202204), ("product", "=", 110), ("node", "in", (0, 1, 2, 3, 4))),
    Rule.of("B. 36-71 meses", ("period", ">=", 202204), ("product", "=", 110), ("node", "in", (5, 6, 7, 8, 9))),
    Rule.of("C. 72+ meses", ("period", ">=", 202204), ("product", "=", 110),
            ("node", "in", (10, 11, 12, 13, 14, 15, 16))),
), "D. Menor a 7 meses", "string", ("product", "period", "node"))

# ---------------------------------------------------------------------------
# R19 overdraft origin, R20 section mix
# ---------------------------------------------------------------------------
OVERDRAFT_ORIGIN = RuleTable("overdraft_origin", (
    Rule.of(1, ("auto", ">", 0), ("manual", "is_null"), ("section", "is_null")),
    Rule.of(2, ("auto", ">", 0), ("manual", "is_null"), ("section", "=", 1)),
    Rule.of(3, ("auto", ">", 0), ("manual", "is_null"), ("section", "=", 2)),
    Rule.of(1, ("auto", ">", 0), ("manual", "is_null"), ("section", "=", 3)),
    Rule.of(4, ("auto", ">", 0), ("manual", ">", 0), ("section", "=", 1)),
    Rule.of(5, ("auto", ">", 0), ("manual", ">", 0), ("section", "=", 2)),
    Rule.of(6, ("auto", ">", 0), ("manual", ">", 0), ("section", "=", 3)),
    Rule.of(6, ("auto", ">", 0), ("manual", ">", 0), ("section", "is_null")),
    Rule.of(7, ("auto", "is_null"), ("manual", ">", 0)),
), None, "int", ("auto", "manual", "section"))
SECTION_MIX = RuleTable("section_mix", (
    Rule.of(3, ("n_zero", ">", 0), ("n_main", ">", 0)),
    Rule.of(1, ("n_zero", ">", 0), ("n_main", "=", 0)),
    Rule.of(2, ("n_zero", "=", 0), ("n_main", ">", 0)),
), None, "int", ("n_zero", "n_main"))

# R21 qualifying cash-advance transaction (counts toward the gross count)
QUALIFYING_TXN = RuleTable("qualifying_txn", (
    Rule.of(1, ("code", "in", (2, 102, 320, 122)), ("product", "=", 110)),
    Rule.of(1, ("code", "in", (2, 102, 320, 1002, 1102, 2002, 2102, 122)), ("product", "=", 100)),
    Rule.of(1, ("plan", "in", (20003, 20004)), ("code", "in", (12, 122)), ("product", "in", (200, 210))),
), 0, "int", ("code", "product", "plan"))

# R23 macro-segment default
MACRO_SEGMENT_UNCLASSIFIED = (0, 99)
