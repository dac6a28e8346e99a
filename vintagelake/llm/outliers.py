"""Quality rules by robust multivariate outliers (built-in functions only).

Base statistics of the whole text (a null text has no words): words are
``[^\\x20\\x09-\\x0D]+``; word_chars their code points; n_symbols the characters
of ``[#*$%&|<>]``; n_dup_lines the lines with a word that equal an earlier
line; n_repeat_words the words inside 3-word windows that occur twice or more
in the text, first occurrence included.  ``base_failed``: fewer than 50 words,
or ``100 * n_repeat_words > 50 * n_words``.

Outliers.  Documents that pass become vectors of transformed statistics: the
mean word length, and the symbol, repeated-line and repeated-window rates on
an arcsine or log scale.  Each (lang, source) group gets a minimum covariance
determinant estimate by concentration steps: start from medians and median
absolute deviations, then repeatedly take mean and covariance of the ``half``
of the rows nearest by Mahalanobis distance.  Quantiles and moments are
mergeable aggregates, so a hot group is combined map-side.  The final
covariance is scaled so that the median distance is the chi-square median, and
a small variance floor keeps constant statistics from dividing by zero.  Rows
beyond ``cutoff`` are rejected.  Groups with fewer than ``min_group`` passing
rows use the estimate over all rows, itself made the same way.

Null lang or source form groups of their own.  Rows are kept one to one,
repeated rows included; empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import SPACES, WORD, stage

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
HALF = 0.75
STEPS = 3
MIN_GROUP = 100
# median of chi-square with 4 degrees of freedom
CHI2_MEDIAN = 3.3567
# far beyond chi-square: the rates of ordinary text are heavy-tailed
CUTOFF = 90.0
# standard deviations that a statistic is given at least
FLOOR = (0.12, 0.05, 0.5, 0.15)
STATS = ("v0", "v1", "v2", "v3")


def base_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("ws", F.filter(F.split("text", SPACES), lambda w: w != ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    d = d.select(
        "doc_id", "lang", "source", "ws", F.size("ws").alias("n"),
        F.char_length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("ls"))
    # Each 3-word window as one number: hash above, index in the low bits.  Sorting brings equal windows together.
    bits = F.ceil(F.log2(F.col("n") + F.lit(2))).cast("int")
    d = d.withColumn("bits", bits).withColumn("dup", (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long"))
    d = d.drop("ls").withColumn("win", F.expr(
        "CASE WHEN n < 3 THEN array() ELSE sort_array(transform(sequence(0, n - 3), i -> "
        "shiftleft(xxhash64(ws[i], ws[i + 1], ws[i + 2]), bits) | i)) END"))
    d = d.drop("ws").withColumn("top", F.expr("size(win) - 1")).withColumn("hits", F.expr(
        "sort_array(transform(filter(win, (x, i) -> "
        "(i > 0 AND shiftright(win[greatest(i - 1, 0)], bits) = shiftright(x, bits)) OR "
        "(i < top AND shiftright(win[least(i + 1, top)], bits) = shiftright(x, bits))), "
        "x -> x & (shiftleft(1L, bits) - 1)))"))
    d = d.drop("win").withColumn("last", F.expr("size(hits) - 1"))
    covered = F.expr("aggregate(transform(hits, (x, i) -> CASE WHEN i = last THEN 3L "
                     "ELSE least(3L, hits[least(i + 1, last)] - x) END), 0L, (a, x) -> a + x)")
    return d.select("doc_id", "lang", "source", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                    F.col("dup").alias("n_dup_lines"), covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vectors(stats: DataFrame) -> DataFrame:
    """``stats`` with the transformed statistics v0..v3."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda x: F.asin(F.sqrt(F.least(F.lit(1.0), x / n)))
    return stats.withColumns({
        "v0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "v1": F.log1p(F.col("n_symbols") / n),
        "v2": F.log1p(100 * F.col("n_dup_lines") / n),
        "v3": share(F.col("n_repeat_words"))})


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(STATS)) for j in range(i + 1)]


def _moments(rows: DataFrame) -> DataFrame:
    """Mean m0.. and covariance c00.. of each group, from sums around the group's centre."""
    aggs = [F.count(F.lit(1)).alias("cnt")]
    aggs += [F.avg(v).alias(f"m{i}") for i, v in enumerate(STATS)]
    aggs += [F.covar_pop(STATS[i], STATS[j]).alias(f"c{i}{j}") for i, j in _pairs()]
    return rows.groupBy("gl", "gs").agg(*aggs)


def _cholesky(params: DataFrame) -> DataFrame:
    """Lower factor l00.. of the covariance with the variance floor added."""
    for i in range(len(STATS)):
        for j in range(i + 1):
            dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            if i == j:
                params = params.withColumn(f"l{i}{i}", F.sqrt(F.greatest(
                    F.col(f"c{i}{i}") + F.lit(FLOOR[i] ** 2) - dot, F.lit(FLOOR[i] ** 2))))
            else:
                params = params.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}"))
    return params.select("gl", "gs", *[f"m{i}" for i in range(len(STATS))], *[f"l{i}{j}" for i, j in _pairs()])


def _distance(rows: DataFrame, params: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with ``d2``, the squared Mahalanobis distance to their group's estimate."""
    p = params.withColumnsRenamed({"gl": "pl", "gs": "ps"})
    j = rows.join(p, (F.col("gl") == F.col("pl")) & (F.col("gs") == F.col("ps")))
    for i, v in enumerate(STATS):
        dot = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        j = j.withColumn(f"z{i}", (F.col(v) - F.col(f"m{i}") - dot) / F.col(f"l{i}{i}"))
    return j.select(*keep, sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(STATS))), F.lit(0.0)).alias("d2"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians, and a diagonal covariance from median absolute deviations."""
    mid = rows.groupBy("gl", "gs").agg(*[F.percentile_approx(v, 0.5, 1000).alias(f"m{i}") for i, v in enumerate(STATS)])
    p = mid.withColumnsRenamed({"gl": "pl", "gs": "ps"})
    dev = rows.join(p, (F.col("gl") == F.col("pl")) & (F.col("gs") == F.col("ps"))).groupBy("gl", "gs").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(STATS))],
        *[F.percentile_approx(F.abs(F.col(v) - F.col(f"m{i}")), 0.5, 1000).alias(f"a{i}") for i, v in enumerate(STATS)])
    for i, j in _pairs():
        dev = dev.withColumn(f"c{i}{j}", F.pow(1.4826 * F.col(f"a{i}"), F.lit(2.0)) if i == j else F.lit(0.0))
    return dev


def mcd(rows: DataFrame, half: float = HALF, steps: int = STEPS) -> DataFrame:
    """(gl, gs, m*, l*, scale): the estimate of each group of ``rows`` (gl, gs, v0..v3)."""
    params = stage(_cholesky(_start(rows)), "mcd")
    keep = ["gl", "gs", *STATS]
    for _ in range(steps):
        near = _distance(rows, params, keep)
        cut = near.groupBy("gl", "gs").agg(F.percentile_approx("d2", half, 1000).alias("cut"))
        near = near.join(cut.withColumnsRenamed({"gl": "pl", "gs": "ps"}),
                         (F.col("gl") == F.col("pl")) & (F.col("gs") == F.col("ps"))).filter("d2 <= cut")
        params = stage(_cholesky(_moments(near.select(*keep))), "mcd")
    scale = _distance(rows, params, keep).groupBy("gl", "gs").agg(
        (F.percentile_approx("d2", 0.5, 1000) / CHI2_MEDIAN).alias("scale"))
    return params.join(scale, ["gl", "gs"]).withColumn("scale", F.greatest("scale", F.lit(0.25)))


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """(doc_id, base statistics, base_failed, kept, distance), one row per row of ``docs``."""
    # a missing value is its own group: no given string starts with these two characters
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    rows = stage(vectors(base_statistics(docs)).withColumn("base_failed", base_failed())
                 .withColumns({"l": name("lang"), "s": name("source")}), "statistics")
    rows = rows.drop("lang", "source")
    passed = rows.filter("NOT base_failed")
    big = passed.groupBy("l", "s").count().filter(F.col("count") >= min_group).select(
        F.col("l").alias("bl"), F.col("s").alias("bs"))
    own = rows.join(big, (F.col("l") == F.col("bl")) & (F.col("s") == F.col("bs")), "left")
    own = stage(own.withColumns({"gl": F.coalesce("bl", F.lit("*")), "gs": F.coalesce("bs", F.lit("*"))}), "grouped")
    fit = own.filter("NOT base_failed").select("gl", "gs", *STATS)
    every = passed.select(F.lit("*").alias("gl"), F.lit("*").alias("gs"), *STATS)
    params = mcd(fit.filter("gl != '*'").union(every))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = _distance(own, params.select("gl", "gs", *[c for c in params.columns if c not in ("gl", "gs")]),
                       [*out, "scale"])
    good = scored.select(*out, (F.col("d2") / F.col("scale")).alias("distance"))
    good = good.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= cutoff))
    # with no passing row there is no estimate, and nothing is kept
    lone = own.join(params.select(F.col("gl").alias("pl"), F.col("gs").alias("ps")),
                    (F.col("gl") == F.col("pl")) & (F.col("gs") == F.col("ps")), "left_anti")
    return good.select(*out, "kept", "distance").union(
        lone.select(*out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))
