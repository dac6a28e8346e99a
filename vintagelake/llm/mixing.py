"""Mixing sources to target weights by entropy balancing (built-in functions only).

* Size: words of a text; a null text has 0.
* Targets.  Sources in code point order (null last) weigh 3, 1, 2, repeating,
  and share ``share`` times all words.  A target stops at ``most`` times its
  source's size; the excess goes to the others by weight until none is above.
* Rates.  Among all document rates r the balanced ones are those closest in
  entropy to 1, ``min sum size * (r log r - r + 1)`` with ``sum size * r`` of
  each source equal to its target.  The dual is convex, its solution is
  ``r = exp(dual of the source)``, and Newton's step needs only sums over a
  source's documents.  These are aggregated once (map-side first); the steps
  then run on the source rows, spread over the cluster like any DataFrame.
  ``target <= most * size`` keeps every rate within ``most``.
* Copies.  Rates are cut to 9 digits.  A document takes its whole part, and
  the fraction is dealt evenly along the source's documents from long to
  short, ties by doc_id: rank i gets an extra copy when ``floor(i * f + 0.5)``
  steps up.  Neighbours have like sizes, so the words taken miss the target by about
  one document.  Ranks come from one distributed sort with offsets of its
  partitions, so a hot source is spread over many tasks.

Empty sources have target 0 and rate 0; no documents give no rows.  Repeated
rows are separate documents.  Reruns agree: nothing is drawn at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import WORD, attach, stage

NEWTON_STEPS = 60


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, th, source, size): th is the hash of the text"""
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "source", F.coalesce(
        F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) by water-filling; one row per source.

    The level is found by passes over the source rows, each a one-row
    aggregate: a pass caps the sources that stand above it.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0)),
                          (F.row_number().over(order) - 1) % 3 + 1)
    per = stage(per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "sources")
    total = per.agg(F.sum("source_size")).first()[0]
    if total is None:
        return per.select("source", "source_size", F.lit(0.0).alias("target"))
    level = -1.0
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        row = per.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)),
                      F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if not row[1]:
            break
        new = (share * total - row[0]) / row[1]
        if new <= level:
            break
        level = new
    return per.select("source", "source_size",
                      F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def newton_dual(size: Column, target: Column, steps: int = NEWTON_STEPS) -> Column:
    """The dual of one source: root of ``size * exp(u) = target``.

    A Newton step is ``u - (size e^u - target) / (size e^u)``; steps down are
    held to 1 (a plain damping; from above the step is at most 1 anyway, from
    below it is convex and never undershoots again).
    """
    step = F.expr(f"aggregate(sequence(1, {steps}), 0D, (u, k) -> u - greatest(-1D, least(1D, 1D - t / (s * exp(u)))))")
    return F.when((size > 0) & (target > 0), step)


def rates(targets: DataFrame) -> DataFrame:
    """(source, source_size, target, rate)"""
    t = targets.withColumn("s", F.col("source_size").cast("double")).withColumn("t", F.col("target"))
    t = t.withColumn("dual", newton_dual(F.col("s"), F.col("t")))
    return t.select("source", "source_size", "target",
                    F.coalesce(F.round(F.exp("dual"), 9), F.lit(0.0)).alias("rate"))


def ranked(sized: DataFrame) -> DataFrame:
    """``sized`` with ``rank``: 0, 1, ... within its source, long texts first, ties by doc_id."""
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    rows = stage(sized.orderBy(*order).withColumn("part", F.spark_partition_id())
                 .withColumn("at", F.monotonically_increasing_id()), "ranked")
    per = rows.groupBy("source", "part").agg(F.min("at").alias("least"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per = per.select(F.col("source").alias("ps"), F.col("part").alias("pp"), "least", "before")
    return rows.join(per, rows["source"].eqNullSafe(per["ps"]) & (rows["part"] == per["pp"])) \
        .select("doc_id", "th", "source", "size", (F.col("at") - F.col("least") + F.col("before")).alias("rank"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, th, source, size, source_size, target, rate, copies, taken), one row per row of ``docs``."""
    sized = sizes(docs)
    rank = ranked(sized)
    per = rates(source_targets(rank, share, most)).withColumnRenamed("source", "rs")
    whole = F.floor("rate")
    part = F.col("rate") - whole
    copies = (whole + F.floor((F.col("rank") + 1) * part + 0.5) - F.floor(F.col("rank") * part + 0.5)).cast("long")
    return rank.join(per, rank["source"].eqNullSafe(per["rs"])).withColumn("copies", copies).select(
        "doc_id", "th", "source", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    per = mix(docs, share, most).groupBy(
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("did"), "th").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    rows, cols, repeat = attach(docs, per)
    # the copies of rows that repeat are shared out among them
    times = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("in__repeat") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    return rows.withColumn("in__repeat", repeat).withColumn("in__times", times).filter("in__times > 0") \
        .withColumn("in__copy", F.explode(F.sequence(F.lit(1).cast("long"), "in__times"))).select(*cols)
