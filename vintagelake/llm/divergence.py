"""Which sources of a language differ from it and from each other, and by which terms.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased.  A language
keeps the terms in at least ``MIN_DOCS`` of its documents (rows; repeated rows
count each).  With ``V`` kept terms and ``N`` their occurrences in a source, a
term's share is ``p = 1 + floor(SCALE * (count + 1) / (N + V))``; ``q`` is the
same for what it is compared with, and ``f = floor((p - q)^2 / q)``.

* ``term`` part, by a dominance skyband: where ``p > q``, f grows with the
  source's count and falls with the language's, and ties go to the earlier term.
  So a term that ``k`` others beat in all three (count not lower, language count
  not higher, earlier in UTF-8) is not among the first ``k``.  Each partition (a
  hash part of a source's terms) keeps those that fewer than ``k`` others
  dominate, the skybands of a source are merged in the same way, and what is left
  is ranked exactly.  A merge folds its rows through a buffer of bounded
  size besides the skyband, so a hot source does not grow a task's memory.
* ``pair`` part: f summed over all kept terms for two sources of a language.
  Terms that a source lacks have one share, so the sum is taken from the terms of
  each source (``p`` histogram against the other's empty share) and corrected for
  the terms that both have; a task adds these corrections up by pair before they
  leave it.

Counts and totals are exact integers: shares are divided as decimals, f fits 64
bits, and a sum over terms does for up to ``5e8`` kept terms a language.  Null
text, lang and source are read as ''.  A source without terms has N = 0; a
language without kept terms gives 0 for each pair.  Other columns do not matter;
an empty table gives no rows; very long texts are counted as one document.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import stage

MIN_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
ENTRIES = 300_000      # counter entries of a task before they are handed on
BUFFER = 20_000        # rows of a source waiting for the next reduction to its skyband
PAIR_ROWS = 1_000_000  # pairs of sources of single terms worked out together
PARTS = 8              # hash parts of a source whose skybands are found first
GRID, STEP = 64, 512   # cells a side of the skyband's grid of counts; rows compared together

_OTHER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GROUP = ["lang", "source"]


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it), combined within a task."""
    base = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        found: dict[tuple, tuple[Counter, Counter]] = {}

        def rows():
            for (lang, source), (n, d) in found.items():
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()),
                         pa.array(list(n.values()), pa.int64()), pa.array([d[t] for t in n], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            found.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                n, d = found.setdefault((lang, source), (Counter(), Counter()))
                terms = text.translate(_OTHER).split()
                held -= len(n)
                n.update(terms)
                d.update(set(terms))
                held += len(n)
                if held > ENTRIES:
                    yield from rows()
                    held = 0
        yield from rows()

    parts = base.mapInArrow(run, "lang string, source string, term binary, n long, docs long") \
        .withColumn("term", F.col("term").cast("string"))
    # dealt by term: the counts by source and those of the language need no further exchange
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """One row for each kept term of a language: its count and its counts by source."""
    return counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("by_source")).filter(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", scaled, (total + terms).cast("decimal(19,0)"))


def excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def totals(docs: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per language v and lang_total; per occurring source its total, v and the share of a term it lacks."""
    every = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in GROUP)).distinct()
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    sums = kept.select("lang", F.explode("by_source").alias("s")).groupBy("lang", F.col("s.source").alias("source")) \
        .agg(F.sum("s.n").alias("total"))
    sources = every.join(sums, GROUP, "left").join(langs.select("lang", "v"), "lang", "left").fillna(0, ["total", "v"])
    return langs, sources.withColumn("empty", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))))


# skyband

def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate; ``term`` holds UTF-8 bytes, all different.

    In the order of count down, language count up, term up, a row is dominated by
    earlier rows only; a dominating row that was left out has ``k`` dominating
    rows of its own, which dominate here too, so comparing with kept rows is enough.
    """
    rank = np.empty(len(term), np.int64)
    rank[np.argsort(term)] = np.arange(len(term))
    order = np.lexsort((rank, lang_n, -n))
    low, word = lang_n[order], rank[order]
    # a grid of counts of kept rows: those of lower cells in both directions are dominators, mostly enough of them
    values = np.unique(low)
    bounds = np.concatenate([values[:GRID], values[GRID::max(1, len(values) // GRID)]])
    cell_low = np.searchsorted(bounds, low, "right")
    below = np.where(cell_low < GRID, cell_low, cell_low - 1)  # a cell of one value counts as well
    cell_word = word * GRID // max(1, len(word)) + 1
    grid = np.zeros((int(cell_low.max(initial=0)) + 1, GRID + 1), np.int64)
    kept = np.zeros(len(order), bool)
    have_low, have_word = low[:0], word[:0]
    for at in range(0, len(order), STEP):
        beaten = grid.cumsum(0).cumsum(1)[below[at:at + STEP], cell_word[at:at + STEP] - 1]
        open_ = at + np.flatnonzero(beaten < k)
        l, w = low[open_], word[open_]
        beaten = np.zeros(len(l), np.int64)
        for lo in range(0, len(have_low), 4096):
            beaten += ((have_low[lo:lo + 4096, None] <= l) & (have_word[lo:lo + 4096, None] <= w)).sum(0)
        maybe = beaten < k
        open_, l, w = open_[maybe], l[maybe], w[maybe]
        inside = np.triu((l[:, None] <= l) & (w[:, None] <= w), 1).sum(0)
        good = beaten[maybe] + inside < k
        kept[open_[good]] = True
        np.add.at(grid, (cell_low[open_[good]], cell_word[open_[good]]), 1)
        have_low, have_word = np.concatenate([have_low, l[good]]), np.concatenate([have_word, w[good]])
    return order[kept]


def skybands(points: DataFrame, k: int) -> DataFrame:
    """The skyband of each source within each partition."""
    fields = ["term", "n", "lang_n"]

    def reduce(blocks):
        data = [np.concatenate([b[i] for b in blocks]) for i in range(3)]
        keep = skyband(data[1], data[2], data[0], k)
        return [tuple(d[keep] for d in data)]

    def run(batches):
        held: dict[tuple, list] = {}
        limit: dict[tuple, int] = {}
        for batch in batches:
            data = [np.array(batch.column("term").to_pylist(), object),
                    *(batch.column(c).to_numpy(zero_copy_only=False) for c in fields[1:])]
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())):
                places.setdefault(key, []).append(i)
            for key, at in places.items():
                blocks = held.setdefault(key, [])
                blocks.append(tuple(d[at] for d in data))
                if sum(len(b[0]) for b in blocks) > limit.get(key, BUFFER):
                    held[key] = reduce(blocks)
                    limit[key] = len(held[key][0][0]) + BUFFER
        for (lang, source), blocks in held.items():
            term, n, lang_n = reduce(blocks)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(term), pa.binary()),
                 pa.array(n, pa.int64()), pa.array(lang_n, pa.int64())], names=[*GROUP, *fields])

    return points.mapInArrow(run, "lang string, source string, term binary, n long, lang_n long")


def distinctive(kept: DataFrame, langs: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    """Part ``term``: the first ``top`` terms of each source that it has more of than its language."""
    points = kept.select("lang", "term", "lang_n", F.explode("by_source").alias("s")) \
        .select("lang", F.col("s.source").alias("source"), F.col("term").cast("binary").alias("term"), F.col("s.n").alias("n"), "lang_n")
    bands = skybands(points.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(PARTS))), top)
    bands = skybands(bands.repartition("lang", "source"), top)
    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    rated = bands.join(sources.drop("v"), GROUP).join(langs, "lang").select(*GROUP, F.col("term").cast("string").alias("item"),
                                                                       p.alias("p"), q.alias("q"))
    rated = rated.filter("p > q").select(*GROUP, "item", excess(F.col("p"), F.col("q")).alias("value"))
    return ranked(rated).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))


def ranked(rows: DataFrame) -> DataFrame:
    window = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(window))


# pairs

def shared_corrections(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """For terms that two sources both have: what their sum differs by from what :func:`divergences` adds for each."""
    shares = kept.select("lang", "term", F.explode("by_source").alias("s")).select("lang", "term", F.col("s.source").alias("source"),
                                                                                F.col("s.n").alias("n"))
    shares = shares.join(sources, GROUP).groupBy("lang", "term").agg(F.collect_list(F.struct(
        "source", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "empty")).alias("by_source"))

    def run(batches):
        def f(x, y):
            return (x - y) * (x - y) // y

        def add(lang, lists):
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            names = flat.field("source").dictionary_encode()
            code, words = names.indices.to_numpy(zero_copy_only=False).astype(np.int64), names.dictionary
            p, empty = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("p", "empty"))
            each, start = np.repeat(size, size), np.repeat(np.cumsum(size) - size, size)
            # each entry meets the entries of its term, in rounds of bounded size
            turn = (np.cumsum(each) - each) // PAIR_ROWS
            for at in np.split(np.arange(len(p)), np.flatnonzero(np.diff(turn)) + 1):
                m = each[at]
                left = np.repeat(at, m)
                right = np.repeat(start[at] - (np.cumsum(m) - m), m) + np.arange(len(left))
                pl, pr, el, er = p[left], p[right], empty[left], empty[right]
                value = f(pl, pr) - f(pl, er) - f(el, pr) + f(el, er)
                key = code[left] * len(words) + code[right]
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.diff(key[order], prepend=-1))
                sums, key = np.add.reduceat(value[order], first), key[order][first]
                a, b = key // len(words), key % len(words)
                use = a != b
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * int(use.sum()), pa.string()), words.take(pa.array(a[use])), words.take(pa.array(b[use])),
                     pa.array(sums[use], pa.int64())], names=["lang", "source", "item", "value"])

        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            at = langs.indices.to_numpy(zero_copy_only=False)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                lists = batch.column("by_source").take(pa.array(np.flatnonzero(at == i)))
                if len(lists):
                    yield from add(lang, lists)

    return shares.mapInArrow(run, "lang string, source string, item string, value long")


def divergences(kept: DataFrame, sources: DataFrame) -> DataFrame:
    """Part ``pair``: every other source of the language, with f summed over all kept terms."""
    shares = kept.select("lang", F.explode("by_source").alias("s")).groupBy("lang", F.col("s.source").alias("source"), F.col("s.n").alias("n")) \
        .agg(F.count(F.lit(1)).alias("terms")).join(sources, GROUP) \
        .select(*GROUP, share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "terms")
    histogram = shares.groupBy(*GROUP).agg(F.collect_list(F.struct("p", "terms")).alias("hist"))
    full = sources.join(histogram, GROUP, "left")
    left = full.select("lang", "source", "v", F.col("empty").alias("e"), F.col("hist").alias("h"))
    right = full.select("lang", F.col("source").alias("item"), F.col("empty").alias("item_e"), F.col("hist").alias("item_h"))
    zero = F.lit(0).cast("long")

    def over(hist, f):
        return F.coalesce(F.aggregate(hist, zero, lambda acc, x: acc + x["terms"] * f(x["p"])), zero)

    both_lack = excess(F.col("e"), F.col("item_e"))
    base = F.col("v") * both_lack + over(F.col("h"), lambda p: excess(p, F.col("item_e")) - both_lack) \
        + over(F.col("item_h"), lambda q: excess(F.col("e"), q) - both_lack)
    pairs = left.join(right, "lang").filter(F.col("source") != F.col("item")) \
        .select(*GROUP, "item", F.when(F.col("v") > 0, base).otherwise(zero).alias("value"))
    # no source of a pair is large here: at most one row each from the base and from every task
    sums = pairs.unionByName(shared_corrections(kept, sources)).groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))
    return ranked(sums).withColumn("part", F.lit("pair"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of every occurring source."""
    kept = stage(kept_terms(count_terms(docs), min_docs), "kept-terms")
    langs, sources = totals(docs, kept)
    sources = stage(sources, "sources")
    out = divergences(kept, sources).unionByName(distinctive(kept, langs, sources, top))
    return out.select("lang", "source", "part", "item", "value", "rank")
