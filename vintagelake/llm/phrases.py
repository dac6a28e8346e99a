"""Phrases of 2 to ``WORDS`` words that occur more often than their parts would have it.

Weighted de Bruijn graph per language.  Nodes are phrases of one word less than
the longest, edges the longest grams between overlapping nodes:

* every word position gives one edge, the longest gram that starts there; at a
  piece's end, where fewer words are left, that is the piece-end correction of
  the shorter grams.  Edges are counted within a task before they are shuffled.
* a word pair seen fewer than ``MIN_COUNT`` times breaks the walk as a piece end
  does: no phrase with it can be frequent, and every occurrence of a phrase
  without it is still seen whole, so counts stay exact.  Frequent pairs are
  found first, by 34-bit or longer cells of a hash; two pairs in one cell only
  keep a walk whole that might have been broken.
* the count of a shorter gram is the flow through its node: all edges that leave
  it plus its corrections.  Edges are put in order, so the edges of a node stand
  together, a partition adds up the flows of all orders in one pass with no
  memory but the open nodes, and only nodes open at a partition's ends are summed
  across partitions.  A node with many edges lies in several partitions.
* unary paths are compacted: a phrase all of whose flow passes on to one longer
  phrase, or comes from one, is dropped.

Each phrase left is cut in two at its worst place and scored by
``floor(1000 * a * n / (l * r))``, in decimals of 38 digits (exact while ``1000 a``
and ``n`` stay below 10^18).

Null text has no words, null lang is ``und``; empty texts and tables give no
rows; repeated rows count each; columns besides text and lang do not matter.
Texts are walked in slices cut between pieces, so a long text does not grow a
task's memory, except one very long piece.  Ties go to the first cut, and in the
ranking to the phrase first in UTF-8.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import compress
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import stage

WORDS, MIN_COUNT, TOP, FACTOR = 5, 100, 2000, 1000
SLICE = 1 << 21         # bytes of text walked together
PAIRS = 2_000_000       # pair cells of a task sorted together
EDGES = 300_000         # distinct edges of a task before they are handed on
HASHED = 300_000        # words whose hash a task remembers
MIN_BLOCKS, OFFSET_BITS = 1024, 24
MAX_BITS = 27           # the bitmap of frequent pairs has at most 2^27 bits (16 MB)
SALTS = 64

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_END = b"\x01"          # stands between pieces; escaped where a word holds it
_SPLIT = bytes.maketrans(b"\t.,;:!?\n\v\f\r", b" " + _END * 10)
# control characters sort before the space between words: escaped, so that a node's edges stand together
_CONTROL = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]")
_ESCAPED = re.compile(rb"\x7f(.)")


def plain(gram: bytes) -> bytes:
    return _ESCAPED.sub(lambda m: m[1] if m[1] == b"\x7f" else bytes([m[1][0] - 64]), gram) if b"\x7f" in gram else gram


def slices(text: bytes) -> Iterator[bytes]:
    """The text in lower case, with a mark after each piece, in slices cut between pieces."""
    at = 0
    text = text.lower()
    if _CONTROL.search(text):
        text = _CONTROL.sub(lambda m: b"\x7f" + bytes([m[0][0] | 64]), text)
    text = text.translate(_SPLIT) + _END
    while at < len(text):
        end = text.find(_END, min(at + SLICE, len(text)) - 1) + 1
        yield text[at:end].replace(_END, b" \x01 ")
        at = end


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= HASHED:
            self.clear()
            self[_END] = 0
        h = self[word] = xxhash.xxh3_64_intdigest(word) | 1
        return h


class Walker:
    """Words and hashes of pairs of neighbours, for the slices of all texts of a task."""

    def __init__(self, blocks: int):
        self.hashes = _Hashes({_END: 0})
        self.shift = np.uint64(64 - OFFSET_BITS - (blocks.bit_length() - 1))

    def walk(self, batches) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
        """lang, words (with marks), cells of the pairs that start at each word but the last, whether it is a pair."""
        waiting: dict[str, list[bytes]] = {}
        size: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for part in slices(text):
                    waiting.setdefault(lang, []).append(part)
                    size[lang] += len(part)
                    if size[lang] >= SLICE:
                        yield self.pairs(lang, waiting.pop(lang))
                        size[lang] = 0
        for lang, parts in waiting.items():
            yield self.pairs(lang, parts)

    def pairs(self, lang, parts):
        words = b"".join(parts).split()
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        key = (h[:-1] * _A + h[1:] + np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))) * _B
        key ^= key >> np.uint64(31)
        key *= _C
        return lang, words, key >> self.shift, (h[:-1] != 0) & (h[1:] != 0)


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def bitmap_place(cell: np.ndarray) -> np.ndarray:
    return (cell * _A) >> np.uint64(64 - MAX_BITS)


def frequent_pairs(docs: DataFrame, blocks: int, min_count: int) -> DataFrame:
    """Places (of 2^MAX_BITS) of the pairs seen at least ``min_count`` times, and perhaps of a few more."""
    need = min(min_count, 255)  # counts are kept in a byte

    def run(batches):
        held, size = [], 0
        for _, _, cells, real in Walker(blocks).walk(batches):
            held.append(cells[real])
            size += len(held[-1])
            if size >= PAIRS:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    def rows(held):
        cells, n = np.unique(np.concatenate(held), return_counts=True)
        block = (cells >> np.uint64(OFFSET_BITS)).astype(np.int32)
        data = ((cells << np.uint64(8)).astype(np.uint32) | np.minimum(n, 255).astype(np.uint32)).tobytes()
        start = np.flatnonzero(np.diff(block, prepend=-1))
        ends = np.append(start[1:], len(block))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[start]), pa.array([data[4 * a:4 * b] for a, b in zip(start, ends)], pa.binary())], names=["block", "cells"])

    def add_up(key, table):
        block = key[0].as_py()
        found = np.frombuffer(b"".join(x.as_py() for x in table.column("cells")), np.uint32)
        offset, at = np.unique(found >> np.uint32(8), return_inverse=True)
        often = offset[np.bincount(at, found & np.uint32(255)) >= need].astype(np.uint64)
        place = bitmap_place((np.uint64(block) << np.uint64(OFFSET_BITS)) | often)
        return pa.table({"place": pa.array(place.astype(np.int32))})

    counted = texts(docs).mapInArrow(run, "block int, cells binary")
    return counted.groupBy("block").applyInArrow(add_up, "place int")


def bitmap(places: DataFrame) -> tuple[bytes, int]:
    """Bits set for the places, and how many low bits of a place are left out; 16 MB at most."""
    n = places.count()
    bits = min(MAX_BITS, max(15, (16 * n).bit_length()))
    cut = MAX_BITS - bits
    place = F.shiftright("place", cut).cast("long") + 1
    rows = places.groupBy(F.bitmap_bucket_number(place).alias("part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = bytearray(1 << (bits - 3))
    for r in rows:
        out[(r["part"] - 1) * 4096:r["part"] * 4096] = r["bits"]
    return bytes(out), cut


def edges(docs: DataFrame, blocks: int, bits: bytes, cut: int, words_max: int) -> DataFrame:
    """lang, gram (words joined by a space, control characters escaped) and its count n."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # at most 16 MB

    def run(batches):
        often = np.frombuffer(shared.value, np.uint8)
        found: dict[str, Counter] = {}
        for lang, words, cells, real in Walker(blocks).walk(batches):
            place = bitmap_place(cells) >> np.uint64(cut)
            goes_on = real & ((often[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            goes_on = np.append(goes_on, False)
            length, more = np.ones(len(goes_on), np.int64), goes_on
            for step in range(1, words_max):
                length += more
                more = more & np.append(goes_on[step:], np.zeros(min(step, len(goes_on)), bool))[:len(goes_on)]
            counts = found.setdefault(lang, Counter())
            counts.update(compress(words, (length == 1).tolist()))
            at = np.flatnonzero(length > 1)
            counts.update([b" ".join(words[i:j]) for i, j in zip(at.tolist(), (at + length[at]).tolist())])
            counts.pop(_END, None)
            if sum(map(len, found.values())) > EDGES:
                yield from rows(found)
                found = {}
        yield from rows(found)

    def rows(found):
        for lang, n in found.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(list(n), pa.binary()),
                                                  pa.array(list(n.values()), pa.int64())], names=["lang", "gram", "n"])

    return texts(docs).mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def flows(counted: DataFrame, min_count: int) -> DataFrame:
    """lang, phrase, k (words) and a: counts of at least ``min_count``, for grams of every order."""
    def run(batches):
        lang, nodes, sums, kept = None, [], [], []  # open nodes; those of the first row are kept whatever their count
        first, out = True, []

        def close(depth):
            while len(nodes) > depth:
                if sums[-1] >= min_count or kept[-1]:
                    out.append((lang, plain(b" ".join(nodes)), len(nodes), sums[-1]))
                nodes.pop(), sums.pop(), kept.pop()

        def rows():
            cols = list(zip(*out)) or [[], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.int32(), pa.int64()))],
                                              names=["lang", "phrase", "k", "n"])

        for batch in batches:
            for at, gram, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "gram", "n"))):
                words = gram.split(b" ")
                same = 0
                if at == lang:
                    for x, y in zip(nodes, words):
                        if x != y:
                            break
                        same += 1
                close(same)
                lang = at
                for w in words[same:]:
                    nodes.append(w)
                    sums.append(0)
                    kept.append(first)
                first = False
                for i in range(len(words)):
                    sums[i] += n
            yield rows()
        kept[:] = [True] * len(kept)
        close(0)
        yield rows()

    ordered = counted.repartitionByRange("lang", "gram").sortWithinPartitions("lang", "gram")
    found = ordered.mapInArrow(run, "lang string, phrase binary, k int, n long")
    return found.groupBy("lang", F.col("phrase").cast("string").alias("phrase"), "k").agg(F.sum("n").alias("a")) \
        .filter(F.col("a") >= min_count)


def compacted(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more, without those all of whose flow a longer one has."""
    words = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "),
                    F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " "))
    longer = phrases.filter("k > 2").select("lang", F.explode(inner).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    # a longer phrase with the same count holds one of one word more with it, so neighbours are enough
    return phrases.filter("k > 1").join(longer, ["lang", "phrase"], "left") \
        .filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")


def scored(kept: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with l, r and score of its lowest cut."""
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at"), words.alias("w")) \
        .select("lang", "phrase", "a", "at", F.array_join(F.slice("w", F.lit(1), F.col("at")), " ").alias("left"),
                F.array_join(F.slice("w", F.col("at") + 1, F.col("k") - F.col("at")), " ").alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    big = "decimal(18,0)"
    score = F.call_function("div", (F.col("a") * FACTOR).cast(big) * F.col("n").cast(big), F.col("l").cast(big) * F.col("r").cast(big))
    rated = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang") \
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("cut"))
    return rated.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, words_max: int = WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    parts = docs.rdd.getNumPartitions()
    blocks = 1 << (max(MIN_BLOCKS, parts) - 1).bit_length()
    bits, cut = bitmap(stage(frequent_pairs(docs, blocks, min_count), "frequent-pairs"))
    counted = stage(edges(docs, blocks, bits, cut, words_max), "edges")
    phrases = stage(flows(counted, min_count), "phrases")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    rated = scored(compacted(phrases), phrases, totals)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # no language's phrases all go to one task: the first of each part are enough
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    rated = rated.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("rank") <= top)
    rated = rated.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return rated.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
