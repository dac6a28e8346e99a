"""Line dedup by pairwise alignment.

Documents that share a line are paired, aligned with a patience diff of their
line hashes, and the aligned common blocks are deleted from the later
document (the larger doc_id).

* A line counts when it holds a word; lines are equal when equal after
  trimming [\\x20\\x09-\\x0D].
* Pairs.  A unit is a shortest run of lines, from its first or to its last
  one, with ``min_words`` words; every line of a common block lies in a common
  unit.  A rare unit (in at most ``rare`` documents) pairs every two of its
  documents.  A more frequent one pairs each document with its earliest holder,
  and documents in which a line of it survives with the next 2, 4, ... holders,
  until every holder is tried: the result is that of all pairs.
* Blocks.  Consecutive aligned lines form a block; blank lines between them
  belong to it.  A block of fewer than ``min_words`` words stays.
* The earliest document that holds a block always keeps it.

Rows equal in doc_id and text count as one document, and get the same result.
A null doc_id sorts last; null, empty and blank texts have no lines, pair with
nothing and stay as they are.  Other columns pass through unchanged.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import SPACES, attach, keyed, stage

RARE = 4
MIN_WORDS = 4
# cells of a diff table held at once, in bits
CELLS = 1 << 26


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned index pairs of two lists: equal ends, then lines unique in both
    ranges (longest increasing run), then the same between those anchors; a
    range without such lines gets a longest common subsequence."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al >= ah or bl >= bh:
            continue
        once_a, once_b = _once(a, al, ah), _once(b, bl, bh)
        both = [(i, once_b[x]) for x, i in once_a.items() if i >= 0 and once_b.get(x, -1) >= 0]
        both.sort()
        anchors = _increasing(both)
        if not anchors:
            out += [(al + i, bl + j) for i, j in longest_common(a[al:ah], b[bl:bh])]
            continue
        pa_, pb = al, bl
        for i, j in anchors:
            todo.append((pa_, i, pb, j))
            out.append((i, j))
            pa_, pb = i + 1, j + 1
        todo.append((pa_, ah, pb, bh))
    out.sort()
    return out


def _rows(a: list[int], b: list[int]):
    """For each prefix of ``a`` a number whose bit j is 0 where b[:j + 1] has a longer common subsequence than b[:j]."""
    full, places = (1 << len(b)) - 1, {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Longest common subsequence of ``a`` with every prefix of ``b``."""
    *_, row = _rows(a, b)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def longest_common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence; large tables are halved, so memory stays bounded."""
    both = set(a) & set(b)
    at_a, at_b = ([i for i, x in enumerate(y) if x in both] for y in (a, b))
    a, b = [a[i] for i in at_a], [b[j] for j in at_b]
    if not both:
        return []
    if len(a) > 1 and len(a) * len(b) > CELLS:
        mid = len(a) // 2
        cut = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        out = longest_common(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in longest_common(a[mid:], b[cut:])]
    else:
        rows, out = list(_rows(a, b)), []
        i, j = len(a), len(b)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    out.append((i, j))
        out.reverse()
    return [(at_a[i], at_b[j]) for i, j in out]


def _once(x: list[int], lo: int, hi: int) -> dict[int, int]:
    """Value -> its index, or -1 where it repeats in the range."""
    seen: dict[int, int] = {}
    for i in range(lo, hi):
        seen[x[i]] = -1 if x[i] in seen else i
    return seen


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs whose second parts increase (first parts already do)."""
    tops, ends, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j), ends.append(k)
        else:
            tops[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[int]:
    """Indexes in ``b`` of aligned blocks of at least ``min_words`` words."""
    out, run, weight, last = [], [], 0, None
    for i, j in patience(a, b) + [(-9, -9)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if weight >= min_words:
                out += run
            run, weight = [], 0
        if j >= 0:
            run.append(j)
            weight += words[j]
            last = (i, j)
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """(did, th, at, hash, words): per document the positions, hashes and word counts of lines with a word."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(
        i.alias("at"), F.regexp_replace(x, rf"^{SPACES}|{SPACES}$", "").alias("line")))
    kept = docs.select("did", "th", F.filter(lines, lambda x: x["line"] != "").alias("ls")).filter(F.size("ls") > 0)
    return kept.select(
        "did", "th", F.transform("ls", lambda x: x["at"]).alias("at"),
        F.transform("ls", lambda x: F.xxhash64(x["line"])).alias("hash"),
        F.transform("ls", lambda x: F.size(F.split(x["line"], SPACES))).alias("words")).dropDuplicates(["did", "th"])


def unit_runs(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """(start, end) of the shortest runs with ``min_words`` words from each line on, and up to each line."""
    need, n, out = max(1, min_words), len(words), set()
    end = total = 0
    for s in range(n):
        while end < n and total < need:
            total += words[end]
            end += 1
        if total < need:
            break
        out.add((s, end))
        total -= words[s]
    s = total = 0
    for e in range(n):
        total += words[e]
        while total - words[s] >= need:
            total -= words[s]
            s += 1
        if total >= need:
            out.add((s, e + 1))
    return out


def _units(lines: DataFrame, min_words: int) -> DataFrame:
    """(h, d): the units of each of ``lines`` of which a line is not in ``gone``."""
    def run(batches):
        for batch in batches:
            found = []
            for at, hashes, words, gone in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5))):
                lost = set(gone or ())
                found.append(list({
                    hashes[s] if e == s + 1 else xxhash.xxh3_64_intdigest(np.array(hashes[s:e], np.int64).tobytes()) - (1 << 63)
                    for s, e in unit_runs(words, min_words) if not lost or any(x not in lost for x in at[s:e])}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                                             ["did", "th", "hs"])
    got = lines.select("did", "th", "at", "hash", "words", "gone").mapInArrow(run, "did long, th long, hs array<long>")
    return got.select(F.explode("hs").alias("h"), F.struct("did", "th").alias("d"))


def _align(pairs: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """(did, th, gone): the line positions of aligned blocks in ``b`` of each pair (a, b)."""
    key = F.struct("did", "th")
    left = lines.select(key.alias("a"), F.col("hash").alias("ah"))
    right = lines.select(key.alias("b"), F.col("hash").alias("bh"), "at", "words")
    both = pairs.join(right, "b").join(left, "a").select("b", "ah", "bh", "at", "words")

    def align(batches):
        for batch in batches:
            keep, gone = [], []
            for i, (ah, bh, at, words) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                if hit := common_blocks(ah, bh, words, min_words):
                    keep.append(i)
                    gone.append([at[x] for x in hit])
            b = batch.column(0).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.field("did"), b.field("th"), pa.array(gone, pa.list_(pa.int32()))],
                                             ["did", "th", "gone"])
    return both.mapInArrow(align, "did long, th long, gone array<int>")


def _merged(gone: DataFrame) -> DataFrame:
    return gone.groupBy("did", "th").agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("gone"))


def deleted_lines(docs: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """(did, th, gone): for each later document the line positions to delete."""
    lines = stage(_lines(keyed(docs.select("doc_id", "text"))), "lines")
    held = _units(lines.withColumn("gone", F.lit(None).cast("array<int>")), min_words)
    per = held.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("d").alias("first")).filter("df > 1")
    held = stage(held.join(per, "h"), "units")
    few, many = held.filter(F.col("df") <= rare), held.filter(F.col("df") > rare)
    pairs = held.filter("d > first").select(F.col("first").alias("a"), F.col("d").alias("b")).union(
        few.select("h", F.col("d").alias("a")).join(few.select("h", F.col("d").alias("b")), "h")
        .filter("a < b").select("a", "b")).distinct()
    gone = stage(_merged(_align(pairs, lines, min_words)), "gone")
    # the earliest holder is tried; now the holders of rank low to high, for the documents where a frequent unit survives
    low, high, left = 2, 3, many.filter("d > first").select("h", "d")
    while True:
        some = lines.join(left.select("d.did", "d.th").distinct(), ["did", "th"], "left_semi").join(gone, ["did", "th"], "left")
        left = stage(left.join(_units(some, min_words), ["h", "d"], "left_semi"), "left")
        tried = many.select("h", F.col("d").alias("a")).join(left.select("h").distinct(), "h", "left_semi") \
            .withColumn("nth", F.row_number().over(Window.partitionBy("h").orderBy("a"))) \
            .filter(F.col("nth") <= high).filter(F.col("nth") >= low).select("h", "a")
        pairs = stage(left.join(tried, "h").filter("a < d").select("a", F.col("d").alias("b")).distinct(), "pairs")
        if pairs.isEmpty():
            return gone
        gone = stage(_merged(gone.union(_align(pairs, lines, min_words))), "gone")
        low, high = high + 1, 2 * high + 1


def line_dedup(docs: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated blocks deleted from ``text``, plus n_lines and n_removed (long)."""
    gone = deleted_lines(docs, rare, min_words)
    joined, cols, _ = attach(docs, gone)
    joined = joined.withColumn("text", F.col("in_text"))
    lines = F.split("text", "\n", -1)
    # whole text where nothing goes: most rows need no splitting
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(
        F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n"))
    out = [text.alias(c) if c == "text" else col for c, col in zip(docs.columns, cols)]
    extra = [c for c in ("n_lines", "n_removed") if c not in docs.columns]
    counts = {"n_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
              "n_removed": F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")}
    return joined.select(*out, *[counts[c].alias(c) for c in extra])
