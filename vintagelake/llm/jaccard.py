"""N-gram Jaccard join: size-aware heavy-light set join (exact).

Every document is the set of its distinct ``k``-word shingles.  Two sets link
when ``100 * |A & B| >= percent * |A | B|``; the result is one row per
document with its set size and its connected component.

* Order.  All shingles are ordered by (corpus count in steps of the sketch's
  own noise, hash); the counts come from a fixed-size sketch over every
  document.  Any common order keeps the prefix bounds below exact; this one
  moves passages that many documents share out of the prefixes, also where the
  corpus fills the sketch.
* Light sets (fewer than ``x`` shingles) enumerate all 2-subsets of their
  prefix: linked sets share at least one.
* Heavy sets scan the inverted lists of the shingles in their prefix.
* ``x`` minimises the estimated rows of both paths, from the sizes of all sets
  and the sketch's list lengths.  Sets near ``x`` are also listed.
* A list of a few rows gives all its pairs; every longer one is compared with
  its smallest member only (a star, not all pairs).
  A cluster, the members around one such pivot, that verification did not
  unite is then compared across its components, in blocks of bounded bytes
  that find links without emitting pairs.  Thus no link between different
  texts is lost, while a group of copies costs about its size.

Identical sets share a set id (a 64-bit digest), so copies never form pairs.
A null, empty or blank text has the empty set: ``n_shingles`` 0, linked with
nothing.  Repeated rows stay repeated rows.  A null doc_id never becomes a
component id unless the whole component has none.  Other input columns are
ignored.  Reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm import sketch
from vintagelake.llm.common import attach, batch_rows, stage

MIN_BITS, MAX_BITS = 20, 24
TOKEN_BYTES = 5
MAX_LIGHT = 64
HOT_LIST = 65536
FEW = 4
LONGER = 10
LIGHT, LISTED, BEYOND = 0, 1, 2
BLOCK_BYTES = 16 << 20
FILTER_BUCKETS = 1 << 20

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 18
BATCH_ROWS = 1000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """64-bit hashes of the words of UTF-8 text, many texts at once.

    A word's hash is a polynomial over random numbers of its A-Z lower-cased
    bytes; words are split at the bytes 0x20 and 0x09-0x0D.
    """

    def __init__(self):
        table = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        table[65:91] = table[97:123]
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self.table, self.space = table, space
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = np.full(SEGMENT, _BASE, np.uint64)
        self.down = np.full(SEGMENT, inverse, np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def words(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first byte) of each word; no word spans a position of ``cuts``."""
        raw, lo = self.sums(data, cuts)
        return _mix(raw), lo

    def sums(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with the value of the polynomial, from a word's first byte, for its hash."""
        full = ~self.space[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(full[1:], full[:-1], out=edge[1:-1])
        edge[cuts] = True
        at = np.flatnonzero(edge)
        lo, hi = at[:-1], at[1:]
        word = full[lo]
        lo, hi = lo[word], hi[word]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=total[1:])
        return (total[hi] - total[lo]) * self.down[lo], lo


def batch_words(column: pa.Array, hasher: Hasher):
    """Yield (row numbers, number of words of each, word hashes) for the texts of an Arrow column.

    Short texts go together, long ones in segments cut at a space.  A word of
    more than SEGMENT bytes is summed over its segments.
    """
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SEGMENT, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[last])
        if hi - lo <= SEGMENT or last > row + 1:
            h, at = hasher.words(data[lo:hi], offsets[row:last] - lo)
            n = np.diff(np.searchsorted(at, offsets[row:last + 1] - lo))
        else:
            parts, held, size = [], None, 0
            while lo < hi:
                end, inside = min(hi, lo + SEGMENT), False
                if end < hi:
                    gaps = np.flatnonzero(hasher.space[data[lo:end]])
                    inside = not len(gaps)
                    end = end if inside else lo + int(gaps[-1]) + 1
                raw, at = hasher.sums(data[lo:end], np.zeros(1, np.int64))
                if held is not None:  # the word that the last segment ended in
                    if len(raw) and at[0] == 0:
                        raw[:1] = held + raw[:1] * np.uint64(pow(_BASE, size, 1 << 64))
                    else:
                        raw = np.concatenate([held, raw])
                held, size = (raw, size + end - lo) if inside else (None, 0)
                if not inside:
                    parts.append(_mix(raw))
                lo = end
            h = np.concatenate(parts)
            n = np.array([len(h)])
        yield np.arange(row, last), n, h
        row = last


def batch_shingles(column: pa.Array, k: int, hasher: Hasher):
    """Yield (row numbers, number of shingles of each, shingle hashes), repeats included.

    A text of 1 to k - 1 words has one shingle, the whole sequence.
    """
    for rows, n, h in batch_words(column, hasher):
        end = np.cumsum(n)
        start, out = end - n, np.empty(0, np.uint64)
        if len(h) >= k:
            out = np.full(len(h) - k + 1, k, np.uint64)
            for j in range(k):
                out = (out ^ (h[j:j + len(out)] * _MULT[j % 8])) * _MULT[(j + 3) % 8]
                out ^= out >> np.uint64(29)
            out = _mix(out)
        made = np.maximum(n - k + 1, 0)
        short = np.flatnonzero((n > 0) & (n < k))
        owner = np.repeat(np.arange(len(n)), n)[:len(out)]
        keep = np.arange(len(out)) < (start + made)[owner]
        out = out[keep]
        if len(short):
            whole = np.empty(len(short), np.uint64)
            for i, r in enumerate(short):
                v = n[r:r + 1].astype(np.uint64)
                for j in range(int(n[r])):
                    v = (v ^ (h[start[r] + j:start[r] + j + 1] * _MULT[j % 8])) * _MULT[(j + 3) % 8]
                    v ^= v >> np.uint64(29)
                whole[i] = _mix(v)[0]
            out = np.insert(out, np.cumsum(made)[short], whole)
            made[short] = 1
        yield rows, made, out


def _needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set it links to."""
    return -(-percent * n // 100)


def _size(n: int, percent: int, x: int) -> tuple[int, int]:
    """Prefix lengths (scanned, enumerated) of a set of ``n``; 0: not used."""
    o = _needed(n, percent)
    scanned = n - o + 1 if 100 * n >= percent * x else 0
    light = n - o + 2 if n < x and o >= 2 else 0
    return scanned, light


def _shared(n: int, percent: int) -> int:
    """How many tokens linked sets share at least, where the prefixes of both are longer by one less than this.

    ``n`` is the size of the smaller one; the number never falls as sizes grow.
    """
    o = _needed(n, percent)
    return min(o, 1 + (n - o + 1) // LONGER)


def boundary(sizes: dict[int, tuple[int, float]], percent: int) -> int:
    """The size from which sets scan lists: the cheapest of 1..MAX_LIGHT.

    ``sizes[n]``: how many sets have n shingles, and the sketch's estimate of
    the other rows in the lists of their prefix shingles.  Enumerating costs a
    row for each 2-subset of the prefix; scanning costs a row for each prefix
    shingle and the other rows of its list.
    """
    def cost(x):
        total = 0.0
        for n, (count, others) in sizes.items():
            scanned, light = _size(n, percent, x)
            total += count * (scanned + light * (light - 1) / 2) + (others if scanned else 0)
        return total
    return min(range(1, MAX_LIGHT + 1), key=lambda x: (cost(x), x))


def sketch_bits(rows: int) -> int:
    """Log size of the sketch: a few shingles per bucket, within fixed bounds."""
    return min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(rows * 64 + 1))))


def _order(docs: DataFrame, k: int, bits: int) -> tuple[np.ndarray, float]:
    """Order code of each sketch bucket (the level of its count), and the mean count."""
    def count(batches):
        hasher, counter = Hasher(), sketch.Counter(1 << bits)
        for b in batches:
            for _, _, h in batch_shingles(b.column(0), k, hasher):
                counter.add(h >> np.uint64(64 - bits))
        yield counter.batch()
    return sketch.codes(docs.select("text").mapInArrow(count, sketch.SCHEMA), 1 << bits)


def _unpack(blob: bytes) -> np.ndarray:
    raw = np.zeros((len(blob) // TOKEN_BYTES, 8), np.uint8)
    raw[:, :TOKEN_BYTES] = np.frombuffer(blob, np.uint8).reshape(-1, TOKEN_BYTES)
    return raw.view("<u8").ravel()


def shingle_sets(docs: DataFrame, code: np.ndarray, mean: float, k: int, percent: int, whole: bool = False) -> DataFrame:
    """(doc_id, th, n, sid, others, toks): hash of the text, the set's size, id, the estimated
    other rows in its prefix lists, and its shingles in order as 40-bit numbers: those that
    ``signatures`` may read, or all if ``whole``."""
    top = np.uint64(64 - (len(code).bit_length() - 1))
    other_rows = np.maximum(0, sketch.excess(np.arange(256), mean) - 4 * mean ** 0.5)

    def build(batches):
        hasher = Hasher()
        for b in batches:
            n, sid, toks, others = [], [], [], []
            for _, made, h in batch_shingles(b.column(1), k, hasher):
                order = code[h >> top].astype(np.uint64)
                keys, at = (order << np.uint64(56)) | (h >> np.uint64(8)), 0
                for m in made.tolist():
                    if not m:
                        n.append(0), sid.append(None), toks.append(None), others.append(0.0)
                        continue
                    own = np.unique(keys[at:at + m])
                    at += m
                    kept = len(own) if whole else len(own) - _needed(len(own), percent) + 1 + _shared(len(own), percent)
                    packed = ((own[:kept] >> np.uint64(16)) & np.uint64((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)
                    n.append(len(own))
                    sid.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
                    toks.append(np.ascontiguousarray(packed[:, :TOKEN_BYTES]).tobytes())
                    prefix = len(own) - _needed(len(own), percent) + 1
                    others.append(float(other_rows[own[:prefix] >> np.uint64(56)].sum()) if len(own) <= MAX_LIGHT else 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sid, pa.int64()),
                 pa.array(others, pa.float64()), pa.array(toks, pa.binary())], ["doc_id", "th", "n", "sid", "others", "toks"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")).mapInArrow(
        build, "doc_id long, th long, n long, sid long, others double, toks binary")


def signatures(sets: DataFrame, code: np.ndarray, mean: float, x: int, percent: int, hot_list: int) -> DataFrame:
    """(sig, sid, at): prefix shingles of heavy sets (LISTED), some more of them (BEYOND, see ``_linkable``), and
    2-subsets of light ones (LIGHT).  ``at`` is one number, as these are the most rows of the join: the set's size, the
    place in the prefix, the kind and whether the list is hot (see ``_FIELDS``)."""
    hot_code = sketch.level(np.array([hot_list]), mean)[0]
    shift = np.uint64(40 - (len(code).bit_length() - 1))

    def emit(batches):
        out, rows = [], 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["sig", "sid", "at"])
        for b in batches:
            for sid, n, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                scanned, light = _size(n, percent, x)
                longer = scanned + _shared(n, percent) - 1 if scanned else 0
                tok = _unpack(blob.as_buffer()[:TOKEN_BYTES * max(longer, light)])
                parts = []
                if scanned:
                    t, pos = tok[:longer], np.arange(longer)
                    parts.append((t.astype(np.int64), code[t >> shift] >= hot_code,
                                  pos << 3 | np.where(pos < scanned, LISTED, BEYOND) << 1))
                if light:
                    t = tok[:light]
                    i, j = np.triu_indices(len(t), 1)
                    pair = _mix(t[i] * _MULT[0] ^ _mix(t[j] * _MULT[1])) >> np.uint64(2)
                    hot = (code[t[i] >> shift] >= hot_code) & (code[t[j] >> shift] >= hot_code)
                    parts.append(((pair | np.uint64(1 << 61)).astype(np.int64), hot, LIGHT << 1))
                for sig, hot, place in parts:
                    out.append((sig, np.full(len(sig), sid, np.int64), n << 32 | place | hot))
                    rows += len(sig)
                if rows > 200_000:
                    yield flush()
                    out, rows = [], 0
        if out:
            yield flush()
    return sets.filter("n > 0").select("sid", "n", "toks").mapInArrow(
        emit, "sig long, sid long, at long")


_FIELDS = {"n": "shiftright(at, 32)", "pos": "shiftright(at, 3) & 536870911", "kind": "shiftright(at, 1) & 3", "hot": "at & 1 = 1"}


def _may_link(a: str, b: str, percent: int) -> Column:
    """False where the sizes or the places of the shared signature rule a link out."""
    size = lambda x: F.col(f"{x}.n")
    reach = F.least(size(a) - F.col(f"{a}.pos"), size(b) - F.col(f"{b}.pos"))
    return (100 * F.least(size(a), size(b)) >= percent * F.greatest(size(a), size(b))) \
        & (reach * (100 + percent) >= percent * (size(a) + size(b)))


def _linkable(shared: DataFrame, percent: int) -> DataFrame:
    """``shared`` (rows of lists with other rows) without the rows that no link needs.

    Linked sets share ``_shared`` tokens of their longer prefixes, so a set with
    fewer tokens in lists with other rows has no link to find in them.  It has
    only a passage or so in common with others, and the sketch did not show it.
    """
    needed = lambda n: F.expr(f"({percent} * {n} + 99) div 100")
    least = F.least(F.col("o"), 1 + F.expr(f"(least_n - o + 1) div {LONGER}"))
    listed = shared.filter(F.col("kind") != LIGHT)
    able = listed.groupBy("sid", "n").agg(F.count(F.lit(1)).alias("found")) \
        .withColumn("least_n", needed("n")).withColumn("o", needed("least_n")).filter(F.col("found") >= least).select("sid")
    return shared.filter(F.col("kind") == LIGHT).union(
        listed.filter(F.col("kind") == LISTED).join(able, "sid", "left_semi").select(*shared.columns))


def _candidates(sigs: DataFrame, percent: int, hot: bool = True) -> DataFrame:
    """(p, m, ok, far): pairs of set ids that share a signature.

    Lists of at most FEW rows give all their pairs.  In longer ones (``far``)
    every member is paired with the smallest set id only; ``ok`` is then false
    where a link is ruled out.  Lists that the sketch calls hot (none, unless
    ``hot``) are reduced map-side and joined back, so that the join can split
    them; the others are read in one window.
    """
    row = F.struct("sid", "n", "pos")
    by = Window.partitionBy("sig")
    is_hot = F.expr(_FIELDS["hot"])
    shared = sigs.filter(~is_hot) if hot else sigs
    shared = shared.withColumn("rows", F.count(F.lit(1)).over(by)).filter("rows > 1").drop("rows")
    if hot:
        shared = shared.union(sigs.filter(is_hot))
    shared = stage(shared, "shared").select("sig", "sid", *[F.expr(e).alias(c) for c, e in _FIELDS.items()])
    shared = _linkable(shared, percent)
    calm = shared.filter(~F.col("hot")).select("sig", row.alias("m")).withColumn("rows", F.count(F.lit(1)).over(by))
    calm = calm.filter("rows > 1")
    by_id = by.orderBy("m.sid")
    calm = calm.withColumns({"p": F.first("m").over(by_id), **{
        f"b{i}": F.lag("m", i).over(by_id) for i in range(1, FEW)}})
    # the pairs of a row: with its list's first member, or with the few before it
    first, few = F.array(F.col("p")), F.array(*[F.col(f"b{i}") for i in range(1, FEW)])
    far = F.col("rows") > FEW
    both = calm.select("m", far.alias("far"), F.explode(F.when(far, first).otherwise(few)).alias("p")).select("p", "m", "far")
    if hot:
        most = shared.filter("hot")
        most = most.join(most.groupBy("sig").agg(F.min(row).alias("p")), "sig").select("p", row.alias("m"))
        both = both.union(most.select("p", "m", F.lit(True)))
    both = both.filter("p.sid != m.sid")
    both = both.select(F.col("p.sid").alias("p"), F.col("m.sid").alias("m"), _may_link("p", "m", percent).alias("ok"), "far")
    return both.filter("ok or far").groupBy("p", "m").agg(F.max("ok").alias("ok"), F.max("far").alias("far"))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(pairs: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """The pairs (p, m) whose sets link."""
    blobs = _only(blobs, pairs.select(F.col("p").alias("sid")).union(pairs.select(F.col("m").alias("sid"))))
    left = pairs.join(blobs.select(F.col("sid").alias("m"), F.col("toks").alias("mt")), "m")
    both = left.join(blobs.select(F.col("sid").alias("p"), F.col("toks").alias("pt")), "p")

    def check(batches):
        for b in batches:
            keep, last, a = [], None, None
            for i, (p, pt, mt) in enumerate(zip(b.column(0).to_pylist(), b.column(2), b.column(3))):
                if p != last:
                    last, a = p, _unpack(pt.as_buffer())
                if _linked(a, _unpack(mt.as_buffer()), percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())),
                                              b.column(1).take(pa.array(keep, pa.int64()))], ["p", "m"])
    return both.select("p", "m", "pt", "mt").mapInArrow(check, "p long, m long")


def components(links: DataFrame) -> DataFrame:
    """(sid, comp): the smallest id of each node's component, by alternating stars.

    A round points every neighbour of a node to the smallest one (large star),
    then does so for the smaller neighbours (small star); it is an aggregate
    and a join on the node.  Rounds are staged until nothing changes.
    """
    def star(e, large):
        if large:
            nb = e.union(e.select("b", "a"))
        else:
            nb = e
        low = nb.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        j = nb.join(low, "a")
        if large:
            out = j.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
                j.select("a", F.col("low").alias("b")))
        return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = stage(links.select(F.greatest("p", "m").alias("a"), F.least("p", "m").alias("b"))
                  .filter("a != b").distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = stage(star(star(edges, True), False), "edges")
    return edges.select(F.col("a").alias("sid"), F.col("b").alias("comp"))


def _across(key, xs: pd.DataFrame, ys: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the components of one cluster block: each x against all y.

    Counts overlaps by scanning the block's inverted lists, and returns one
    link for each x and component it meets.
    """
    found = []
    if len(xs) and len(ys):
        tok = [_unpack(t) for t in ys["ytoks"]]
        size = np.array([len(t) for t in tok])
        flat, owner = np.concatenate(tok), np.repeat(np.arange(len(tok)), size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        ysid, ycomp = ys["ysid"].to_numpy(), ys["ycomp"].to_numpy()
        for sid, comp, blob in zip(xs["sid"], xs["comp"], xs["toks"]):
            t = _unpack(blob)
            lo, hi = np.searchsorted(flat, t, "left"), np.searchsorted(flat, t, "right")
            n = hi - lo
            if not n.any():
                continue
            at = np.repeat(hi - n.cumsum(), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(tok))
            hit = np.flatnonzero((100 * both >= percent * (size + len(t) - both)) & (ycomp != comp))
            _, one = np.unique(ycomp[hit], return_index=True)
            found += [(sid, y) for y in ysid[hit[one]]]
    return pd.DataFrame(found, columns=["p", "m"], dtype="int64")


def _only(rows: DataFrame, wanted: DataFrame, key: str = "sid") -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``wanted``, before any exchange.

    Ids are compared by hash bucket; the broadcast side has at most
    FILTER_BUCKETS rows, whatever the input.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(FILTER_BUCKETS))
    buckets = wanted.select(bucket.alias("bucket")).distinct()
    return rows.withColumn("bucket", bucket).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")


def _residual(pairs: DataFrame, comps: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """Links inside clusters that the stars left in several components."""
    pairs = pairs.filter("far")
    members = pairs.select("p", F.col("m").alias("sid")).union(pairs.select("p", F.col("p").alias("sid")).distinct())
    members = members.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    members = members.join(blobs.select("sid", "n"), "sid")
    home = F.max(F.when(F.col("p") == F.col("sid"), F.col("comp"))).alias("home")
    clusters = members.groupBy("p").agg(
        F.count(F.lit(1)).alias("c"), home, F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("c > 2 and lo != hi")
    rows = members.join(clusters.select("p", "home"), "p").withColumn("apart", F.col("comp") != F.col("home"))
    rows = stage(rows.select("p", "sid", "comp", "n", "apart"), "clusters")
    weight = TOKEN_BYTES * F.col("n")
    plan = rows.groupBy("p").agg(
        F.ceil(F.sum(weight) / BLOCK_BYTES).alias("yb"),
        F.ceil(F.sum(F.when(F.col("apart"), weight).otherwise(0)) / BLOCK_BYTES).alias("xb"))
    rows = rows.join(plan, "p")
    slot = F.xxhash64("sid", F.lit("block"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    xs = rows.filter("apart").select("p", "sid", "comp", F.pmod(slot, "xb").alias("i"), upto("yb").alias("j"))
    ys = rows.select(F.col("p").alias("yp"), F.col("sid").alias("ysid"), F.col("comp").alias("ycomp"),
                     F.pmod(slot, "yb").alias("yj"), upto("xb").alias("yi"))
    toks = _only(blobs, rows).select(F.col("sid").alias("bsid"), "toks")
    xs = xs.join(toks, F.col("sid") == F.col("bsid")).drop("bsid")
    ys = ys.join(toks, F.col("ysid") == F.col("bsid")).drop("bsid").withColumnRenamed("toks", "ytoks")

    def across(key, a, b):
        return _across(key, a, b, percent)
    return xs.groupBy("p", "i", "j").cogroup(ys.groupBy("yp", "yi", "yj")).applyInPandas(across, "p long, m long")


def _labelled(docs: DataFrame, k: int, percent: int, hot_list: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, n, sid), and (sid, comp) for every set that has a link.

    Tasks take and give BATCH_ROWS rows at a time: neither side of a task holds
    more texts or sets at once.
    """
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _labels(docs, k, percent, hot_list)


def _labels(docs: DataFrame, k: int, percent: int, hot_list: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select("doc_id", "text")
    code, mean = _order(docs, k, sketch_bits(docs.count()))
    sets = stage(shingle_sets(docs, code, mean, k, percent), "sets")
    small = sets.filter((F.col("n") > 0) & (F.col("n") <= MAX_LIGHT)).groupBy("n").agg(
        F.count(F.lit(1)).alias("count"), F.sum("others").alias("others")).collect()
    x = boundary({r["n"]: (r["count"], r["others"]) for r in small}, percent)
    hot = bool((code >= sketch.level(np.array([hot_list]), mean)[0]).any())
    pairs = stage(_candidates(signatures(sets, code, mean, x, percent, hot_list), percent, hot), "pairs")
    wanted = pairs.select(F.col("p").alias("sid")).union(pairs.select(F.col("m").alias("sid")))
    # whole sets are made again for the texts of pairs, rather than stored for all
    texts = _only(docs.withColumn("th", F.xxhash64("text")), _only(sets.filter("n > 0").select("sid", "th"), wanted), "th")
    blobs = stage(_only(shingle_sets(texts, code, mean, k, percent, whole=True).filter("n > 0"), wanted).groupBy("sid").agg(
        F.first("n").alias("n"), F.first("toks").alias("toks")), "blobs")
    links = stage(_verify(pairs.filter("ok").select("p", "m"), blobs, percent), "links")
    comps = components(links)
    more = stage(_residual(pairs, comps, blobs, percent), "more")
    if not more.isEmpty():
        comps = components(more.union(comps.select(F.col("sid").alias("p"), F.col("comp").alias("m"))))
    return sets.select("doc_id", "th", "n", "sid"), comps


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 75, hot_list: int = HOT_LIST) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text)."""
    ids, comps = _labelled(docs, k, percent, hot_list)
    firsts = ids.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    label = firsts.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    lowest = label.groupBy("comp").agg(F.min("first").alias("component_id"))
    label = label.join(lowest, "comp").select("sid", "component_id")
    return ids.join(label, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def first_of_groups(docs: DataFrame, k: int = 5, percent: int = 75, hot_list: int = HOT_LIST) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each linked group does.

    The smallest doc_id stays (null last), one row of it; rows without words all stay.
    """
    ids, comps = _labelled(docs, k, percent, hot_list)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    firsts = ids.filter("n > 0").groupBy("sid").agg(F.min(order).alias("first"))
    firsts = firsts.join(comps, "sid", "left").groupBy(F.coalesce("comp", "sid").alias("comp")).agg(
        F.min("first").alias("first"))
    last = F.lit((1 << 63) - 1)
    keep = firsts.select(F.coalesce("first.doc_id", last).alias("did"), F.col("first.th").alias("th"), F.lit(1).alias("n"))
    blank = ids.filter("n = 0").select(F.coalesce("doc_id", last).alias("did"), "th", F.lit(0).alias("n")).distinct()
    rows, cols, repeat = attach(docs, keep.union(blank))
    return rows.filter(F.col("n").isNotNull()).withColumn("in__repeat", repeat) \
        .filter((F.col("n") == 0) | (F.col("in__repeat") == 1)).select(*cols)
