"""Approximate nearest neighbours with vantage-point trees.

Vectors are dealt by a hash of their id into shards of about ``shard_rows``.
A task builds each shard's tree once and stages it as one row.  Queries go in
blocks of bounded size; every block meets every shard, and the best ``k`` of
each shard are merged per query.

A tree node splits its vectors into the nearer and the farther half around a
vantage point and keeps the distance range of each half.  By the triangle
inequality, a half whose range is more than the current k-th best distance
away from the query's distance cannot hold a better vector.  ``factor`` relaxes
this: a half is skipped when the gap exceeds ``factor`` times that distance.
Factor 1 is exact, ties included; smaller factors skip more.

Distances are Euclidean in double precision on the original vectors.  Vectors
that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows with a null id; vectors of another length than the query are no
candidates.  A query's own row is no candidate; other rows with equal vectors
or equal ids are.  Ties go to the smaller id.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintagelake.llm.common import stage

K, FACTOR = 10, 0.6
SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 512, 32


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.filter((F.size("v") > 0) & fine & some).withColumn("dim", F.size("v"))


def build(ids: np.ndarray, x: np.ndarray) -> dict:
    """Tree over the rows of ``x``: vectors in tree order, nodes over ranges of them.

    Node (lo, hi): row lo is the vantage point, (lo + 1, mid) the nearer half
    and (mid, hi) the farther, with the range of distances of each.
    """
    order, dist = np.argsort(ids, kind="stable"), np.empty(len(ids))
    nodes, todo = {}, [(0, len(ids))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= LEAF:
            continue
        part = order[lo:hi]
        # the point farthest from the first one: near the rim, where ranges are narrow
        far = int(np.argmax(((x[part] - x[part[0]]) ** 2).sum(1)))
        part[[0, far]] = part[[far, 0]]
        d = np.sqrt(((x[part[1:]] - x[part[0]]) ** 2).sum(1))
        by = np.argsort(d, kind="stable")
        order[lo + 1:hi], dist[lo + 1:hi] = part[1:][by], d[by]
        mid = lo + 1 + (hi - lo - 1) // 2
        nodes[lo, hi] = (mid, dist[lo + 1], dist[mid - 1], dist[mid], dist[hi - 1])
        todo += [(lo + 1, mid), (mid, hi)]
    return {"ids": ids[order], "x": x[order], "nodes": nodes}


class Search:
    """Best ``k`` rows of one tree for a block of queries, visited together."""

    def __init__(self, tree: dict, qid: np.ndarray, q: np.ndarray, k: int, factor: float):
        self.ids, self.x, self.nodes = tree["ids"], tree["x"], tree["nodes"]
        self.qid, self.q, self.k, self.factor = qid, q, k, factor
        self.best = np.full((len(q), k), np.inf)
        self.who = np.full((len(q), k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Compare queries ``rows`` with vectors lo..hi; returns the distances."""
        d = np.sqrt(((self.q[rows][:, None, :] - self.x[None, lo:hi]) ** 2).sum(2))
        own = self.qid[rows][:, None] == self.ids[None, lo:hi]
        shown = np.where(own, np.inf, d)
        near = np.flatnonzero((shown <= self.best[rows, -1:]).any(1))
        if len(near):
            at = rows[near]
            dist = np.concatenate([self.best[at], shown[near]], 1)
            who = np.concatenate([self.who[at], np.where(np.isinf(shown[near]), np.iinfo(np.int64).max,
                                                         np.broadcast_to(self.ids[lo:hi], (len(near), hi - lo)))], 1)
            by = np.lexsort((who, dist))[:, :self.k]
            self.best[at], self.who[at] = np.take_along_axis(dist, by, 1), np.take_along_axis(who, by, 1)
        return d

    def run(self) -> None:
        todo = [(0, len(self.ids), np.arange(len(self.q)), np.zeros(len(self.q)))]
        while todo:
            lo, hi, rows, gap = todo.pop()
            stay = gap <= self.factor * self.best[rows, -1]
            rows = rows[stay]
            if not len(rows) or lo >= hi:
                continue
            node = self.nodes.get((lo, hi))
            if node is None:
                self.offer(rows, lo, hi)
                continue
            mid, near_lo, near_hi, far_lo, far_hi = node
            d = self.offer(rows, lo, lo + 1)[:, 0]
            gap_near = np.maximum(0, np.maximum(near_lo - d, d - near_hi))
            gap_far = np.maximum(0, np.maximum(far_lo - d, d - far_hi))
            first = gap_near <= gap_far
            # last in, first out: each query goes down its likelier half first
            for pick, one, two in ((first, (lo + 1, mid, gap_near), (mid, hi, gap_far)),
                                   (~first, (mid, hi, gap_far), (lo + 1, mid, gap_near))):
                if pick.any():
                    todo.append((two[0], two[1], rows[pick], two[2][pick]))
                    todo.append((one[0], one[1], rows[pick], one[2][pick]))


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in column])


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, tree): the trees over ``usable`` rows, staged."""
    shards = max(1, -(-rows.count() // shard_rows))

    def grow(key, pdf):
        tree = build(pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["v"]))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [pickle.dumps(tree, protocol=5)]})
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int"))
    return stage(dealt.groupBy("dim", "shard").applyInPandas(grow, "dim int, shard int, tree binary"), "trees")


def search(vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR,
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row, nearest first."""
    rows = stage(usable(vectors), "vectors")
    trees = index(rows, shard_rows)
    asked = rows.filter(is_query)
    n_blocks = max(1, -(-asked.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(n_blocks)).cast("int")

    def gather(key, pdf):
        blob = pickle.dumps((pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["v"])), protocol=5)
        return pd.DataFrame({"qdim": [key[0]], "block": [key[1]], "queries": [blob]})
    blocks = asked.withColumn("block", block).groupBy("dim", "block").applyInPandas(
        gather, "qdim int, block int, queries binary")
    # each block of queries against each shard of its dimension
    meet = blocks.join(trees.select(F.col("dim").alias("qdim"), F.col("shard").alias("qshard")), "qdim")
    meet = meet.join(trees, (F.col("qdim") == F.col("dim")) & (F.col("qshard") == F.col("shard"))) \
        .repartition("block", "shard")

    def run(batches):
        for b in batches:
            for blob, tree in zip(b.column(0), b.column(1)):
                qid, q = pickle.loads(blob.as_buffer())
                s = Search(pickle.loads(tree.as_buffer()), qid, q, k, factor)
                s.run()
                i, j = np.nonzero(np.isfinite(s.best))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qid[i]), pa.array(s.who[i, j]), pa.array(s.best[i, j])], ["query_id", "vec_id", "score"])
    found = meet.select("queries", "tree").mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
