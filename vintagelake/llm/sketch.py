"""Count sketches of hashed items: counted in tasks, summed by chunk, bounded in size."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import stage

CHUNK = 1 << 16
SCHEMA = "chunk int, low binary, at binary, counts binary"
SLOTS = 8


def _pack(chunk: int, acc: np.ndarray) -> tuple:
    """A chunk's counts: low ones as compressed bytes, those from 255 apart."""
    at = np.flatnonzero(acc >= 255)
    return (int(chunk), zlib.compress(np.minimum(acc, 255).astype(np.uint8).tobytes(), 1),
            at.astype("<u2").tobytes(), acc[at].astype("<i8").tobytes())


def _unpack(low: bytes, at: bytes, counts: bytes) -> np.ndarray:
    acc = np.frombuffer(zlib.decompress(low), np.uint8).astype(np.int64)
    acc[np.frombuffer(at, "<u2")] = np.frombuffer(counts, "<i8")
    return acc


def _sum(pdf: pd.DataFrame) -> np.ndarray:
    acc = np.zeros(CHUNK, np.int64)
    for row in zip(pdf["low"], pdf["at"], pdf["counts"]):
        acc += _unpack(*row)
    return acc


class Counter:
    """Counts of one task, added in place: 4 bytes for each of the sketch's buckets and no more."""

    def __init__(self, size: int):
        self.counts = np.zeros(-(-size // CHUNK) * CHUNK, np.uint32)

    def add(self, ids: np.ndarray) -> None:
        np.add.at(self.counts, ids.astype(np.int64), np.uint32(1))

    def batch(self) -> pa.RecordBatch:
        """Rows of SCHEMA for the chunks that hold any count."""
        chunks = self.counts.reshape(-1, CHUNK)
        rows = [_pack(i, chunks[i].astype(np.int64)) for i in np.flatnonzero(chunks.any(axis=1))]
        cols = list(zip(*rows)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ["chunk", "low", "at", "counts"])


def spread(mean: float) -> float:
    """Standard deviation of the counts that chance alone gives the buckets, at least 1."""
    return max(1.0, math.sqrt(mean))


def level(counts: np.ndarray, mean: float) -> np.ndarray:
    """A byte for each count, in their order: quarters of the spread from 8 below the mean to 24 above, then thirds of octaves.

    The steps follow the spread, so an item of some more copies than its bucket holds by chance stands out as well in a
    full sketch as in an empty one.
    """
    above = (np.asarray(counts, np.float64) - mean) / spread(mean)
    far = 128 + np.floor(3 * np.log2(np.maximum(above, 24) / 24))
    return np.clip(np.where(above < 24, np.floor(32 + 4 * above), far), 0, 255).astype(np.uint8)


def excess(codes: np.ndarray, mean: float) -> np.ndarray:
    """The least count above the mean of each byte of ``level``."""
    codes = np.asarray(codes, np.float64)
    return spread(mean) * np.where(codes < 128, (codes - 32) / 4, 24 * 2.0 ** ((codes - 128) / 3))


def codes(parts: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """For each of ``size`` buckets the ``level`` of its count, and the mean count.

    The parts of a chunk are summed in SLOTS groups first, then these.
    """
    def part(key, pdf):
        acc = _sum(pdf)
        return pd.DataFrame([(*_pack(key[0], acc), int(acc.sum()))], columns=["chunk", "low", "at", "counts", "total"])

    slots = parts.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)))
    dense = stage(slots.groupBy("chunk", "slot").applyInPandas(part, f"{SCHEMA}, total long"), "counts")
    mean = (dense.agg(F.sum("total")).first()[0] or 0) / size

    def code(key, pdf):
        return pd.DataFrame({"chunk": [key[0]], "code": [zlib.compress(level(_sum(pdf), mean).tobytes(), 1)]})

    out = np.full(size, level(np.zeros(1), mean)[0], np.uint8)
    for r in dense.groupBy("chunk").applyInPandas(code, "chunk int, code binary").collect():
        at = r["chunk"] * CHUNK
        out[at:at + CHUNK] = np.frombuffer(zlib.decompress(r["code"]), np.uint8)
    return out, mean
