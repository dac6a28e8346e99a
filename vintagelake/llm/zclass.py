"""Quality classifier by compression.

Two zstandard dictionaries hold raw text of good and of bad labelled documents.
A text is compressed with each; the difference of the compressed sizes over
their sum tells which class it resembles.  Very repetitive text compresses to
almost nothing with either, so the compressed share of the text and its length
join the difference in a logistic calibration, fitted on labelled rows that
are not in the dictionaries.

Fitting uses a bounded sample of the learning rows: about ``dict_docs``
documents of each label for the dictionaries, ``fit_docs`` of each for the
calibration.  The dictionary texts are cut into segments of ``SEGMENT``
characters; where they exceed ``dict_bytes``, a hash of document and place
chooses segments from all of every text until the budget is full.  Every text is scored whole, in
pieces of ``PIECE`` bytes so that memory stays bounded.  A null or empty text
gets the calibrated score of zero sizes.  Labels, lang, source and doc_id
never enter a score.  Conflicting or repeated labels count one by one; null
labels are ignored; with labels of one kind only, the score is their share.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vintagelake.llm.common import fold, sample_rows, stage

DICT_DOCS, DICT_BYTES, FIT_DOCS = 800, 256 << 10, 3000
SEGMENT = 512
LEVEL = 3
PIECE = 1 << 20
THRESHOLD = 0.3


def compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    """Plain, good and bad, without frame extras."""
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False,
                                                            write_dict_id=False)
    out = [zstandard.ZstdCompressor(compression_params=params)]
    for raw in (good, bad):
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(compression_params=params, dict_data=d))
    return out


def features(text: str | None, tools: list[zstandard.ZstdCompressor]) -> list[float]:
    """[normalised size difference, compressed share, log length]"""
    raw = (text or "").encode()
    if not raw:
        return [0.0, 0.0, 0.0]
    plain = good = bad = 0
    for at in range(0, len(raw), PIECE):
        piece = raw[at:at + PIECE]
        plain += len(tools[0].compress(piece))
        good += len(tools[1].compress(piece))
        bad += len(tools[2].compress(piece))
    return [(bad - good) / (bad + good), min(1.5, plain / len(raw)), math.log1p(len(raw))]


def _expand(x: np.ndarray) -> np.ndarray:
    """Intercept, the features, their squares and products."""
    a, b, c = x[:, 0] * 10, x[:, 1] * 2 - 1, x[:, 2] / 4 - 2
    return np.stack([np.ones(len(x)), a, b, c, b * b, a * b, a * c, b * c, c * c, b * b * b], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton's method for ridge logistic regression."""
    z, w = _expand(x), np.zeros(10)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + ridge * w
        hess = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(10)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionaries(texts: DataFrame, dict_bytes: int) -> dict[int, bytes]:
    """Raw dictionary of each label from ``texts`` (doc_id, y, text): hash-chosen segments from everywhere in them."""
    total = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    # a little more than fits, so that the budget is filled
    limit = {y: int(min(1.0, 1.2 * dict_bytes / max(1, n)) * (1 << 63)) for y, n in total.items()}

    def choose(batches):
        for b in batches:
            out = []
            for doc_id, y, text in zip(b["doc_id"], b["y"], b["text"]):
                for at in range(0, len(text), SEGMENT):
                    h = xxhash.xxh3_64_intdigest(f"{doc_id} {at}".encode()) >> 1
                    if h < limit[y]:
                        out.append((y, h, text[at:at + SEGMENT]))
            yield pd.DataFrame(out, columns=["y", "h", "text"])
    parts = texts.select("doc_id", "y", "text").mapInPandas(choose, "y int, h long, text string").toPandas()
    found = {}
    for y in (0, 1):
        mine, size = [], 0
        for text in parts[parts["y"] == y].sort_values(["h", "text"])["text"]:
            raw = text.encode()
            if size + len(raw) + 1 > dict_bytes:
                break
            mine.append(raw)
            size += len(raw) + 1
        found[y] = b"\n".join(mine) or b"        "
    return found


def fit(docs: DataFrame, labels: DataFrame, dict_docs: int = DICT_DOCS, dict_bytes: int = DICT_BYTES,
        fit_docs: int = FIT_DOCS) -> dict:
    """The model: dictionaries and calibration weights (a few hundred KB)."""
    lab = labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    share = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        return {"constant": float(share.get(1, 0) > 0) if share else 0.5}
    picked = sample_rows(lab, "y", dict_docs + fit_docs, "quality")
    # a bounded sample of ids, so the texts are found without shuffling the documents
    texts = docs.select("doc_id", "text").join(F.broadcast(picked.withColumnRenamed("doc_id", "lid")),
                                               F.col("doc_id") == F.col("lid"))
    part = dict_docs / (dict_docs + fit_docs)
    use = F.pmod(F.xxhash64("doc_id", F.lit("dictionary")), F.lit(1 << 20)) < int(part * (1 << 20))
    texts = stage(texts.select("doc_id", "y", F.coalesce("text", F.lit("")).alias("text"), use.alias("use")), "sample")
    dictionary = dictionaries(texts.filter("use"), dict_bytes)

    @pandas_udf("array<double>")
    def sizes(t: pd.Series) -> pd.Series:
        tools = compressors(dictionary[1], dictionary[0])
        return t.map(lambda s: features(s, tools))

    rows = texts.filter("NOT use").select("doc_id", "y", sizes("text").alias("x")).toPandas().sort_values("doc_id")
    y = rows["y"].to_numpy(float)
    if len(rows) < 20 or y.min() == y.max():
        return {"constant": share[1] / (share[0] + share[1])}
    total = share[0] + share[1]
    # undo the sampling by label, so that a score is a probability
    weight = np.where(y == 1, share[1] / total / max(1, y.sum()), share[0] / total / max(1, (1 - y).sum())) * len(y)
    return {"good": dictionary[1], "bad": dictionary[0],
            "weights": fit_logistic(np.array(rows["x"].tolist()), y, weight).tolist()}


def scorer(model: dict):
    """A column function text -> score in [0, 1]."""
    @pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        if "constant" in model:
            return pd.Series(model["constant"], index=t.index, dtype="float64")
        tools = compressors(model["good"], model["bad"])
        x = np.array([features(s, tools) for s in t]).reshape(len(t), 3)
        return pd.Series(1 / (1 + np.exp(-np.clip(_expand(x) @ np.array(model["weights"]), -30, 30))), index=t.index)
    return score


def quality_query(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    score = scorer(fit(docs, labels, **options))
    out = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), score("text").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` predicted good, with the columns of ``docs``."""
    score = scorer(fit(docs, labels, **options))
    return docs.filter(score("text") >= THRESHOLD)
