"""A training-data pipeline of five stages over ``documents``.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its rows are
written as parquet in the shared folder and read again as the next one's
``docs``.  All but the last return the columns of ``docs``.

1. quality classifier: documents predicted bad go.
2. line dedup: blocks repeated from earlier documents are deleted, ``n_chars``
   (where present) follows the text, and documents of which no word is left go.
3. n-gram Jaccard join: of each group of linked documents the one with the
   smallest doc_id stays (one row, if it is repeated); documents without words
   stay, being in no group.
4. mixing: every document appears as often as its source's target weight asks.
5. SentencePiece: the pieces of every text, with merge-dropout drawn anew for
   each copy.  They are decoded again; a text that does not come back fails the run.

Null texts have no words; null ids and repeated rows are treated as each
operator says; empty tables give empty results.  Extra columns are kept by
stages 1 to 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintagelake.llm import bpe, jaccard, lines, mixing, zclass
from vintagelake.llm.common import WORD, read, stage

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return zclass.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(docs.withColumnsRenamed({c: f"keep_{c}" for c in ("n_lines", "n_removed") if c in docs.columns}))
    out = out.filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    back = out.drop("n_lines", "n_removed").withColumnsRenamed({f"keep_{c}": c for c in ("n_lines", "n_removed")})
    return back.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.first_of_groups(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # copies of a row differ in nothing but this number
    copies = Window.partitionBy("doc_id", "key").orderBy("key")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).withColumn("copy", F.row_number().over(copies))
    model = bpe.default_model()
    out = bpe.decode(bpe.encode(docs, model, copy="copy"), model)
    lossy = F.raise_error(F.concat(F.lit("pieces do not decode to the text of document "),
                                   F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    pieces = F.when(F.col("text").eqNullSafe(F.col("decoded")), F.col("piece_ids")).otherwise(lossy).alias("piece_ids")
    return out.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), pieces)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
