"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagelake.llm import (bpe, divergence, html, jaccard, langid, lines, mixing, outliers, phrases, prefixes, vptree, warc,
                             zclass)
from vintagelake.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@register("op1_ngram_jaccard_join")
def op1(spark, sf_dir):
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


@register("op2_sentencepiece")
def op2(spark, sf_dir):
    return bpe.round_trip(read(spark, sf_dir, "documents"), bpe.default_model())


@register("op3_line_dedup")
def op3(spark, sf_dir):
    out = lines.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars_left"),
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


@register("op4_language_id")
def op4(spark, sf_dir):
    return langid.language_query(read(spark, sf_dir, "documents"))


@register("op5_quality_rules")
def op5(spark, sf_dir):
    return outliers.quality_rules(read(spark, sf_dir, "documents"))


@register("op6_quality_classifier")
def op6(spark, sf_dir):
    return zclass.quality_query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op7_mixing", """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT source, source_size, weight, 2.0::DOUBLE * source_size AS cap,
         sum(2.0::DOUBLE * source_size) OVER w AS caps, sum(weight) OVER () - sum(weight) OVER w AS weights_left,
         1.5::DOUBLE * sum(source_size) OVER () AS share
  FROM per WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
levels AS (
  SELECT max((share - (caps - cap)) / (weights_left + weight)) AS level FROM filled),
targets AS (
  SELECT source, source_size, least(cap, level * weight) AS target FROM filled, levels),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size, 9) ELSE 0 END AS rate FROM targets),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS LAST) - 1 AS rank FROM sized)
SELECT r.doc_id, r.size, t.source_size, t.target,
       CAST((floor(rate) + floor((rank + 1) * (rate - floor(rate)) + 0.5) - floor(rank * (rate - floor(rate)) + 0.5)) * r.size AS BIGINT) AS taken
FROM ranked r JOIN rated t ON r.source IS NOT DISTINCT FROM t.source
""")
def op7(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op8_nearest_neighbours")
def op8(spark, sf_dir):
    return vptree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op9_html_extraction")
def op9(spark, sf_dir):
    return html.extract(read(spark, sf_dir, "pages"))


@register("op10_warc")
def op10(spark, sf_dir):
    return warc.archive_query(read(spark, sf_dir, "pages"))


@register("op11_source_divergence", r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
tokens AS (SELECT row_id, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY ALL HAVING count(DISTINCT row_id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang) LEFT JOIN counts USING (lang, source)
  GROUP BY lang, source),
shares AS (
  SELECT s.lang, s.source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (s.total + s.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + s.v)::HUGEINT AS q
  FROM sources s JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rated AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rated QUALIFY part = 'pair' OR rank <= 200
""")
def op11(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


@register("op13_token_counts")
def op13(spark, sf_dir):
    return prefixes.token_counts(read(spark, sf_dir, "documents"), prefixes.load(prefixes.default_path()), 512)


@register("op12_phrase_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM listed),
grams AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND a >= 100),
inner_grams AS (
  SELECT lang, a, array_to_string(words[s:s + m - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest(range(1, 5)) AS s), (SELECT unnest(range(2, 5)) AS m) WHERE m < k AND s + m - 1 <= k),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_grams GROUP BY lang, phrase),
kept AS (SELECT c.* FROM candidates c LEFT JOIN most m USING (lang, phrase) WHERE m.most IS NULL OR 100 * m.most < 100 * c.a),
parts AS (
  SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS first, array_to_string(words[cut + 1:], ' ') AS rest
  FROM kept, (SELECT unnest(range(1, 5)) AS cut) WHERE cut < k),
cuts AS (
  SELECT p.*, t.n, l.a AS l, r.a AS r, (1000::HUGEINT * p.a * t.n::HUGEINT) // (l.a::HUGEINT * r.a) AS score
  FROM parts p JOIN totals t ON t.lang = p.lang JOIN f l ON l.lang = p.lang AND l.phrase = p.first
  JOIN f r ON r.lang = p.lang AND r.phrase = p.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= 2000
""")
def op12(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))
