"""Registered queries of the operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import (
    decontaminate, html_text, jaccard, lm, minmax, mixing, quality, repair, repeats, shards,
    surrogates, toxicity, whitening,
)
from reelstat.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the weight of its cell, its probability and the draw."""
    out = mixing.draws(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"), "sampled",
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.anonymize(docs, key=b"reelstat")


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that overlap."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shards.shard_documents(docs, 40, measures=True)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        held_out=toxicity.held_out_fold(),
    )


def op9_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), held_out=lm.held_out_fold())


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85, links=True)


def op11_min_max_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=85)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair(turns, live=F.col("live"))


def op13_shifted_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def _rake_sql(rounds: int = 40, power: float = 0.7) -> str:
    """The raking of ``op1_mix_sources``, each round written out."""
    goals = " ".join(
        f"""g_{name} AS (SELECT {name}, pow(CAST(sum(tokens) AS DOUBLE), {power})
        / sum(pow(CAST(sum(tokens) AS DOUBLE), {power})) OVER () AS {name}_goal
        FROM cells WHERE tokens > 0 GROUP BY {name}),"""
        for name in ("source", "lang", "topic")
    )
    steps, last = [], "w0"
    for i in range(rounds):
        for name in ("source", "lang", "topic"):
            now = f"w{i + 1}_{name}"
            steps.append(
                f"{now} AS (SELECT * REPLACE (w * {name}_goal / sum(w) OVER (PARTITION BY {name})"
                f" AS w) FROM {last}),"
            )
            last = now
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH docs AS (
  SELECT doc_id, source, lang, coalesce(source, '{mixing.NONE}') AS s, coalesce(lang, '{mixing.NONE}') AS l,
         CASE WHEN regexp_matches(coalesce(text, ''), '{mixing.LICENCE}') THEN 'licensed'
              WHEN regexp_matches(coalesce(text, ''), '{mixing.CONTACT}') THEN 'contact'
              ELSE 'prose' END AS topic,
         CAST(coalesce(len(regexp_extract_all(text, '{word}')), 0) AS BIGINT) AS n_tokens
  FROM documents
),
cells AS (SELECT s AS source, l AS lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tokens
          FROM docs GROUP BY s, l, topic),
{goals}
w0 AS (SELECT source, lang, topic, tokens, source_goal, lang_goal, topic_goal, CAST(tokens AS DOUBLE) AS w
       FROM cells JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic)
       WHERE tokens > 0),
{" ".join(steps)}
raked AS (SELECT source, lang, topic, w / tokens AS factor FROM {last}),
scaled AS (SELECT c.source, c.lang, c.topic,
                  coalesce(factor, 0) * (SELECT CAST(sum(tokens) AS DOUBLE) FROM cells) AS weight,
                  coalesce(factor, 0) / (SELECT max(factor) FROM raked) AS probability
           FROM cells c LEFT JOIN raked r ON c.source = r.source AND c.lang = r.lang AND c.topic = r.topic)
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, round(weight, 6) AS weight,
       round(probability, 6) AS probability,
       CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || 'mix'), 1, 8) AS BIGINT) AS DOUBLE)
         / 4294967296.0 < probability AS sampled
FROM docs d JOIN scaled p ON d.s = p.source AND d.l = p.lang AND d.topic = p.topic
"""


def _links_sql(n: int, percent: int, more: str = "") -> str:
    """Components of documents by comparing all pairs that share an n-gram."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))
         END) AS s FROM words
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, n_shingles, component_id{more} FROM (
  SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
         coalesce(n, 0) AS n_links
  FROM sets LEFT JOIN smallest ON doc_id = a
  LEFT JOIN (SELECT a AS linked, count(*) AS n FROM links GROUP BY a) ON doc_id = linked
)
"""


def _repeats_sql(length: int) -> str:
    """Bytes of strings that also start earlier, by grouping every string of the corpus."""
    return f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, unnest(list_transform(
              range(0, CAST(length(h) // 2 AS BIGINT) - {length - 1}),
              lambda p: {{'p': p, 'string': hash(substr(h, 2 * p + 1, {2 * length}))}}), recursive := true)
            FROM texts),
again AS (SELECT doc_id, p FROM strings
          QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, p) > 1),
marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {length}
                             THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + {length} AS b FROM runs GROUP BY doc_id, run),
pieces AS (SELECT s.doc_id, a, b,
                  substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) + 1,
                         2 * (a - coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0))) AS piece
           FROM spans s JOIN texts t ON s.doc_id = t.doc_id),
kept AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_removed, max(b) AS last,
                string_agg(piece, '' ORDER BY a) AS head FROM pieces GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_html_text": op2_html_text,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_line_rules": op5_line_rules,
    "op6_decontaminate": op6_decontaminate,
    "op7_histogram_shards": op7_histogram_shards,
    "op8_toxicity": op8_toxicity,
    "op9_hmm_scores": op9_hmm_scores,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_min_max_near_duplicates": op11_min_max_near_duplicates,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_shifted_cholesky_whitening": op13_shifted_cholesky_whitening,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": _rake_sql(),
    "op3_suffix_array_dedup": _repeats_sql(100),
    "op10_ngram_jaccard_join": _links_sql(4, 85, ", n_links"),
    "op11_min_max_near_duplicates": _links_sql(5, 85, ", component_id = doc_id AS kept"),
}
