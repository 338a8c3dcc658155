"""The registered queries of this subpackage, each over its whole table, and SQL for those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    exact_dedup,
    hard_negatives,
    html_text,
    language_id,
    mixing,
    packing,
    paragraphs,
    personal_data,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    whitening,
)

#: The tokenizer that documents are packed with.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix, measured = mixing.mix_documents(_table(spark, sf_dir, "documents"))
    taken = mix.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return measured.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_near(_table(spark, sf_dir, "documents"))


def op7_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_exact(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    # a long holds the deviations of some 600,000 vectors; beyond that they stand in the exact column only
    return rows.withColumn("deviation_exact", F.col("deviation")).withColumn(
        "deviation", F.col("deviation").try_cast("long")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", noisy)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mix_sources,
        op3_html_text,
        op4_secret_scan,
        op5_pack_sequences,
        op6_simhash_groups,
        op7_exact_groups,
        op8_language_id,
        op9_paragraph_dedup,
        op10_suffix_dedup,
        op11_whitening,
        op12_hard_negatives,
        op13_personal_data,
    )
}

_RULE_SCORES = {
    "symbols": "1000 * n_symbols // greatest(word_chars, 1)",
    "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
    "long_words": "10 * word_chars // greatest(n_words, 1)",
}
_TESTS = " UNION ALL ".join(
    f"SELECT stratum, count(*) AS n, '{rule}' AS rule, {cut} AS cut, count(*) FILTER ({_RULE_SCORES[rule]} >= {cut}) AS k"
    " FROM good GROUP BY stratum"
    for rule, cuts in quality.CUTOFFS.items()
    for cut in cuts
)
_REJECTS = " OR ".join(
    f"coalesce({score} >= (SELECT min(cut) FROM safe s WHERE s.stratum = m.stratum AND s.rule = '{rule}'), false)"
    for rule, score in _RULE_SCORES.items()
)

OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), places AS (SELECT r, w, unnest(range(0, len(w) - 4)) AS i FROM d WHERE len(w) >= 5
), windows AS (SELECT r, i, array_to_string(w[i + 1 : i + 5], ' ') AS k FROM places
), repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM windows) WHERE c > 1
), covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM repeated) GROUP BY r
), m AS (
  SELECT d.r, doc_id, stratum, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(w) < 10 OR 100 * coalesce(c.n, 0) > 20 * len(w) AS base_failed
  FROM d LEFT JOIN covered c ON c.r = d.r
), good AS (SELECT DISTINCT m.* EXCLUDE (r, doc_id) FROM m
  JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) l ON l.doc_id = m.doc_id WHERE NOT base_failed
), tests AS ({_TESTS}
), tails AS (
  SELECT *, CASE WHEN k > n * {quality.RATE} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                  + j * ln({quality.RATE}) + (n - j) * ln(1 - {quality.RATE})))) END AS p,
    count(*) OVER () AS all_tests
  FROM tests
), safe AS (SELECT * FROM tails WHERE p <= {quality.ERROR} / all_tests)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_REJECTS}) AS kept
FROM m
"""

_WEIGHT = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
OP2_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', '{mixing.SEED}', doc_id::VARCHAR)) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM d GROUP BY source
), weighed AS (SELECT *, CASE (rank - 1) % {len(mixing.WEIGHTS)} {_WEIGHT} END AS weight FROM s
), levels AS (
  SELECT *, (sum(words) OVER () - {mixing.MOST_USES} * coalesce(sum(words) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0))::DOUBLE / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW f AS (ORDER BY words / weight, rank)
), t AS (
  SELECT source, words, least((SELECT arg_min(level, words / weight) FROM levels
    WHERE level * weight <= {mixing.MOST_USES} * words) * weight, {mixing.MOST_USES} * words::DOUBLE) AS target
  FROM levels
), placed AS (
  SELECT d.*, words, target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, words AS source_size, target,
       ({" + ".join(f"greatest(0, least({c} * words + start + size, round(target)::BIGINT) - ({c} * words + start))" for c in range(mixing.MOST_USES))})::BIGINT AS taken
FROM placed
"""

OP7_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
), g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), hard AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""

ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op2_mix_sources": OP2_SQL,
    "op7_exact_groups": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
}
