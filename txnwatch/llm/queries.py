"""The corpus queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from . import (
    chat_format, exact_dedup, near_dedup, packing, phrases, quality_rules, sharding, source_mixing, substring_dedup, token_counts,
    token_output, url_filter, whitening)
from .common import table, tokenizer


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), "class_id", "copy_id", "n_copies", "kept")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.digest(chat_format.chat_windows(given.unionByName(hard)))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_dedup(docs).select(
        "doc_id", F.col("__keep_id").alias("keep_id"), F.col("__group_size").alias("group_size"), F.col("__kept").alias("kept"),
        F.col("__sha").alias("text_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = token_output.write_token_files(table(spark, sf_dir, "documents"), tokenizer())
    return token_output.read_token_files(spark, path).select(F.col("__id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).drop("grp")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = source_mixing.mix_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    p = [F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(source_mixing.DOMAINS)]
    return out.select(F.col("__id").alias("doc_id"), "tokens", *p, "rate", "copies")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(F.col("__id").alias("doc_id"), *quality_rules.COUNTS, "base_failed", "kept")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("__id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer()).withColumnRenamed("__id", "doc_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("__id", "vec_id")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json")).withColumnRenamed("__id", "doc_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS cost,
    8 + length(role) + length(text) + 4 * (length(role || text) - length(replace(role || text, '&', '')))
      + 3 * (length(role || text) - length(replace(role || text, '<', '')))
      + 4 * (length(role || text) - length(replace(role || text, '[', '')))
      + 4 * (length(role) - length(replace(role, chr(10), ''))) AS chars FROM given),
p AS (
  SELECT *, coalesce(sum(cost) OVER w, 0) AS before, count(*) OVER w AS place FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, before // 512 AS span FROM p),
e AS (SELECT conv_id, span, max(before + cost) AS stop FROM s GROUP BY ALL),
last AS (SELECT conv_id, max(span) AS last_span, min(span) AS first_span, count(DISTINCT span) AS n_spans FROM s GROUP BY ALL),
own AS (SELECT conv_id, sum(chars) AS c FROM s GROUP BY ALL),
history AS (
  SELECT s.conv_id, sum(chars) AS c FROM s JOIN e USING (conv_id, span) JOIN last USING (conv_id)
  WHERE span < last_span AND stop - before <= 64 AND NOT (place = 0 AND role = 'system') GROUP BY ALL),
head AS (
  SELECT s.conv_id, chars * (n_spans - 1) AS c FROM s JOIN last USING (conv_id) WHERE place = 0 AND role = 'system')
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
  (own.c + coalesce(history.c, 0) + coalesce(head.c, 0))::BIGINT AS formatted_chars
FROM (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM given GROUP BY conv_id)
JOIN own USING (conv_id) LEFT JOIN history USING (conv_id) LEFT JOIN head USING (conv_id)
"""

OP6_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP9_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(ws) - 48)) t(i)),
least_id AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
hit AS (SELECT doc_id, i FROM win JOIN least_id USING (h) WHERE d < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, unnest(range(50)) r(k)),
word AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) u(p)),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept 
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
line AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d),
piece AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM line),
place AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM piece),
run AS (SELECT lang, ws[i:i + 4] AS ws FROM place),
edge AS MATERIALIZED (SELECT lang, ws, count(*) AS c FROM run GROUP BY ALL),
gram AS (SELECT lang, ws, c, unnest(range(1, len(ws) + 1)) AS m FROM edge),
f AS MATERIALIZED (SELECT lang, m, array_to_string(ws[1:m], ' ') AS phrase, sum(c)::BIGINT AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS ws FROM f WHERE f >= 100),
part AS (SELECT lang, ws, f, m, unnest(range(1, m)) AS k FROM often WHERE m >= 2),
span AS (SELECT lang, ws, f, k, unnest(range(1, m - k + 2)) AS i FROM part),
sub AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(f) AS above FROM span GROUP BY ALL),
two AS (SELECT lang, f AS a, k, array_to_string(ws, ' ') AS phrase, array_to_string(ws[1:k], ' ') AS one, array_to_string(ws[k + 1:], ' ') AS rest FROM part),
cut AS (
  SELECT two.lang, two.phrase, a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM two JOIN often x ON x.lang = two.lang AND x.phrase = one JOIN often y ON y.lang = two.lang AND y.phrase = rest
  JOIN total ON total.lang = two.lang),
best AS (
  SELECT lang, phrase, a, n, l, r, score FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT best.lang, best.phrase, a, n, score::BIGINT AS score, l, r,
    row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(best.phrase)) AS rank
  FROM best LEFT JOIN sub ON sub.lang = best.lang AND sub.phrase = best.phrase WHERE above IS NULL OR 100 * above < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_source_mixing": op3_source_mixing,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_files": op7_token_files,
    "op8_sharding": op8_sharding,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_token_counts": op12_token_counts,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {"op2_chat_format": OP2_SQL, "op6_exact_dedup": OP6_SQL, "op9_substring_dedup": OP9_SQL,
                      "op13_collocations": OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
