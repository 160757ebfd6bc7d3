"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitwx.llm import (
    alignment,
    decontamination,
    language,
    mixing,
    near_dedup,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
    url_filter,
    vector_dedup,
    whitening,
)

#: (verdict, host, path)
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
SHARDS = 40
#: Vocabulary files, which every executor has at this place.
TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    # more digits than this differ between math libraries
    place = F.round("position", 9).alias("position")
    return plan.orderBy("position", "doc_id").select("doc_id", "size", "source_size", "target", "taken", place)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.train(table(spark, sf_dir, "documents"), labels)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [kind for kind, *_ in secret_scan.BASE]
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in kinds),
        F.sha2(secret_scan.listed(kinds), 256).alias("base_sha256"),
        secret_scan.listed([*kinds, secret_scan.RANDOM]).alias("spans"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.predict_language(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_profile(table(spark, sf_dir, "documents"), TOKENIZER_A, TOKENIZER_B)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id",
        *quality_rules.MEASURES,
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.CURRENT).alias("kept"),
        "failed",
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.component_rows(*whitening.whiten(table(spark, sf_dir, "embeddings")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_mixing": op2_mixing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_language": op9_language,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_quality_rules": op12_quality_rules,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op1_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
                       ELSE substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), hosts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT h.*, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS n
  FROM hosts h LEFT JOIN rules r
    ON (h.host = r.rule_host OR ends_with(h.host, '.' || r.rule_host)) AND starts_with(h.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
""",
    "op2_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, sum(3 * source_size) OVER o AS held, sum(weight) OVER o AS gone,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights, row_number() OVER o AS n
  FROM sources WINDOW o AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST)
), levels AS (
  SELECT 0 AS n, (any_value(total))::DOUBLE / any_value(weights)::DOUBLE AS level FROM ratios
  UNION ALL
  SELECT n, (total - held)::DOUBLE / (weights - gone)::DOUBLE FROM ratios WHERE weights > gone
), level AS (
  SELECT l.level FROM levels l
  WHERE NOT EXISTS (SELECT 1 FROM ratios r WHERE r.n > l.n AND 3 * r.source_size <= r.weight * l.level)
  ORDER BY l.n LIMIT 1
), goals AS (
  SELECT source, source_size, kind, least((3 * source_size)::DOUBLE, weight * (SELECT level FROM level)) AS target FROM sources
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.kind, round(g.target)::BIGINT AS goal,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), taken AS (
  SELECT *, CASE WHEN source_size > 0 THEN
      ((goal // source_size) * size + greatest(least(goal % source_size - start, size), 0))::BIGINT ELSE 0 END AS taken
  FROM placed
)
-- integrals of the schedules 1/2 + t, 1 and 3/2 - t, solved for t
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(CASE kind WHEN 0 THEN sqrt(0.25 + 2 * (start / target)) - 0.5
                                                WHEN 1 THEN start / target
                                                ELSE 1.5 - sqrt(2.25 - 2 * (start / target)) END, 9) END AS position
FROM taken
""",
    "op3_substring_dedup": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT r, doc_id, i, words[i:i + 12] AS w
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts)
), later AS (
  SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM windows
), removed AS (
  SELECT DISTINCT r, i + d AS i FROM later, (SELECT unnest(range(0, 13)) AS d) WHERE first < doc_id
), lists AS (
  SELECT r, list(i) AS gone FROM removed GROUP BY r
), judged AS (
  SELECT doc_id, words, coalesce(gone, []) AS gone FROM texts LEFT JOIN lists USING (r)
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string([words[i] for i in range(1, len(words) + 1) if NOT list_contains(gone, i)], ' '), ''))
         AS kept_sha256
FROM judged
""",
    "op5_minhash_dedup": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents
), elements AS (
  SELECT DISTINCT doc_id, words[i:i + 4] AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM texts WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM elements a JOIN elements b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c.n >= 0.8 * (x.n + y.n - c.n)
), steps AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, s.b FROM reach r JOIN steps s ON r.other = s.a
)
SELECT doc_id, min(other) AS component_id, min(other) = doc_id AS kept FROM reach GROUP BY doc_id
""",
    "op7_vector_dedup": r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
), steps AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, s.b FROM reach r JOIN steps s ON r.other = s.a
), counted AS (
  SELECT a, count(*) AS n FROM steps GROUP BY a
), lowest AS (
  SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept
FROM lowest LEFT JOIN counted ON a = vec_id
""",
    "op12_quality_rules": r"""
WITH parts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT r, i, words[i:i + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM parts)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), repeated AS (
  SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY r
), measured AS (
  SELECT p.r, doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len([x for x in lines if regexp_matches(x, '[^\x20\x09-\x0D]')])::BIGINT AS n_lines,
         len(list_distinct([x for x in lines if regexp_matches(x, '[^\x20\x09-\x0D]')]))::BIGINT AS n_own_lines,
         len([x for x in words if regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')])::BIGINT AS n_letter_words,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, n_lines - n_own_lines AS n_dup_lines,
         (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (word_chars < 2 * n_words)::BIGINT
         + 8 * (word_chars > 20 * n_words)::BIGINT + 16 * (100 * n_symbols > 10 * word_chars)::BIGINT
         + 32 * (100 * (n_lines - n_own_lines) > 60 * n_lines)::BIGINT
         + 64 * (100 * n_letter_words < 40 * n_words)::BIGINT AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_letter_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed
FROM judged
""",
}
