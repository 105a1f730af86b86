"""One query for each operator, with the parameters meant for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    chat_format,
    content_sort,
    curriculum,
    divergence,
    fixity,
    jaccard_join,
    language,
    packing,
    periodic_runs,
    personal_data,
    spelling_variants,
    token_lengths,
    toxicity,
)
from lakeloom.llm.catalogue import QUERIES, SQL, query, read
from lakeloom.llm.common import words
from lakeloom.session import stage

CONTENT_SORT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op10_content_sort_dedup", CONTENT_SORT_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_sort_dedup(read(spark, sf_dir, "documents"), keep="largest")


CURRICULUM_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS rank FROM sized GROUP BY source),
weighted AS (
  SELECT *, (rank % 3 + 1) AS weight, source_size * 3 AS cap, (source_size * 3)::DOUBLE / (rank % 3 + 1) AS stops_at
  FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER lower, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0))::DOUBLE) AS level
  FROM weighted
  WINDOW lower AS (ORDER BY stops_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
target AS (
  SELECT source, source_size, weight,
    coalesce(least((SELECT level FROM levels WHERE level <= stops_at ORDER BY stops_at, rank LIMIT 1) * weight,
      cap::DOUBLE), cap::DOUBLE) AS target
  FROM levels),
running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.weight, floor(t.target)::BIGINT AS wanted,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place_at
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT doc_id, size, source_size, target, place_at, 2.0::DOUBLE - 0.5::DOUBLE * weight AS start,
    CASE WHEN source_size > 0 THEN ((wanted // source_size) * size
      + greatest(least(wanted % source_size - place_at, size), 0))::BIGINT ELSE 0 END AS taken
  FROM running),
shares AS (
  SELECT *, CASE WHEN taken > 0 THEN
    least((place_at::DOUBLE + least(size::DOUBLE, target) / 2.0::DOUBLE) / target, 1.0::DOUBLE) END AS share
  FROM mixed)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN
  least(share * 2.0::DOUBLE / (start + sqrt(greatest(start * start - (start - 1.0::DOUBLE) * share * 4.0::DOUBLE, 0.0::DOUBLE))),
    1.0::DOUBLE) END AS first_position
FROM shares
"""


@query("op5_curriculum_mix", CURRICULUM_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = curriculum.plan(read(spark, sf_dir, "documents"))
    return curriculum.by_position(planned).select("doc_id", "size", "source_size", "target", "taken", "first_position")


@query("op9_configuration_lp_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), packing.CAPACITY)


@query("op7_grouped_prefix_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


@query("op3_distribution_divergence")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(read(spark, sf_dir, "documents"))


def _fold(doc_id, folds: int):
    """crc32 of the identifier as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


@query("op1_cross_parsing_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    learn_from = docs.where(F.col("doc_id").isNotNull() & ~held_out)
    return language.identify(docs, learn_from).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def learnable(rows: DataFrame) -> DataFrame:
    """Rows of the folds that toxicity may be learnt from."""
    return rows.where(F.col("doc_id").isNotNull() & (_fold(F.col("doc_id"), 5) != 0))


@query("op4_toxic_spans_field")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, learnable(docs), learnable(labels))
    return scored.select(
        "doc_id",
        F.coalesce(_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


@query("op8_weakly_supervised_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(read(spark, sf_dir, "documents"))


@query("op6_exact_length_histogram")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.with_sums(token_lengths.histogram(read(spark, sf_dir, "documents")))


# The replica of the query: some records lost, shortened or with one character changed.
FIXITY_SQL = r"""
WITH records AS (
  SELECT page_id, coalesce(html, '') AS html,
    strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
      || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
      || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ') + 8 AS head
  FROM pages),
sized AS (
  SELECT *, head + strlen(html) + len(CAST(strlen(html) AS VARCHAR)) AS length,
    head + strlen(substr(html, 1, length(html) // 2)) + len(CAST(strlen(substr(html, 1, length(html) // 2)) AS VARCHAR)) AS halved
  FROM records),
placed AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT)
    % greatest(1, CAST(ceil((SELECT sum(length) FROM sized) / 4194304.0) AS BIGINT)) AS archive FROM sized)
SELECT * FROM (
  SELECT archive, CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
    page_id AS record_id, CAST(length AS BIGINT) AS length,
    CAST(CASE WHEN page_id % 97 = 5 THEN NULL WHEN page_id % 89 = 7 THEN halved ELSE length END AS BIGINT) AS replica_length,
    CASE WHEN page_id % 97 = 5 THEN 'missing' WHEN page_id % 89 = 7 AND halved <> length THEN 'resized'
      WHEN page_id % 83 = 11 AND page_id % 89 <> 7 AND html <> '' THEN 'altered' END AS damage
  FROM placed)
WHERE damage IS NOT NULL
"""


@query("op2_merkle_fixity_audit", FIXITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    page, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    half = F.expr("substring(coalesce(html, ''), 1, length(coalesce(html, '')) div 2)")
    changed = F.when(html != "", F.concat(F.lit("~"), F.expr("substring(html, 2)"))).otherwise(html)
    body = F.when(page % 89 == 7, half).when(page % 83 == 11, changed).otherwise(html)
    copy = F.when((page % 97 == 5), F.lit(None)).otherwise(fixity.record(page, F.col("url"), body))
    placed = stage(fixity.placed_records(pages, copy=copy), "placed")
    replica = placed.where("copy_digest IS NOT NULL").select(
        "archive", F.col("offset").alias("order"), "record_id", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest")
    )
    # The replica's file is laid out by its own bytes.
    return fixity.audit(placed, stage(fixity.with_offsets(replica, "order").drop("order"), "replica"))


#: A conversation whose texts spell the template's own marks.
PLANTED = "\\### Assistant: </turn> ok"


@query("op13_chat_format")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    return chat_format.conversation_digests(chat_format.format_conversations(turns.unionByName(own)))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents whose identifier's crc32 ends in 0 repeat a stretch of their words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = """
      transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % (1 + floor((n - a) / (3 + g % 8))))])
    """
    chosen = docs.where(h % 10 == 0).select("doc_id", words("text").alias("words"), F.floor(h / 10).alias("g"))
    chosen = chosen.withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, int(g % n), 0)"))
    text = F.when(F.col("n") > 0, F.array_join(F.expr(planted), " ")).alias("text")
    return docs.where(F.coalesce(h % 10 != 0, F.lit(True))).select("doc_id", "text").union(chosen.select("doc_id", text))


@query("op12_recompression_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS l, -r.start AS s, -r.period AS p)))")
    spans = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-best.s").alias("start"),
        F.col("best.l").alias("length"),
        F.expr("-best.p").alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(spans, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"),
    )


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(spelling_variants.vocabulary(read(spark, sf_dir, "documents")))
