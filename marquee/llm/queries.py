"""The registered ``opN_`` queries: each operator over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (bm25_topk, conversation_repair, decontaminate, html_extract, language_id, license_scan,
                         mixing, secret_scan, sharding, simhash, token_alignment, token_counts, toxicity)
from marquee.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def op1_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    languages = language_id.learn(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"),
                        language_id.predict_column(languages, spark, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op2_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.license_notices(read_table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    chain = toxicity.train(docs, read_table(spark, d, "labels"))
    scored = docs.select("doc_id", "text", toxicity.score_column(chain, F.col("text")).alias("scores"))
    return scored.select("doc_id", F.col("scores.low_quality").alias("p_low_quality"),
                         F.col("scores.toxic").alias("p_toxic"),
                         toxicity.is_toxic(F.col("scores"), F.col("text")).alias("toxic"))


def op4_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    model = html_extract.fit(html_extract.labelled_pages())
    pages = read_table(spark, d, "pages").select(
        "page_id", "url", html_extract.extract_column(spark, model, F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    return bm25_topk.top_k(docs.where(F.col("doc_id") % 20 == 0), docs, k=10)


def op6_simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, d, "documents"), shingle=4, max_bits=4, seed=42)
    return groups.select(F.col("id").alias("doc_id"),
                         F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         F.col("component").alias("component_id"))


def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contained_items(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.token_counts(read_table(spark, d, "documents"),
                                       public_tokenizers.path(TOKENIZER))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_sharding(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id")
    return sharding.place(docs).select("doc_id", "slot", "shard")


def op10_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    plan = mixing.mix_plan(read_table(spark, d, "documents"), keep=["doc_id"])
    return plan.select("row.doc_id", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def op11_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.align(read_table(spark, d, "documents"), public_tokenizers.path(TOKENIZER),
                                 public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = conversation_repair.damage(read_table(spark, d, "conversations"))
    reported, repaired = conversation_repair.repair(rows)
    digests = conversation_repair.text_digests(repaired).withColumnRenamed("conv_id", "digest_of")
    return (reported.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_of")), "left").drop("digest_of")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))))


def op13_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.secret_spans(read_table(spark, d, "documents"))
    spans, fixed = F.col("spans"), secret_scan.KINDS[:3]
    counts = [F.size(secret_scan.of_kind(spans, k)).cast("bigint").alias(f"n_{k}") for k in fixed]
    base = F.sha2(secret_scan.span_list(secret_scan.of_kind(spans, *fixed)).cast("binary"), 256)
    return found.select(F.col("id").alias("doc_id"), *counts, base.alias("base_sha256"),
                        secret_scan.span_list(spans).alias("spans"))


def _number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


OP9_SQL = f"""
WITH RECURSIVE prefs AS (
  SELECT s.shard, list((({_number(f"'{sharding.SEED}:offset:' || s.shard::VARCHAR")} % {sharding.TABLE_SIZE})
         + j.j * ({_number(f"'{sharding.SEED}:skip:' || s.shard::VARCHAR")} % {sharding.TABLE_SIZE - 1} + 1))
         % {sharding.TABLE_SIZE} ORDER BY j.j) AS wanted
  FROM range({sharding.N_SHARDS}) s(shard), range({sharding.TABLE_SIZE}) j(j) GROUP BY s.shard
), fill(turn, owners) AS (
  SELECT 0, list_transform(range({sharding.TABLE_SIZE}), lambda x: -1::BIGINT)
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(owners[:pick], [shard]), owners[pick + 2:])
  FROM (SELECT turn, owners, p.shard,
               list_filter(p.wanted, lambda s: owners[s + 1] < 0)[1] AS pick
        FROM fill JOIN prefs p ON p.shard = turn % {sharding.N_SHARDS}
        WHERE turn < {sharding.TABLE_SIZE})
), placed AS (
  SELECT unnest(range({sharding.TABLE_SIZE})) AS slot, unnest(owners) AS shard
  FROM fill WHERE turn = {sharding.TABLE_SIZE}
)
SELECT doc_id, slot::INTEGER AS slot, shard::INTEGER AS shard
FROM (SELECT doc_id, {_number(f"'{sharding.SEED}:key:' || coalesce(doc_id::VARCHAR, '')")}
             % {sharding.TABLE_SIZE} AS slot FROM documents) JOIN placed USING (slot)
"""

OP10_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         {_number(f"'{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')")} AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM docs GROUP BY source
), steps AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER by_cap AS step,
         ((SELECT sum(source_size) FROM sources) * {mixing.SHARE}::DOUBLE
          - coalesce(sum(2 * source_size) OVER (by_cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (by_cap ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW by_cap AS (ORDER BY 2 * source_size / weight, place)
), opened AS (
  SELECT min(step) AS first_open, arg_min(level, step) AS final
  FROM steps WHERE level <= cap / weight
), targets AS (
  SELECT source, source_size, CASE WHEN step < first_open THEN cap ELSE least(cap, weight * final) END AS target,
         ({_number(f"'{mixing.SEED}:offset:' || coalesce(source, '')")} % 1073741824)::DOUBLE / 1073741824 AS shift
  FROM steps, opened
), placed AS (
  SELECT d.*, t.source_size::BIGINT AS source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS expected,
         row_number() OVER (PARTITION BY d.source ORDER BY
           length(d.size::VARCHAR) * 100 + substr(d.size::VARCHAR, 1, 2)::INTEGER, h, d.size) AS place
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, (floor(place * expected + shift) - floor((place - 1) * expected + shift))::BIGINT AS copies
  FROM placed
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM taken
"""


def _words(table: str, key: str) -> str:
    return f"""SELECT {key}, row_number() OVER () AS row,
      regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table}"""


_SHINGLES = "unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))"

OP7_SQL = f"""
WITH doc_words AS ({_words("documents", "doc_id")}), item_words AS ({_words("benchmark", "item_id")}),
cut AS (SELECT *, least(len(w), {decontaminate.SHINGLE}) AS k FROM item_words WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, row, {_SHINGLES} AS shingle FROM cut),
doc AS (SELECT DISTINCT doc_id, row, {_SHINGLES} AS shingle
        FROM doc_words JOIN (SELECT DISTINCT k FROM cut) ON len(w) >= k),
sizes AS (SELECT item_id, row, count(*)::INTEGER AS n_shingles FROM item GROUP BY ALL),
shared AS (SELECT doc.doc_id, doc.row AS doc_row, item.item_id, item.row, count(*)::INTEGER AS n_shared
           FROM doc JOIN item USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared::DOUBLE / n_shingles AS containment
FROM shared JOIN sizes USING (item_id, row) WHERE n_shared >= {decontaminate.CONTAINMENT} * n_shingles - 1e-9
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_html_extraction": op4_html_extraction,
    "op5_bm25_topk": op5_bm25_topk,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_sharding": op9_sharding,
    "op10_source_mixing": op10_source_mixing,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_scan": op13_secret_scan,
}
ORACLES: dict[str, str] = {"op7_decontamination": OP7_SQL, "op9_sharding": OP9_SQL, "op10_source_mixing": OP10_SQL}
