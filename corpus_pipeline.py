"""The corpus pipeline: documents through five stages, each a Parquet table of the next.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each result to the
session's shared scratch space and reads it back, so a lost executor costs at
most the stage at hand.

Rows with nulls, blank or very long texts, repeats or extra columns pass like
any other, and ids may be of any type that has an order (one that does not read as
a label's id has no label); what each stage does with them is in its operator's module. An empty
table passes all stages and stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, mixing, sharding, simhash, toxicity
from marquee.llm.common import cut_lineage, unused
from marquee.session import scratch_path
from marquee.sources.tables import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    chain = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scores = toxicity.score_column(chain, F.col("text"))
    return docs.where(~toxicity.is_toxic(scores, F.col("text")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id, then the smallest text hash.

    Rows of the same id and text are one document: one of them stays. The texts
    are shuffled once, for the join; dropping repeats needs no other exchange.
    """
    names = [unused(docs, n) for n in ("kept_id", "kept_null", "kept_key")]

    def keys(doc_id: Column, text_key: Column) -> dict[str, Column]:
        return dict(zip(names, (F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull(), text_key)))

    rows = simhash.simhash_groups(docs, shingle=4, max_bits=4, seed=42)
    first = (rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "text_key")).alias("first"))
             .select(F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")))
    kept = cut_lineage(first.withColumns(keys(F.col("id"), F.col("text_key"))).select(*names))
    keyed = docs.withColumns(keys(F.col("doc_id"), F.xxhash64(F.col("text").cast("string"))))
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, once or twice)."""
    return mixing.systematic_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard."""
    return sharding.place(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The classifier of the first stage has no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
