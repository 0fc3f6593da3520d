import pytest

import corpus_pipeline
from conftest import SMALL_SF
from helpers import BASE, CLASHING, LONG, awkward, empty
from marquee.llm import mixing, sharding, toxicity
from pyspark.sql import functions as F
from test_decontaminate import plain_hits
from test_sharding import number, plain_table
from test_simhash import plain_components, plain_fingerprint

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL_SF}/documents.parquet").cache()


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages_equal_brute_force_on_their_own_inputs(spark, docs):
    rows = docs.collect()
    chain = toxicity.train(docs, spark.read.parquet(f"{SMALL_SF}/labels.parquet"))
    flagged = docs.where(toxicity.is_toxic(toxicity.score_column(chain, F.col("text")), F.col("text")))
    assert ids(STAGES["toxicity"](spark, docs, SMALL_SF)) == sorted(set(ids(docs)) - set(ids(flagged)), key=str)
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    assert ids(STAGES["simhash_dedup"](spark, docs, SMALL_SF)) == sorted(set(plain_components(prints, 4)), key=str)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL_SF}/benchmark.parquet").collect()]
    leaks = {h[0] for h in plain_hits([(r.doc_id, r.text) for r in rows], items)}
    assert ids(STAGES["decontamination"](spark, docs, SMALL_SF)) == sorted(set(ids(docs)) - leaks, key=str)
    plan = mixing.mix_plan(docs).collect()
    assert ids(STAGES["mixing"](spark, docs, SMALL_SF)) == sorted(
        (r["row"]["doc_id"] for r in plan for _ in range(r["copies"])), key=str)
    table = plain_table(sharding.N_SHARDS, sharding.TABLE_SIZE, sharding.SEED)
    for r in STAGES["sharding"](spark, docs, SMALL_SF).collect():
        assert r.shard == table[number(f"{sharding.SEED}:key:{r.doc_id}") % sharding.TABLE_SIZE]


def test_run_is_the_stages_one_after_another(spark, docs):
    out = corpus_pipeline.run(spark, SMALL_SF)
    assert out.columns == [*docs.columns, "slot", "shard"]
    expected = docs
    for _, stage in corpus_pipeline.STAGES:
        expected = stage(spark, expected, SMALL_SF)
    assert sorted(map(str, out.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_takes_awkward_and_empty_tables(spark, name):
    given = awkward(spark)
    out = STAGES[name](spark, given, SMALL_SF)
    kept = out.collect()
    if name == "sharding":
        assert set(out.columns) == set(given.columns) and len(kept) == given.count()
    else:
        assert out.columns == given.columns and out.schema["doc_id"] == given.schema["doc_id"]
        assert all(getattr(r, c) == f"{c}!" for r in kept for c in CLASHING)
    if name == "decontamination" or name == "toxicity":
        assert len(kept) == given.count()
    if name == "simhash_dedup":  # copies, repeats, and all rows without a word
        assert sorted((str(r.doc_id), (r.text or "")[:3]) for r in kept) == sorted(
            [("1", "The"), ("3", ""), ("None", "Ein"), ("6", LONG[:3]), ("7", "123"), ("8", "one"), ("9", "naï")])
    assert STAGES[name](spark, empty(spark), SMALL_SF).count() == 0
    assert STAGES[name](spark, empty(spark), SMALL_SF).columns[:5] == [c.split()[0] for c in BASE.split(", ")]


def test_ids_may_be_text(spark, docs):
    named = docs.withColumn("doc_id", F.concat(F.lit("d-"), F.col("doc_id"))).unionByName(
        docs.limit(3).withColumn("doc_id", F.lit(None).cast("string"))).cache()
    plain = {"d-" + str(i) for i in ids(STAGES["simhash_dedup"](spark, docs, SMALL_SF))}
    kept = ids(STAGES["simhash_dedup"](spark, named, SMALL_SF))
    assert len(kept) == len(plain) and len(set(kept)) == len(kept)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, named, SMALL_SF)
        assert out.schema["doc_id"].dataType.typeName() == "string" and out.count() > 0, name
