import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL_SF
from helpers import awkward, empty, frame
from marquee.llm import toxicity

SF = SMALL_SF.replace("0.001", "0.01")


def scored(docs, chain):
    scores = toxicity.score_column(chain, F.col("text"))
    return docs.withColumn("scores", scores).withColumn(
        "flag", toxicity.is_toxic(F.col("scores"), F.col("text")))


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 3 <> 0"))
    rows = scored(docs, chain).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.flag for r in clean) <= 0.02 * len(clean)
    english = [r for r in toxic if r.lang == "en"]
    assert sum(r.flag for r in english) >= 0.8 * len(english)
    low = [r.scores.low_quality for r in rows if r.quality == 0]
    high = [r.scores.low_quality for r in rows if r.quality == 1]
    assert np.mean(low) > 0.7 and np.mean(high) < 0.1


def test_later_model_learns_from_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    n = 300
    first = rng.integers(0, 2, n)
    # A column a row of its own gives category one away only in the rows it was fitted on.
    rows = [np.array([i]) for i in range(n)]
    sparse = toxicity.SparseRows(rows, n)
    labels = np.column_stack([first, first]).astype(float)
    chain = toxicity.fit_chain(sparse, labels, np.arange(n) % toxicity.FOLDS, ("a", "b"), np.arange(n, dtype=np.uint64))
    # Out of fold, category one is unknown, so its probability gets no weight worth the name.
    assert abs(chain.models[1].earlier[0]) < 1
    told = toxicity.SparseRows([np.array([int(v)]) for v in first], 2)
    chain = toxicity.fit_chain(told, labels, np.arange(n) % toxicity.FOLDS, ("a", "b"), np.arange(2, dtype=np.uint64))
    assert chain.models[1].earlier[0] > 1
    assert ((chain.predict(told)[:, 1] > 0.5) == first.astype(bool)).all()


def test_fit_reaches_the_optimum():
    rng = np.random.default_rng(1)
    dense = (rng.random((200, 12)) < 0.3).astype(float)
    y = (dense[:, 0] + dense[:, 3] + rng.random(200) > 1.1).astype(float)
    sparse = toxicity.SparseRows([np.flatnonzero(r) for r in dense], 12)
    model = toxicity.fit_linear(sparse, np.zeros((200, 0)), y, np.ones(200, bool))
    p = 1 / (1 + np.exp(-(dense @ model.weights + model.bias)))
    assert np.abs(dense.T @ (p - y) + toxicity._RIDGE * model.weights).max() < 0.05
    assert abs((p - y).sum()) < 0.05


def test_stems_and_long_texts(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(3, 9)))
    docs, labels = [], []
    for i in range(600):
        words = [word() for _ in range(60)]
        if i % 5 == 0:
            words[7] = "zorgel" + word()
            words[31] = "zorgel" + word()
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    labels += [(3, None, None), (None, 1, 1), (5, 0, 0)]
    chain = toxicity.train(frame(spark, docs), frame(spark, labels, "doc_id BIGINT, quality INT, toxic INT"))
    tests = frame(spark, [(1, "zorgelix " + " ".join(word() for _ in range(20000)) + " Zorgelaum"),
                          (2, " ".join(word() for _ in range(20000))), (3, None), (4, "")])
    assert [r.flag for r in scored(tests, chain).orderBy("doc_id").collect()] == [True, False, False, False]


def test_without_labels_nothing_is_toxic(spark):
    docs = awkward(spark)
    none = frame(spark, [], "doc_id BIGINT, quality INT, toxic INT")
    one_sided = frame(spark, [(1, 1, 1), (8, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
    for labels in (none, one_sided):
        rows = scored(docs, toxicity.train(docs, labels)).collect()
        assert len(rows) == docs.count()
        assert not any(r.flag for r in rows if not (r.text or "").strip())
        assert all(0 <= r.scores.toxic <= 1 for r in rows)
    assert not any(r.flag for r in scored(docs, toxicity.train(docs, none)).collect())
    assert scored(empty(spark), toxicity.train(empty(spark), none)).count() == 0


def test_a_repeated_id_leaves_the_sample_bounded(spark):
    docs = spark.range(900).selectExpr("if(id < 600, 0, id) doc_id", "concat('some words ', id) text")
    labels = spark.range(900).where("id = 0 or id >= 600").selectExpr("id doc_id", "double(id % 2) toxic")
    rows = toxicity._training_rows(docs, labels, "doc_id", "text", ("toxic",), 301)
    assert rows.count() == 301 and rows.distinct().count() == 301
    same = docs.selectExpr("doc_id", "if(doc_id = 0, 'one text', text) text")
    assert toxicity._training_rows(same, labels, "doc_id", "text", ("toxic",), 310).count() == 310
    assert toxicity._training_rows(docs.where("doc_id > 0"), labels, "doc_id", "text", ("toxic",), 301).count() == 300


def test_features_and_folds_know_nothing_of_the_held_out_fold(spark):
    rows = spark.range(900).selectExpr(
        "int(id % 3) fold", "concat('plain text ', if(id % 6 = 0, 'onlyzero', if(id % 2 = 0, 'everywhere', 'other'))) text",
        "double(id % 2 = 0) y0")
    keys, chosen = toxicity._select_features(rows, ("bad",), 100, 5)
    place = {w: int(np.flatnonzero(keys == toxicity.Words([w]).hash[0])[0]) for w in ("onlyzero", "everywhere")}
    assert [bool(c[place["onlyzero"]]) for c in chosen] == [False, True, True, True]
    assert [bool(c[place["everywhere"]]) for c in chosen] == [True] * 4
    copies = spark.range(60).selectExpr("id doc_id", "concat('text ', id % 6) text")
    labels = spark.range(60).selectExpr("id doc_id", "double(id % 2) toxic")
    dealt = toxicity._training_rows(copies, labels, "doc_id", "text", ("toxic",), 100).select("text", "fold").distinct()
    assert dealt.count() == 6
