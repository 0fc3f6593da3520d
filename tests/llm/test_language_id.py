import zlib

import numpy as np

from conftest import SMALL_SF
from helpers import awkward, empty, frame
from marquee.llm import language_id
from marquee.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = SMALL_SF.replace("0.001", "0.01")


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in " " + text.lower() + " ")
    squeezed = " " + " ".join(letters.split()) + " "
    return sorted(squeezed[i:i + n] for n in language_id.LENGTHS for i in range(len(squeezed) - n + 1)
                  if " " not in squeezed[i + 1:i + n - 1])


def test_grams_are_those_inside_words_and_their_borders():
    texts = ["Ab c, d!e", "", "x", "  né'e 12 f", "!!", "abc", "abc"]
    owner, hashes = language_id.gram_hashes(texts)
    names = {}
    for i, t in enumerate(texts):
        mine, alone = sorted(hashes[owner == i].tolist()), language_id.gram_hashes([t])[1]
        assert mine == sorted(alone.tolist()) and len(mine) == (len(plain_grams(t)) if any(map(str.isalpha, t)) else 0)
        names.setdefault(tuple(mine), t)
    assert (hashes[owner == 5] == hashes[owner == 6]).all()


def test_filter_gives_all_languages_of_a_gram_and_corrects_counts():
    rng = np.random.default_rng(0)
    grams = [rng.integers(0, 2 ** 63, 5000, dtype=np.uint64) for _ in range(11)]  # two planes
    grams[3] = grams[9][:4000]
    built = language_id.LanguageFilter.build([f"l{i}" for i in range(11)], grams)
    for i, g in enumerate(grams):
        plane, bit = built.planes[i // 8], 1 << (i % 8)
        held = np.bitwise_and.reduce([plane[language_id._rows(g, j)] for j in range(language_id.HASHES)])
        assert (held & bit).all()
    assert (built.false_rate < 0.01).all() and built.false_rate[0] > 0


def test_held_out_accuracy_and_shape(spark):
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.learn(docs)
    rows = docs.withColumn("found", language_id.predict_column(model, spark, F.col("text"))).collect()
    for r in rows:
        assert (r.found.lang == "und") == (not any(map(str.isalpha, r.text or "")))
        assert 0 <= r.found.score <= 1
    nothing = language_id.learn(empty(spark))
    assert {r.found.lang for r in docs.withColumn("found", language_id.predict_column(
        nothing, spark, F.col("text"))).collect()} == {"und"}
    assert empty(spark).withColumn("found", language_id.predict_column(model, spark, F.col("text"))).count() == 0


def test_many_languages(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i * 20 + k, f"{alphabet[i]}{alphabet[(i + 1) % 26]}{alphabet[i]} " * 5, f"l{i:02}") for i in range(20) for k in range(8)]
    model = language_id.learn(frame(spark, rows, "doc_id BIGINT, text STRING, lang STRING"))
    lang, score = model.predict([r[1] for r in rows])
    assert lang == [r[2] for r in rows] and (score == 1).all()


def test_rows_of_a_sample_are_bounded_not_ids(spark, monkeypatch):
    docs = spark.range(400).selectExpr("1L doc_id", "if(id < 300, 'en', 'de') lang", "concat('das und ', id) text")
    kept = []
    monkeypatch.setattr(language_id, "cut_lineage", lambda df: kept.append(df.cache()) or kept[-1])
    language_id.learn(docs, docs_per_language=20)
    assert [r.n for r in kept[0].where("key is null").collect()] == [20, 20]


def test_at_most(spark):
    from marquee.llm.common import at_most

    rows = spark.range(1000).selectExpr("if(id < 700, 'en', 'de') lang", "if(id < 600, 'one text', concat('text ', id)) text")
    got = at_most(rows, 50, "lang").groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"en": 50, "de": 50}
    assert at_most(rows, 60).count() == 60
    assert at_most(rows, 700, "lang").count() == 1000 and at_most(rows.where("false"), 5).count() == 0


def test_the_sample_is_the_lowest_hashes_whatever_the_size(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 50 = 0, 'b', 'a') lang").unionByName(
        spark.range(900).selectExpr("7 id", "'c' lang")).selectExpr("id", "lang", "xxhash64(id, 'language') hashed")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    for n in (1, 20, 100, 10_000):
        few = [tuple(r) for r in language_id._lowest_hashes(rows, sizes, n).collect()]
        for lang, count in sizes.items():
            every = sorted((r.hashed, r.id) for r in rows.where(F.col("lang") == lang).collect())
            kept = sorted((h, i) for i, found, h in few if found == lang)
            assert kept[:n] == every[:n]
            assert len(kept) <= max(10 * n, 40) or lang == "c"
