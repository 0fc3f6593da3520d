import random

import pytest

from conftest import SMALL_SF
from helpers import awkward, empty, frame
from marquee.llm import decontaminate
from marquee.llm.queries import QUERIES


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_shingles(words, k):
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def plain_hits(docs, items, share=0.8, k=5):
    """Items of fewer than ``k`` words: their own whole sequence, anywhere in the document."""
    out, docs = [], [(d, plain_words(body)) for d, body in docs]
    for i, text in items:
        words = plain_words(text)
        if not words:
            continue
        cut = min(k, len(words))
        want = plain_shingles(words, cut)
        for d, body in docs:
            n = len(want & plain_shingles(body, cut))
            if n >= share * len(want) - 1e-9:
                out.append((d, i, n, len(want)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.id, r.item_id, r.n_shared, r.n_shingles) for r in df.collect()), key=str)


def test_whole_tables_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL_SF}/benchmark.parquet").collect()]
    got = QUERIES["op7_decontamination"](spark, SMALL_SF).collect()
    want = plain_hits(docs, items)
    assert want and sorted(((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got), key=str) == want


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_borders_of_containment(spark, block):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 15, 30, 64, 65])]
    docs, k = [], 0
    for _, text in items:
        words = text.split()
        for changed in range(0, 4):  # words replaced: around the border of 0.8
            copy = list(words)
            for at in rng.sample(range(len(words)), min(changed, len(words))):
                copy[at] = "zz"
            docs.append((k, " ".join([rng.choice(vocabulary) for _ in range(rng.choice([0, 50, 500]))] + copy + ["tail", "End."]).upper()))
            docs.append((k + 1, ", ".join(copy)))
            k += 2
    got = decontaminate.contained_items(frame(spark, docs), frame(spark, items, "item_id BIGINT, text STRING"),
                                        block_shingles=block)
    assert found(got) == plain_hits(docs, items)


def test_awkward_rows_on_both_sides(spark):
    docs = awkward(spark)
    items = awkward(spark).select("doc_id", "text")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    got = decontaminate.contained_items(docs, items, item_id_col="doc_id")
    assert found(got) == plain_hits(given, given)
    kept = decontaminate.without_items(docs, items.where("doc_id = 1"), item_id_col="doc_id")
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    nothing = frame(spark, [], "item_id BIGINT, text STRING")
    assert decontaminate.contained_items(docs, nothing).count() == 0
    assert decontaminate.without_items(docs, nothing).count() == docs.count()
    assert decontaminate.without_items(empty(spark), items, item_id_col="doc_id").count() == 0


def test_short_items_inside_long_documents(spark):
    items = [(1, "Quartz"), (2, "blue heron"), (3, "the blue heron"), (4, "the blue heron, flies"),
             (5, "the blue heron flies south"), (6, "heron blue"), (7, "--"), (8, None), (8, "blue heron")]
    filler = "grey words of no use " * 3
    long = "many other words here " * 70_000  # over the size that is searched in pieces
    docs = [(1, f"{filler} a Quartz! {filler}"), (2, f"{filler} the blue, HERON flies {filler}"),
            (3, "blue heron"), (4, "heron"), (5, "quartz"), (6, "blue x heron the blue"),
            (7, f"{long}the blue heron {long}"), (8, long), (9, None), (10, "The blue heron flies south. Quartz"),
            (11, long[:(1 << 20) - 5] + " blue heron " + long)]
    got = decontaminate.contained_items(frame(spark, docs), frame(spark, items, "item_id BIGINT, text STRING"))
    want = plain_hits(docs, items)
    assert found(got) == want and {(d, i) for d, i, _, _ in want} >= {
        (1, 1), (2, 2), (2, 3), (2, 4), (3, 2), (5, 1), (7, 3), (10, 5), (11, 8)}
    kept = decontaminate.without_items(frame(spark, docs), frame(spark, items[:1], "item_id BIGINT, text STRING"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7, 8, 9, 11]


def test_sql_searches_short_items_too(spark):
    import duckdb
    import pandas as pd
    from marquee.llm.queries import OP7_SQL

    items = [(1, "Quartz"), (2, "blue heron"), (3, "the blue heron flies"), (4, "the blue heron flies far south"),
             (5, ""), (2, "blue heron")]
    docs = [(1, "some quartz lies here in the sand"), (2, "Look, the blue heron flies far south again"),
            (3, "blue heron"), (4, "heron"), (5, None), (2, "the blue heron")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    want = plain_hits(docs, items)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in con.sql(OP7_SQL).fetchall()), key=str) == want and len(want) == 9
    got = decontaminate.contained_items(frame(spark, docs), frame(spark, items, "item_id BIGINT, text STRING"))
    assert found(got) == want


def test_sketch_meets_every_containing_document():
    for n in range(1, 200):
        missing = n - -(-4 * n // 5)  # most shingles that a containing document may lack
        assert decontaminate.sketch_size(n, 0.8) > missing


def test_equal_items_are_broadcast_once(spark):
    text = " ".join(f"w{i}" for i in range(20))
    items = frame(spark, [(1, text)] * 500 + [(2, text), (None, text), (None, text)], "item_id BIGINT, text STRING")
    blocks = list(decontaminate.item_blocks(items, "item_id", "text", 1 << 20))
    assert [(ids, repeats) for ids, _, repeats in blocks] == [([None, 1, 2], [2, 500, 1])]
    docs = [(7, text), (8, "other words"), (7, text)]
    got = decontaminate.contained_items(frame(spark, docs), items)
    assert found(got) == plain_hits(docs, [(r.item_id, r.text) for r in items.collect()])
    assert decontaminate.without_items(frame(spark, docs), items).count() == 1
