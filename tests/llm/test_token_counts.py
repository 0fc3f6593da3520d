import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SMALL_SF
from helpers import awkward, empty, frame
from marquee.llm import token_counts
from marquee.llm.queries import QUERIES, TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)


def library_counts(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_table_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}
    rows = QUERIES["op8_token_counts"](spark, SMALL_SF).collect()
    assert len(rows) == len(texts)
    for row, n in zip(rows, library_counts(texts[r.doc_id] for r in rows)):
        assert (row.n_tokens, row.over_limit) == (n, n > 512)
        assert row.n_bytes == len((texts[row.doc_id] or "").encode())


TRICKY = ["<|endoftext|>", "a<|endoftext|>  b<|endoftext|><|endoftext|>", "  \n\n x  ", "it's I'LL don't 's''s", "x" * 5000,
          "a  <|endoftext|>", "　 \x85 \xa0z", "Ⅷ²½ 12٣", "é‍🙂👩‍👩‍👧", "<|endoftext|", None, ""]


@pytest.mark.parametrize("cache, table", [(1 << 19, 1 << 16), (3, 2), (1, 0)])
def test_tricky_texts_and_small_caches(spark, cache, table):
    docs = frame(spark, list(enumerate(TRICKY)))
    rows = token_counts.token_counts(docs, PATH, cache_size=cache, table_size=table).orderBy("id").collect()
    assert [r.n_tokens for r in rows] == library_counts(TRICKY)


def test_table_round_trip():
    lengths = {" the": 1, "é\n": 3, "": 1, "x" * 64: 9}
    assert token_counts.unpack_table(token_counts.pack_table({**lengths, "y" * 65: 2, "z": 300})) == lengths


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = token_counts.token_counts(docs, PATH).collect()
    want = sorted(zip([str(r.doc_id) for r in docs.collect()], library_counts(r.text for r in docs.collect())))
    assert sorted((str(r.id), r.n_tokens) for r in rows) == want
    assert token_counts.token_counts(empty(spark), PATH).count() == 0


def test_the_sample_does_not_take_every_row_of_one_id(spark):
    docs = spark.range(0, 4000, 1, 4).selectExpr("CAST(NULL AS BIGINT) doc_id", "concat('x', id) text")
    pieces = token_counts.frequent_pieces(docs, "doc_id", "text", 100, 100_000)
    assert 0 < len(pieces) < 400
    one = docs.selectExpr("7L doc_id", "text")
    assert 0 < len(token_counts.frequent_pieces(one, "doc_id", "text", 100, 100_000)) < 400


def test_other_kinds_of_files_are_refused(spark):
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.token_counts(frame(spark, [(1, "x")]), public_tokenizers.path("word_bpe_49k.json"))
