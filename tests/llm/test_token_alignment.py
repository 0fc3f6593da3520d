import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SMALL_SF
from helpers import LONG, awkward, empty, frame
from marquee.llm import token_alignment as ta
from marquee.llm.queries import PIECES, QUERIES, TOKENIZER

A, B = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = ta.byte_alphabet()
    vocab = json.loads(a.to_str())["model"]["vocab"]
    a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
    b_bytes = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        b_bytes[i] = bytes([int(p[3:5], 16)]) if p[:3] == "<0x" else p.replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def brute(texts, libraries):
    """Whole-text encodings, groups cut by common ends, counts by nested loops."""
    a, b, a_bytes, b_bytes = libraries
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if b"".join(a_bytes[i] for i in ids_a) != raw or b"".join(b_bytes[i] for i in ids_b) != raw:
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(a_bytes[i]) for i in ids_a]), np.cumsum([len(b_bytes[i]) for i in ids_b])
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        at_a, at_b = (dict(zip(e.tolist(), i)) for e, i in ((ends_a, ids_a), (ends_b, ids_b)))
        links = [(at_a[e], at_b[e]) for e in common]
        groups, i, j = [], 0, 0
        for e in common:
            lo_i, lo_j = i, j
            while i < len(ends_a) and ends_a[i] <= e:
                i += 1
            while j < len(ends_b) and ends_b[j] <= e:
                j += 1
            groups.append(",".join(map(str, ids_a[lo_i:i])) + "|" + ",".join(map(str, ids_b[lo_j:j])))
        found.append((len(ids_a), len(ids_b), links, ";".join(groups)))
    counts = Counter(link for f in found if f for link in f[2])
    top = Counter()
    for (x, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[2]), sum(counts[x] == top[x[1]] for x in f[2]), sum(counts[x] for x in f[2]),
             hashlib.sha256(f[3].encode()).hexdigest()) for f in found]


def values(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256)


def test_whole_table_equals_brute_force(spark, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}
    rows = {r.doc_id: values(r) for r in QUERIES["op11_token_alignment"](spark, SMALL_SF).collect()}
    assert rows == dict(zip(docs, brute(docs.values(), libraries)))


TRICKY = ["<|endoftext|> and <s> </s> <unk>", "a<|endoftext|>  b", "  \n\n x  ", "it's I'LL don't 's''s", "x" * 3000,
          "a\n  b\n \n   c \t d", "a \n", " ", "   ", "\n", "　 \x85 \xa0z", "Ⅷ²½ 12٣", "é‍🙂👩‍👩‍👧", "▁x", "a ▁ b", "ﬁ ﬀ ½",
          "\x00 \x01a", "\x1c b \x1d  c", "漢字 かな  交じり", "<0x41> <0x0A>", "tab\tseparated\tvalues  ", None, ""]


@pytest.mark.parametrize("table, cache", [(1 << 20, 1 << 18), (50, 7), (0, 1)])
def test_tricky_texts_small_tables_and_caches(spark, libraries, table, cache):
    texts = [*TRICKY, *(t and f"{t} the end of the text" for t in TRICKY)]
    docs = frame(spark, list(enumerate(texts)))
    rows = ta.align(docs, A, B, table_size=table, cache_size=cache).orderBy("id").collect()
    assert [values(r) for r in rows] == brute(texts, libraries)


def test_pieces_and_blocks_equal_whole_texts(libraries):
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        pair = ta.Pair(f.read(), g.read())
    texts = ["some words  in a row\n and more of them " * 40, LONG, "", "short one", *[t for t in TRICKY if t]]
    id_texts = ta._id_texts(60_000)
    whole = ta.align_texts(pair, texts, id_texts, 1 << 30, 1 << 30)
    cut = ta.align_texts(pair, texts, id_texts, 50, 7)
    for w, c in zip(whole, cut):
        assert (w.n_a, w.n_b, w.n_groups, w.digest.hexdigest()) == (c.n_a, c.n_b, c.n_groups, c.digest.hexdigest())
        assert w.all_links().tolist() == c.all_links().tolist()
    assert "".join("".join(p) for p in ta.unit_pieces(LONG, 1000)) == " " + LONG


def test_doubling_needs_few_rounds():
    # Tokens of two bytes each, shifted by one: one group of all of them, the longest possible chain.
    n = 1 << 14
    ends_a, ends_b = np.arange(2, 2 * n + 2, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    label, rounds = ta.group_labels(ends_a, ends_b)
    assert set(label.tolist()) == {n - 1} and rounds <= 17


def test_awkward_rows(spark, libraries):
    docs = awkward(spark)
    texts = docs.collect()
    rows = ta.align(docs, A, B).collect()
    want = sorted(zip([str(r.doc_id) for r in texts], brute([r.text for r in texts], libraries)))
    assert sorted((str(r.id), values(r)) for r in rows) == want
    assert ta.align(empty(spark), A, B).count() == 0
    assert ta.align(docs.selectExpr("string(doc_id) doc_id", "text"), A, B).count() == docs.count()
