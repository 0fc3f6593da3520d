"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle of pre-tokens.

A byte-level BPE splits a text into pre-tokens and merges within each, so the
count of a text is the sum over its pre-tokens. The token lengths of the most
frequent pre-tokens (found on a bounded sample of texts, at most
``table_size``) are broadcast as a compact table: one joined string and one
byte a length. Tasks look every pre-token up there; a miss is encoded by the
tokenizer library and remembered in the worker's own bounded cache, which
starts over from the broadcast table when it is full. Whole texts are counted;
the sample only decides what is looked up rather than encoded, never a count.

Null text counts as empty. Special strings inside a text count as the library
counts them by default (one token each). Very long texts are split lazily. Rows are
independent: repeated ids, extra columns and empty tables need no care. A file
whose normalizer or splitting differs from the byte-level kind is refused.
"""

from __future__ import annotations

import json
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import str_rows

# Fixed value: the published pattern of byte-level BPE pre-tokens.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

TABLE_SIZE = 1 << 16   # frequent pre-tokens in the broadcast table
SAMPLE_DOCS = 2000     # texts that the frequent pre-tokens are taken from
CACHE_SIZE = 1 << 19   # entries of a worker's cache, the table included
_LONG = 64             # longer pre-tokens are encoded but not remembered
_LONG_TEXT = 1 << 20   # longer texts are split lazily


class Lengths(dict):
    """Pre-token -> number of tokens: the frequent ones, then what this worker met."""

    def __init__(self, frequent: dict[str, int], encode, limit: int = CACHE_SIZE):
        super().__init__(frequent)
        self.frequent, self.encode, self.limit = frequent, encode, max(limit, len(frequent) + 1)

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= _LONG:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def _specials(tokenizer) -> regex.Pattern | None:
    """Pattern of the strings that the library cuts out before it splits a text."""
    added = json.loads(tokenizer.to_str()).get("added_tokens", [])
    plain = [a["content"] for a in added
             if not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"])]
    if len(plain) < len(added):
        raise ValueError("added tokens with stripping, word or normalising rules are not supported")
    plain.sort(key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, plain))) if plain else None


def _require_byte_level(tokenizer_json: str) -> None:
    """``PRE_TOKEN`` splits texts as the library does only for this kind of file."""
    kind = json.loads(tokenizer_json)
    pre = kind.get("pre_tokenizer") or {}
    if (kind.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or kind["model"].get("type", "BPE") != "BPE"):
        raise ValueError("only byte-level BPE files without normalizer and prefix space are supported")


def count_tokens(text: str, lengths: Lengths, pieces: regex.Pattern,
                 specials: regex.Pattern | None) -> int:
    parts = specials.split(text) if specials is not None else [text]
    total = len(parts) - 1
    for part in parts:
        found = pieces.findall(part) if len(part) <= _LONG_TEXT else (
            m.group() for m in pieces.finditer(part))
        total += sum(map(lengths.__getitem__, found))
    return total


_worker: dict = {}  # of this Python worker: the tokenizer and cache of the last table it used


def _counter(tokenizer_json: str, table: tuple[str, bytes, bytes], cache_size: int):
    """The counting function of this worker; its cache outlives a task."""
    from tokenizers import Tokenizer

    key = (hash(tokenizer_json), hash(table), cache_size)
    if _worker.get("key") != key:
        tokenizer = Tokenizer.from_str(tokenizer_json)
        lengths, pieces = Lengths(unpack_table(table), tokenizer.encode, cache_size), regex.compile(PRE_TOKEN)
        specials = _specials(tokenizer)
        _worker.update(key=key, count=lambda text: count_tokens(text, lengths, pieces, specials))
    return _worker["count"]


def pack_table(lengths: dict[str, int]) -> tuple[str, bytes, bytes]:
    """Joined pre-tokens, their character counts (one byte) and token counts (one byte)."""
    fit = {p: n for p, n in lengths.items() if len(p) <= _LONG and n < 256}
    return "".join(fit), bytes(map(len, fit)), bytes(fit.values())


def unpack_table(table: tuple[str, bytes, bytes]) -> dict[str, int]:
    joined, sizes, counts = table
    ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64).tolist()
    return {joined[a:b]: n for a, b, n in zip([0, *ends], ends, counts)}


def frequent_pieces(docs: DataFrame, id_col: str, text_col: str, sample_docs: int,
                    table_size: int) -> list[str]:
    """The most frequent pre-tokens of about ``sample_docs`` texts picked by a hash of the id and row number."""
    every = max(1, docs.count() // max(1, sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = regex.compile(PRE_TOKEN), Counter()
        for batch in batches:
            for text in str_rows(batch.column(0)):
                counts.update(m.group() for m in pieces.finditer(text))
        top = [(p, n) for p, n in counts.most_common(table_size) if len(p) <= _LONG]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    sample = docs.where(F.pmod(F.xxhash64(id_col, F.monotonically_increasing_id()), F.lit(every)) == 0)
    rows = sample.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "piece string, n long")
    total: Counter = Counter()
    for piece, n in rows.collect():  # what the bounded sample holds, at most
        total[piece] += n
    return [p for p, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:table_size]]


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                 table_size: int = TABLE_SIZE, sample_docs: int = SAMPLE_DOCS,
                 cache_size: int = CACHE_SIZE) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row, counted by the byte-level BPE of ``tokenizer_file``.

    The file is read by the driver and travels with the broadcast.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer_json = f.read()
    tokenizer = Tokenizer.from_str(tokenizer_json)
    _require_byte_level(tokenizer_json)
    pieces = frequent_pieces(docs, id_col, text_col, sample_docs, table_size)
    encoded = (tokenizer.encode(p, add_special_tokens=False) for p in pieces)
    table = pack_table({p: len(e.ids) for p, e in zip(pieces, encoded)})
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(*shared.value, cache_size)
        for batch in batches:
            texts = str_rows(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([count(t) for t in texts], pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(run, schema)
