"""Benchmark passages inside documents: size-partitioned MinHash containment search.

An item is found in a document if at least ``containment`` of its distinct word
shingles occur in it, wherever they stand. Items are partitioned by their
number of shingles into classes up to 2, 4, 8, ... The class decides how many
of an item's smallest MinHash values are kept: with ``u`` the class's largest
size, ``floor((1 - containment) * u) + 1``. A document that contains the item
misses at most ``(1 - containment) * n`` of its shingles, so at least one kept
value is among the document's own: the sketch of the short side meets any
document that contains it, however long, and no contained item is lost. The
same classes bound the other side: a document with fewer shingles than the
containment needs is no candidate. Every candidate is verified on the exact
words of the shared shingles.

The sketches are a lookup table that tasks hold while they pass once over the
documents: no document is shuffled. The table is cut into blocks of a bounded number
of shingles, whatever the number of items, and each block is one pass.

Words are runs of letters and digits, lower-cased. An item of fewer words than a
shingle has its whole sequence as its only one, and is found wherever a document
holds these words one after another: documents are also cut into shingles of
every such length that items have (at most ``shingle - 1`` more lengths). A
document of fewer words than an item's shingle does not hold it. Null or wordless items
are in no document; null or wordless documents hold no item. Repeated item or
document rows are matched row by row. Without items or documents nothing is found;
columns beside id and text are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import cut_at_blanks, groups_by_size, mix64
from marquee.llm.wordhash import HashTable, Words

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_SHINGLES = 1 << 20  # shingles of items in one broadcast table
_CHARS = 1 << 20          # characters hashed at a time
_HITS = "array<struct<item:string,n_shared:int,n_shingles:int,repeats:bigint>>"


def sketch_size(n: int, containment: float) -> int:
    """Kept MinHash values of an item with ``n`` shingles, by its size class."""
    upper = 1 << max(0, n - 1).bit_length()
    return min(n, int((1 - containment) * upper + 1e-9) + 1)


class ItemTable:
    """Sketch table of a block of items, with the words needed to verify a candidate."""

    def __init__(self, texts: list[str], shingle: int = SHINGLE, containment: float = CONTAINMENT):
        self.shingle, self.containment = shingle, containment
        self.items: list[dict[int, set]] = []  # per item: shingle hash -> its word sequences
        self.sizes = np.zeros(len(texts), np.int64)
        self.lengths = np.zeros(len(texts), np.int64)  # words of an item's shingles
        keys, owners = [], []
        for i, text in enumerate(texts):
            found = _sequences(text, shingle)
            self.items.append(found)
            self.sizes[i] = sum(map(len, found.values()))
            self.lengths[i] = max((len(s) for same in found.values() for s in same), default=0)
            hashes = np.fromiter(found, np.uint64, len(found))
            smallest = hashes[np.argsort(mix64(hashes), kind="stable")][:sketch_size(len(hashes), containment)] \
                if len(hashes) else hashes
            keys.append(smallest)
            owners.append(np.full(len(smallest), i))
        every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        self.cuts = [int(n) for n in np.unique(self.lengths) if n]
        distinct, inverse = np.unique(every, return_inverse=True)
        self.table = HashTable(distinct)
        self.owners = [owner[inverse == k].tolist() for k in range(len(distinct))] \
            if len(distinct) < 4096 else _grouped(owner, inverse, len(distinct))

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text: ``(item, shared shingles, shingles of the item)`` of the items in it."""
        out: list[list] = [[] for _ in texts]
        for lo, hi in groups_by_size([len(t) + 1 for t in texts], _CHARS):
            if hi - lo == 1 and len(texts[lo]) > _CHARS:
                out[lo] = self._search_long(texts[lo])
                continue
            words = Words(texts[lo:hi])
            for cut in self.cuts:
                self._search_words(words, cut, out[lo:hi])
        return out

    def _search_words(self, words: Words, cut: int, out: list[list]) -> None:
        """Adds the items with shingles of ``cut`` words to the lists of their texts."""
        begin, hashes = _full_shingles(words, cut)
        at, place = self.table.find(hashes)
        if not len(at):
            return
        owner = words.text[begin]
        candidates = sorted({(int(owner[a]), i) for a, p in zip(at, place) for i in self.owners[p]
                             if self.lengths[i] == cut})
        edges = np.searchsorted(owner, np.arange(len(out) + 1))
        for t, i in candidates:
            a, b = int(edges[t]), int(edges[t + 1])
            if b - a >= self.containment * self.sizes[i] - 1e-9:
                out[t] += self._verified(i, self._shared(words, i, begin[a:b], hashes[a:b]))

    def _verified(self, item: int, met: set) -> list[tuple[int, int, int]]:
        enough = len(met) >= self.containment * self.sizes[item] - 1e-9
        return [(item, len(met), int(self.sizes[item]))] if enough else []

    def _search_long(self, text: str) -> list[tuple[int, int, int]]:
        """The same for one long text, piece by piece: candidates first, then their shared words."""
        out: list[tuple[int, int, int]] = []
        for cut in self.cuts:
            candidates: set[int] = set()
            for _, _, hashes in _long_shingles(text, cut):
                candidates.update(i for p in self.table.find(hashes)[1] for i in self.owners[p]
                                  if self.lengths[i] == cut)
            met: dict[int, set] = {i: set() for i in sorted(candidates)}
            for words, begin, hashes in _long_shingles(text, cut) if met else ():
                for i, found in met.items():
                    found |= self._shared(words, i, begin, hashes)
            out += [hit for i, found in met.items() for hit in self._verified(i, found)]
        return out

    def _shared(self, words: Words, item: int, begin, hashes) -> set:
        """Distinct word sequences of the item that stand in the document."""
        known, met, cut = self.items[item], set(), int(self.lengths[item])
        for k in np.flatnonzero(np.isin(hashes, np.fromiter(known, np.uint64, len(known)))):
            sequence = tuple(words.word(int(begin[k]) + j) for j in range(cut))
            if sequence in known[int(hashes[k])]:
                met.add(sequence)
        return met


def _full_shingles(words: Words, cut: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the shingles that have ``cut`` words, none fewer."""
    begin, length, hashes = words.shingles(cut)
    full = length == cut
    return begin[full], hashes[full]


def _long_shingles(text: str, cut: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Shingles by piece; a piece starts again at the last words of the one before."""
    lowered, lo, limit = text.lower(), 0, _CHARS
    while True:
        hi = cut_at_blanks(lowered, limit, lo)
        words = Words([lowered[lo:hi]])
        if hi < len(lowered) and len(words.begin) < 2 * cut:
            limit *= 2  # words of enormous length
            continue
        yield words, *_full_shingles(words, cut)
        if hi == len(lowered):
            return
        lo, limit = lo + int(words.begin[1 - cut]) if cut > 1 else hi, _CHARS


def _grouped(owner: np.ndarray, inverse: np.ndarray, n: int) -> list[list[int]]:
    order = np.argsort(inverse, kind="stable")
    edges = np.searchsorted(inverse[order], np.arange(n + 1))
    return [owner[order[a:b]].tolist() for a, b in zip(edges, edges[1:])]


def _sequences(text: str, shingle: int) -> dict[int, set]:
    words = Words([text])
    out: dict[int, set] = {}
    for a, n, h in zip(*words.shingles(shingle)):
        out.setdefault(int(h), set()).add(tuple(words.word(int(a) + j) for j in range(int(n))))
    return out


def _search_column(spark, ids: list, texts: list[str], repeats: list[int], text: Column, shingle: int,
                   containment: float) -> Column:
    shared = spark.sparkContext.broadcast(([None if i is None else str(i) for i in ids], texts, repeats))

    @F.pandas_udf(_HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids, texts, repeats = shared.value
        table = ItemTable(texts, shingle, containment)
        for batch in batches:
            hits = table.search([t or "" for t in batch])
            yield pd.Series([[{"item": ids[i], "n_shared": s, "n_shingles": n, "repeats": repeats[i]} for i, s, n in h]
                             for h in hits], index=batch.index, dtype=object)

    return search(text.cast("string"))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_shingles: int):
    """The items as ``(ids, texts, repeats)`` blocks, each with a bounded amount of text for one broadcast.

    A word has two characters at least (itself and a blank), so characters
    bound shingles; an item larger than a block is a block of its own. Equal
    item rows are one item with their number in ``repeats``.
    """
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0)) + 1
    total = rows.distinct().agg(F.sum(size.cast("bigint"))).first()[0] or 0
    n = -(-total // (2 * block_shingles)) if total else 0
    for k in range(n):
        part = (rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).groupBy("id", "text")
                .agg(F.count(F.lit(1)).alias("repeats")).orderBy("id", "text").collect())
        if part:
            yield [r.id for r in part], [r.text or "" for r in part], [r.repeats for r in part]


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
                    containment: float = CONTAINMENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``(id, item_id, n_shared, n_shingles, containment)`` of every item found in a document row."""
    spark = docs.sparkSession
    item_type = items.schema[item_id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for ids, texts, repeats in item_blocks(items, item_id_col, item_text_col, block_shingles):
        hits = rows.select("id", F.explode(_search_column(spark, ids, texts, repeats, F.col("text"),
                                                            shingle, containment)).alias("hit"))
        if max(repeats) > 1:
            hits = hits.select("id", "hit", F.explode(F.sequence(F.lit(1), F.col("hit.repeats")))).select("id", "hit")
        found = hits.select("id", F.col("hit.item").cast(item_type).alias("item_id"),
                            "hit.n_shared", "hit.n_shingles",
                            (F.col("hit.n_shared") / F.col("hit.n_shingles")).alias("containment"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.where("false").select("id", F.lit(None).cast(item_type).alias("item_id"),
                                         F.lit(0).alias("n_shared"), F.lit(1).alias("n_shingles"),
                                         F.lit(0.0).alias("containment"))
    return out


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", shingle: int = SHINGLE, containment: float = CONTAINMENT,
                  block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are."""
    for ids, texts, repeats in item_blocks(items, item_id_col, item_text_col, block_shingles):
        hits = _search_column(docs.sparkSession, ids, texts, repeats, F.col(text_col), shingle, containment)
        docs = docs.where(F.size(hits) == 0)
    return docs
