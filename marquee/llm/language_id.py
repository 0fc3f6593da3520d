"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter has one row for each hash position and one bit for
each language in a row. The rows at an n-gram's positions, combined by AND,
give at once the set of all languages whose filter holds the n-gram. Over a
text's n-grams the bits are counted for each language; a filter whose slice is
filled to a share ``f`` reports an unknown n-gram with probability ``f ** k``,
so the count is corrected to ``(hits - n * f ** k) / (1 - f ** k)``, and the
largest corrected count decides. The score is its share of all languages'
corrected counts.

The filters hold character n-grams inside words with their borders, chosen on
a bounded sample (``docs_per_language`` by hash of the id): an n-gram belongs
to the languages in which it occurs in at least ``least_share`` of the share of
documents it reaches in its best language, most frequent ones first, at most
``grams_per_language``. Counting the sample runs as a partial aggregation;
the driver receives only the chosen n-grams' hashes. Prediction is one map
over whole texts without a shuffle, and uses the text alone.

Null text, or text without a letter, is ``und`` with score 0. A text none of
whose n-grams is known gets the most frequent learned language with score 0;
without any learned language everything is ``und``. Repeated rows and equal texts
get equal results; very long texts are counted in pieces cut at blanks, with the
same counts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import at_most, cut_lineage, groups_by_size, mix64, pieces, str_rows
from marquee.llm.wordhash import char_table, code_points

LENGTHS = (3, 4)
DOCS_PER_LANGUAGE = 2000
GRAMS_PER_LANGUAGE = 20000
MIN_DOCS = 3
LEAST_SHARE = 0.3
FILTER_BITS = 18  # rows of the filter, as a power of two
HASHES = 3
_CHARS = 1 << 20
_PLANE = 8        # languages in one byte


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, hash)`` of every n-gram inside a word and its borders, repeats included."""
    codes, starts = code_points([" " + t.lower() for t in texts])
    letter = char_table("isalpha")[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]   # one border after a word
    keep[:-1] |= letter[1:]   # and one before it
    at = np.flatnonzero(keep)
    letter = letter[at]
    chars = np.where(letter, codes[at], 32).astype(np.uint64)
    text = (np.searchsorted(starts, at, side="right") - 1).astype(np.int64)
    owners, hashes = [], []
    for n in LENGTHS:
        size = len(chars) - n + 1
        if size <= 0:
            continue
        whole = np.ones(size, bool)
        for j in range(1, n - 1):
            whole &= letter[j:j + size]
        h = np.full(size, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + chars[j:j + size]
        # A gram that starts at a border of the text before belongs to its letters' text.
        owners.append(text[1:1 + size][whole])
        hashes.append(mix64(h[whole]))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(hashes)


def gram_groups(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first text, end, number from there, hash)`` by group of texts; a long one comes in several groups."""
    for lo, hi in groups_by_size([len(t) + 2 for t in texts], _CHARS):
        for part in ([p] for p in pieces(texts[lo], _CHARS)) if hi - lo == 1 else (texts[lo:hi],):
            yield lo, hi, *gram_hashes(part)


def _rows(hashes: np.ndarray, j: int) -> np.ndarray:
    return ((hashes >> np.uint64(j * FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


@dataclass
class LanguageFilter:
    """Bit-sliced Bloom filter; ``planes[p][row]`` holds the bits of languages 8p to 8p+7."""

    languages: list[str]
    planes: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], grams: list[np.ndarray]) -> "LanguageFilter":
        planes = np.zeros((max(1, -(-len(languages) // _PLANE)), 1 << FILTER_BITS), np.uint8)
        rate = np.zeros(len(languages))
        for i, hashes in enumerate(grams):
            bit = np.uint8(1 << (i % _PLANE))
            for j in range(HASHES):
                planes[i // _PLANE, _rows(hashes, j)] |= bit
            rate[i] = ((planes[i // _PLANE] & bit) > 0).mean() ** HASHES
        return LanguageFilter(languages, planes, rate)

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts ``(texts, languages)``, and which texts have a letter."""
        hits = np.zeros((len(texts), len(self.planes) * _PLANE))
        total = np.zeros(len(texts))
        bits = (np.arange(256)[:, None] >> np.arange(_PLANE)) & 1
        for lo, hi, owner, hashes in gram_groups(texts):
            total[lo:hi] += np.bincount(owner, minlength=hi - lo)
            rows = [_rows(hashes, j) for j in range(HASHES)]
            for p, plane in enumerate(self.planes):
                held = plane[rows[0]]
                for r in rows[1:]:
                    held &= plane[r]
                by_set = np.bincount(owner * 256 + held, minlength=(hi - lo) * 256).reshape(-1, 256)
                hits[lo:hi, p * _PLANE:(p + 1) * _PLANE] += by_set @ bits
        f = self.false_rate
        corrected = (hits[:, :len(f)] - total[:, None] * f) / np.maximum(1 - f, 1e-9)
        return np.maximum(corrected, 0), total > 0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        counts, lettered = self.counts(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        best, total = counts.argmax(1), counts.sum(1)
        top = counts[np.arange(len(texts)), best]
        score = np.where(lettered & (total > 0), top / np.maximum(total, 1e-9), 0.0)
        return [self.languages[b] if x else "und" for b, x in zip(best, lettered)], score


def _lowest_hashes(rows: DataFrame, sizes: dict[str, int], n: int) -> DataFrame:
    """Rows that hold the ``n`` lowest hashes of every language, and few others, however many rows it has.

    A bound that about four times as many rows pass follows from the count of a
    language; one whose hashes crowd above it (an id in many rows) keeps all its rows.
    """
    top, bounds = (1 << 63) - 1, {}
    for lang, count in sizes.items():
        bounds[lang] = min(top, -(1 << 63) + (1 << 64) * 4 * n // max(count, 1))
    for _ in range(2):
        bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
        few = rows.where(F.col("hashed") <= bound[F.col("lang")])
        passed = {r["lang"]: r["count"] for r in few.groupBy("lang").count().collect()}  # one row a language
        short = [lang for lang, count in sizes.items() if passed.get(lang, 0) < min(n, count)]
        if not short:
            break
        bounds |= dict.fromkeys(short, top)
    return few


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          docs_per_language: int = DOCS_PER_LANGUAGE,
          grams_per_language: int = GRAMS_PER_LANGUAGE) -> LanguageFilter:
    """The filter of the languages of ``docs`` (labelled training rows), most frequent language first."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"))
    sizes = rows.groupBy("lang").count().collect()  # one row a language
    languages = [r["lang"] for r in sorted(sizes, key=lambda r: (-r["count"], r["lang"]))]
    if not languages:
        return LanguageFilter.build([], [])
    order = Window.partitionBy("lang").orderBy("hashed", "id")
    hashed = rows.select("id", "lang", F.xxhash64("id", F.lit("language")).alias("hashed"))
    chosen = (_lowest_hashes(hashed, {r["lang"]: r["count"] for r in sizes}, docs_per_language)
              .withColumn("nth", F.row_number().over(order))
              .where(F.col("nth") <= docs_per_language).select(F.col("id").alias("s_id"), F.col("lang").alias("s_lang")))
    sample = at_most(  # an id may stand in many rows
        rows.join(F.broadcast(chosen), (F.col("id") == F.col("s_id")) & (F.col("lang") == F.col("s_lang")),
                  "left_semi").select("lang", "text"), docs_per_language, "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            langs = np.array([number[v] for v in batch.column(0).to_pylist()], np.int64)
            texts = str_rows(batch.column(1))
            for (lo, hi), group in groupby(gram_groups(texts), key=lambda g: g[:2]):
                owner, hashes = map(np.concatenate, zip(*((o, h) for _, _, o, h in group)))
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
                lang, hashes = langs[lo:hi][owner[new]], hashes[new]
                for i in np.unique(lang):
                    keys, n = np.unique(hashes[lang == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), i, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)],
                        ["lang", "key", "n"])
                seen, n = np.unique(langs[lo:hi], return_counts=True)
                yield pa.RecordBatch.from_arrays(  # key null: the number of documents
                    [pa.array(seen.astype(np.int32)), pa.array([None] * len(seen), pa.int64()), pa.array(n)],
                    ["lang", "key", "n"])

    counted = cut_lineage(sample.mapInArrow(count, "lang int, key long, n long")
                          .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    documents = {r["lang"]: r["n"] for r in counted.where("key is null").collect()}
    size = F.coalesce(*[F.when(F.col("lang") == i, F.lit(float(n))) for i, n in documents.items()], F.lit(1.0))
    rated = counted.where((F.col("key").isNotNull()) & (F.col("n") >= MIN_DOCS)).withColumn("rate", F.col("n") / size)
    best = rated.groupBy("key").agg(F.max("rate").alias("best"))
    by_use = Window.partitionBy("lang").orderBy(F.col("n").desc(), "key")
    held = (rated.join(best, "key").where(F.col("rate") >= F.col("best") * LEAST_SHARE)
            .withColumn("nth", F.row_number().over(by_use)).where(F.col("nth") <= grams_per_language)
            .select("lang", "key").collect())
    grams: list[list[int]] = [[] for _ in languages]
    for r in held:
        grams[r["lang"]].append(r["key"])
    return LanguageFilter.build(languages, [np.array(g, np.int64).view(np.uint64) for g in grams])


def predict_column(languages: LanguageFilter, spark, text: Column) -> Column:
    """Struct ``(lang, score)`` of a text column."""
    shared = spark.sparkContext.broadcast(languages)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, score = shared.value.predict([t or "" for t in batch])
            yield pd.DataFrame({"lang": lang, "score": score}, index=batch.index)

    return predict(text.cast("string"))
