"""Toxicity by a classifier chain over label categories.

The categories are predicted one after another by linear (logistic) models.
Each model sees a text's features and the probabilities of all categories
before it. For training these probabilities are out of fold: a document's are
predicted by models whose features were chosen and whose weights were fitted without
its fold, so a later model learns from inputs as uncertain as those it will meet.
Folds are dealt by text, so copies are in one.

Features are presences, not counts, so a long text is no more suspicious than
a short one: whole words, word beginnings of 3 to 6 letters (a stem with other
endings is still known) and a few shape bins (share of symbols, of capitals).
Kept are the features that speak for a category beyond chance, the strongest
first, at most ``n_features``: what speaks for nothing is no feature, so the
many ordinary words of a long text cannot outweigh the few that matter.

Fitting uses a bounded sample of labelled documents, ``max_train`` by hash of
the id, spread over the tasks; the driver gets the counts of kept features and
the sample's sparse rows. Scoring is one map over whole texts, with the model
(a few thousand numbers) in the closure: no shuffle.

A label row counts if its id and label are not null; repeated label rows of an
id count as their largest value. Without labelled rows of both kinds, a
category's probability is the share seen (0 if none). Null or empty text has
no features and is never toxic. Repeated documents score alike. An empty table
gives an empty result; columns beside id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import WORD_PATTERN, at_most, cut_lineage, groups_by_size, mix64, pieces, str_rows
from marquee.llm.wordhash import HashTable, Words, char_table, code_points

CATEGORIES = ("low_quality", "toxic")  # in chain order
MAX_TRAIN = 8000     # labelled documents that the chain is fitted on
N_FEATURES = 2048    # features kept for each category
MIN_DOCS = 5         # training documents a kept feature occurs in, at least
LEAST_Z = 4.5        # how much more often than by chance a kept feature meets its category
FOLDS = 3
THRESHOLD = 0.4
_PREFIXES = (3, 4, 5, 6)
_RIDGE = 0.3
_STEPS = 300
_CHARS = 1 << 20


def _marks(texts: list[str]) -> np.ndarray:
    """Per text: its symbols, its capitals, its characters."""
    codes, starts = code_points(texts)
    letter, upper = char_table("isalnum")[codes], char_table("isupper")[codes]
    symbol = ~letter & ~char_table("isspace")[codes]
    return np.column_stack([*(np.add.reduceat(m.astype(np.int64), starts[:-1]) for m in (symbol, upper)),
                            np.diff(starts) - 1])


def _shape_features(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two feature hashes a text that has a character: its share of symbols and of capitals, in bins."""
    who = np.flatnonzero(marks[:, 2])
    bins = [np.searchsorted([0.01, 0.02, 0.04, 0.08, 0.16, 0.32], marks[who, kind] / marks[who, 2]) for kind in (0, 1)]
    return np.tile(who, 2), np.concatenate([mix64((b + 64 * (k + 1)).astype(np.uint64)) for k, b in enumerate(bins)])


def _word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    owners, hashes = [words.text], [words.hash]
    for length in _PREFIXES:
        h, there = words.prefix_hash(length)
        owners.append(words.text[there])
        hashes.append(mix64(h[there] + np.uint64(length)))
    return np.concatenate(owners), np.concatenate(hashes)


def features(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, its number from there, feature hash)`` arrays by group of texts, repeats included.

    A long text comes as several groups, one after another.
    """
    for lo, hi in groups_by_size([len(t) + 1 for t in texts], _CHARS):
        marks = np.zeros((hi - lo, 3), np.int64)
        for part in ([p] for p in pieces(texts[lo], _CHARS)) if hi - lo == 1 else (texts[lo:hi],):
            yield lo, *_word_features(part)
            marks += _marks(part)
        yield lo, *_shape_features(marks)


def _distinct_pairs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def _distinct_rows(owner: np.ndarray, value: np.ndarray, n: int) -> list[np.ndarray]:
    """Distinct values of each owner 0..n-1."""
    owner, value = _distinct_pairs(owner, value)
    edges = np.searchsorted(owner, np.arange(n + 1))
    return [value[a:b] for a, b in zip(edges, edges[1:])]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class SparseRows:
    """Rows of column numbers (presences) with a few dense columns beside them."""

    def __init__(self, rows: list[np.ndarray], n_columns: int):
        self.n, self.n_columns = len(rows), n_columns
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.column = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n)

    def only(self, columns: np.ndarray) -> SparseRows:
        """The same rows without the entries of other columns."""
        out = SparseRows([], self.n_columns)
        kept = columns[self.column]
        out.n, out.row, out.column = self.n, self.row[kept], self.column[kept]
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row], self.n_columns)


@dataclass
class Linear:
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' probabilities
    bias: float

    def score(self, sparse: SparseRows, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(sparse.times(self.weights) + earlier @ self.earlier + self.bias)


def fit_linear(sparse: SparseRows, earlier: np.ndarray, y: np.ndarray, use: np.ndarray) -> Linear:
    """Ridge logistic regression on the rows in ``use``, by accelerated gradient steps."""
    used, n = use.astype(float), max(1, int(use.sum()))
    share = float((y * used).sum() / n)
    bias = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    k = sparse.n_columns
    w = np.zeros(k + earlier.shape[1] + 1)
    w[-1] = bias
    if 0 < share < 1:
        # Bound of the curvature along each coordinate: entries are at least 0, so
        # a quarter of the sum over rows of entry x row sum; gives each its own step.
        reach = used * (np.bincount(sparse.row, minlength=sparse.n) + earlier.sum(1) + 1) / 4
        curvature = np.concatenate([sparse.back(reach) + _RIDGE, earlier.T @ reach + _RIDGE, [reach.sum()]])
        ahead, momentum = w.copy(), 1.0
        for _ in range(_STEPS):
            z = sparse.times(ahead[:k]) + earlier @ ahead[k:-1] + ahead[-1]
            r = (_sigmoid(z) - y) * used
            gradient = np.concatenate([sparse.back(r), earlier.T @ r, [r.sum()]])
            gradient[:-1] += _RIDGE * ahead[:-1]
            new = ahead - gradient / curvature
            following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
            ahead = new + (momentum - 1) / following * (new - w)
            w, momentum = new, following
    return Linear(w[:k], w[k:-1], float(w[-1]))


@dataclass
class Chain:
    categories: tuple[str, ...]
    keys: np.ndarray                     # feature hashes, in column order
    models: list[Linear] = field(default_factory=list)

    def predict(self, sparse: SparseRows) -> np.ndarray:
        found = np.zeros((sparse.n, 0))
        for model in self.models:
            found = np.column_stack([found, model.score(sparse, found)])
        return found


def fit_chain(sparse: SparseRows, labels: np.ndarray, fold: np.ndarray, categories, keys,
              without_fold: list[np.ndarray] | None = None) -> Chain:
    """Models in chain order; each is fitted on the out-of-fold probabilities of those before.

    ``without_fold``: for each fold, which columns were chosen without it; last, which on all rows.
    """
    chain, earlier = Chain(tuple(categories), keys), np.zeros((sparse.n, 0))
    columns = without_fold or [np.ones(sparse.n_columns, bool)] * (FOLDS + 1)
    views = [sparse.only(c) for c in columns]
    for c in range(labels.shape[1]):
        known = ~np.isnan(labels[:, c])
        y = np.where(known, labels[:, c], 0.0)
        chain.models.append(fit_linear(views[-1], earlier, y, known))
        if c + 1 < labels.shape[1]:
            held_out = np.zeros(sparse.n)
            for f in range(FOLDS):
                part = fit_linear(views[f], earlier, y, known & (fold != f))
                held_out = np.where(fold == f, part.score(views[f], earlier), held_out)
            earlier = np.column_stack([earlier, held_out])
    return chain


def _training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories,
                   max_train: int) -> DataFrame:
    """``(fold, text, <category>...)`` of the bounded sample, one row a labelled document.

    At most ``max_train`` rows, however often an id stands in ``docs``. Ids of
    unlike types are compared as text.
    """
    values = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        *[F.max(F.col(c).cast("double")).alias(f"y{i}") for i, c in enumerate(categories)])
    order = F.xxhash64(F.col("label_id"), F.lit("toxicity"))
    sample = values.orderBy(order, "label_id").limit(max_train)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    given, labelled = F.col("id"), F.col("label_id")
    if rows.schema["id"].dataType != sample.schema["label_id"].dataType:
        given, labelled = given.cast("string"), labelled.cast("string")
    return at_most(rows.join(F.broadcast(sample), given == labelled).select(
        F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), "text",
        *[f"y{i}" for i in range(len(categories))]), max_train)


def _select_features(train: DataFrame, categories, n_features: int,
                     min_docs: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the features that speak most for some category, by the z-score of their label sums.

    Chosen once without each fold and once on all rows; beside all hashes, which were chosen each time.
    """
    width = len(categories)
    names = [f"{x}_{f}" for f in range(FOLDS) for x in ("n", *(f"s{i}" for i in range(width)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, fold = str_rows(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            y = np.nan_to_num(np.column_stack([np.ones(len(texts)), *(
                np.asarray(batch.column(i + 2).to_pandas(), float) for i in range(width))]))
            for lo, group in groupby(features(texts), key=lambda g: g[0]):
                owner, hashes = map(np.concatenate, zip(*(_distinct_pairs(o, h) for _, o, h in group)))
                who, flat = _distinct_pairs(owner, hashes)
                who = who + lo
                keys, place = np.unique(flat, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), *[pa.array(np.bincount(place, y[who, i] * (fold[who] == f), len(keys)))
                                                      for f in range(FOLDS) for i in range(width + 1)]], ["key", *names])

    counted = cut_lineage(
        train.select("text", "fold", *[f"y{i}" for i in range(width)])
        .mapInArrow(run, "key long, " + ", ".join(f"{n} double" for n in names))
        .groupBy("key").agg(*[F.sum(n).alias(n) for n in names])
        .where(sum(F.col(f"n_{f}") for f in range(FOLDS)) >= min_docs))
    totals = train.groupBy("fold").agg(*[x for i in range(width) for x in (
        F.count(f"y{i}").alias(f"known{i}"), F.coalesce(F.sum(f"y{i}"), F.lit(0.0)).alias(f"sum{i}"))]).collect()
    chosen: list[set[int]] = []
    for left_out in [*range(FOLDS), None]:
        folds, keys = [f for f in range(FOLDS) if f != left_out], set()
        n = sum(F.col(f"n_{f}") for f in folds)
        for i in range(width):
            known = sum(r[f"known{i}"] for r in totals if r.fold in folds)
            p = sum(r[f"sum{i}"] for r in totals if r.fold in folds) / known if known else 0.0
            if 0 < p < 1:
                z = (sum(F.col(f"s{i}_{f}") for f in folds) - n * p) / F.sqrt(n * p * (1 - p))
                keys.update(r.key for r in counted.where(n >= min_docs).select("key", z.alias("z"))
                            .where(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "key").limit(n_features).collect())
        chosen.append(keys)
    every = np.array(sorted(set().union(*chosen)), np.int64)
    return every.view(np.uint64), [np.isin(every, np.fromiter(keys, np.int64, len(keys))) for keys in chosen]


def _matched(texts: list[str], table: HashTable) -> list[np.ndarray]:
    owners, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, owner, hashes in features(texts):
        at, column = table.find(hashes)
        owners.append(owner[at] + lo)
        columns.append(column)
    return _distinct_rows(np.concatenate(owners), np.concatenate(columns), len(texts))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None,
          id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN,
          n_features: int = N_FEATURES, min_docs: int = MIN_DOCS) -> Chain:
    """A chain fitted on a bounded sample. ``categories``: 0/1 columns of ``labels``, in chain order."""
    categories = categories or {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}
    names = tuple(categories)
    marked = labels.select(id_col, *[c.alias(n) for n, c in categories.items()])
    rows = cut_lineage(_training_rows(docs, marked, id_col, text_col, names, max_train))
    keys, without_fold = _select_features(rows, names, n_features, min_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = HashTable(keys)
        for batch in batches:
            found = _matched(str_rows(batch.column(1)), table)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.tolist() for f in found], pa.list_(pa.int32())),
                 *batch.columns[2:]], ["fold", "columns", *batch.schema.names[2:]])

    ys = [f"y{i}" for i in range(len(names))]
    matrix = rows.mapInArrow(run, "fold int, columns array<int>, " + ", ".join(f"{y} double" for y in ys)).collect()
    sparse = SparseRows([np.array(r["columns"], np.int64) for r in matrix], len(keys))
    y = np.array([[np.nan if r[c] is None else r[c] for c in ys] for r in matrix], float).reshape(-1, len(names))
    return fit_chain(sparse, y, np.array([r.fold for r in matrix], np.int64), names, keys, without_fold)


def score_column(chain: Chain, text: Column) -> Column:
    """Struct of one probability a category for a text column; null or blank text scores as no feature."""
    @F.pandas_udf(", ".join(f"{c} double" for c in chain.categories))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = HashTable(chain.keys)
        for batch in batches:
            texts = [t or "" for t in batch]
            sparse = SparseRows(_matched(texts, table), len(chain.keys))
            yield pd.DataFrame(chain.predict(sparse), columns=list(chain.categories), index=batch.index)

    return score(text.cast("string"))


def is_toxic(scores: Column, text: Column, threshold: float = THRESHOLD, category: str = "toxic") -> Column:
    return F.coalesce(text.rlike(WORD_PATTERN), F.lit(False)) & (scores[category] > threshold)
