"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; each of its documents then has the
same expected number of copies, target over source size. The documents of a
source stand in one fixed order, their expected copies are summed along it, one
random offset is added, and a document is emitted once for every integer that
the running sum passes over it. The order groups documents of about equal size,
so a source's emitted words come near its target, and within such a group it is
the order of a hash of the id, so reruns agree and equal copies spread out.

Native DataFrame code only. The running sum needs no task with a whole source:
a document's place is the number of documents in lower size bins of its source,
plus those in lower hash cells of its bin, plus its row number in its own cell.
The three windows run over at most a few hundred bins, 4,096 cells, and the
rows of one cell.

Null text has size 0; a null source is a source of its own, ordered last.
Sources without words have target 0. Repeated rows are separate rows, equal ids
are told apart by size and text. Words are counted in whole texts, however long. An
empty table gives an empty mix. Extra columns travel along untouched, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import WORD_PATTERN, cut_lineage, md5_number

# Parameters of the mix: weights of the sources in order, share of all words
# taken, and the highest multiple of a source (so of a document) that is taken.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"
_CELL_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def _size_bin(size: Column) -> Column:
    """Digits of the size and its first two digits, as one number: bins 1 to 10 % wide."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source.

    Sources by code point, null last, take the weights in turn. Each gets
    weight x level, but at most ``most`` times its size; the level is the one
    at which the targets sum to ``share`` of all words. With sources sorted by
    cap over weight, the level is found at the first source that stays below
    its cap. One row a source reaches these global windows.
    """
    code_point = Window.orderBy(F.col("source").isNull(), "source")
    ranked = (sizes.withColumn("place", F.row_number().over(code_point))
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 ((F.col("place") - 1) % len(weights) + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    below = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = (ranked
                .withColumn("step", F.row_number().over(by_cap))
                .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(share))
                .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
                            / F.sum("weight").over(rest))
                .withColumn("open", F.col("level") <= F.col("cap") / F.col("weight")))
    first = (levelled.withColumn("first_open", F.min(F.when(F.col("open"), F.col("step"))).over(everything))
             .withColumn("final", F.max(F.when(F.col("step") == F.col("first_open"), F.col("level")))
                         .over(everything)))
    return first.select("source", "source_size",
                        F.when(F.col("step") < F.col("first_open"), F.col("cap"))
                        .otherwise(F.least("cap", F.col("weight") * F.col("final"))).alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", weights=WEIGHTS, share: float = SHARE,
             most: int = MOST_COPIES, seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """``(row, size, source_size, target, copies)``; ``row`` is the input row as a struct.

    ``keep`` names the columns of ``row`` (all by default): what is not kept is
    not shuffled, and without the text among it the narrow rows are checkpointed, so
    that texts are read and their words counted once. The counts of the cells are
    computed once and checkpointed.
    """
    text = F.col(text_col).cast("string")
    size = word_count(text)
    hashed = md5_number(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
                       F.col(source_col).cast("string").alias("source"), size.alias("size"),
                       hashed.alias("hash"), F.xxhash64(text).alias("tie"))
    rows = (rows.withColumn("bin", _size_bin(F.col("size")))
            .withColumn("cell", F.shiftright("hash", 60 - _CELL_BITS)))
    if text_col not in (keep or docs.columns):
        rows = cut_lineage(rows)
    cells = cut_lineage(rows.groupBy("source", "bin", "cell").agg(F.count(F.lit(1)).alias("n"),
                                                                  F.sum("size").alias("words")))
    bins = cells.groupBy("source", "bin").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")),
                             weights, share, most)
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed_bins = (bins.withColumn("bin_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
                   .select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), "bin_start"))
    per_source = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    placed_bins = placed_bins.join(per_source, F.col("b_source").eqNullSafe(F.col("t_source")))
    inside = (Window.partitionBy("source", "bin").orderBy("cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    offset = (md5_number(F.concat(F.lit(f"{seed}:offset:"), F.coalesce("source", F.lit(""))))
              % F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    starts = (cells.withColumn("cell_start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(placed_bins, F.col("source").eqNullSafe(F.col("b_source"))
                    & (F.col("bin") == F.col("b_bin")))
              .select(F.col("source").alias("c_source"), F.col("bin").alias("c_bin"),
                      F.col("cell").alias("c_cell"), "source_size", "target",
                      (F.col("bin_start") + F.col("cell_start")).alias("start"),
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                      .otherwise(F.lit(0.0)).alias("expected"), offset.alias("offset")))
    own = Window.partitionBy("source", "bin", "cell").orderBy("hash", "size", "tie")
    # null-safe on every key: a plain equality adds "is not null" filters that count the words again
    joined = (rows.withColumn("nth", F.row_number().over(own))
              .join(starts, F.col("source").eqNullSafe(F.col("c_source"))
                    & F.col("bin").eqNullSafe(F.col("c_bin")) & F.col("cell").eqNullSafe(F.col("c_cell"))))
    place = F.col("start") + F.col("nth")
    crossed = (F.floor(place * F.col("expected") + F.col("offset"))
               - F.floor((place - 1) * F.col("expected") + F.col("offset")))
    return joined.select("row", "size", "source_size", "target", crossed.cast("bigint").alias("copies"))


def systematic_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan takes it."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return (plan.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .select("row.*"))
