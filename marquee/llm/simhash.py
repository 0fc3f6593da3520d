"""SimHash near-duplicate groups through one-wildcard segment signatures.

A document's 64-bit fingerprint takes the majority of each bit over the XXH64
values of its word shingles. To find all fingerprints within ``max_bits``, the
64 bits are cut into ``max_bits // 2 + 1`` segments: two fingerprints that
differ in at most ``max_bits`` bits then have a segment in which they differ
in at most one bit (with four bits and three segments, two bits in each would
make six). Every segment is indexed once per bit position with that bit
deleted; segments one bit apart (or equal) share such a variant, so an
equality join on (segment, deleted position, remaining bits) meets every pair,
and a bit count over the whole fingerprints verifies it.

At scale
- Equal fingerprints collapse first: the index holds distinct fingerprints,
  so a group of copies of any size costs one entry set.
- A pair that shares several variants is accepted at one of them only (its
  first segment with at most one difference, at the differing position).
- A bucket that many distinct fingerprints share (a large family of near
  copies) would emit its pairs. Buckets above ``hot_bucket`` are taken out and
  their fingerprints linked through half-distance balls instead: every
  fingerprint lists the 64-bit values within half the distance, and all that
  list a value are linked to the smallest of them. Two fingerprints are within
  the distance exactly if such a value exists, so nothing is lost and the work
  is linear in the fingerprints (2,081 values each at four bits).
- Components come from star rounds over the links; no step collects rows.

Null or blank text has fingerprint zero and links like any other. Fewer words
than a shingle: the whole sequence is the one shingle. Rows that repeat a
document id are treated as separate rows. A null id never becomes a component
id unless the whole component has null ids. Very long texts are hashed whole, in
pieces that overlap by a shingle. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import cut_lineage, utf8_rows
from marquee.llm.components import connected_components

_CHUNK = 1 << 18  # shingle hashes unpacked to bits at a time
_PIECE = 1 << 20  # bytes of a text split into words at a time
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _bit_counts(words: list[bytes], shingle: int, seed: int) -> tuple[np.ndarray, int]:
    """How many shingle hashes have each of the 64 bits set, and how many there are."""
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    span = min(shingle, len(words))
    starts, ends = edges[:len(words) - span + 1], edges[span:]
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(starts), _CHUNK):
        hashes = [digest(joined[a:b - 1], seed)
                  for a, b in zip(starts[lo:lo + _CHUNK].tolist(), ends[lo:lo + _CHUNK].tolist())]
        part = np.array(hashes, np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(0, dtype=np.int64)
    return counts, len(starts)


def _byte_pieces(text: bytes) -> Iterator[bytes]:
    lo = 0
    while lo < len(text):
        blank = _BLANK.search(text, lo + _PIECE)
        hi = blank.start() if blank else len(text)
        yield text[lo:hi]
        lo = hi


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text; zero if it has no word.

    Long texts are worked on in pieces; a piece takes over the last words of the
    one before, so its first shingle follows on the last one there.
    """
    counts, n, words = np.zeros(64, np.int64), 0, []
    for piece in _byte_pieces(text.lower()):  # on bytes: A-Z only, and the six ASCII blanks
        words += piece.split()
        if len(words) >= shingle:
            more, m = _bit_counts(words, shingle, seed)
            counts, n, words = counts + more, n + m, words[len(words) - shingle + 1:]
    if not n:
        if not words:
            return 0
        counts, n = _bit_counts(words, shingle, seed)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """``(id, fp, text_key)`` per row: signed 64-bit fingerprint, hash of the exact text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle, seed) for t in utf8_rows(batch.column(1))],
                              np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), batch.column(2)], ["id", "fp", "text_key"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType),
                           T.StructField("fp", T.LongType()), T.StructField("text_key", T.LongType())])
    return rows.mapInArrow(run, schema)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of each segment: so few that one differs by at most one bit."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(lo: int, width: int) -> int:
    return _signed(((1 << width) - 1) << lo)


def _variants(value: Column, segment: int, lo: int, width: int) -> list[Column]:
    """The one-wildcard variants of a segment value: (slot, value without the bit)."""
    return [F.struct(F.lit(segment * 64 + p).alias("slot"),
                     value.bitwiseAND(F.lit(_signed(~(1 << (lo + p)) & (2 ** 64 - 1)))).alias("key"))
            for p in range(width)]


def _index(fps: DataFrame, max_bits: int) -> DataFrame:
    fp = F.col("fp")
    entries = [v for s, (lo, width) in enumerate(segments(max_bits))
               for v in _variants(fp.bitwiseAND(F.lit(_mask(lo, width))), s, lo, width)]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.slot", "e.key", "fp")


def _accepting_slot(differing: Column, max_bits: int) -> Column:
    """The one slot at which a pair with these differing bits is accepted."""
    slot = F.lit(None).cast("int")
    for s, (lo, width) in reversed(list(enumerate(segments(max_bits)))):
        part = F.shiftrightunsigned(differing.bitwiseAND(F.lit(_mask(lo, width))), lo)
        position = (F.when(part == 0, 0).when(part == F.lit(-(1 << 63)), 63)
                    .otherwise(F.bit_count(part - 1)))
        slot = F.when(F.bit_count(part) <= 1, position + s * 64).otherwise(slot)
    return slot


def _hot_buckets(fps: DataFrame, max_bits: int, hot_bucket: int) -> DataFrame:
    """(slot, key) of every bucket that may hold more than ``hot_bucket`` fingerprints.

    A variant bucket joins two exact segment values, so one of them has at least
    half of its members; counting exact values needs three rows a fingerprint.
    """
    cut = segments(max_bits)
    exact = fps.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), F.col("fp").bitwiseAND(F.lit(_mask(lo, w))).alias("value"))
        for s, (lo, w) in enumerate(cut)])).alias("e")).groupBy("e.s", "e.value").count()
    hot = exact.where(F.col("count") * 2 > hot_bucket)
    variants = F.lit(None)
    for s, (lo, width) in enumerate(cut):
        variants = F.when(F.col("s") == s, F.array(*_variants(F.col("value"), s, lo, width))
                          ).otherwise(variants)
    return hot.select(F.explode(variants).alias("e")).select("e.slot", "e.key").distinct()


def _ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect exactly what pairs within ``max_bits`` would connect.

    ``near`` values are at most ``max_bits // 2`` bits away, ``far`` ones (odd
    distances only) one bit more. A value's list holds at most as many
    fingerprints as a ball has points, so its size is bounded whatever the data.
    """
    half, rest = max_bits // 2, max_bits % 2
    masks = [(_signed(sum(1 << p for p in c)), r <= half)
             for r in range(half + rest + 1) for c in combinations(range(64), r)]
    ball = F.array(*[F.lit(m) for m, near in masks if near])
    points = fps.select("fp", F.explode(ball).alias("m"), F.lit(True).alias("near"))
    if rest:
        outer = F.array(*[F.lit(m) for m, near in masks if not near])
        points = points.unionByName(
            fps.select("fp", F.explode(outer).alias("m"), F.lit(False).alias("near")))
    listed = points.groupBy(F.col("fp").bitwiseXOR(F.col("m")).alias("point")).agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("all"))
    return (listed.where(F.col("a").isNotNull() & (F.size("all") > 1))
            .select("a", F.explode("all").alias("b")).where("a <> b").distinct())


def links(fps: DataFrame, max_bits: int = 4, hot_bucket: int = 1000) -> DataFrame:
    """``(a, b)`` links between the distinct values of column ``fp``.

    Outside hot buckets: each pair within ``max_bits`` once. In hot buckets:
    links with the same connected components as those pairs.
    """
    n, narrowest = fps.count(), min(w for _, w in segments(max_bits))
    hot_bucket = max(hot_bucket, 32 * (n >> (narrowest - 1)))  # well above the mean bucket
    index = _index(fps, max_bits)
    hot = cut_lineage(_hot_buckets(fps, max_bits, hot_bucket))
    quiet = index.join(hot, ["slot", "key"], "left_anti")
    left = quiet.select("slot", "key", F.col("fp").alias("a"))
    right = quiet.select(F.col("slot").alias("slot_b"), F.col("key").alias("key_b"),
                         F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    pairs = left.join(right, (F.col("slot") == F.col("slot_b")) & (F.col("key") == F.col("key_b"))
                      & (F.col("a") < F.col("b")) & (F.bit_count(differing) <= max_bits)
                      & (F.col("slot") == _accepting_slot(differing, max_bits))).select("a", "b")
    crowded = index.join(hot, ["slot", "key"], "left_semi").select("fp").distinct()
    return pairs.unionByName(_ball_links(crowded, max_bits).select("a", "b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, max_bits: int = 4, seed: int = 42,
                   hot_bucket: int = 1000) -> DataFrame:
    """``(id, text_key, fp, component)`` per row of ``docs``.

    ``component`` is the smallest id among the rows reachable through links of
    at most ``max_bits`` differing bits, the row itself included.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = connected_components(links(distinct.select("fp"), max_bits, hot_bucket), "a", "b")
    rooted = cut_lineage(roots.select(F.col("node").alias("fp"), "root"))
    lowest = (rooted.join(distinct, "fp").groupBy("root").agg(F.min("first_id").alias("component")))
    linked = rooted.join(lowest, "root").select("fp", "component")
    table = cut_lineage(distinct.join(linked, "fp", "left")
                        .select("fp", F.coalesce("component", "first_id").alias("component")))
    return rows.join(table, "fp").select("id", "text_key", "fp", "component")
