"""Equi-joins that split heavy keys by themselves.

A key that holds a large share of one side's rows lands in one task of a shuffle
join. ``split_join`` finds such keys first and deals them to several tasks:

``heavy_buckets``  counts rows per hash bucket of the key. The counts are made in
    the map tasks and merged, at most ``buckets`` rows whatever the input, so the
    result may be broadcast. A heavy key always makes its bucket heavy; light
    keys that share the bucket are split with it, which changes no result.
``split_join``     rows of a heavy bucket on the heavy side get one of the
    bucket's pieces in turn, the other side's rows of the bucket are repeated once
    a piece (a replicated join), and both meet on (key, piece). All other rows
    have the one piece 0 and take the plain shuffle. Each side is shuffled once,
    and what adaptive execution does (broadcast of a small side) still applies.

The number of pieces follows the bucket's count: a piece has about a quarter of an
even share of the rows, so that pieces that meet in one task do not stand out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marquee.operators.clean import all_of

BUCKETS = 1 << 14      # rows of the summary, at most
MAX_PIECES = 1 << 12   # pieces of a bucket, at most
FINER = 4              # pieces to an even share


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """Hash bucket of the key columns, the same for integers of any width."""
    cols = [F.col(k).cast("bigint") if isinstance(df.schema[k].dataType, IntegralType) else F.col(k) for k in keys]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def heavy_buckets(df: DataFrame, keys: Sequence[str], shares: int, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, pieces`` of the buckets that hold more rows than an even share (one of ``shares``) of ``df``."""
    usable = df.where(all_of(F.col(k).isNotNull() for k in keys))
    counts = usable.groupBy(_bucket(df, keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = counts.agg(F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n")).alias("all"))
    one = every.select("total", F.explode("all").alias("b")).select("total", "b.*")
    pieces = F.least(F.ceil(F.col("n") * shares / F.col("total")), F.lit(MAX_PIECES)).cast("int")
    return one.select("bucket", pieces.alias("pieces")).where("pieces > 1")


def split_join(heavy: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]], shares: int | None = None,
               buckets: int = BUCKETS, spread: Column | None = None) -> DataFrame:
    """Inner join on ``heavy.a == other.b`` for every pair, heavy keys of ``heavy`` split; both keys kept.

    shares  even shares that a key may not exceed (default: the session's shuffle partitions).
    spread  whole number by which a row takes its turn (default: its running id). It has to be
            the same when a task is run again; a running id is, for a side read from files.
    """
    left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
    for a, b in pairs:
        kinds = {heavy.schema[a].dataType, other.schema[b].dataType}
        if len(kinds) > 1 and not all(isinstance(k, IntegralType) for k in kinds):
            raise ValueError(f"{a} and {b} are of different types: cast one of them")
    shares = shares or int(heavy.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = F.broadcast(heavy_buckets(heavy, left_keys, FINER * shares, buckets))  # at most ``buckets`` rows
    turn = F.monotonically_increasing_id() if spread is None else spread
    pieces = F.coalesce("_pieces", F.lit(1))
    sides = []
    for df, keys, bucket in ((heavy.withColumn("_turn", turn), left_keys, "_b1"), (other, right_keys, "_b2")):
        known = found.select(F.col("bucket").alias(bucket), F.col("pieces").alias("_pieces"))
        sides.append(df.join(known, _bucket(df, keys, buckets) == F.col(bucket), "left").drop(bucket))
    dealt = sides[0].withColumn("_piece", F.pmod("_turn", pieces).cast("int")).drop("_pieces", "_turn")
    copies = sides[1].withColumn("_copy", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces")
    same = all_of(dealt[a] == copies[b] for a, b in pairs) & (dealt["_piece"] == copies["_copy"])
    return dealt.join(copies, same).drop("_piece", "_copy")
