"""Placing documents on shards through a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size, a
permutation given by an offset and a skip hashed from its name. The shards take
turns, each claiming its first slot that is still free, until the table is
full; shares then differ by one slot at most, and adding or removing a shard
moves few slots. A document hashes to a slot, and the broadcast table gives its
shard in constant time: no shuffle, and no document depends on any other.

Native DataFrame code only: the table is one SQL expression over literals (a
fold over the turns), a few thousand rows whatever the data, so its broadcast
size is fixed by ``table_size``. The key is the document id, so a source or a
group of copies that holds a third of all rows still spreads over all shards.

A null id hashes as the empty string; rows that repeat an id share a shard. Texts
are not read, so their length is no matter; an empty table stays empty. An existing
column named like an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import md5_number, unused

N_SHARDS = 16
TABLE_SIZE = 2039  # a prime, over 100 slots a shard
SEED = "shard-1"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup_table(spark: SparkSession, n_shards: int = N_SHARDS, table_size: int = TABLE_SIZE,
                 seed: str = SEED) -> DataFrame:
    """``(slot, shard)``, one row a slot, filled by the shards in turns."""
    if n_shards < 1 or table_size < max(2, n_shards) \
            or any(table_size % p == 0 for p in range(2, int(table_size ** 0.5) + 1)):
        raise ValueError("table_size must be a prime and at least the number of shards")
    size, shards = F.lit(table_size), F.sequence(F.lit(0), F.lit(n_shards - 1))
    # Both values stay below table_size, so they fit an int.
    offsets = F.transform(shards, lambda i: (
        md5_number(F.concat(F.lit(f"{seed}:offset:"), i.cast("string"))) % size).cast("int"))
    skips = F.transform(shards, lambda i: (
        md5_number(F.concat(F.lit(f"{seed}:skip:"), i.cast("string"))) % (size - 1) + 1).cast("int"))

    def claim(table: Column, turn: Column) -> Column:
        """``table`` after the shard whose turn it is took its first free slot."""
        shard = turn % n_shards
        start = F.struct(F.get(offsets, shard).cast("bigint").alias("at"), F.get(skips, shard).alias("skip"))
        wanted = _let(start, lambda p: F.transform(
            F.sequence(F.lit(0), size - 1), lambda j: ((p["at"] + j * p["skip"]) % size).cast("int")))
        first_free = F.get(F.filter(wanted, lambda s: F.get(table, s) < 0), F.lit(0))
        return _let(first_free, lambda slot: F.transform(
            table, lambda v, s: F.when(s == slot, shard).otherwise(v)))

    filled = F.aggregate(F.sequence(F.lit(0), size - 1), F.array_repeat(F.lit(-1), table_size), claim)
    return spark.range(1).select(F.posexplode(filled).alias("slot", "shard"))


def place(docs: DataFrame, id_col: str = "doc_id", n_shards: int = N_SHARDS,
          table_size: int = TABLE_SIZE, seed: str = SEED) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` added."""
    docs = docs.drop("slot", "shard") if id_col not in ("slot", "shard") else docs
    at, name = unused(docs, "table_slot"), unused(docs, "table_shard")
    table = lookup_table(docs.sparkSession, n_shards, table_size, seed).select(
        F.col("slot").alias(at), F.col("shard").alias(name))
    key = F.concat(F.lit(f"{seed}:key:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    slot = (md5_number(key) % table_size).cast("int")
    return (docs.join(F.broadcast(table), slot == F.col(at))
            .withColumnsRenamed({at: "slot", name: "shard"}))
