import hashlib
from collections import Counter

import pytest

from helpers import awkward, empty
from marquee.llm import sharding


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_table(n, size, seed):
    offset = [number(f"{seed}:offset:{i}") % size for i in range(n)]
    skip = [number(f"{seed}:skip:{i}") % (size - 1) + 1 for i in range(n)]
    table, nxt, filled = [-1] * size, [0] * n, 0
    while True:
        for i in range(n):
            while table[(offset[i] + nxt[i] * skip[i]) % size] >= 0:
                nxt[i] += 1
            table[(offset[i] + nxt[i] * skip[i]) % size] = i
            filled += 1
            if filled == size:
                return table


@pytest.mark.parametrize("n, size", [(1, 2), (3, 7), (5, 5), (7, 101)])
def test_table_equals_the_turns(spark, n, size):
    rows = sharding.lookup_table(spark, n, size, "s").orderBy("slot").collect()
    assert [r.shard for r in rows] == plain_table(n, size, "s")


def test_shares_differ_by_one_slot_and_few_slots_move(spark):
    before, after = plain_table(16, 2039, "s"), plain_table(17, 2039, "s")
    shares = Counter(before).values()
    assert max(shares) - min(shares) <= 1
    assert sum(a != b for a, b in zip(before, after)) < 2039 * 0.25


def test_place_awkward_rows(spark):
    docs = awkward(spark)
    placed = sharding.place(docs, n_shards=3, table_size=31)
    assert set(placed.columns) == set(docs.columns)  # slot and shard replaced
    table = plain_table(3, 31, sharding.SEED)
    rows = placed.collect()
    assert len(rows) == docs.count()
    for r in rows:
        slot = number(f"{sharding.SEED}:key:{'' if r.doc_id is None else r.doc_id}") % 31
        assert (r.slot, r.shard) == (slot, table[slot])
    assert sharding.place(empty(spark)).count() == 0


def test_not_a_prime(spark):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, 3, 33)


def test_native_broadcast_plan(spark):
    plan = sharding.place(awkward(spark))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan
