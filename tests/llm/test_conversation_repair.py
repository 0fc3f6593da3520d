import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from conftest import SMALL_SF
from helpers import CLASHING, LONG
from marquee.llm import conversation_repair as cr
from marquee.llm import queries
from marquee.llm.queries import QUERIES

BLANK = re.compile(r"[\x20\x09-\x0D]")


def cheapest(rows):
    """Cost, audit and repaired rows of ``(role, text, fault)`` rows: uniform-cost search over whole paths."""
    heap = [(0, "", 0, 0, ())]  # cost, audit, row, state, repaired
    step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    done = set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit, out
        role, then = step[state]
        heapq.heappush(heap, (cost + 5, audit + "I", i, then, (*out, (role, ""))))
        if i == len(rows):
            continue
        own, text, fault = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, out))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 if fault == "truncated" else 0
        if own[:1] == role[0]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, then, (*out, (own, text))))
        if own[:1] == "s" and state == 0:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1, (*out, (own, text))))
        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, then, (*out, (role, text))))


def brute(rows, damaged=True):
    """Everything the query returns, from ``(conv_id, turn, role, text)`` rows, in plain Python."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damaged else 9
        mine = conversations[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in conversations.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults, judged = set(), dict(blank=0, duplicate=0, truncated=0), []
        for turn, role, text in mine:
            words = BLANK.sub("", text)
            fault = ("blank" if not words else "duplicate" if (role, text) in seen
                     else "truncated" if words[-1] not in ".!?" else None)
            seen.add((role, text))
            judged.append((role, text, fault))
            if fault:
                faults[fault] += 1
        turns = {r[0] for r in mine} - {None}
        initials = [r[1][:1] for r in mine]
        cost, audit, repaired = cheapest(judged)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults.values(),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def values(row):
    return (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit, row.repaired_sha256)


def check(spark, monkeypatch, rows, schema="conv_id BIGINT, turn BIGINT, role STRING, text STRING", extra=False):
    table = spark.createDataFrame(rows, schema)
    if extra:
        table = table.selectExpr("*", *[f"'{c}!' AS `{c}`" for c in CLASHING], "1 present", "2 kind", "3 copy", "4 audit")
    monkeypatch.setattr(queries, "read_table", lambda *_: table)
    got = [(r.conv_id, values(r)) for r in QUERIES["op12_conversation_repair"](spark, "").collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(rows)


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/conversations.parquet").collect()]
    got = {r.conv_id: values(r) for r in QUERIES["op12_conversation_repair"](spark, SMALL_SF).collect()}
    assert got == brute(rows)


def test_awkward_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice([*range(12), None]), rng.choice([*range(9), None, -3]), rng.choice(
        ["user", "assistant", "system", "tool", "", None, "Us"]), rng.choice(
        ["Yes.", "No", "", " \t\n", None, "Wait!  \n", "naïve 漢字?", "a\nb:c.", LONG])) for _ in range(150)]
    check(spark, monkeypatch, [*rows, *rows[:20]], extra=True)


def test_empty_table_and_lost_conversations(spark, monkeypatch):
    check(spark, monkeypatch, [])
    gone = [(c, t, "user", "Hi.") for c in range(60) for t in range(60) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    check(spark, monkeypatch, gone)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, t, ("user", "assistant")[t % 2] if rng.random() < .9 else "system", f"Line {t % 50}.") for t in range(900)]
    check(spark, monkeypatch, [*rows, (2, 0, "user", "A."), (2, 1, "assistant", "B.")])


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_uniform_cost_search(seed):
    rng = random.Random(seed)
    names = {0: "s", 1: "user", 2: "assistant", 3: "x"}
    faults = {cr.SOUND: None, cr.MUST_GO: "blank", cr.CUT: "truncated"}
    weights = rng.choice([(8, 1, 1), (1, 1, 1), (3, 0, 3)])
    for n in [*range(9)] * 12 + [30, 80]:
        codes = [4 * rng.choices((0, 1, 2), weights)[0] + rng.choices((0, 1, 2, 3), (1, 6, 6, 1))[0] for _ in range(n)]
        want = cheapest([(names[c % 4], "", faults[c // 4]) for c in codes])
        assert cr.cheapest_edits(bytes(codes)) == want[:2]


def test_bounds_are_admissible_and_deepening_happens():
    rng = random.Random(1)
    deeper = 0
    for _ in range(200):
        codes = bytes(4 * rng.choice((0, 0, 0, 2, 1)) + rng.randrange(4) for _ in range(rng.randrange(1, 40)))
        cost, _ = cr.cheapest_edits(codes)
        first = cr.lower_bounds(codes)[cr.START]
        assert first <= cost
        deeper += first < cost
    assert deeper > 20


def test_a_long_conversation_is_searched_in_seconds():
    rng = random.Random(2)
    codes = bytes(4 * rng.choice((0,) * 8 + (1, 2)) + rng.choice((1, 2)) for _ in range(20_000))
    cost, audit = cr.cheapest_edits(codes)
    assert len(audit) >= 20_000 and cost > 0


def test_repaired_rows_are_sound(spark):
    rows = cr.damage(spark.read.parquet(f"{SMALL_SF}/conversations.parquet"))
    _, repaired = cr.repair(rows)
    roles = defaultdict(dict)
    for r in repaired.collect():
        roles[r.conv_id][r.place] = r.role[0]
    for places in roles.values():
        assert sorted(places) == list(range(len(places)))
        assert re.fullmatch("s?(ua)+", "".join(places[i] for i in sorted(places)))
