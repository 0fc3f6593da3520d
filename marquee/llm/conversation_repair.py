"""Faults of conversations, and the cheapest edits that give them a sound structure.

A sound conversation has role initials ``(s?(ua)+)?``. Edits of a row: Keep
(cost 0), Rerole to user or assistant (1), Delete (2); an empty row may be
Inserted anywhere (5). Blank rows and rows that repeat an earlier role and text
must be deleted; a row whose text does not end in ``.``, ``!`` or ``?`` costs 5
more if it stays. A row's first fault of blank, duplicate, truncated counts.

The edits are found by iterative-deepening A*: a depth-first search tries the
edits of a place in ASCII order (D, I, K, R) and gives up where the cost so far
and a lower bound of the rest pass the bound; the bound starts at the lower bound
of the whole conversation and grows to the least value that passed it. The first
accepting path is the answer: the cheapest, of ties the ASCII-least. The
transposition table keeps, for every (row, state of the pattern), the least cost
that is not yet ruled out; a state that failed is not searched again with as
little left to spend. The lower bound is additive over windows of rows: the exact
cost to the end of the own window in whichever state, and the least cost of each
later window from whichever state. With at most 16 windows (of four rows at
least) it misses little, so that conversations of any length need few bounds.

What runs where. Rows are reduced to one code each; which texts repeat is
counted by (conversation, role, digest) with partial aggregation, so neither the
rows of a conversation nor the copies of a text are held in a task. One task
streams a conversation's codes in order and holds a byte a row, as long as the
``audit`` string that it returns. A second stream, again sorted by Spark, applies
the audit to the rows and returns the repaired conversation; it holds one row.
Both are dealt by conversation: its order is the thing asked for, so a
conversation is read by one task, sorted with spill and bounded memory.

Results for unusual rows: a null role or text reads as one space. Rows are
ordered by turn, nulls first, then role, then the digest of the text, so that
ties and repeated rows have one order. Null turns count in no gap. A null
conversation id is a conversation of its own. A conversation without rows (see
``present``) has zeros and an empty audit. Long texts are digested and streamed
whole. An empty table gives an empty result. Other columns are not read, so they
may have any name.
"""

from __future__ import annotations

import hashlib
import math
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import cut_lineage

BLANKS = " \t\n\x0b\x0c\r"  # the six ASCII blanks
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
WINDOWS = 16                # windows of the lower bound, at most
LEAST_WINDOW = 4            # rows of a window, at least

# States of the pattern: nothing yet; after s; after u; after a. The first and the last accept.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
EXPECTED = ("user", "user", "assistant", "user")  # the role that may be inserted or given in a state
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
INITIALS = "sua"
SOUND, MUST_GO, CUT = range(3)                    # faults that matter to the search
_FAR = 1 << 40


def fits(initial: int, state: int) -> int | None:
    """The state after keeping a row with ``INITIALS[initial]`` (3: any other initial), None if it may not stay."""
    if initial == 0:
        return AFTER_S if state == START else None
    if initial == 3 or INITIALS[initial] != EXPECTED[state][0]:
        return None
    return NEXT[state]


_FITS = [[fits(i, s) for s in range(4)] for i in range(4)]


def moves(codes: bytes, place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """``(edit, cost, place, state)`` of every edit, in ASCII order. A code is 4 x fault + initial."""
    if place == len(codes):
        yield "I", INSERT, place, NEXT[state]
        return
    fault, initial = divmod(codes[place], 4)
    yield "D", DELETE, place + 1, state
    yield "I", INSERT, place, NEXT[state]
    if fault != MUST_GO:
        more = TRUNCATED if fault == CUT else 0
        kept = _FITS[initial][state]
        if kept is not None:
            yield "K", KEEP + more, place + 1, kept
        yield "R", REROLE + more, place + 1, NEXT[state]


def _with_inserts(v: list[int]) -> list[int]:
    """``v`` where rows may be inserted before going on."""
    u, a = min(v[AFTER_U], v[AFTER_A] + INSERT), min(v[AFTER_A], v[AFTER_U] + INSERT)
    return [min(v[START], u + INSERT), min(v[AFTER_S], u + INSERT), u, a]


def lower_bounds(codes: bytes) -> list[int]:
    """A cost that finishing from (place, state) cannot go below, at ``4 * place + state``."""
    n = len(codes)
    size = max(LEAST_WINDOW, math.ceil(n / WINDOWS))
    out = [0] * (4 * n + 4)
    out[4 * n:] = after = _with_inserts([0, _FAR, _FAR, 0])
    for lo in range((n - 1) // size * size if n else -1, -1, -size):
        hi = min(n, lo + size)
        for place in range(hi - 1, lo - 1, -1):
            v = [after[s] + DELETE for s in range(4)]
            for state in range(4):
                for edit, cost, to, then in moves(codes, place, state):
                    if to > place:
                        v[state] = min(v[state], cost + after[then])
            out[4 * place:4 * place + 4] = after = _with_inserts(v)
        after = [min(after)] * 4  # the window before may end in any state
    return out


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and edits (``D I K R``) of the cheapest repair, of ties the ASCII-least; see the module text."""
    n, need = len(codes), lower_bounds(codes)
    while True:
        bound = need[START]
        # A frame: node, what is left to spend, its untried edits, the least cost that passed what is left.
        frames = [[START, bound, moves(codes, 0, START), _FAR]]
        path: list[str] = []
        if n == 0:
            return 0, ""
        while frames:
            frame = frames[-1]
            node, left, untried, _ = frame
            for edit, cost, place, state in untried:
                child = 4 * place + state
                if cost + need[child] > left:
                    frame[3] = min(frame[3], cost + need[child])
                    continue
                path.append(edit)
                if place == n and state in (START, AFTER_A):
                    return bound, "".join(path)
                frames.append([child, left - cost, moves(codes, place, state), _FAR])
                frame.append(cost)
                break
            else:
                need[node] = max(need[node], frame[3])  # failed with ``left``: not again with as little
                frames.pop()
                if frames:
                    path.pop()
                    above = frames[-1]
                    above[3] = min(above[3], above.pop() + need[node])


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Rows damaged by a hash of their id: some absent (``present`` false), emptied, stripped of ends, repeated, reroled.

    Returns conv_id, turn, role, text, present. What happens is crc32 of
    ``conv_id:turn`` modulo 20: 0 absent, 1 text emptied, 2 text without
    ``.!?``, 3 repeated, 4 role user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"),
                   F.coalesce(F.col(turn).cast("string"), space))
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    words = F.coalesce(F.col(text), space)
    return (rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(words, "[.!?]", ""))
                        .otherwise(words).alias("text"),
                        (kind != 0).alias("present"), kind.alias("kind"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
            .drop("kind", "copy"))


def _coded(rows: DataFrame) -> DataFrame:
    """One narrow row a row: its order, initial, digest, and whether it is blank, repeats an earlier turn's, is cut."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select("conv_id", "turn", "role", "present", _digest(F.col("text")).alias("digest"),
                         (trimmed == "").alias("blank"),
                         (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"))
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))  # nulls first
    again = (narrow.where("present").groupBy("conv_id", "role", "digest")
             .agg(F.min(order).alias("first"), F.max(order).alias("last")).where(F.col("first") < F.col("last"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return narrow.join(again, same, "left").select(
        "conv_id", "turn", "role", "digest", "present", "blank", "cut",
        F.coalesce(order > F.col("first"), F.lit(False)).alias("repeats"))


class _Conversation:
    """What one pass over the rows of a conversation, in order, keeps of them."""

    def __init__(self):
        self.codes = bytearray()
        self.faults = [0, 0, 0]  # blank, duplicate, truncated
        self.illegal = self.turns = 0
        self.least = self.most = self.before = None
        self.initial = ""

    def add(self, turn, role, digest, blank, cut, repeats) -> None:
        if turn is not None:
            if turn != self.most:
                self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        if self.codes and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        same = (turn, role, digest) == self.before  # equal rows stand side by side
        fault = 0 if blank else 1 if repeats or same else 2 if cut else None
        if fault is not None:
            self.faults[fault] += 1
        kind = SOUND if fault is None else CUT if fault == 2 else MUST_GO
        self.codes.append(4 * kind + (INITIALS.index(initial) if initial and initial in INITIALS else 3))
        self.before, self.initial = (turn, role, digest), initial

    def report(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        cost, audit = cheapest_edits(bytes(self.codes))
        return gaps, *self.faults, self.illegal, cost, audit


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    ``rows``: conv_id, turn, role, text and present; rows that are not present
    only make their conversation known.
    """
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in _COUNTS],
                           T.StructField("audit", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []
        id_type = None

        def out():
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:7]],
                 pa.array(columns[7], pa.string())], schema.names)

        conv = object()
        for batch in batches:
            id_type = batch.column(0).type
            for key, turn, role, digest, present, blank, cut, repeats in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or key != conv:
                    if now is not None:
                        found.append((conv, *now.report()))
                    now, conv = _Conversation(), key
                if present:
                    now.add(turn, role, digest, blank, cut, repeats)
            if len(found) >= 1000:
                yield out()
                found = []
        if now is not None:
            found.append((conv, *now.report()))
        if found:
            yield out()

    return (_coded(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
            .mapInArrow(run, schema))


def repaired_rows(rows: DataFrame, reported: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations, by the audits of ``reports``.

    The rows of a conversation come in order, one after another, in one
    partition; a conversation that keeps nothing has none.
    """
    audits = reported.where("audit <> ''").select("conv_id", F.lit(0).alias("part"), F.lit(None).cast(
        rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
        F.col("audit").alias("text"))
    texts = rows.where("present").select("conv_id", F.lit(1).alias("part"), "turn", "role",
                                         _digest(F.col("text")).alias("digest"), "text")
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()),
                           T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, START, 0
        conv = None

        def inserted():
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                yield conv, place, "I", EXPECTED[state], ""
                at, state, place = at + 1, NEXT[state], place + 1

        def edited(key, part, role, text):
            nonlocal audit, at, state, place, conv
            if part == 0:
                yield from inserted()  # after the last row of the conversation before
                audit, at, state, place, conv = text, 0, START, 0, key
                return
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = NEXT[state] if role[:1] != "s" else AFTER_S
            elif edit == "R":
                role, state = EXPECTED[state], NEXT[state]
            if edit != "D":
                yield key, place, edit, role, text
                place += 1

        for batch in batches:
            keys, parts, roles, texts = (batch.column(i).to_pylist() for i in (0, 1, 3, 5))
            out = [x for row in zip(keys, parts, roles, texts) for x in edited(*row)]
            yield _batch(out, schema, batch.column(0).type)
        out = list(inserted())
        if out:
            yield _batch(out, schema, pa.array([x[0] for x in out]).type)

    return (audits.unionByName(texts).repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "turn", "role", "digest").mapInArrow(run, schema))


def _batch(rows: list[tuple], schema: T.StructType, id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)


def text_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the ``role:text`` lines of ``repaired_rows`` (read in the order it gives)."""
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, conv = None, None
        for batch in batches:
            keys, digests = [], []
            for key, place, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if place == 0:
                    if digest is not None:
                        keys.append(conv)
                        digests.append(digest.hexdigest())
                    digest, conv = hashlib.sha256(), key
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            id_type = batch.column(0).type
            yield pa.RecordBatch.from_arrays([pa.array(keys, id_type), pa.array(digests, pa.string())], schema.names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], id_type), pa.array([digest.hexdigest()])], schema.names)

    return repaired.mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``reports`` (computed once) and ``repaired_rows`` of conversations with columns conv_id, turn, role, text, present."""
    reported = cut_lineage(reports(rows))
    return reported, repaired_rows(rows, reported)
