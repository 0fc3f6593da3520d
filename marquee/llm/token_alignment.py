"""Groups of tokens that two tokenizers cut at the same bytes, and how often token ids meet in a corpus.

A text is encoded as space + text by a byte-level BPE (A) and, since it adds
that space itself, as the text by a sentencepiece model (B). Both token rows
cover the same bytes; where an A and a B token end together a group ends.

Groups are found by pointer jumping: every token points to the token farthest
to the right that overlaps it (its own kind loses a tie, so that both tokens
that end a group meet in the A one). Following the successor's successor doubles
the step each time until no pointer moves: each token then points to the last
A token of its group, which labels it. All tokens of a block of texts jump at
once, as one numpy array.

What runs where. Tasks encode and align whole texts and write, once, a narrow
table: counts and digest of every document, its links as packed id pairs, and
the pair counts of each block, already summed. The counts are summed by Spark.
The most frequent pairs (at most ``table_size``, chosen by a count threshold)
are broadcast together with the highest count of each B id (as many numbers as
B has ids); tasks look every link up there. Links of rarer pairs, few by
construction, are joined with the counts by a shuffle. Both ways always run, so
the size of the corpus changes how many links take which, not the result.

Texts are encoded in units: a run that starts at a space after a character that
is no white space. No token of either kind crosses such a place (checked for B's
vocabulary; A's published splitting pattern never does), so units can be
encoded alone and remembered in the worker, and long texts are worked on in
pieces of units. Memory is bounded by a piece, not by a text, unless a text has
no such place at all.

Results for unusual rows: null, empty, or texts whose joined token bytes differ
from space + text (B maps them to other characters) have no tokens: all counts
0, no groups. Rows are independent: repeated rows and repeated or null ids each
get a row and each count as an occurrence. An empty table gives an empty result.
Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import cut_lineage, str_rows
from marquee.session import scratch_path

TABLE_SIZE = 1 << 20   # most frequent pairs that are broadcast
BLOCK_CHARS = 1 << 21  # texts aligned at once
PIECE_UNITS = 1 << 17  # units of a long text worked on at once
CACHE_SIZE = 1 << 19   # units that a worker remembers
BUFFER_PAIRS = 1 << 21  # pair counts that a task holds before it passes them on
_LONG = 64             # longer units are encoded but not remembered

# A unit starts at a space and ends before the next space that follows a character other than white space.
UNITS = re.compile(r" \s*+(?:\S++|[^\S ]\s*+)*+")


def byte_alphabet() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, others for 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, the bytes of their ids, and the encoded units of this worker."""

    def __init__(self, tokenizer_json: str, model: bytes, cache_size: int = CACHE_SIZE):
        import sentencepiece
        from tokenizers import Tokenizer

        kind = json.loads(tokenizer_json)
        pre = kind.get("pre_tokenizer") or {}
        if kind.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or not pre.get("use_regex", True):
            raise ValueError("A must be a byte-level BPE without normalizer and prefix space")
        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            known = all(c in alphabet for c in entry)
            self.a_bytes[i] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("B has pieces with a space after other characters")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p)
                        else p.replace("▁", " ").encode() for p in pieces]
        self.space = self.b.piece_to_id("▁")
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.limit, self.known = cache_size, {}

    def _encode(self, units: list[str]) -> list[tuple[bytes, bytes] | None]:
        """A and B ids of each unit as packed 32-bit numbers; None if the bytes of either differ from the unit's.

        Units that end in a character other than white space are joined and
        encoded as one text, whose tokens are then cut where the units end.
        """
        text = "".join(units)
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:]) if text != " " else [self.space]
        raw = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            half = len(units) // 2
            return [*self._encode(units[:half]), *self._encode(units[half:])] if half else [None]
        ends = np.cumsum([len(u.encode()) for u in units])
        rows = []
        for ids, sizes in ((a, self.a_sizes), (b, self.b_sizes)):
            ids = np.array(ids, np.uint32)
            cuts = (4 * np.searchsorted(np.cumsum(sizes[ids]), ends) + 4).tolist()
            packed = ids.tobytes()
            rows.append([packed[lo:hi] for lo, hi in zip([0, *cuts], cuts)])
        return list(zip(*rows))

    def learn(self, rows: list[list[str]]) -> list[str]:
        """Encodes the units that are not known yet; returns those too long to be remembered."""
        known, units = self.known, dict.fromkeys(chain.from_iterable(rows))
        new = [u for u in units if u not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            new = list(units)
        joined = [u for u in new if not u[-1].isspace()]
        if joined:
            known.update(zip(joined, self._encode(joined)))
        if len(joined) < len(new):
            known.update((u, self._encode([u])[0]) for u in new if u[-1].isspace())
        return [u for u in new if len(u) > _LONG]

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """A and B ids of a row of learned units, None if any of them has other bytes."""
        found = [self.known[u] for u in units]
        if None in found:
            return None
        return tuple(np.frombuffer(b"".join(x), np.uint32) for x in zip(*found))


def unit_pieces(text: str, size: int = PIECE_UNITS) -> Iterator[list[str]]:
    """The units of space + text, in rows of at most ``size``."""
    if len(text) <= 1 << 16:
        yield UNITS.findall(" " + text)
        return
    row: list[str] = []
    for m in UNITS.finditer(" " + text):
        row.append(m.group())
        if len(row) == size:
            yield row
            row = []
    if row:
        yield row


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, int]:
    """For every A token, then every B token, the place of the last A token of its group, and the rounds it took.

    ``ends_*`` are the byte offsets where the tokens end; both rows cover the
    same bytes without gaps and no token is empty.
    """
    n = len(ends_a)
    starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
    over_b = np.searchsorted(starts_b, ends_a) - 1  # the last B token that begins before the A token ends
    over_a = np.searchsorted(starts_a, ends_b) - 1
    own = np.arange(n)
    step = np.concatenate([np.where(ends_b[over_b] > ends_a, n + over_b, own), over_a])
    rounds = 0
    while True:
        further = step[step]
        rounds += 1
        if np.array_equal(further, step):
            return step, rounds
        step = further


def _id_texts(n: int) -> np.ndarray:
    """Rows of bytes: the decimals of id // 3 and the separator ``,|;`` number id % 3, padded with zeros."""
    width = len(str(n)) + 1
    return np.array([f"{i}{c}".encode() for i in range(n) for c in ",|;"], f"S{width}").view(np.uint8).reshape(-1, width)


class Block:
    """Aligned pieces of texts: the ends of their tokens, groups and links."""

    def __init__(self, pair: Pair, a: list[np.ndarray], b: list[np.ndarray], id_texts: np.ndarray):
        self.a_cuts, self.b_cuts = (np.cumsum([0, *map(len, x)]) for x in (a, b))
        ids_a, ids_b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        ends_a, ends_b = np.cumsum(pair.a_sizes[ids_a]), np.cumsum(pair.b_sizes[ids_b])
        n_a, n_b = len(ids_a), len(ids_b)
        label, _ = group_labels(ends_a, ends_b)
        self.last_a = np.flatnonzero(label[:n_a] == np.arange(n_a))   # one A token for each group
        self.last_b = np.append(np.flatnonzero(np.diff(label[n_a:])), n_b - 1)
        self.links = ids_a[self.last_a] * len(pair.b_bytes) + ids_b[self.last_b]
        # Written order: the A tokens of a group, then its B tokens. A token's place is its own place in its row
        # and the other kind's tokens of earlier groups (for B, of its own group too).
        group_a, group_b = (np.searchsorted(self.last_a, x) for x in (label[:n_a], label[n_a:]))
        code = np.empty(n_a + n_b, np.int64)
        sep_a, sep_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        sep_a[self.last_a], sep_b[self.last_b] = 1, 2
        code[np.arange(n_a) + np.concatenate([[0], self.last_b + 1])[group_a]] = ids_a * 3 + sep_a
        code[np.arange(n_b) + self.last_a[group_b] + 1] = ids_b * 3 + sep_b
        text = id_texts[code]
        used = np.count_nonzero(text, axis=1)
        self.text_cuts = np.concatenate([[0], np.cumsum(used)])[self.a_cuts + self.b_cuts]
        flat = text.reshape(-1)
        self.text = flat[flat != 0].tobytes()
        self.group_cuts = np.searchsorted(self.last_a, self.a_cuts)

    def piece(self, k: int) -> tuple[int, int, int, bytes, np.ndarray]:
        """Of a piece: A tokens, B tokens, groups, their text with a closing ``;``, links."""
        lo, hi = self.group_cuts[k], self.group_cuts[k + 1]
        return (int(self.a_cuts[k + 1] - self.a_cuts[k]), int(self.b_cuts[k + 1] - self.b_cuts[k]), int(hi - lo),
                self.text[self.text_cuts[k]:self.text_cuts[k + 1]], self.links[lo:hi])


class Aligned:
    """What is known of a text so far."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = 0
        self.digest, self.links = hashlib.sha256(), []

    def add(self, n_a: int, n_b: int, n_groups: int, text: bytes, links: np.ndarray) -> None:
        self.digest.update((b";" if self.n_groups else b"") + text[:-1])
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups
        self.links.append(links)

    def all_links(self) -> np.ndarray:
        return np.concatenate(self.links) if self.links else np.empty(0, np.int64)


def align_texts(pair: Pair, texts: list[str], id_texts: np.ndarray, block_chars: int = BLOCK_CHARS,
                piece_units: int = PIECE_UNITS) -> list[Aligned]:
    """Every text encoded, cut into groups and linked; texts with other bytes have no tokens."""
    out = [Aligned() for _ in texts]
    waiting, chars = [], 0
    wrong: set[int] = set()

    def flush():
        nonlocal chars
        long = pair.learn([units for _, units in waiting])
        encoded = [(i, pair.ids(units)) for i, units in waiting]
        wrong.update(i for i, ids in encoded if ids is None)
        encoded = [(i, *ids) for i, ids in encoded if ids is not None]
        if encoded:
            block = Block(pair, [a for _, a, _ in encoded], [b for _, _, b in encoded], id_texts)
            for k, (i, _, _) in enumerate(encoded):
                out[i].add(*block.piece(k))
        for unit in long:
            del pair.known[unit]
        waiting.clear()
        chars = 0

    for i, text in enumerate(texts):
        for units in unit_pieces(text, piece_units) if text else ():
            waiting.append((i, units))
            chars += sum(map(len, units))
            if chars >= block_chars:
                flush()
    if waiting:
        flush()
    for i in wrong:
        out[i] = Aligned()
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def packing(pair: Pair) -> str:
    """The number type that holds every id pair."""
    return "<u4" if len(pair.a_bytes) * len(pair.b_bytes) <= 1 << 32 else "<u8"


_worker: dict = {}  # of this Python worker: the tokenizers and units of the last pair it used


def _pair(tokenizer_json: str, model: bytes, cache_size: int) -> tuple[Pair, np.ndarray]:
    key = (hash(tokenizer_json), hash(model), cache_size)
    if _worker.get("key") != key:
        pair = Pair(tokenizer_json, model, cache_size)
        _worker.update(key=key, pair=(pair, _id_texts(max(len(pair.a_bytes), len(pair.b_bytes)))))
    return _worker["pair"]


def _write_alignment(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, model: bytes,
                     cache_size: int) -> DataFrame:
    """Documents (``row`` is not null) and the pair counts of tasks (``keys``, ``counts``), written once."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer_json, model))  # the two files
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.LongType()),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, id_texts = _pair(*shared.value, cache_size)
        packed = packing(pair)
        held, size, id_type = [], 0, None

        def counts_row():
            keys, counts = summed(*map(np.concatenate, zip(*held)))
            columns = [pa.nulls(1, id_type), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()),
                       pa.nulls(1, pa.binary()), pa.array([keys]), pa.array([counts])]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            id_type = batch.column(0).type
            texts, lo = str_rows(batch.column(2)), 0
            while lo < len(texts):  # a few million characters at once
                hi, chars = lo, 0
                while hi < len(texts) and chars < BLOCK_CHARS:
                    chars += len(texts[hi])
                    hi += 1
                found = align_texts(pair, texts[lo:hi], id_texts)
                links = [x.all_links() for x in found]
                every = np.sort(np.concatenate(links))
                if len(every):
                    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
                    held.append((every[first], np.diff(np.append(first, len(every)))))
                    size += len(first)
                numbers = [[x.n_a for x in found], [x.n_b for x in found], [x.n_groups for x in found],
                           [len(x) for x in links]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     *[pa.array(x, pa.int64()) for x in numbers],
                     pa.array([x.digest.hexdigest() if x.n_groups else "" for x in found]),
                     pa.array([x.astype(packed).tobytes() for x in links], pa.binary()),
                     *[pa.nulls(hi - lo, pa.list_(pa.int64()))] * 2], names)
                if size >= BUFFER_PAIRS:
                    yield counts_row()
                    held, size = [], 0
                lo = hi
        if held:
            yield counts_row()

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    path = scratch_path(spark, "token-links")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _frequent(counts: DataFrame, table_size: int) -> DataFrame:
    """The pairs whose count reaches the least power of two that at most ``table_size`` pairs reach."""
    power = F.floor(F.log2("n")).cast("int")
    least, total = 63, 0
    for p, pairs in sorted(counts.groupBy(power.alias("p")).agg(F.count(F.lit(1))).collect(), reverse=True):
        total += pairs
        if total > table_size:
            break
        least = p
    return counts.where(power >= least)


def _look_up(rows: DataFrame, frequent: DataFrame, best: DataFrame, n_b: int, packed: str) -> DataFrame:
    """``rows`` with the sums over links of frequent pairs, and the links of all others."""
    spark = rows.sparkSession
    found = frequent.toArrow()  # at most table_size rows
    keys, counts = (found.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys)
    top = np.zeros(n_b, np.int64)
    for b, n in best.collect():  # one row a B id
        top[b] = n
    shared = spark.sparkContext.broadcast((keys[order], counts[order], top))
    kept = [c for c in rows.columns if c != "links"]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("hit_best", T.LongType()),
                           T.StructField("hit_sum", T.LongType()), T.StructField("rest", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, top = shared.value
        for batch in batches:
            best_of, sums, rest = [], [], []
            for raw in batch.column(kept_links).to_pylist():
                link = np.frombuffer(raw, packed).astype(np.int64)
                at = np.minimum(np.searchsorted(keys, link), max(len(keys) - 1, 0))
                hit = keys[at] == link if len(keys) else np.zeros(len(link), bool)
                n = counts[at[hit]] if len(keys) else np.empty(0, np.int64)
                best_of.append(int((n == top[link[hit] % n_b]).sum()))
                sums.append(int(n.sum()))
                rest.append(link[~hit])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(kept))], pa.array(best_of, pa.int64()),
                 pa.array(sums, pa.int64()), pa.array(rest, pa.list_(pa.int64()))], schema.names)

    kept_links = len(kept)
    return rows.select(*kept, "links").mapInArrow(run, schema)


def align(docs: DataFrame, tokenizer: str, model: str, id_col: str = "doc_id", text_col: str = "text",
          table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``tokenizer`` and ``model`` are the paths of A's ``.json`` and B's ``.model``.
    """
    with open(tokenizer, encoding="utf-8") as f:
        tokenizer_json = f.read()
    with open(model, "rb") as f:
        model_bytes = f.read()
    pair = Pair(tokenizer_json, model_bytes, 1)
    n_b = len(pair.b_bytes)
    written = _write_alignment(docs, id_col, text_col, tokenizer_json, model_bytes, cache_size)
    counts = cut_lineage(written.where("row IS NULL")
                         .select(F.explode(F.arrays_zip("keys", "counts")).alias("x"))
                         .groupBy(F.col("x.keys").alias("key")).agg(F.sum("x.counts").alias("n")))
    best = cut_lineage(counts.groupBy((F.col("key") % n_b).cast("int").alias("b")).agg(F.max("n").alias("top")))
    rows = written.where("row IS NOT NULL").drop("keys", "counts")
    looked = cut_lineage(_look_up(rows, _frequent(counts, table_size), best, n_b, packing(pair)))
    rare = (looked.select("row", F.explode("rest").alias("key")).join(counts, "key")
            .join(F.broadcast(best), (F.col("key") % n_b).cast("int") == F.col("b"))  # one row a B id
            .groupBy("row").agg(F.sum((F.col("n") == F.col("top")).cast("long")).alias("rare_best"),
                                F.sum("n").alias("rare_sum")))
    zero = F.lit(0).cast("long")
    return (looked.join(rare, "row", "left")
            .select("id", "n_a", "n_b", "n_groups", "n_links",
                    (F.col("hit_best") + F.coalesce("rare_best", zero)).alias("n_best"),
                    (F.col("hit_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"), "groups_sha256"))
