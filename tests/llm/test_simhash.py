import random

import numpy as np
import pytest
import xxhash

from helpers import awkward, empty, frame
from marquee.llm import simhash
from marquee.llm.components import connected_components


def plain_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits):
    """rows: (id, fingerprint); smallest reachable id per row."""
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for x in label:
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == x and rows[k][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def test_fingerprint_equals_plain_definition():
    rng = random.Random(3)
    for n in (0, 1, 3, 4, 5, 40):
        text = " ".join(rng.choice(["Ab", "é", "the", "X y", "ÄB"]) + str(rng.randrange(9)) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_spark_hash_agrees_with_the_fingerprint_of_one_shingle(spark):
    value = spark.sql("select xxhash64('a b c d')").first()[0] & (2 ** 64 - 1)
    assert value == simhash.fingerprint(b"A  b\tc d")


def cluster_of_fingerprints(n, seed):
    """Chains, balls and strangers around a few centres, as signed 64-bit values."""
    rng = random.Random(seed)
    values = []
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(n):
            value = centre
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
                value ^= 1 << rng.randrange(64)
            values.append(value)
            if rng.random() < 0.2:
                centre = value
    values += [rng.getrandbits(64) for _ in range(n)] + [0, 2 ** 64 - 1, 1, 2 ** 63]
    return sorted({int(np.uint64(v).astype(np.int64)) for v in values})


@pytest.mark.parametrize("bits", [1, 2, 3, 4, 5])
def test_quiet_and_hot_ways_give_the_same_components(spark, bits):
    values = cluster_of_fingerprints(25, bits)
    fps = frame(spark, [(v,) for v in values], "fp BIGINT")
    rows = [(v, v & (2 ** 64 - 1)) for v in values]
    pairs = {(a, b) for i, a in enumerate(values) for b in values[i + 1:]
             if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= bits}
    quiet = [tuple(r) for r in simhash.links(fps, bits, hot_bucket=10 ** 6).collect()]
    assert len(quiet) == len(set(quiet)) and {tuple(sorted(p)) for p in quiet} == pairs
    want = {v: c for (v, _), c in zip(rows, plain_components(rows, bits))}
    if bits > 3:  # the ball lists of a few thousand values a fingerprint
        fps = fps.where("fp > 0")
        rows = [r for r in rows if r[0] > 0]
        want = {v: c for (v, _), c in zip(rows, plain_components(rows, bits))}
    hot = connected_components(simhash.links(fps, bits, hot_bucket=1), "a", "b")
    got = {r.node: r.root for r in hot.collect()}
    assert all(got.get(v, v) == c for v, c in want.items())


def test_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == docs.count()
    given = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    want = sorted(((i, f, c) for (i, f), c in zip(given, plain_components(given, 4))), key=str)
    assert sorted(((r.id, r.fp & (2 ** 64 - 1), r.component) for r in rows), key=str) == want
    assert simhash.simhash_groups(empty(spark)).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (5, 4), (None, 3)]
    found = connected_components(frame(spark, edges, "a BIGINT, b BIGINT"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(frame(spark, [], "a BIGINT, b BIGINT"), "a", "b").count() == 0
