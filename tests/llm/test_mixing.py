import re
from collections import Counter

import pytest

from conftest import SMALL_SF
from helpers import CLASHING, awkward, empty, frame
from marquee.llm import mixing

SF = SMALL_SF.replace("0.001", "0.01")


def plain_targets(sizes):
    """Water filling by rounds, as the rule is worded."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 70}, {"x": 3}, {"a": 0, "b": 0}, {"é": 50, "z": 50, "Z": 50, "": 50},
    {f"s{i}": (i * 37) % 101 for i in range(30)}])
def test_targets_equal_the_rounds(spark, sizes):
    rows = mixing.source_targets(frame(spark, list(sizes.items()), "source STRING, source_size BIGINT")).collect()
    want = plain_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in rows} == want
    assert all(r.target <= 2 * r.source_size for r in rows)


def test_plan_meets_targets_and_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == docs.count() and all(0 <= r["copies"] <= 2 for r in plan)
    sizes, taken, target = Counter(), Counter(), {}
    for r in plan:
        text = r["row"]["text"] or ""
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text))
        sizes[r["row"]["source"]] += r["size"]
        taken[r["row"]["source"]] += r["size"] * r["copies"]
        target[r["row"]["source"]] = r["target"]
    want = plain_targets(dict(sizes))
    largest = max(r["size"] for r in plan)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 2 * largest + 0.02 * target[s]


def test_mix_emits_the_plan_and_reruns_agree(spark):
    docs = awkward(spark)
    mixed = mixing.systematic_mix(docs)
    assert mixed.columns == docs.columns
    first = Counter(map(str, mixed.collect()))
    assert first == Counter(map(str, mixing.systematic_mix(docs.repartition(5)).collect()))
    plan = mixing.mix_plan(docs).collect()
    assert sum(first.values()) == sum(r["copies"] for r in plan)
    assert all(r["row"][CLASHING[0]] == "id!" for r in plan)
    assert mixing.systematic_mix(empty(spark)).count() == 0


def test_native_plan(spark):
    plan = mixing.systematic_mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
