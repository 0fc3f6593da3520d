"""Measure how one hot key spreads over tasks, from Spark's event log.

Derives a line-item table in which one order key and one part key hold
about a third of all rows, forces sort-merge joins (no broadcast, as for
inputs too large to broadcast), runs each variant under its own job
description, and reports per variant: wall seconds, the largest number of
shuffle records read by one task, and the worst straggler factor (largest
task / mean task of the same stage, over stages with 2+ tasks).
Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

import zstandard
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, ".")
from marquee.operators import avg_by_key, avg_by_packed_key, rank_within, split_join, top_n_per_group  # noqa: E402
from marquee.sources.tables import read_table  # noqa: E402


def events(log_dir):
    for path in glob.glob(os.path.join(log_dir, "*", "*")) + glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(path):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode(errors="replace").splitlines():
            if line.startswith("{"):
                yield json.loads(line)


def aqe_skew_split(spark, sf_dir) -> bool:
    """Does AQE mark a plain sort-merge join on the hot key as skewed?

    AQE splits a skewed partition along map-output blocks, so it needs more
    than one map task (the local files hold one row group each); its size
    thresholds are lowered to match this data size for the check.
    """
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders = read_table(spark, sf_dir, "orders")
        # Rows spread over 16 map tasks first, as a large input read by many
        # tasks would be; the hot key is derived in those tasks.
        lines = (read_table(spark, sf_dir, "lineitem").repartition(16)
                 .withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(7))
                             .otherwise(F.col("l_orderkey"))))
        j = (orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"])
             .groupBy("l_returnflag").agg(F.avg("o_totalprice")))
        j.collect()  # run this DataFrame's own plan so explain() shows the final one
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        return "skew=true" in buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-events-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             # one task per shuffle partition, so task sizes show the key spread
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skew-ckpt-"))
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part")
    hot = F.col("l_linenumber") <= 2  # about a third of the rows
    lines = (read_table(spark, sf_dir, "lineitem")
             .withColumn("l_orderkey", F.when(hot, F.lit(7)).otherwise(F.col("l_orderkey")))
             .withColumn("l_partkey", F.when(hot, F.lit(11)).otherwise(F.col("l_partkey"))))
    share = lines.filter(hot).count() / lines.count()

    # As many map tasks as a large input would have: AQE splits along their outputs.
    lines = (read_table(spark, sf_dir, "lineitem").repartition(16)
             .withColumn("l_orderkey", F.when(hot, F.lit(7)).otherwise(F.col("l_orderkey")))
             .withColumn("l_partkey", F.when(hot, F.lit(11)).otherwise(F.col("l_partkey"))))

    def child_mean():
        return avg_by_key(orders, lines, [("o_orderkey", "l_orderkey")], "l_returnflag", "o_totalprice")

    def child_mean_split():
        return avg_by_key(orders, lines, [("o_orderkey", "l_orderkey")], "l_returnflag", "o_totalprice",
                          split_heavy=True)

    def part_lines_split():
        return split_join(lines, part, [("l_partkey", "p_partkey")]).groupBy("p_brand").agg(F.sum("l_quantity"))

    # One group with all rows and nearly all-distinct values.
    one_group = lines.select(F.lit(1).alias("g"), (F.col("l_extendedprice") * 1000 + F.col("l_linenumber")).alias("v"))

    def plain_packed():
        j = part.join(lines, part["p_partkey"] == lines["l_partkey"])
        return (j.select(F.explode(F.split("p_name", " ")).alias("w"), "l_extendedprice")
                .groupBy("w").agg(F.avg("l_extendedprice")))

    ranked = lines.select("l_partkey", "l_quantity", "l_orderkey")

    def textbook_top3():
        w = Window.partitionBy("l_partkey").orderBy(F.col("l_quantity").desc())
        return ranked.withColumn("rank", F.rank().over(w)).where("rank <= 3")

    scaled = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"}
    off = {"spark.sql.adaptive.skewJoin.enabled": "false"}
    variants = {
        "child_mean_no_skew_join": (child_mean, off),
        "child_mean": (child_mean, scaled),
        "child_mean_split_join": (child_mean_split, off),
        "part_lines_split_join": (part_lines_split, off),
        "one_group_textbook_rank": (lambda: one_group.withColumn(
            "rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc()))), off),
        "one_group_rank_within": (lambda: rank_within(one_group, "g", "v"), off),
        "packed_mean_plain_join": (plain_packed, off),
        "packed_mean_avg_by_packed_key": (lambda: avg_by_packed_key(
            part, lines, [("p_partkey", "l_partkey")], "p_name", "l_extendedprice", sep=" "), off),
        "top3_textbook_window": (textbook_top3, off),
        "top3_best_rows": (lambda: top_n_per_group(ranked, "l_partkey", "l_quantity", 3), scaled),
        "top3_counts_per_value": (lambda: rank_within(ranked, "l_partkey", "l_quantity").where("rank <= 3"), scaled),
    }
    wall = {}
    aqe_split = aqe_skew_split(spark, sf_dir)
    for name, (build, conf) in variants.items():
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobDescription(name)
        t0 = time.time()
        build().write.format("noop").mode("overwrite").save()
        wall[name] = time.time() - t0
        for k, v in old.items():
            spark.conf.set(k, v)
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    job_name, stage_job = {}, {}
    per_stage = defaultdict(list)
    for e in events(log_dir):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            job_name[e["Job ID"]] = desc
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            name = job_name.get(stage_job.get(e["Stage ID"]))
            if name:
                per_stage[(name, e["Stage ID"])].append(recs)
    print(f"hot rows: {share:.1%} of {sf_dir}")
    print(f"AQE splits a plain join's hot partition (fact side from 16 map tasks, "
          f"thresholds scaled to this size): {aqe_split}")
    print(f"{'variant':34s} {'wall s':>7s} {'max task recs':>14s} {'median':>9s} {'straggler':>10s}")
    for name in variants:
        stages = [v for (n, _), v in per_stage.items() if n == name and sum(v)]
        biggest = max((max(v) for v in stages), default=0)
        # median of the stage that has the largest task, over tasks with rows
        widest = max(stages, key=max, default=[0])
        middle = statistics.median([x for x in widest if x] or [0])
        worst = max((max(v) / (sum(v) / len(v)) for v in stages if len(v) > 1), default=1.0)
        print(f"{name:34s} {wall[name]:7.2f} {biggest:14d} {middle:9.0f} {worst:9.1f}x")


if __name__ == "__main__":
    main()
