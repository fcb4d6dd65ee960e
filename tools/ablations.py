"""Pairs of plans for the same rows, timed: what each technique is worth here.

    python tools/ablations.py [--cpus N] [--rows N]
"""

from __future__ import annotations

import argparse
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from weftline.functions.scalars import money, quantity_sum  # noqa: E402
from weftline.operators import joins as J, skew as S, windows as W  # noqa: E402
from weftline.operators.reuse import persisted  # noqa: E402
from weftline.plans.shared import orders_by_month  # noqa: E402
from weftline.session import build_session  # noqa: E402
from weftline.sources.tables import load  # noqa: E402


def timed(run, repeat=3) -> float:
    run()
    seconds = []
    for _ in range(repeat):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def report(name, **runs) -> None:
    times = {label.replace("_", " "): timed(run) for label, run in runs.items()}
    print(f"| {name} | " + ", ".join(f"{label} {t:.2f}" for label, t in times.items()) + " |", flush=True)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--cpus", default="8")
    ap.add_argument("--rows", type=int, default=20_000_000)
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    spark = build_session(
        "ablations", f"local[{args.cpus}]", **{"spark.sql.shuffle.partitions": "16", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("OFF")

    items = load(spark, args.sf, "lineitem").select("l_orderkey", "l_quantity", F.col("l_suppkey").alias("s_suppkey"))
    suppliers = load(spark, args.sf, "supplier")
    report(
        "line items with their suppliers",
        sort_merge=lambda: noop(J.sort_merge_join(items, suppliers, ["s_suppkey"])),
        shuffle_hash=lambda: noop(J.shuffle_hash_join(items, suppliers, ["s_suppkey"])),
        broadcast=lambda: noop(J.broadcast_join(items, suppliers, ["s_suppkey"])),
    )

    table = orders_by_month(spark, args.sf)
    month = (F.col("year") == 1998) & (F.col("month") == 3)
    report("orders of one month", full_scan=lambda: noop(table), pruned=lambda: noop(table.where(month)))

    orders, lines = load(spark, args.sf, "orders"), load(spark, args.sf, "lineitem")
    on, keep = lines.l_orderkey == orders.o_orderkey, (F.col("o_orderstatus") == "F") & (F.col("l_returnflag") == "R")
    early = lines.where(F.col("l_returnflag") == "R").join(orders.where(F.col("o_orderstatus") == "F"), on)
    report("filter and join", filter_after=lambda: noop(lines.join(orders, on).where(keep)), filter_before=lambda: noop(early))

    base = lines.where(F.col("l_quantity") >= 25).select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    outputs = ["l_returnflag", "l_linestatus", "l_linenumber"]

    def cached() -> None:
        with persisted(base) as kept:
            for key in outputs:
                noop(kept.groupBy(key).agg(quantity_sum().alias("qty")))

    def uncached() -> None:
        for key in outputs:
            noop(base.groupBy(key).agg(quantity_sum().alias("qty")))

    report("three outputs of one base", uncached=uncached, cached=cached)

    # One key holds a third of the rows. The cluster's limits are lowered to the size of this test.
    n = args.rows
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50_000)
    hot = spark.range(n).select("id", key.alias("key"), (F.col("id") % 1000).alias("v"))
    dim = spark.range(-1, 50_000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    is_hot = S.in_groups(["key"], S.hot_groups(hot, ["key"], n // 50))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    report(
        f"hot key, join of {n // 1_000_000} M rows",
        plain=lambda: noop(J.sort_merge_join(hot, dim, ["key"])),
        salted=lambda: noop(S.salted_join(hot, dim.hint("merge"), ["key"], 16, ["id"])),
        split=lambda: noop(S.split_skew_join(hot, dim.hint("merge"), ["key"], is_hot, 16, "inner", ["id"])),
    )
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    total = {"total": ("sum", "v")}
    report(
        "hot key, sum",
        plain=lambda: noop(hot.groupBy("key").agg(F.sum("v").alias("total"))),
        two_phase=lambda: noop(S.salted_agg(hot, ["key"], 16, total, ["id"])),
    )
    for name, call in {
        "running total": lambda limit: W.running(hot, ["key"], ["id"], F.col("v"), "t", limit),
        "rank": lambda limit: W.rank_in(hot, ["key"], ["id"], [], max_rows=limit),
        "lag and lead": lambda limit: W.shift_in(hot, ["key"], ["id"], "v", 1, limit),
    }.items():
        report(
            f"hot key, {name}",
            one_task_per_key=lambda call=call: noop(call(n * 10)),
            hot_key_cut=lambda call=call: noop(call(n // 50)),
        )

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    wide = lines.groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("price"))
    runs = {}
    cores = spark.sparkContext.defaultParallelism
    for partitions in (cores, 4 * cores, 16 * cores, 64 * cores):

        def run(partitions=partitions) -> None:
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            noop(wide)

        runs[f"{partitions}"] = run
    report("group by with so many shuffle partitions, none merged", **runs)


if __name__ == "__main__":
    main()
