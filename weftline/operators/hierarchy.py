"""Walk of a hierarchy given as parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weftline.operators.skew import hot_counts, hot_rows, in_groups, salts_for, split_skew_join
from weftline.session import materialise, scratch

#: Links of double length are made as long as there are at most so many for each edge.
GROWTH = 4


def walk(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes reachable from ``roots`` with the length of the shortest path; ``edges`` has ``node`` and ``parent``.

    Path doubling: a link leads from a node to an ancestor that is exactly ``stride`` steps up. Each round finds all nodes
    up to ``stride`` steps deeper than those known, because the ancestor on a shortest path is known then, and
    puts links of the others together in pairs, which doubles the stride. A chain of depth d takes about log2(d) rounds
    instead of d. The links of found nodes are dropped.

    Where nodes have many parents, links of double length may become very many; beyond ``GROWTH`` for each edge, counted
    before they are made, the stride stays and the rounds go on with it. Cycles end because a round that finds no node is the last.
    Edges with a null on either side lead nowhere. A parent with very many children is joined with salt. Every round is written
    to the shared folder, so the plan stays short and a lost executor costs one round only.
    """
    spark = edges.sparkSession
    path = scratch(spark, "levels")
    kind = roots.schema["node"].dataType.simpleString()
    schema = f"node {kind}, depth int"
    roots.select(F.col("node").cast(kind).alias("node"), F.lit(0).alias("depth")).distinct().write.parquet(f"{path}/0")
    known = spark.read.schema(schema).parquet(f"{path}/0")
    usable = F.col("node").isNotNull() & F.col("up").isNotNull() & (F.col("node") != F.col("up"))
    links = edges.select(F.col("node").cast(kind).alias("node"), F.col("parent").cast(kind).alias("up")).where(usable).distinct()
    links, count = _written(links.join(known, "node", "left_anti"))
    most, forks = count * GROWTH, count > links.select("node").distinct().count()
    stride, deepest, doubling, rounds = 1, 0, True, [f"{path}/0"]
    while count:
        # Only nodes of the last ``stride`` depths can be ancestors of a node that is not known yet.
        above = spark.read.schema(schema).parquet(*rounds).where(F.col("depth") > deepest - stride)
        reached = _climb(links, above.select(F.col("node").alias("up"), "depth"), count)
        found, seen = reached.groupBy("node").agg((F.min("depth") + stride).cast("int").alias("depth")), Observation()
        rounds.append(f"{path}/{len(rounds)}")
        found.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(rounds[-1])
        if not seen.get["n"]:
            break
        deepest += stride
        open_ = links.join(spark.read.schema(schema).parquet(rounds[-1]).select("node"), "node", "left_anti")
        upper = links.select(F.col("node").alias("up"), F.col("up").alias("top"))
        if doubling and deepest > 1:
            if forks:
                longer = open_.join(upper.groupBy("up").agg(F.count("*").alias("n")), "up").agg(F.sum("n")).first()[0] or 0
                doubling = longer <= most
            if doubling:
                open_ = _climb(open_, upper, count).select("node", F.col("top").alias("up"))
                open_ = open_.distinct() if forks else open_
                stride *= 2
        links, count = _written(open_)
    return spark.read.schema(schema).parquet(*rounds)


def _climb(links: DataFrame, upper: DataFrame, count: int) -> DataFrame:
    """``links`` joined with what is above their upper end; ancestors of very many nodes are salted."""
    spark = links.sparkSession
    hot = hot_counts(links, ["up"]) if count > hot_rows(spark) else {}
    if not hot:
        return links.join(upper, "up")
    return split_skew_join(links, upper, ["up"], in_groups(["up"], list(hot)), salts_for(hot, hot_rows(spark)), salt_by=["node"])


def _written(links: DataFrame) -> tuple[DataFrame, int]:
    seen = Observation()
    kept = materialise(links.observe(seen, F.count(F.lit(1)).alias("n")), "links")
    return kept, seen.get["n"]
