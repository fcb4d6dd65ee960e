"""Comparison of two copies of a table by a tree of hashes.

Keys are hashed, and a leaf of the tree is a range of key hashes. The hash of a leaf sums the hashes of its rows, the hash of a node those of
its children, so no order matters and one pass per copy is enough, combined before the shuffle. From the root down only
children of nodes that differ are looked at, and in the end only the rows of differing leaves are read
again. The tree of a copy can be stored and compared with later copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weftline.session import materialise

#: Bits of the key hash that name a leaf, and bits by which a level is finer than the one above.
LEAF_BITS, FAN_BITS = 16, 4


def leaf_of(keys: Sequence[str], bits: int = LEAF_BITS) -> Column:
    """Number of the leaf of a row, also for null keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # A hash passes over nulls, so their places are hashed too.
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(20,0)")


def hash_tree(df: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS) -> DataFrame:
    """(leaf, n, one, two) of every leaf with rows: their number and the sums of two independent hashes of the rows."""
    columns = sorted(df.columns)
    return df.groupBy(leaf_of(keys, bits).alias("leaf")).agg(
        F.count("*").alias("n"), F.sum(_row_hash(columns, 1)).alias("one"), F.sum(_row_hash(columns, 2)).alias("two")
    )


def _level(tree: DataFrame, shift: int) -> DataFrame:
    node = F.shiftright("leaf", shift).alias("node")
    return tree.groupBy(node).agg(F.struct(F.sum("n"), F.sum("one"), F.sum("two")).alias("sums"))


def differing_leaves(left: DataFrame, right: DataFrame, bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """(leaf) of two trees that differ, from the root down. Trees have at most 2**bits rows, whatever the tables have."""
    wrong = None
    for shift in range(bits, -1, -fan_bits):
        a, b = (_level(t if wrong is None else _under(t, wrong, shift + fan_bits), shift) for t in (left, right))
        other = b.select(F.col("node").alias("_node"), F.col("sums").alias("_sums"))
        both = a.join(other, F.col("node") == F.col("_node"), "full").where(~F.col("sums").eqNullSafe(F.col("_sums")))
        wrong = materialise(both.select(F.coalesce("node", "_node").alias("node")), "tree-level")
        if wrong.isEmpty():
            break
    return wrong.select(F.col("node").alias("leaf"))


def _under(tree: DataFrame, nodes: DataFrame, shift: int) -> DataFrame:
    """The leaves below nodes of a level."""
    named = nodes.select(F.col("node").alias("_up"))
    return tree.join(named, F.shiftright("leaf", shift) == F.col("_up"), "left_semi")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """Rows that only one of two tables with the same columns has, with ``side`` (before or after) and ``copies``.

    A row that one table has more often counts with the difference. Fewer rows per leaf, so more ``bits``, mean that fewer rows are read again.
    ``bits`` must be a multiple of ``fan_bits``.
    """
    if bits % fan_bits or not 0 < bits <= 48:
        raise ValueError("bits must be a multiple of fan_bits and at most 48")
    columns = before.columns
    after = after.select(*columns)
    trees = [materialise(hash_tree(t, keys, bits), "hash-tree") for t in (before, after)]
    leaves = differing_leaves(*trees, bits, fan_bits)
    again = [suspects(t, leaves, keys, bits) for t in (before, after)]
    signed = again[0].withColumn("_sign", F.lit(-1)).unionByName(again[1].withColumn("_sign", F.lit(1)))
    balance = signed.groupBy(*columns).agg(F.sum("_sign").alias("_balance")).where("_balance != 0")
    side = F.when(F.col("_balance") < 0, "before").otherwise("after").alias("side")
    return balance.select(*columns, side, F.abs("_balance").alias("copies"))


def suspects(table: DataFrame, leaves: DataFrame, keys: Sequence[str], bits: int = LEAF_BITS) -> DataFrame:
    """The rows of the given leaves. There are at most 2**bits leaves; Spark broadcasts them if their files are small."""
    named = leaves.select(F.col("leaf").alias("_leaf"))
    return table.join(named, leaf_of(keys, bits) == F.col("_leaf"), "left_semi")
