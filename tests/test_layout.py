from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import changes as H
from weftline.session import scratch, scratch_root, scratch_table
from weftline.sources import catalog as C, layout as L
from weftline.sources.tables import read_evolved


def small_files(spark, appends=5):
    path = scratch(spark, "small")
    for i in range(appends):
        part = spark.range(i * 100, i * 100 + 100).select("id", (F.col("id") % 3).cast("int").alias("year"), F.lit(1).alias("month"))
        part.repartition(2).write.mode("append").partitionBy("year", "month").parquet(path)
    return path


def by_place(spark):
    """Twenty numbers in each of the places ``10:30``, ``a/b c`` and null."""
    path = scratch(spark, "places")
    place = F.when(F.col("id") % 3 == 0, "10:30").when(F.col("id") % 3 == 1, "a/b c")
    L.write_partitioned(spark.range(60).select("id", place.alias("place")), path, ["place"])
    return path


def counts(spark, path):
    return {r["place"]: r["count"] for r in spark.read.schema("id long, place string").parquet(path).groupBy("place").count().collect()}


def fresh(spark, place, n):
    return spark.range(n).select("id", F.lit(place).cast("string").alias("place"))


def test_overwrite_modes(spark):
    path = by_place(spark)
    L.overwrite(fresh(spark, "10:30", 7), path, ["place"], "dynamic")
    assert counts(spark, path) == {"10:30": 7, "a/b c": 20, None: 20}
    L.overwrite(fresh(spark, "x", 5), path, ["place"], "static")
    assert counts(spark, path) == {"x": 5}
    with pytest.raises(ValueError):
        L.overwrite(fresh(spark, "x", 5), path, ["place"], "other")


@pytest.mark.parametrize("place", ["10:30", "a/b c", None, "new"])
def test_overwrite_one_partition(spark, place):
    path = by_place(spark)
    both = fresh(spark, place, 3).unionByName(fresh(spark, "elsewhere", 9))
    L.overwrite_partition(both, path, {"place": place})
    assert counts(spark, path) == {"10:30": 20, "a/b c": 20, None: 20} | {place: 3}
    L.overwrite_partition(both.limit(0), path, {"place": place})
    assert counts(spark, path).get(place, 0) == 0 and sum(counts(spark, path).values()) in (40, 60)


def test_compaction_of_unpartitioned_and_empty_tables(spark):
    src, dst = scratch(spark, "flat"), scratch(spark, "flat")
    spark.range(100).repartition(7).write.parquet(src)
    L.compact(spark, src, dst, [])
    assert rows(spark.read.parquet(dst)) == rows(spark.range(100).toDF("id"))
    empty, target = scratch(spark, "empty"), scratch(spark, "empty")
    spark.range(0).select("id", F.lit(1).alias("p")).write.partitionBy("p").parquet(empty)
    L.compact(spark, empty, target, ["p"])


def test_compaction_keeps_rows_and_lowers_files(spark):
    src, dst = small_files(spark), scratch(spark, "compact")
    before = L.file_census(spark, src, ["year", "month"])
    L.compact(spark, src, dst, ["year", "month"])
    assert rows(spark.read.parquet(src)) == rows(spark.read.parquet(dst))
    assert before.agg(F.sum("files")).first()[0] == 30
    after = L.file_census(spark, dst, ["year", "month"]).collect()
    assert [r["files"] for r in after] == [1, 1, 1]


def test_compaction_splits_large_partitions(spark):
    src, dst = small_files(spark), scratch(spark, "compact")
    one = L.file_census(spark, src, ["year", "month"]).first()["bytes"]
    L.compact(spark, src, dst, ["year", "month"], target=one // 4)
    assert rows(spark.read.parquet(src)) == rows(spark.read.parquet(dst))
    assert all(1 < r["files"] <= 5 for r in L.file_census(spark, dst, ["year", "month"]).collect())


def test_census_counts_small_files(spark):
    found = L.file_census(spark, small_files(spark), ["year", "month"]).collect()
    assert all(r["small_files"] == r["files"] == 10 and r["avg_bytes"] * 10 == r["bytes"] for r in found)


def test_transform_partitioning_is_hidden(spark):
    path = scratch(spark, "transform")
    df = spark.range(100).select("id", F.timestamp_seconds(F.col("id") * 20_000_000).alias("at"))
    derived = {"_m": L.months("at"), "_b": L.bucket(4, "id")}
    L.write_transform_partitioned(df, path, derived)
    back = L.read_transform_partitioned(spark, path, list(derived))
    assert back.columns == df.columns and rows(back) == rows(df)
    some = L.read_transform_partitioned(spark, path, list(derived), where=F.col("_b") == 2)
    assert rows(some) == rows(df.where(L.bucket(4, "id") == 2))
    with pytest.raises(ValueError, match="clash"):
        L.write_transform_partitioned(df, path, {"id": F.lit(1)})


def test_insert_needs_the_same_columns_in_any_order(spark):
    name = scratch_table(spark, "t")
    C.create_partitioned_table(spark, name, "id BIGINT, amount DECIMAL(10,2), year INT", ["year"])
    C.insert_into(spark.sql("SELECT 2020 AS year, CAST(1.5 AS DECIMAL(10,2)) AS amount, 7L AS id"), name)
    assert [tuple(r) for r in spark.table(name).select("id", "amount", "year").collect()][0][0] == 7
    with pytest.raises(ValueError, match="columns differ"):
        C.insert_into(spark.sql("SELECT 2020 AS year, 7L AS id"), name)


def test_partition_admin(spark):
    name = scratch_table(spark, "t")
    C.create_partitioned_table(spark, name, "id BIGINT, year INT, month INT", ["year", "month"])
    numbers = spark.range(90).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3 + 2000).cast("int").alias("year"), (F.col("id") % 5).cast("int").alias("month"))
    C.insert_into(numbers, name)
    assert C.drop_partition(spark, name, {"year": 2001}) == 5
    C.add_partition(spark, name, {"year": 2030, "month": 1})
    assert C.list_partitions(spark, name).count() == 11
    assert C.list_partitions(spark, name, F.col("year") > 2024).collect() == [(2030, 1)]
    assert C.drop_partition(spark, name, {"year": None}) == 5
    assert spark.table(name).where("year IS NULL").count() == 0 and C.list_partitions(spark, name).count() == 6


def test_partition_values_are_unescaped(spark):
    name = scratch_table(spark, "t")
    C.create_partitioned_table(spark, name, "id BIGINT, place STRING", ["place"])
    C.insert_into(spark.createDataFrame([(1, "a/b=c d"), (2, None)], "id long, place string"), name)
    assert rows(C.list_partitions(spark, name)) == [("a/b=c d",), (None,)]


def test_column_stats_are_exact_where_promised(spark):
    name = scratch_table(spark, "t")
    spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id")).alias("v")).write.saveAsTable(name)
    stats = {r["column_name"]: r for r in C.column_stats(spark, name, ["id", "v"], histogram=True).collect()}
    assert (stats["id"]["min"], stats["id"]["max"], stats["v"]["num_nulls"]) == ("0", "999", "100")
    assert abs(int(stats["id"]["distinct_count"]) - 1000) < 100


def test_bucketed_pair_with_hot_key(spark):
    big = spark.range(2_000).select("id", F.when(F.col("id") < 1_500, 1).otherwise(F.col("id")).alias("k"))
    small = spark.range(2_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    tables = (scratch_table(spark, "big"), scratch_table(spark, "small"))
    C.write_join_pair(big, small, "k", tables, 8, "id", max_rows=100)
    assert rows(C.bucketed_join(spark, tables, "k")) == rows(big.join(small, "k"))
    salts = spark.table(tables[0]).where("k = 1").select("_salt").distinct().count()
    assert salts >= 15


def test_evolved_files(spark):
    old, new = scratch(spark, "old"), scratch(spark, "new")
    spark.range(2).write.parquet(old)
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(new)
    assert rows(read_evolved(spark, [old, new]), "id", "extra") == [(0, "x"), (0, None), (1, "x"), (1, None)]


def test_increment_is_repeatable_and_takes_late_rows(spark):
    path, parts = scratch(spark, "inc"), ["day"]
    source = spark.range(60).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("day"))
    L.write_partitioned(source.where("id < 30"), path, parts)
    for _ in range(2):
        H.load_increment(source, path, parts, "id")
        assert rows(spark.read.parquet(path), "id", "day") == rows(source, "id", "day")


def test_scratch_is_the_shared_folder(spark):
    root = scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")
    assert scratch(spark, "x").startswith(root)
