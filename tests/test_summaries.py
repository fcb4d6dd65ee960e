"""Path doubling, inequality joins, mergeable summaries, comparison by hashes, streamed groups, kept layouts."""

from __future__ import annotations

import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.operators import compare as C, hierarchy as H, pandas_groups as P, sketches as K
from weftline.operators.inequality import inequality_join
from weftline.plans.shared import once, orders_by_month
from weftline.session import scratch_scope

OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


# ---- hierarchy
def shortest(edges, roots):
    below = {}
    for node, parent in edges:
        below.setdefault(parent, []).append(node)
    depth, queue = dict.fromkeys(roots, 0), deque(roots)
    while queue:
        at = queue.popleft()
        for node in below.get(at, []):
            if node is not None and node not in depth:
                depth[node] = depth[at] + 1
                queue.append(node)
    return sorted(depth.items())


def walked(spark, edges, roots):
    found = H.walk(spark.createDataFrame(edges, "node long, parent long"), spark.createDataFrame([(r,) for r in roots], "node long"))
    return sorted(map(tuple, found.collect())), len({f.rsplit("/", 2)[-2] for f in found.inputFiles()})


def test_a_long_chain_takes_few_rounds(spark):
    chain = [(i + 1, i) for i in range(10_000)]
    found, rounds = walked(spark, chain, [0])
    assert found == [(i, i) for i in range(10_001)] and rounds <= 16  # the roots and 15 rounds


@pytest.mark.parametrize(("seed", "growth"), [(0, 4), (1, 4), (2, 0)])
def test_any_graph(spark, monkeypatch, conf, seed, growth):
    monkeypatch.setattr(H, "GROWTH", growth)  # 0: the stride stays one
    conf(spark__weftline__hotRows="5")
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i + 1, i) for i in range(200, 212)]
    edges += [(300 + 2 * i + k, 298 + 2 * i + j) for i in range(1, 8) for k in (0, 1) for j in (0, 1)]  # a ladder of diamonds
    edges += [(200, 3), (300, 7), (301, 7), (7, 1), (3, 1), (500, 501), (501, 500), (1, 212), (600, 600), (None, 1), (610, None)]
    edges += [(1000 + i, 5) for i in range(60)] + [(5, 1)] * 2
    assert walked(spark, edges, [1, 2])[0] == shortest(edges, [1, 2])


def test_walk_without_edges_or_roots(spark):
    assert walked(spark, [], [4])[0] == [(4, 0)] and walked(spark, [(2, 1)], [])[0] == []


# ---- inequalities
@pytest.mark.parametrize("block", [50_000, 7])
@pytest.mark.parametrize("one", list(OPS))
def test_inequalities_are_nested_loops(spark, block, one):
    rng = random.Random(block)
    number = lambda: rng.choice([None, 0, 0, 0, rng.randrange(-9, 10)])
    a = [(i, number(), float(number() or 0) if i % 9 else float("nan")) for i in range(60)]
    b = [(i, number(), number()) for i in range(50)]
    left, right = spark.createDataFrame(a, "i long, x int, z double"), spark.createDataFrame(b, "j long, y long, w int")
    for two in OPS if block == 7 else ["<="]:
        got = inequality_join(left, right, ("x", one, "y"), ("z", two, "w"), block_rows=block)
        want = [(i, j) for i, x, z in a for j, y, w in b if None not in (x, y, w) and OPS[one](x, y) and OPS[two](z, w)]
        assert rows(got, "i", "j") == sorted(want, key=repr)
    assert inequality_join(left.limit(0), right, ("x", one, "y"), ("z", "<", "w")).count() == 0


def test_overlaps_need_no_nested_loop_of_rows(spark):
    n = 4_000
    lasting = lambda name, shift: spark.range(n).select(
        F.col("id").alias(name), (F.col("id") * 10 + shift).alias(f"{name}0"), (F.col("id") * 10 + shift + 12).alias(f"{name}1")
    )
    a, b = lasting("a", 0), lasting("b", 5)
    met = inequality_join(a, b, ("a0", "<=", "b1"), ("a1", ">=", "b0"), block_rows=100)
    assert "NestedLoop" not in met._jdf.queryExecution().executedPlan().toString()
    want = {(i, j) for i in range(n) for j in range(max(0, i - 3), min(n, i + 3)) if i * 10 <= j * 10 + 17 and i * 10 + 12 >= j * 10 + 5}
    assert {tuple(r) for r in met.select("a", "b").collect()} == want


def test_inequality_join_refuses(spark):
    df = spark.range(2)
    with pytest.raises(ValueError, match="both sides"):
        inequality_join(df, df, ("id", "<", "id"), ("id", ">", "id"))
    with pytest.raises(ValueError, match="not an inequality"):
        inequality_join(df, df.toDF("j"), ("id", "=", "j"), ("id", ">", "j"))
    with pytest.raises(ValueError, match="neither"):
        inequality_join(df.withColumn("s", F.lit("x")), df.toDF("j"), ("s", "<", "j"), ("id", ">", "j"))


# ---- summaries
@pytest.mark.parametrize("share", [0.5, 0.1, 0.03])
def test_frequent_keys_are_exact(spark, share):
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 10 == 1, F.lit("b")).when(F.col("id") % 25 == 2, F.lit("c"))
    # One partition holds all rows of a key that is rare elsewhere.
    df = spark.range(0, 40_000, 1, 7).withColumn("key", F.when(F.col("id") < 1_800, F.lit("early")).otherwise(key.otherwise(F.concat(F.lit("k"), "id"))))
    df = df.withColumn("key", F.when((F.col("id") % 3 == 0) & (F.col("id") >= 1_800), F.lit(None)).otherwise(F.col("key")))
    counts = Counter(r["key"] for r in df.select("key").collect())
    want = sorted(((k, n) for k, n in counts.items() if n > 40_000 * share), key=repr)
    assert rows(K.frequent_keys(df, ["key"], share), "key", "n") == want
    assert K.frequent_keys(df.limit(0), ["key"], share).count() == 0


def test_a_task_hands_on_few_entries(spark):
    import pyarrow as pa

    batches = [pa.record_batch({"h": [1] * 40 + [j * 1000 + i for i in range(60)]}) for j in range(50)]
    out = pa.Table.from_batches(list(K._space_saving(iter(batches), 16)))
    assert out.num_rows <= 16 and dict(zip(*(c.to_pylist() for c in out.columns)))[1] >= 2000


def test_distinct_sketches_unite_and_subtract(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 20_000).alias("user"), (F.col("id") % 3).alias("kind"))
    stored = K.distinct_sketches(df, ["day", "kind"], "user", 12).cache()
    assert K.roll_up(stored, [], 12).first()["distinct"] == pytest.approx(20_000, rel=0.1)
    by_kind = {r["kind"]: r["distinct"] for r in K.roll_up(stored, ["kind"], 12).collect()}
    exact = {r["kind"]: r["n"] for r in df.groupBy("kind").agg(F.count_distinct("user").alias("n")).collect()}
    assert all(by_kind[k] == pytest.approx(n, rel=0.1) for k, n in exact.items())
    few = K.distinct_sketches(df.where("user < 900"), ["day"], "user")
    sides = few.agg(F.max_by("sketch", F.col("day") == 1).alias("a"), F.max_by("sketch", F.col("day") == 2).alias("b"))
    a, b = ({r["user"] for r in df.where(f"user < 900 AND day = {d}").select("user").distinct().collect()} for d in (1, 2))
    got = sides.select(K.overlap(F.col("a"), F.col("b")).alias("o")).first()["o"]
    assert tuple(got) == (len(a & b), len(a - b), len(b - a), len(a | b))


@pytest.fixture
def many_customers(spark, tmp_path):
    """Orders of 50,000 customers, more than a sketch holds; some keys are null, negative or far away."""
    key = F.when(F.col("id") % 1_000 == 0, F.lit(None)).when(F.col("id") % 1_000 == 1, F.lit(10**15)).otherwise(F.col("id") % 50_000 - 7)
    priority = F.when(F.col("id") % 3 == 0, "1-URGENT").when(F.col("id") % 7 == 1, "5-LOW").when(F.col("id") % 7 > 1, "3-MEDIUM")
    day = F.when(F.col("id") % 11 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1_500).cast("int")))
    orders = spark.range(120_000).select(key.alias("o_custkey"), priority.alias("o_orderpriority"), day.alias("o_orderdate"))
    lone = spark.createDataFrame([(None, "9-NONE")], "o_custkey long, o_orderpriority string").withColumn("o_orderdate", F.lit(None).cast("date"))
    orders.unionByName(lone).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("key", ["sketch_rollup", "sketch_overlap"])
@pytest.mark.parametrize("empty", [False, True])
def test_many_customers_are_counted_exactly(spark, many_customers, key, empty):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.sql(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{many_customers}/orders.parquet/*.parquet') WHERE {not empty}")
    sf_dir = many_customers
    if empty:
        sf_dir += "/none"
        spark.read.parquet(f"{many_customers}/orders.parquet").limit(0).write.parquet(f"{sf_dir}/orders.parquet")
    want = con.sql(entry.oracle_sql()[key])
    got = entry.queries()[key](spark, sf_dir)
    assert rows(got, *want.columns) == sorted(want.fetchall(), key=repr)


def test_bitmaps_refuse_text(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        K.distinct_bitmaps(spark.createDataFrame([("a", 1)], "k string, g int"), ["g"], "k")


def test_quantile_sketches_keep_the_rank_error(spark):
    df = spark.range(50_000).select((F.col("id") % 12).alias("month"), F.pow(F.col("id").cast("double"), F.lit(0.5)).alias("v"))
    df = df.withColumn("v", F.when(F.col("month") != 11, F.col("v")))  # one month without values
    stored = K.quantile_sketches(df, ["month"], "v")
    values = sorted(r["v"] for r in df.where("v IS NOT NULL").collect())
    merged = K.merge_quantiles(stored, [])
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for share, value in zip(shares, K.quantiles(merged, shares).first()["quantiles"]):
        assert abs(sum(v <= value for v in values) / len(values) - share) < 0.01
    bins = K.histogram(merged, 10).orderBy("bin").collect()
    assert len(bins) == 10 and bins[0]["lo"] == values[0] and bins[-1]["hi"] == values[-1]
    for b in bins:
        assert abs(sum(b["lo"] < v <= b["hi"] for v in values) - b["rows"]) < 0.02 * len(values)
    assert K.histogram(merged, 1).first()["rows"] == len(values)


# ---- comparison
def test_changed_rows_are_found_and_little_is_read_again(spark):
    before = spark.range(20_000).select((F.col("id") % 15_000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 15_000).alias("v"))
    after = before.where("k != 77").withColumn("v", F.when(F.col("k") == 4_001, -1).otherwise(F.col("v")))
    after = after.unionByName(before.where("k = 9")).unionByName(spark.createDataFrame([(None, None)], "k long, v long"))
    got = rows(C.changed_rows(before, after, ["k"]), "k", "v", "side", "copies")
    a, b = (Counter(map(tuple, t.collect())) for t in (before, after))
    want = [(*r, "before", n) for r, n in (a - b).items()] + [(*r, "after", n) for r, n in (b - a).items()]
    assert got == sorted(want, key=repr) and len(got) >= 4
    trees = [C.hash_tree(t, ["k"]) for t in (before, after)]
    leaves = C.differing_leaves(*trees).cache()
    assert leaves.count() <= 4 and C.suspects(before, leaves, ["k"]).count() < 20
    assert C.changed_rows(before, before, ["k"]).count() == 0
    assert C.changed_rows(before.limit(0), before, ["k"]).agg(F.sum("copies")).first()[0] == 20_000
    with pytest.raises(ValueError):
        C.changed_rows(before, after, ["k"], bits=10)


def test_rows_whose_nulls_are_elsewhere_differ(spark):
    a = spark.createDataFrame([(1, None, 2), (2, 3, None)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 2, None), (2, 3, None)], "k int, x int, y int")
    assert rows(C.changed_rows(a, b, ["k"]), "k", "side") == [(1, "after"), (1, "before")]


# ---- groups
def test_streamed_groups_come_batch_by_batch(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="100")
    df = spark.range(5_000).select((F.col("id") % 3).cast("string").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 4).alias("g"), "id")

    def sizes(key, batches):
        import pandas as pd

        each = [(len(pdf), pdf["id"].is_monotonic_increasing) for pdf in batches]
        yield pd.DataFrame({"k": [key[0]], "g": pd.array([key[1]], "Int64"), "n": [sum(n for n, _ in each)], "most": [max(n for n, _ in each)]})

    want = rows(df.groupBy("k", "g").agg(F.count("*").alias("n")), "k", "g", "n")
    for order in ([], ["id"]):
        got = P.stream_groups(df, ["k", "g"], sizes, "k string, g long, n long, most long", order=order)
        assert rows(got, "k", "g", "n") == want and got.agg(F.max("most")).first()[0] <= 100


def test_a_function_may_leave_its_group_unread(spark):
    df = spark.range(1_000).select((F.col("id") % 10).alias("k"), "id")

    def first(key, batches):
        import pandas as pd

        yield pd.DataFrame({"k": [key[0]], "id": [int(next(batches)["id"].iloc[0])]})

    got = P.stream_groups(df, ["k"], first, "k long, id long", order=["id"])
    assert rows(got, "k", "id") == [(i, i) for i in range(10)]


def test_python_groups_use_several_tasks(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"), "id")

    def count(pdf):
        return pdf.groupby("k", as_index=False).agg(n=("id", "size"))

    for merge in (None, lambda pdf: pdf.groupby("k", as_index=False)["n"].sum()):
        got = P.per_group(df, ["k"], count, "k long, n long", merge=merge)
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert rows(got, "k", "n") == sorted([(i, 100) for i in range(100)], key=repr)


# ---- kept layouts
def test_kept_layouts_outlive_a_scope(spark, sf_dir, tmp_path):
    written = []
    with scratch_scope(spark):
        path = once(spark, str(tmp_path), "kept", lambda p: (written.append(p), spark.range(3).write.parquet(p)))
        months = orders_by_month(spark, sf_dir).count()
    assert once(spark, str(tmp_path), "kept", written.append) == path and len(written) == 1
    assert spark.read.parquet(path).count() == 3 and orders_by_month(spark, sf_dir).count() == months
