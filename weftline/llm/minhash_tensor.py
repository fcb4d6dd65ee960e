"""Near-duplicates by MinHash with tensored banding.

Two small collections of ``m`` short MinHash tuples are computed per document. Table (i, j) is keyed by the pair of the i-th
tuple of the one and the j-th of the other, so ``m * m`` tables cost ``2 m`` tuples. Documents that share a key are
candidates; links are confirmed on the full shingle sets, and groups are the connected components of the links.

How groups of any size are worked through:

* Equal sets are one node; the copies follow by their digest.
* Keys are sorted by range, on (key, document), so a key that a third of the rows share is cut over many tasks; only rows whose
  key occurs again go on.
* Each bucket compares its members with one leader, the member that meets most others in all its buckets: in a group of
  edited copies this is the common source. Confirmed links give first components.
* The unconfirmed pairs join buckets to neighbourhoods: a candidate pair is always inside one. In each neighbourhood that still has
  several components, all members outside the largest one are compared with all members by an inverted index of
  their full sets. Large neighbourhoods are cut into tiles of bounded size. So no candidate is capped or left out.

Candidates whose tuples agree less than ``least_agreement`` of 2 m are passed over unread; for a pair at the threshold that
happens less than once in a million.

Cases: a text without words (null, empty) has an empty set and links with nothing; fewer words than a shingle give the whole
sequence as one shingle. Rows with a null id are linked with nothing, have a null component and are kept. Rows that
repeat an id are one document, linked with whatever one of them links with. Empty tables give empty results. Ties
and orders do not matter: the component is the smallest id reachable. Other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.llm.workers import Memo, once_per_worker
from weftline.session import materialise

#: Shingles that one side of a tile holds.
TILE_SHINGLES = 2_000_000
#: Words whose hash a worker keeps.
REMEMBERED = 500_000
ROWS_PER_SORT_TASK = 4_000_000


@dataclass(frozen=True)
class Scheme:
    """``percent``: links need 100 * intersection >= percent * union. ``miss``: chance to overlook a pair at the threshold."""

    words: int = 5
    percent: int = 80
    tuple_size: int = 3
    miss: float = 1e-4
    seed: int = 5

    @property
    def tuples(self) -> int:
        """Per collection; a pair is found if it agrees in one tuple of each collection."""
        return math.ceil(math.log(self.miss / 2) / math.log(1 - (self.percent / 100) ** self.tuple_size))

    @property
    def least_agreement(self) -> int:
        n, p = 2 * self.tuples, (self.percent / 100) ** self.tuple_size
        total, k = 0.0, 0
        while True:
            total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if total > 1e-6:
                return max(k, 2)
            k += 1


class Shingler:
    """Hashed shingle sets and MinHash tuples of texts."""

    def __init__(self, scheme: Scheme):
        import numpy as np
        import xxhash

        self.scheme, self.np = scheme, np
        self.memo = Memo(xxhash.xxh64_intdigest, REMEMBERED)
        random = np.random.default_rng(scheme.seed)
        odd = lambda n: random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.place = odd(scheme.words)
        self.factor, self.shift = odd(2 * scheme.tuples * scheme.tuple_size), odd(2 * scheme.tuples * scheme.tuple_size)
        self.join = odd(scheme.tuple_size)

    def _mixed(self, x):
        np = self.np
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))

    def shingles(self, text: str):
        """The set as sorted 64-bit hashes. ASCII letters are lower-cased; words end at ASCII blanks."""
        np, k = self.np, self.scheme.words
        found = text.encode().lower().split()
        n = len(found)
        if not n:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.memo.__getitem__, found), np.uint64, n)
        size = min(k, n)
        total = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            total += hashes[i : n - size + 1 + i] * self.place[i]
        return np.unique(self._mixed(total))

    def tuples(self, shingles):
        """2 m hashes, each of ``tuple_size`` MinHash values."""
        np = self.np
        least = None
        for at in range(0, len(shingles), 2048):
            some = (shingles[at : at + 2048, None] * self.factor + self.shift).min(axis=0)
            least = some if least is None else np.minimum(least, some)
        grouped = (least >> np.uint64(20)).reshape(-1, self.scheme.tuple_size) * self.join
        return self._mixed(grouped.sum(axis=1, dtype=np.uint64)).view(np.int64)


def _shingler(scheme: Scheme) -> Shingler:
    return once_per_worker("shingler", scheme, lambda: Shingler(scheme))


def signatures(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc, n (size of the set), digest (of the set; null if empty), tuples."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        shingler = _shingler(scheme)
        for batch in batches:
            sizes, digests, tuples = [], [], []
            for t in batch.column(1):
                s = shingler.shingles(t.as_py() or "")
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                tuples.append(shingler.tuples(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(tuples, pa.list_(pa.int64()))],
                names=["doc", "n", "digest", "tuples"],
            )

    return docs.mapInArrow(run, "doc bigint, n bigint, digest binary, tuples array<bigint>")


def sets(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc, shingles: the full set, as hashes."""

    def run(batches):
        import pyarrow as pa

        shingler = _shingler(scheme)
        for batch in batches:
            found = [shingler.shingles(t.as_py() or "").view("int64") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc", "shingles"])

    return docs.mapInArrow(run, "doc bigint, shingles array<bigint>")


def table_keys(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, doc) for every table: the pair of a tuple of the first collection and one of the second."""
    m = scheme.tuples
    first, second = F.slice("tuples", 1, m), F.slice("tuples", m + 1, m)
    pairs = F.flatten(
        F.transform(first, lambda a, i: F.transform(second, lambda b, j: F.xxhash64(i * m + j, a, b)))
    )
    return nodes.select(F.explode(pairs).alias("key"), "doc")


def _repeated(batches):
    """Rows whose key equals a neighbour's; the first and the last key of a task go on in any case."""
    import numpy as np
    import pyarrow as pa

    held, first = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        keys = table["key"].to_numpy()
        same = keys[1:] == keys[:-1]
        keep = np.concatenate([[first], same]) | np.concatenate([same, [False]])
        if held is not None:
            keep[0] |= held_keep
        held, held_keep, first = table.slice(len(keys) - 1).to_batches()[0], keep[-1], False
        keep[-1] = False
        yield from table.filter(pa.array(keep)).to_batches()
    if held is not None:
        yield held


def buckets(nodes: DataFrame, scheme: Scheme, rows: int) -> DataFrame:
    """(key, doc, size) of the buckets with more than one document."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * scheme.tuples**2 // ROWS_PER_SORT_TASK))
    ordered = table_keys(nodes, scheme).repartitionByRange(parts, "key", "doc").sortWithinPartitions("key", "doc")
    met = materialise(ordered.mapInArrow(_repeated, "key bigint, doc bigint"), "minhash-met")
    sizes = met.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return materialise(met.join(sizes, "key"), "minhash-buckets")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """Each member with the leader of its bucket."""
    joined = members.alias("m").join(leaders.alias("l"), "key").where(F.col("m.doc") != F.col("l.doc"))
    return joined.select(*_pairs(F.col("m.doc"), F.col("l.doc"))).distinct()


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    agree = F.size(F.filter(F.zip_with("ta", "tb", lambda x, y: x == y), lambda same: same))
    sized = nodes.select("doc", "n", "tuples")
    near = (
        pairs.join(sized.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("tuples").alias("ta")), "a")
        .join(sized.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("tuples").alias("tb")), "b")
        .where((100 * F.least("na", "nb") >= scheme.percent * F.greatest("na", "nb")) & (agree >= scheme.least_agreement))
        .select("a", "b")
        .distinct()
    )
    near = materialise(near, "minhash-near")
    wanted = materialise(near.select(F.col("a").alias("doc")).union(near.select("b")).distinct(), "minhash-wanted")
    full = materialise(sets(docs.join(wanted, "doc", "left_semi"), scheme), "minhash-sets")
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        near.join(full.select(F.col("doc").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(full.select(F.col("doc").alias("b"), F.col("shingles").alias("sb")), "b")
        .where(100 * shared >= scheme.percent * (F.size("sa") + F.size("sb") - shared))
        .select("a", "b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(doc, component): the smallest id that links lead to, for every linked document.

    Each round points every node at the smallest of its neighbours, and its larger neighbours at that one too, until nothing
    changes. Minima are combined before the shuffle, and the arcs of a hub get its minimum where they lie, so a node with
    very many links is no burden.
    """
    arcs = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "cc")
    known = _print(arcs)
    while True:
        both = arcs.union(arcs.select("v", "u"))
        share = _fair_share(arcs.sparkSession, 2 * known[0])
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
        least = materialise(least, "cc-least")
        large = _with_least(both.where("v > u"), least, share).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "cc-large")  # read three times
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, low, share).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        arcs = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        before, known = known, _print(arcs)
        if known == before:
            return arcs.select(F.col("u").alias("doc"), F.col("v").alias("component"))


def _fair_share(spark: SparkSession, rows: int) -> int:
    """Rows that a task of a shuffle has on average."""
    return max(1, rows // int(spark.conf.get("spark.sql.shuffle.partitions")))


def _with_least(arcs: DataFrame, least: DataFrame, share: int) -> DataFrame:
    """``arcs`` with the minimum of their node from ``least`` (u, m, n).

    A hub has more arcs than the fair share of a task, so there are hardly more hubs than tasks, and they are broadcast. All other
    arcs are joined by node; no node brings more of them to a task than its fair share.
    """
    hubs = F.broadcast(least.where(F.col("n") > share).select("u", "m"))
    # A left join in both branches, so that they share the broadcast.
    dealt = arcs.join(hubs, "u", "left")
    others = dealt.where("m IS NULL").drop("m").join(least.where(F.col("n") <= share).select("u", "m"), "u")
    return dealt.where("m IS NOT NULL").union(others)


def _print(arcs: DataFrame) -> tuple:
    return tuple(arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _named(frame: DataFrame, found: DataFrame) -> DataFrame:
    """``frame`` with the component of each document, its own id where it has no link."""
    return frame.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _tiles(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of open neighbourhoods dealt to tiles (bin, ob, tile): those outside the largest component, and all.

    Small neighbourhoods share a bin up to the size of a tile; a large one is a bin of its own, cut into several tiles.
    """
    weight = F.sum("n").alias("weight")
    parts = members.groupBy("around", "component").agg(weight, F.count("*").alias("docs"))
    around = parts.groupBy("around").agg(
        F.sum("weight").alias("weight"), F.count("*").alias("parts"), F.max_by("component", F.struct("docs", "component")).alias("main"),
    ).where("parts > 1")
    around = materialise(around, "minhash-around")
    light = F.col("weight") <= TILE_SHINGLES
    bins = -(-(around.where(light).agg(F.sum("weight")).first()[0] or 0) // TILE_SHINGLES) or 1
    around = around.select(
        "around", "main",
        F.when(light, -1 - F.pmod(F.xxhash64("around"), F.lit(bins))).otherwise(F.col("around")).alias("bin"),
        F.when(light, F.lit(1)).otherwise(F.ceil(F.col("weight") / TILE_SHINGLES)).cast("int").alias("tiles"),
    )
    dealt = members.join(around, "around")
    place, every = F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    outside = dealt.where("component != main").select("doc", "component", "bin", place.alias("ob"), every.alias("tile"))
    return outside, dealt.select("doc", "component", "bin", place.alias("tile"), every.alias("ob"))


def _linked(percent: int):
    def run(outside, members):
        import numpy as np
        import pyarrow as pa

        found_a, found_b = [], []
        if outside.num_rows and members.num_rows:
            docs, component = members["doc"].to_numpy(), members["component"].to_numpy()
            column = members["shingles"].combine_chunks()
            sizes = np.diff(column.offsets.to_numpy())
            values = column.flatten().to_numpy()
            order = np.argsort(values, kind="stable")
            postings, owners = values[order], np.repeat(np.arange(len(docs)), sizes)[order]
            own = outside["shingles"].combine_chunks()
            starts, flat = own.offsets.to_numpy(), own.flatten().to_numpy()
            starts = starts - starts[0]
            for k, (doc, part) in enumerate(zip(outside["doc"].to_pylist(), outside["component"].to_pylist())):
                mine = flat[starts[k] : starts[k + 1]]
                low, high = np.searchsorted(postings, mine, "left"), np.searchsorted(postings, mine, "right")
                counts = high - low
                at = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                both = np.bincount(owners[at], minlength=len(docs))
                near = (100 * both >= percent * (len(mine) + sizes - both)) & (component != part)
                hits = np.flatnonzero(near)
                _, first = np.unique(component[hits], return_index=True)  # one link to a component is enough
                found_a += [doc] * len(first)
                found_b += docs[hits[first]].tolist()
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return run


def links(nodes: DataFrame, docs: DataFrame, scheme: Scheme, rows: int) -> DataFrame:
    """Confirmed links that connect every component; links inside a component that others already connect are not looked for."""
    met = buckets(nodes, scheme, rows)
    meeting = met.groupBy("doc").agg(F.sum("size").alias("met"))
    ranked = materialise(met.join(meeting, "doc"), "minhash-ranked")
    leaders = ranked.groupBy("key").agg(F.max_by("doc", F.struct("met", -F.col("doc"))).alias("doc"))
    tried = materialise(star_pairs(ranked, leaders), "minhash-pairs")
    confirmed = materialise(confirm(tried, nodes, docs, scheme), "minhash-links")
    around = components(tried).withColumnRenamed("component", "around")
    around = around.unionByName(around.select(F.col("around").alias("doc"), "around").distinct())
    members = _named(around, components(confirmed)).join(nodes.select("doc", "n").distinct(), "doc")
    outside, every = _tiles(materialise(members, "minhash-members"))
    wanted = materialise(every.select("doc").distinct(), "minhash-wanted")
    full = materialise(sets(docs.join(wanted, "doc", "left_semi"), scheme), "minhash-sets")
    keys, fields = ["bin", "ob", "tile"], ["doc", "component", "shingles", "bin", "ob", "tile"]
    # Aliases: both sides come from the same tables, and their columns must not be taken for each other.
    left, right = (side.join(full, "doc").select(*[F.col(c).alias(c) for c in fields]) for side in (outside, every))
    more = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_linked(scheme.percent), "a bigint, b bigint")
    return confirmed.union(materialise(more.distinct(), "minhash-links"))


def near_duplicates(table: DataFrame, scheme: Scheme = Scheme(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_shingles, component, kept) of every row."""
    docs = table.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    signed = materialise(signatures(docs, scheme), "minhash-signatures")
    named = signed.where("doc IS NOT NULL AND n > 0")
    nodes = named.groupBy("digest").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("tuples").alias("tuples"))
    nodes = materialise(nodes, "minhash-nodes")
    same = nodes.select("digest", F.col("doc").alias("node"))
    placed = materialise(named.select("doc", "digest").distinct().join(same, "digest").select("doc", "node"), "minhash-copies")
    by_id = placed.groupBy("doc").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("texts"))
    repeated_ids = placed.join(by_id.where("texts > 1").select("doc", "low"), "doc").select(F.col("low").alias("a"), F.col("node").alias("b"))
    found = links(nodes, docs, scheme, nodes.count()).union(repeated_ids)
    groups = materialise(components(found), "minhash-groups")
    of_node = by_id.select("doc", F.col("low").alias("node")).join(groups.withColumnRenamed("doc", "node"), "node", "left")
    of_node = of_node.select("doc", F.coalesce("component", "node").alias("component"))
    return signed.join(of_node, "doc", "left").select(
        "doc",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component"),
        F.coalesce(F.coalesce("component", "doc") == F.col("doc"), F.lit(True)).alias("kept"),
    )
