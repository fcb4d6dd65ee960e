"""Repeated lines removed by probing a sharded minimal perfect hash.

A line's key is the line without blanks at its ends and with A-Z lower-cased. Keys are hashed to 128 bits and counted per document;
those found in enough documents are frequent. The frequent hashes are dealt to shards, and each shard builds a minimal perfect
hash over its own: levels of bit arrays, in which a hash takes the first place that no other hash of the level wants, and its
slot is the number of places taken before. The slot indexes plain arrays: a 64-bit fingerprint, the number of documents, and the
document that keeps the line. A document then looks its lines up in the arrays; no line is joined. A key that is not
frequent ends at a slot of some other one and is told apart by the fingerprint; the chance of a mistake is 2**-64 a line.

Where the shards together are within ``most_bytes``, measured, they are broadcast and the texts are not shuffled. Beyond it
every shard is dealt to tasks, as many copies as its number of lines asks for, the hashes of the lines go to a
copy of their shard, and only the hits come back to the documents.

Cases: a null or empty text is one empty line. Rows that repeat an id are one document; lines of a row with a null id are
not counted, and it keeps no line that is frequent elsewhere. A frequent key keeps all its lines in the largest id that holds it.
Texts are read whole, whatever their length. Repeated rows get equal results each. An empty table gives an empty result. Other
columns are not looked at, and their names do not matter.
"""

from __future__ import annotations

import io
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from weftline.llm.workers import once_per_worker
from weftline.session import materialise

BLANKS = b" \t\n\v\f\r"
#: Hashes of one shard, bytes of an index that is broadcast, and lines that one copy of a shard looks up.
SHARD_KEYS, BROADCAST_BYTES, PROBES = 1 << 16, 64 << 20, 4_000_000
#: Places of a level for each hash that is left, and levels before what is left is simply listed.
GAMMA, LEVELS = 1.5, 40
RESULT = "doc_id bigint, text string, n_lines bigint, n_dropped bigint"


@dataclass(frozen=True)
class Policy:
    """Keys of at least ``least_chars`` code points in at least ``least_docs`` documents are repeated lines."""

    least_chars: int = 40
    least_docs: int = 5


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _places(key, level: int, size: int):
    import numpy as np

    salt = np.uint64((level + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    return _mixed(key + salt) % np.uint64(size)


class PerfectHash:
    """Slots 0 to n - 1 for ``n`` distinct pairs of 64-bit hashes."""

    def __init__(self, high, low):
        import numpy as np

        levels, rest = [], np.arange(len(high))
        while len(rest) and len(levels) < LEVELS:
            size = 64 * math.ceil(GAMMA * len(rest) / 64)
            at = _places(self._key(high[rest], low[rest]), len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        self._index(levels, [(int(high[i]), int(low[i])) for i in rest])

    def _index(self, levels, listed):
        import numpy as np

        self.sizes = [len(bits) for bits in levels]
        self.bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.before = np.concatenate([[0], np.cumsum(self.bits)])
        self.listed = {pair: int(self.before[-1]) + i for i, pair in enumerate(listed)}

    @staticmethod
    def _key(high, low):
        import numpy as np

        return _mixed(high) + low * np.uint64(0x9E3779B97F4A7C15)

    def slots(self, high, low):
        """A slot per pair: its own for a pair of the set, any or -1 for another one."""
        import numpy as np

        slot, open_, start = np.full(len(high), -1, np.int64), np.arange(len(high)), 0
        key = self._key(high, low)
        for level, size in enumerate(self.sizes):
            at = _places(key[open_], level, size).astype(np.int64) + start
            hit = self.bits[at]
            slot[open_[hit]] = self.before[at[hit]]
            open_, start = open_[~hit], start + size
        if self.listed:
            for i in open_:
                slot[i] = self.listed.get((int(high[i]), int(low[i])), -1)
        return slot

    def saved(self) -> dict:
        import numpy as np

        listed = np.array(list(self.listed), np.uint64).reshape(-1, 2)
        return {"sizes": np.array(self.sizes, np.int64), "bits": np.packbits(self.bits), "listed": listed}

    @classmethod
    def load(cls, saved) -> PerfectHash:
        import numpy as np

        self, sizes = cls.__new__(cls), saved["sizes"].tolist()
        bits = np.unpackbits(saved["bits"], count=sum(sizes)).astype(bool)
        ends = np.cumsum(sizes).tolist()
        self._index([bits[b - s : b] for s, b in zip(sizes, ends)], list(map(tuple, saved["listed"].tolist())))
        return self


class Shard:
    """The arrays of one shard behind its perfect hash."""

    def __init__(self, blob: bytes):
        import numpy as np

        with np.load(io.BytesIO(blob)) as saved:
            self.hash = PerfectHash.load(saved)
            self.prints, self.docs, self.keeper = saved["prints"], saved["docs"], saved["keeper"]

    @staticmethod
    def build(high, low, docs, keeper) -> bytes:
        import numpy as np

        found = PerfectHash(high, low)
        order = np.argsort(found.slots(high, low))
        out = io.BytesIO()
        np.savez(out, prints=low[order], docs=docs[order], keeper=keeper[order], **found.saved())
        return out.getvalue()

    def find(self, high, low):
        """(frequent, keeper) of each pair."""
        import numpy as np

        slot = self.hash.slots(high, low)
        at = np.maximum(slot, 0)
        known = (slot >= 0) & (self.prints[at] == low) if len(self.prints) else np.zeros(len(high), bool)
        return known, self.keeper[at] if len(self.keeper) else np.zeros(len(high), np.int64)


class Cutter:
    """Lines of a text and the hashes of their keys."""

    def __init__(self, least: int):
        from xxhash import xxh3_128_digest

        self.least, self.digest = least, xxh3_128_digest

    def key(self, line: bytes) -> bytes | None:
        """The hash of a line's key; None where it is too short to be a repeated line."""
        if len(line) < self.least:
            return None
        key = line.strip(BLANKS).lower()  # of bytes: only A-Z change
        if len(key) < self.least or not key.isascii() and len(key.decode(errors="replace")) < self.least:
            return None
        return self.digest(key)

    def keys(self, raw: bytes) -> set[bytes]:
        found = set(map(self.key, raw.split(b"\n")))
        found.discard(None)
        return found


def _pairs(digests: list[bytes]):
    """High and low halves of 128-bit hashes."""
    import numpy as np

    both = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0], both[:, 1]


def _raw(batch):
    """(id or None, text as bytes) of each row of (doc, text)."""
    import pyarrow as pa

    texts = batch.column(1).cast(pa.binary())
    for doc, text in zip(batch.column(0).to_pylist(), texts):
        yield doc, text.as_py() or b""


def _row_key(doc: int | None, raw: bytes) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(repr(doc).encode() + b"\n" + raw)


def line_keys(docs: DataFrame, policy: Policy) -> DataFrame:
    """(row, doc, high, low) of each distinct key of a row of (doc, text)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cutter = Cutter(policy.least_chars)
        for batch in batches:
            rows, ids, digests, counts = [], [], [], []
            for doc, raw in _raw(batch):
                if found := cutter.keys(raw):
                    rows.append(_row_key(doc, raw))
                    ids.append(doc)
                    counts.append(len(found))
                    digests += found
            high, low = _pairs(digests)
            each = pa.array(np.repeat(np.arange(len(rows)), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()).take(each), pa.array(ids, pa.int64()).take(each), pa.array(high.view(np.int64)), pa.array(low.view(np.int64))],
                names=["row", "doc", "high", "low"],
            )

    return docs.mapInArrow(run, "row binary, doc bigint, high bigint, low bigint")


def frequent(docs: DataFrame, policy: Policy) -> DataFrame:
    """(high, low, docs, keeper) of the frequent keys. Counts are combined before the shuffle, so a very common line is no burden."""
    seen = line_keys(docs, policy).where("doc IS NOT NULL").select("high", "low", "doc").distinct()
    return seen.groupBy("high", "low").agg(F.count("*").alias("docs"), F.max("doc").alias("keeper")).where(F.col("docs") >= policy.least_docs)


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, index): the arrays of each shard. A hash deals the keys, so shards are of equal size whatever the lines are."""

    def build(table):
        import numpy as np
        import pyarrow as pa

        column = lambda name: table[name].to_numpy()
        blob = Shard.build(column("high").view(np.uint64), column("low").view(np.uint64), column("docs").astype(np.uint32), column("keeper"))
        return pa.table({"shard": pa.array([column("shard")[0]], pa.int64()), "index": pa.array([blob], pa.binary())})

    dealt = keys.withColumn("shard", F.pmod("high", F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(build, "shard bigint, index binary")


def _rebuilt(batch, cutter: Cutter, dropped_of):
    """Result rows of a batch. ``dropped_of`` takes (row, doc, hash) lists of all long lines and tells which go."""
    import pyarrow as pa

    ids, texts, places, lists = [], [], [], ([], [], [])
    for row, (doc, raw) in enumerate(_raw(batch)):
        ids.append(doc)
        texts.append(raw.split(b"\n"))
        for i, key in enumerate(map(cutter.key, texts[-1])):
            if key is not None:
                places.append((row, i))
                for to, value in zip(lists, (row, doc, key)):
                    to.append(value)
    gone = {}
    for (row, i), drop in zip(places, dropped_of(*lists)):
        if drop:
            gone.setdefault(row, set()).add(i)
    kept = [[x for i, x in enumerate(lines) if i not in gone[r]] if r in gone else lines for r, lines in enumerate(texts)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([b"\n".join(lines) for lines in kept], pa.binary()).view(pa.string()),
            pa.array([len(lines) for lines in texts], pa.int64()),
            pa.array([len(gone.get(r, ())) for r in range(len(texts))], pa.int64()),
        ],
        names=["doc_id", "text", "n_lines", "n_dropped"],
    )


def _found(shards: dict, count: int, digests: list[bytes]):
    """(frequent, keeper) arrays for hashes of any shard."""
    import numpy as np

    high, low = _pairs(digests)
    known, keeper, home = np.zeros(len(high), bool), np.zeros(len(high), np.int64), high.view(np.int64) % count
    for shard in np.unique(home).tolist():
        if shard in shards:
            mine = np.flatnonzero(home == shard)
            known[mine], keeper[mine] = shards[shard].find(high[mine], low[mine])
    return known, keeper


def _probe_everywhere(docs: DataFrame, index: DataFrame, count: int, policy: Policy) -> DataFrame:
    """Every task holds all shards."""
    blobs = {row["shard"]: bytes(row["index"]) for row in index.collect()}
    shared, key = docs.sparkSession.sparkContext.broadcast(blobs), uuid.uuid4().hex

    def run(batches):
        import numpy as np

        cutter = Cutter(policy.least_chars)
        shards = once_per_worker("line-index", key, lambda: {s: Shard(b) for s, b in shared.value.items()})

        def dropped(rows, ids, digests):
            known, keeper = _found(shards, count, digests)
            return known & ~np.fromiter((d is not None and d == k for d, k in zip(ids, keeper.tolist())), bool, len(ids))

        for batch in batches:
            yield _rebuilt(batch, cutter, dropped)

    return docs.mapInArrow(run, RESULT)


def _probe_by_shard(docs: DataFrame, index: DataFrame, count: int, policy: Policy, probes: int) -> DataFrame:
    """Hashes go to their shard, hits come back to their row, which is known by a hash of its id and text."""
    keys = materialise(line_keys(docs, policy).withColumn("shard", F.pmod("high", F.lit(count))), "line-probes")
    copies = keys.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(probes)).cast("int").alias("copies"))
    placed = materialise(index.join(copies, "shard"), "line-shards")
    sized = placed.select("shard", "copies")
    tables = placed.select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "index")
    dealt = keys.join(sized, "shard").withColumn("copy", F.pmod(F.xxhash64("row", "low"), F.col("copies")).cast("int"))

    def look_up(wanted, shard):
        import numpy as np
        import pyarrow as pa

        if not wanted.num_rows or not shard.num_rows:
            return pa.table({"row": pa.array([], pa.binary()), "hit": pa.array([], pa.binary())})
        high, low = (wanted[c].to_numpy().view(np.uint64) for c in ("high", "low"))
        known, keeper = Shard(shard["index"][0].as_py()).find(high, low)
        doc = wanted["doc"]
        own = np.array(doc.is_valid()) & (doc.fill_null(0).to_numpy() == keeper)
        hits = np.flatnonzero(known & ~own)
        both = np.stack([high[hits], low[hits]], axis=1).astype(">u8")
        digests = [both[i].tobytes() for i in range(len(hits))]
        return pa.table({"row": wanted["row"].take(pa.array(hits)), "hit": pa.array(digests, pa.binary())})

    by = ["shard", "copy"]
    found = dealt.drop("copies").groupBy(*by).cogroup(tables.groupBy(*by)).applyInArrow(look_up, "row binary, hit binary")
    hits = found.groupBy("row").agg(F.collect_set("hit").alias("hits"))

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            keys_ = pa.array([_row_key(doc, raw) for doc, raw in _raw(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys_], names=["doc", "text", "row"])

    def run(batches):
        cutter = Cutter(policy.least_chars)
        for batch in batches:
            gone = [set(h or ()) for h in batch.column(2).to_pylist()]
            yield _rebuilt(batch, cutter, lambda rows, ids, digests: [d in gone[r] for r, d in zip(rows, digests)])

    rows = docs.mapInArrow(keyed, "doc bigint, text string, row binary")
    return rows.join(hits, "row", "left").select("doc", "text", "hits").mapInArrow(run, RESULT)


def drop_repeated_lines(
    table: DataFrame,
    policy: Policy = Policy(),
    doc_id: str = "doc_id",
    text: str = "text",
    most_bytes: int = BROADCAST_BYTES,
    shard_keys: int = SHARD_KEYS,
    probes: int = PROBES,
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row: its text without repeated lines, its lines before, and those dropped."""
    docs = table.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    keys = materialise(frequent(docs, policy), "line-keys")
    shards = max(1, math.ceil(keys.count() / shard_keys))
    index = materialise(build_index(keys, shards), "line-index")
    size = index.agg(F.sum(F.octet_length("index"))).first()[0] or 0
    if size <= most_bytes:
        return _probe_everywhere(docs, index, shards, policy)
    return _probe_by_shard(docs, index, shards, policy, probes)
