"""Alignment of the tokens of two tokenizers over the bytes of a text, for documents of any length.

Tokenizer A is byte-level BPE, tokenizer B a sentence-piece model with byte fallback. Both spell the same bytes: a space and the text. The
offsets where tokens of both end cut the two id lists into groups; inside a group, tokens whose bytes overlap are linked.

Long documents are cut into byte ranges, each a row with the tokens that end in it. What a range knows of the alignment is a fragment: an
open prefix up to the first offset where both tokenizers end, closed groups after that, and an open suffix after the last
such offset; a range without such an offset is open as a whole. Fragments compose: the suffix of the left one and the prefix
of the right one become a closed run, or stay open where one side knows no common end. The composition is associative, so a tree reduction puts the ranges of a document together across tasks,
``FAN`` neighbours at a time. Closed runs are given out at once and don't travel up the tree; only the open ends do.

Closed runs are self-contained: groups, links and counts are array operations over many runs at a time. Every piece between two
neighbouring ends of either tokenizer is one link. The corpus-wide count of an id pair comes from a first pass over the runs,
combined before the shuffle; a second pass looks the counts up in a broadcast array of the pairs, or in one part of the pairs after the other
where they are more than ``most_pairs``. The number of pairs is bounded by the two vocabularies.

Tokens are computed once. Texts are cut at the blanks across which neither tokenizer joins tokens, and a bounded memory of the
parts saves repeated work.

Cases: texts that are null or empty, or that a tokenizer doesn't spell exactly (B has no byte for U+2581), have no tokens, no groups and zero counts.
Strings of special tokens are plain text. Repeated rows and rows with a null id are aligned each by itself; each
occurrence counts. An empty table gives an empty result. Other columns are not looked at, and their names do not matter.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import ChainMap
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.llm.workers import Generations, fingerprint, once_per_worker
from weftline.session import materialise

#: Bytes of a range, neighbouring fragments that one step of the tree composes, and characters that are encoded together.
RANGE, FAN, SEGMENT = 1 << 16, 8, 1 << 20
#: Parts of texts whose ids a worker keeps, twice, and their greatest length.
REMEMBERED, SHORT = 200_000, 48
#: Unknown parts that are encoded as one text.
BLOCK = 400
#: Pairs whose counts are broadcast at once, and pairs that a task holds before it passes their counts on.
PAIRS, HELD = 4_000_000, 2_000_000
#: Tokens that are aligned together.
TOGETHER = 400_000
# Before a blank between two others: no pre-token of A and no piece of B goes on across it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def _awkward(text: str) -> bool:
    """Whether a text may have a blank that is no such cut."""
    return text[:1] == " " or text[-1:] == " " or any(x in text for x in ("  ", "\n ", " \n", *_BLANKS))


@dataclass(frozen=True)
class Tokenizers:
    """The files' contents: A as JSON text of a byte-level tokenizer with its split pattern, B as model bytes."""

    a: str
    pattern: str
    b: bytes

    @classmethod
    def read(cls, a_path: str, pattern: str, b_path: str) -> Tokenizers:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), pattern, b.read())


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: itself if it is printable in Latin-1, else one from U+0100 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Speller:
    """Ids and token bytes of both tokenizers."""

    def __init__(self, files: Tokenizers):
        import json

        import numpy as np
        import sentencepiece
        import tiktoken

        model, letters = json.loads(files.a)["model"], _byte_letters()
        self.a_bytes = {i: bytes(map(letters.__getitem__, entry)) for entry, i in model["vocab"].items()}
        # A rank tokenizer merges by id; that is the same as by the list of merges where ids follow it.
        first = len(model["vocab"]) - len(model["merges"])
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if model["vocab"][left + right] != first + i:
                raise ValueError("the ids of the byte-level tokenizer do not follow its merges")
        ranks = {token: i for i, token in self.a_bytes.items()}
        self.encode_a = tiktoken.Encoding("align", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)  # then no blank is a safe cut
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(t) for t in self.a_bytes.values()]
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.known = Generations(REMEMBERED)

    def _one(self, part: str) -> tuple[bytes, bytes]:
        """Ids of a part of a text by A and by B, as 32-bit integers; two empty strings where they don't both spell the part."""
        b = self.b.encode(part)  # puts a blank before by itself
        exact = b"".join(map(self.b_bytes.__getitem__, b)) == b" " + part.encode()
        return (array("I", self.encode_a(" " + part)).tobytes(), array("I", b).tobytes()) if exact else (b"", b"")

    def _learn(self, parts: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of each part. Those without blanks at their ends are encoded as blocks of text, which are cut at their ends again."""
        import numpy as np

        joined = [] if self.whole else [p for p in parts if p and not p[0].isspace() and not p[-1].isspace()]
        if not joined:
            return {p: self._one(p) for p in parts}
        blocks = [" ".join(joined[i : i + BLOCK]) for i in range(0, len(joined), BLOCK)]
        a = np.concatenate([np.array(self.encode_a(" " + block), np.uint32) for block in blocks])
        b = np.concatenate([np.array(ids, np.uint32) for ids in self.b.encode(blocks, num_threads=1)])
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != "".join(" " + block for block in blocks).encode():
            return {p: self._one(p) for p in parts}
        stops = np.cumsum([len(p.encode()) + 1 for p in joined])
        cuts = []
        for ids, sizes in ((a, self.a_sizes), (b, self.b_sizes)):
            at = (4 * np.searchsorted(np.cumsum(sizes[ids]), stops, "right")).tolist()
            data = ids.tobytes()
            cuts.append([data[i:j] for i, j in zip([0, *at], at)])
        found = dict(zip(joined, zip(*cuts)))
        found.update((p, self._one(p)) for p in parts if p not in found)
        return found

    def encode(self, texts: list[str]) -> list[tuple]:
        """(ids by A, ids by B) of each text, empty where they don't both spell a space and the text."""
        import numpy as np

        cut = [[t] if self.whole else _CUT.split(t) if _awkward(t) else t.split(" ") for t in texts]
        self.known.age()
        found = self._learn(self.known.missing(set().union(*cut)))
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= SHORT)
        found = ChainMap(self.known, found) if any(len(p) > SHORT for p in found) else self.known
        none, out = np.zeros(0, np.uint32), []
        for text, parts in zip(texts, cut):
            pairs = list(map(found.__getitem__, parts))
            a, b = (np.frombuffer(b"".join([p[k] for p in pairs]), np.uint32) for k in (0, 1))
            # A part that is not spelt exactly is missing here.
            out.append((a, b) if text and int(self.a_sizes[a].sum()) == len(text.encode()) + 1 else (none, none))
        return out


def _speller(spark: SparkSession, files: Tokenizers):
    """A function that gives the worker's speller."""
    shared, key = spark.sparkContext.broadcast(files), fingerprint(files.a, files.pattern, files.b)
    return lambda: once_per_worker("speller", key, lambda: Speller(shared.value))


# --- Fragments ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Open:
    """Tokens whose group is not closed yet: ids and ends, counted from the start of the document."""

    a: tuple = ()
    a_ends: tuple = ()
    b: tuple = ()
    b_ends: tuple = ()

    def __add__(self, other: Open) -> Open:
        return Open(self.a + other.a, self.a_ends + other.a_ends, self.b + other.b, self.b_ends + other.b_ends)


@dataclass(frozen=True)
class Fragment:
    """``prefix`` up to the first common end, closed runs (place, a ids, b ids), ``suffix`` after the last common end.

    Without a common end ``suffix`` is None and all tokens are in ``prefix``; the neutral fragment is one without tokens.
    """

    prefix: Open = Open()
    runs: tuple = ()
    suffix: Open | None = None
    place: int = 0  # of the range with the first common end

    def __add__(self, other: Fragment) -> Fragment:
        if self.suffix is None and other.suffix is None:
            return Fragment(self.prefix + other.prefix)
        if self.suffix is None:
            return Fragment(self.prefix + other.prefix, other.runs, other.suffix, other.place)
        if other.suffix is None:
            return Fragment(self.prefix, self.runs, self.suffix + other.prefix, self.place)
        middle = self.suffix + other.prefix
        return Fragment(self.prefix, (*self.runs, (2 * other.place, middle.a, middle.b), *other.runs), other.suffix, self.place)


def fragment(place: int, a, a_ends, b, b_ends) -> Fragment:
    """The fragment of one range, from arrays of the tokens that end in it. Its own closed groups are one run."""
    import numpy as np

    common = np.intersect1d(a_ends, b_ends, assume_unique=True)

    def open_(low: int, high: float) -> Open:
        x, y = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        return Open(*(tuple(v.tolist()) for v in (a[x], a_ends[x], b[y], b_ends[y])))

    if not len(common):
        return Fragment(open_(-1, float("inf")))
    first, last = common[0], common[-1]
    inner = open_(first, last)
    runs = ((2 * place + 1, inner.a, inner.b),) if inner.a else ()
    return Fragment(open_(-1, first), runs, open_(last, float("inf")), place)


# --- Spark ----------------------------------------------------------------------------------------------------

_TOKENS = "row bigint, doc bigint, place int, ranges int, a_from bigint, b_from bigint, a binary, b binary"
_RUNS = "row bigint, doc bigint, place int, a binary, b binary"


def _blob(ids) -> bytes:
    """Ids as 32-bit integers, first all lowest bytes, then all next ones and so on: the upper bytes hardly differ and compress well."""
    import numpy as np

    return np.asarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _ids(blob: bytes):
    import numpy as np

    return np.frombuffer(blob, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def tokenise(docs: DataFrame, files: Tokenizers, range_bytes: int = RANGE) -> DataFrame:
    """One row per byte range of each row of (doc, text), with the ids of the tokens that end in it (see ``_blob``)."""
    speller = _speller(docs.sparkSession, files)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        spell = speller()
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        for batch in batches:
            keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some in _runs_of(batch.column(2), SEGMENT):
                rows = [[] for _ in kinds]
                for at, (a, b) in zip(some, spell.encode(list(some.values()))):
                    a_ends, b_ends = np.cumsum(spell.a_sizes[a]), np.cumsum(spell.b_sizes[b])
                    ranges = max(1, -(-int(a_ends[-1]) // range_bytes)) if len(a) else 1
                    edges = np.arange(1, ranges) * range_bytes
                    a_cuts, b_cuts = ([0, *np.searchsorted(e, edges, "right").tolist(), len(e)] for e in (a_ends, b_ends))
                    for place in range(ranges):
                        x, y = slice(*a_cuts[place : place + 2]), slice(*b_cuts[place : place + 2])
                        start = lambda ends, part: int(ends[part.start - 1]) if part.start else 0
                        values = keys[0][at], keys[1][at], place, ranges, start(a_ends, x), start(b_ends, y)
                        for to, v in zip(rows, (*values, _blob(a[x]), _blob(b[y]))):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], names=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc", "text")
    return materialise(numbered.mapInArrow(run, _TOKENS), "align-tokens", compression="zstd")


def _runs_of(texts, most: int):
    """Texts of an Arrow column by position, in runs of about ``most`` characters or one longer text; null is empty."""
    run, size = {}, 0
    for i, value in enumerate(texts):
        run[i] = text = value.as_py() or ""
        size += len(text)
        if size >= most:
            yield run
            run, size = {}, 0
    if run:
        yield run


def _packed(value: Open) -> bytes:
    import pickle

    return pickle.dumps((value.a, value.a_ends, value.b, value.b_ends))


def _unpacked(blob: bytes) -> Open:
    import pickle

    return Open(*pickle.loads(blob))


def close_runs(tokens: DataFrame, files: Tokenizers, fan: int = FAN) -> DataFrame:
    """Closed runs (row, doc, place, a, b) of documents with several ranges, by a tree of fragments."""
    spark = tokens.sparkSession
    speller = _speller(spark, files)
    fields = f"{_RUNS}, at int, prefix binary, suffix binary"

    def rows_of(row, doc, at, whole: Fragment, ends: bool):
        """Closed runs of a fragment, and its open ends as a row of their own, unless it is the whole document."""
        out = []
        if ends:
            # Offset 0 and the end of the text are common ends.
            last = whole.suffix
            assert last is not None and not last.a and not last.b
            out.append((row, doc, 2 * whole.place, whole.prefix.a, whole.prefix.b, None, None, None))
        out += [(row, doc, place, a, b, None, None, None) for place, a, b in whole.runs]
        if not ends:
            suffix = None if whole.suffix is None else _packed(whole.suffix)
            out.append((row, doc, whole.place, None, None, at, _packed(whole.prefix), suffix))
        return out

    def table(rows):
        import pyarrow as pa

        blob = lambda ids: None if ids is None else _blob(ids)
        columns = list(zip(*[(r, d, p, blob(a), blob(b), at, x, y) for r, d, p, a, b, at, x, y in rows])) or [()] * 8
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in fields.split(", ")])

    def leaf(batches):
        import numpy as np

        spell = speller()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                a, b = _ids(r["a"]), _ids(r["b"])
                ends = np.cumsum(spell.a_sizes[a]) + r["a_from"], np.cumsum(spell.b_sizes[b]) + r["b_from"]
                rows += rows_of(r["row"], r["doc"], r["place"], fragment(r["place"], a, ends[0], b, ends[1]), False)
            yield from table(rows).to_batches()

    def composed(last: bool):
        def run(group):
            rows = sorted(group.to_pylist(), key=lambda r: r["at"])
            whole = Fragment()
            for r in rows:
                suffix = None if r["suffix"] is None else _unpacked(r["suffix"])
                whole += Fragment(_unpacked(r["prefix"]), (), suffix, r["place"])
            return table(rows_of(rows[0]["row"], rows[0]["doc"], rows[0]["at"] // fan, whole, last))

        return run

    most = tokens.agg(F.max("ranges")).first()[0] or 1
    long_ = tokens.where("ranges > 1").drop("ranges")
    level = materialise(long_.mapInArrow(leaf, fields), "align-fragments")
    closed = [level.where("at IS NULL")]
    while most > 1:
        most = -(-most // fan)
        groups = level.where("at IS NOT NULL").groupBy("row", F.expr(f"at div {fan}"))
        level = materialise(groups.applyInArrow(composed(most == 1), fields), "align-fragments")
        closed.append(level.where("at IS NULL"))
    found = closed[0]
    for more in closed[1:]:
        found = found.unionByName(more)
    return found.select("row", "doc", "place", "a", "b")


class Links:
    """The links of many closed runs, in order: one for each piece between neighbouring ends of either tokenizer."""

    def __init__(self, spell: Speller, runs: list[tuple]):
        import numpy as np

        counts = lambda k: np.array([len(r[k]) for r in runs], np.int64)
        self.n_a, self.n_b = counts(0), counts(1)
        self.a, self.b = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.uint32) for k in (0, 1))
        a_ends, b_ends = np.cumsum(spell.a_sizes[self.a]), np.cumsum(spell.b_sizes[self.b])
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, np.uint8)  # by byte: 1 where A ends, 2 where B ends
        marks[a_ends] = 1
        marks[b_ends] += 2
        ends = np.flatnonzero(marks)
        marks = marks[ends]
        self.is_a, self.is_b, self.is_common = (marks & 1).astype(bool), marks >= 2, marks == 3
        self.upto_a, self.upto_b = np.cumsum(self.is_a, dtype=np.int32), np.cumsum(self.is_b, dtype=np.int32)
        last = np.concatenate([[0], a_ends])[np.concatenate([[0], np.cumsum(self.n_a)])]  # where each run ends
        self.links = np.searchsorted(ends, last, "right")
        self.groups = np.concatenate([[0], np.cumsum(self.is_common, dtype=np.int64)])[self.links]

    @property
    def pairs(self):
        import numpy as np

        a, b = self.a[self.upto_a - self.is_a], self.b[self.upto_b - self.is_b]
        return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)

    def texts(self, names) -> list[bytes]:
        """The groups of each run as ``a1,a2|b1;a3|b2``, in decimal, closed by a semicolon."""
        import numpy as np

        in_a, in_b = names
        size = len(in_a) // 2
        group = np.cumsum(self.is_common, dtype=np.int32) - self.is_common
        out = np.empty(len(self.a) + len(self.b), in_a.dtype)
        # Before a token of A come all tokens of B of earlier groups, before one of B all of A up to its own group.
        earlier_b = np.concatenate([[0], self.upto_b[self.is_common]])
        out[np.arange(len(self.a)) + earlier_b[group[self.is_a]]] = in_a[self.a + size * self.is_common[self.is_a]]
        upto_a = self.upto_a[self.is_common]
        out[np.arange(len(self.b)) + upto_a[group[self.is_b]]] = in_b[self.b + size * self.is_common[self.is_b]]
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        return [out[i:j].tobytes().translate(None, b"\0") for i, j in zip([0, *stops], stops)]


def _names(size: int):
    """Decimal ids with a comma after them, then with a bar for A and a semicolon for B, in fields of equal width."""
    import numpy as np

    field = lambda c: np.array([f"{i}{c}" for i in range(size)], f"S{len(str(size)) + 1}")
    return tuple(np.concatenate([field(","), field(c)]) for c in "|;")


def _batches_of(batch):
    """Index ranges of a batch of (…, a, b) with about TOGETHER tokens each."""
    import pyarrow.compute as pc

    sizes = pc.add(pc.binary_length(batch["a"]), pc.binary_length(batch["b"])).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(sizes):
        size += n // 4
        if size >= TOGETHER:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _ids_of(batch, i: int, j: int) -> list[tuple]:
    return [(_ids(a.as_py()), _ids(b.as_py())) for a, b in zip(batch["a"][i:j], batch["b"][i:j])]


def pair_counts(runs: DataFrame, files: Tokenizers) -> DataFrame:
    """(pair, n, best) of all linked id pairs; ``pair`` is a * 2**32 + b, ``best``: no pair of the same B id has more."""
    speller = _speller(runs.sparkSession, files)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        spell, held, size = speller(), [], 0

        def merged():
            pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            counts = np.zeros(len(pairs), np.int64)
            np.add.at(counts, place, np.concatenate([n for _, n in held]))
            return pairs, counts

        def batch_of(pairs, counts):
            return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            for i, j in _batches_of(batch):
                held.append(np.unique(Links(spell, _ids_of(batch, i, j)).pairs, return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    held, size = [merged()], 0
                    if len(held[0][0]) > HELD // 2:
                        yield batch_of(*held.pop())
        if held:
            yield batch_of(*merged())

    counted = runs.select("a", "b").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "align-pairs").withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return materialise(counted.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best")), "align-counts")


def _measure(runs: DataFrame, files: Tokenizers, counts: DataFrame, with_text: bool) -> DataFrame:
    """Per run: sums over its links by the given pairs, and with ``with_text`` its sizes and the text of its groups."""
    table = counts.select("pair", "n", "best").toArrow()
    spark, key = runs.sparkSession, uuid.uuid4().hex
    speller = _speller(spark, files)
    columns = [table.column(c).to_numpy() for c in ("pair", "n", "best")]
    order = columns[0].view("u8").argsort()
    shared = spark.sparkContext.broadcast([c[order] for c in columns])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        spell = speller()
        pairs, n, best = once_per_worker("align-pairs", key, lambda: (shared.value[0].view(np.uint64), *shared.value[1:]))
        names = once_per_worker("align-names", key, lambda: _names(max(len(spell.a_sizes), len(spell.b_sizes)))) if with_text else None
        for batch in batches:
            for i, j in _batches_of(batch):
                links = Links(spell, _ids_of(batch, i, j))
                wanted, place = np.unique(links.pairs, return_inverse=True)
                at = np.minimum(np.searchsorted(pairs, wanted), max(len(pairs) - 1, 0))
                known = pairs[at] == wanted if len(pairs) else np.zeros(len(wanted), bool)
                count = np.where(known, n[at], 0) if len(pairs) else np.zeros(len(wanted), np.int64)
                is_best = known & best[at] if len(pairs) else known
                upto = lambda v: np.concatenate([[0], np.cumsum(v[place], dtype=np.int64)])[links.links]
                sizes = [links.n_a, links.n_b, np.diff(links.groups), np.diff(links.links)]
                sums = [np.diff(upto(is_best)), np.diff(upto(count))]
                values = sizes + sums if with_text else [v * 0 for v in sizes] + sums
                texts = pa.array(links.texts(names), pa.binary()).view(pa.string()) if with_text else pa.nulls(j - i, pa.string())
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc"], part["place"], *map(pa.array, values), texts],
                    names=["row", "doc", "place", *_SUMS, "groups"],
                )

    sums = ", ".join(f"{c} bigint" for c in _SUMS)
    return runs.mapInArrow(run, f"row bigint, doc bigint, place int, {sums}, groups string")


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(
    table: DataFrame,
    files: Tokenizers,
    doc_id: str = "doc_id",
    text: str = "text",
    range_bytes: int = RANGE,
    fan: int = FAN,
    most_pairs: int = PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row; ``groups`` is text like ``1,2|3;4|5,6``."""
    docs = table.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    tokens = tokenise(docs, files, range_bytes)
    single = tokens.where("ranges = 1").select("row", "doc", "place", "a", "b")
    several = close_runs(tokens, files, fan)
    counts = pair_counts(single.unionByName(several), files)
    total = counts.count()
    parts = max(1, -(-total // most_pairs))

    def measured(runs: DataFrame) -> DataFrame:
        found = None
        for part in range(parts):
            some = _measure(runs, files, counts.where(F.pmod(F.xxhash64("b"), F.lit(parts)) == part) if parts > 1 else counts, not part)
            found = some if found is None else found.unionByName(some)
        return found

    sums = [F.sum(c).alias(c) for c in _SUMS]
    whole, pieces = measured(single), measured(several)
    if parts > 1:
        whole = whole.groupBy("row", "doc", "place").agg(*sums, F.max("groups").alias("groups"))
        pieces = pieces.groupBy("row", "doc", "place").agg(*sums, F.max("groups").alias("groups"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("place", "groups"))), lambda r: r["groups"])
    joined = pieces.groupBy("row", "doc").agg(*sums, F.array_join(in_order, "").alias("groups"))
    final = [F.col("doc").alias("doc_id"), *_SUMS, F.rtrim("groups", F.lit(";")).alias("groups")]
    return whole.select(*final).unionByName(joined.select(*final))
