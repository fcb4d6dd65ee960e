"""Spelling variants: words one edit apart, found by probing generated edits against length-sharded Bloom filters.

The vocabulary is hashed and filed in one large Bloom filter of 64-bit blocks, in which every word length owns a range of blocks. The
filter is built in pieces of equal size by as many tasks, and broadcast. Each word generates its deletions and its replacements
by a larger code point and looks their hashes up in the range of the resulting length; an insertion is the deletion of the longer word, and a
replacement by a smaller code point is one by a larger of the other word, so no pair is missed or met twice. The hash of
an edit follows from the word's by sums, so no edited word is built. Only the edits that the filter may hold go through a shuffle, to an exact
join with the vocabulary that removes the false ones: the two words of a pair are compared.

A filter is broadcast up to ``most_blocks`` blocks. A larger one is used in windows of that many blocks, one pass over
the vocabulary for each, and the passes are put together.

Cases: null words and words without occurrences take no part; a word that is given twice counts as one with the sum. Texts are read whole, whatever
their length; a null id is written as no characters. Among near words with the same largest count the smallest in code-point order is the form.
An empty table gives an empty result. Other columns are not looked at, and their names do not matter.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from weftline.llm.workers import once_per_worker
from weftline.session import materialise

#: Letters of the words: ASCII and Latin-1 from À on.
LETTERS = "A-Za-zÀ-ÿ"
#: Bits of the filter for each word, blocks that one task builds, and blocks (of 8 bytes) that are broadcast at once.
BITS, PIECE_BLOCKS, BROADCAST_BLOCKS = 20, 1 << 16, 8 << 20
#: Words from this length on share the last range.
LONGEST = 255
#: Distinct words that a task holds before it passes their counts on, and edits that are hashed together.
HELD, TOGETHER = 400_000, 2_000_000


def count_words(
    docs: DataFrame, least_chars: int, change: Callable[[int, str], str] | None = None, least: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(word, n): the maximal runs of letters of all texts, with A-Z lower-cased, that have ``least_chars`` code points.

    ``change`` turns a run into the word that counts; it gets the run and the CRC of ``<id>:<run>``. Words with fewer than
    ``least`` occurrences are left out. Counts are combined before the shuffle.
    """
    runs = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))

    def run(batches):
        import pyarrow as pa

        find = re.compile(f"[{LETTERS}]{{{least_chars},}}").findall
        held: Counter[str] = Counter()

        def counted():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = Counter(find((value.as_py() or "").encode().lower().decode()))  # of bytes: only A-Z change
                if change is not None:
                    start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                    for word, n in words.items():
                        changed = change(zlib.crc32(word.encode(), start), word)
                        if len(changed) >= least_chars:
                            held[changed] += n
                else:
                    held.update(words)
                if len(held) > HELD:
                    yield counted()
        yield counted()

    counts = runs.mapInArrow(run, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _value(points):
    """A random 64-bit number for each code point."""
    import numpy as np

    return _mixed(points.astype(np.uint64) + np.uint64(0x51ED270B9F7A3C11))


def _factor(start: int, stop: int):
    """An odd random 64-bit number for each position."""
    import numpy as np

    return _mixed(np.arange(start, stop, dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)


def _closed(total, length: int):
    import numpy as np

    return _mixed(total + np.uint64(length * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def _by_length(words: list[str]):
    """(indices, matrix of code points) for each length among the words."""
    import numpy as np

    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        joined = "".join(words[i] for i in at).encode("utf-32-le", "surrogatepass")
        yield at, np.frombuffer(joined, "<u4").reshape(len(at), n)


def hashes(words: list[str]):
    import numpy as np

    out = np.zeros(len(words), np.uint64)
    for at, points in _by_length(words):
        n = points.shape[1]
        rows = max(1, TOGETHER // max(n, 1))
        for i in range(0, len(at), rows):
            out[at[i : i + rows]] = _closed((_value(points[i : i + rows]) * _factor(0, n)).sum(axis=1, dtype=np.uint64), n)
    return out


def edits(points, alphabet, lengths):
    """(row, hash, length) arrays of the deletions and of the replacements by a larger code point, block by block.

    ``points`` is a matrix of words of one length, ``lengths`` tells which resulting lengths are wanted.
    """
    import numpy as np

    n = points.shape[1]
    values_of = _value(alphabet)
    rows = max(1, TOGETHER // max(1, n * len(alphabet)))
    wide = max(1, TOGETHER // max(1, len(alphabet)))
    for i in range(0, len(points), rows):
        some = points[i : i + rows]
        values, factor = _value(some), _factor(0, n)
        weighted = values * factor
        total = weighted.sum(axis=1, dtype=np.uint64)
        if lengths(n - 1):
            before = np.cumsum(weighted, axis=1, dtype=np.uint64) - weighted
            moved = np.zeros_like(weighted)  # the letters after a position, each one place to the left
            moved[:, :-1] = values[:, 1:] * factor[:-1]
            after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
            # Deleting either of two equal neighbours gives the same word.
            new = np.ones(some.shape, bool)
            new[:, 1:] = some[:, 1:] != some[:, :-1]
            row, place = np.nonzero(new)
            yield row + i, _closed(before[row, place] + after[row, place], n - 1), n - 1
        if lengths(n) and len(alphabet):
            for j in range(0, n, wide):
                part = slice(j, j + wide)
                changed = (values_of - values[:, part, None]) * factor[part, None] + total[:, None, None]
                row, place, letter = np.nonzero(alphabet > some[:, part, None])
                yield row + i, _closed(changed[row, place, letter], n), n


class Ranges:
    """The blocks of the filter that each word length owns."""

    def __init__(self, counts: dict[int, int], bits: int = BITS):
        import numpy as np

        self.blocks = np.zeros(LONGEST + 1, np.uint64)
        for length, n in counts.items():
            self.blocks[length] = max(1, math.ceil(n * bits / 64))
        self.starts = np.cumsum(self.blocks) - self.blocks
        self.total = int(self.blocks.sum())

    def has(self, length: int) -> bool:
        return length >= 0 and bool(self.blocks[min(length, LONGEST)])

    def places(self, hashed, length):
        """Block of each hash, by its upper half."""
        import numpy as np

        at = np.minimum(length, LONGEST)
        return self.starts[at] + ((hashed >> np.uint64(32)) * self.blocks[at] >> np.uint64(32))

    @staticmethod
    def masks(hashed):
        """Four bits of a block, by the lower half."""
        import numpy as np

        mask = np.zeros(len(hashed), np.uint64)
        for shift in (0, 6, 12, 18):
            mask |= np.uint64(1) << (hashed >> np.uint64(shift) & np.uint64(63))
        return mask


def build_filter(vocabulary: DataFrame, ranges: Ranges) -> DataFrame:
    """(piece, bits): the filter in pieces of equal size."""

    def place(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            hashed, chars = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            block = ranges.places(hashed, chars).astype(np.int64)
            columns = [block // PIECE_BLOCKS, block % PIECE_BLOCKS, ranges.masks(hashed).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["piece", "block", "mask"])

    def build(table):
        import numpy as np
        import pyarrow as pa

        piece = table["piece"][0].as_py()
        bits = np.zeros(min(PIECE_BLOCKS, ranges.total - piece * PIECE_BLOCKS), np.uint64)
        np.bitwise_or.at(bits, table["block"].to_numpy(), table["mask"].to_numpy().view(np.uint64))
        return pa.table({"piece": pa.array([piece], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    placed = vocabulary.select("h", "chars").mapInArrow(place, "piece bigint, block bigint, mask bigint")
    return placed.groupBy("piece").applyInArrow(build, "piece bigint, bits binary")


def _probe(vocabulary: DataFrame, alphabet: list[int], ranges: Ranges, pieces: DataFrame, first: int, count: int) -> DataFrame:
    """(id, h): the edits of each word that the ``count`` pieces from ``first`` on may hold."""
    rows = pieces.where(F.col("piece").between(first, first + count - 1)).collect()
    blobs = {row["piece"]: bytes(row["bits"]) for row in rows}  # a piece without words is left out
    shared, key = vocabulary.sparkSession.sparkContext.broadcast(blobs), uuid.uuid4().hex
    low, high = first * PIECE_BLOCKS, min((first + count) * PIECE_BLOCKS, ranges.total)

    def load():
        import numpy as np

        bits = np.zeros(high - low, np.uint64)
        for piece, blob in shared.value.items():
            start = piece * PIECE_BLOCKS - low
            bits[start : start + len(blob) // 8] = np.frombuffer(blob, np.uint64)
        return bits

    def run(batches):
        import numpy as np
        import pyarrow as pa

        bits, letters = once_per_worker("spelling-filter", key, load), np.array(alphabet, np.uint32)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, points in _by_length(batch.column(1).to_pylist()):
                for row, hashed, length in edits(points, letters, ranges.has):
                    place, mask = ranges.places(hashed, length).astype(np.int64) - low, ranges.masks(hashed)
                    here = (place >= 0) & (place < len(bits))
                    hit = here & (bits[np.where(here, place, 0)] & mask == mask)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at[row[hit]]]), pa.array(hashed[hit].view(np.int64))], names=["id", "h"]
                    )

    return vocabulary.select("id", "word").mapInArrow(run, "id bigint, h bigint")


def _hashed(words: DataFrame) -> DataFrame:
    """(id, word, n, chars, h) of the distinct words."""
    whole = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n")).where("n > 0")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = batch.column(1).to_pylist()
            chars = pa.array([len(w) for w in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, chars, pa.array(hashes(found).view(np.int64))], names=["id", "word", "n", "chars", "h"])

    numbered = whole.select(F.monotonically_increasing_id().alias("id"), "word", "n")
    return materialise(numbered.mapInArrow(run, "id bigint, word string, n bigint, chars bigint, h bigint"), "spelling-words")


def near_pairs(vocabulary: DataFrame, most_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """(a, b) structs (id, word, n) of the words one edit apart, each pair once. ``vocabulary`` is as ``_hashed`` gives it."""
    length = F.least("chars", F.lit(LONGEST)).cast("int").alias("length")
    ranges = Ranges({row["length"]: row["n"] for row in vocabulary.groupBy(length).agg(F.count("*").alias("n")).collect()})
    letters = vocabulary.select(F.explode(F.array_distinct(F.regexp_extract_all("word", F.lit("(?s)."), F.lit(0)))).alias("c")).distinct()
    # As many rows as there are different code points.
    alphabet = sorted(ord(row["c"]) for row in letters.collect())
    pieces = materialise(build_filter(vocabulary, ranges), "spelling-filter")
    count, step = math.ceil(ranges.total / PIECE_BLOCKS), max(1, most_blocks // PIECE_BLOCKS)
    maybe = None
    for first in range(0, max(count, 1), step):
        found = _probe(vocabulary, alphabet, ranges, pieces, first, step)
        maybe = found if maybe is None else maybe.unionByName(found)
    maybe = materialise(maybe, "spelling-edits")
    word = lambda: F.struct("id", "word", "n")
    target = vocabulary.select(F.col("h"), word().alias("b"))
    source = vocabulary.select("id", word().alias("a"))
    met = maybe.join(target, "h").select("id", "b").join(source, "id")
    return met.where((F.col("a.word") != F.col("b.word")) & (F.levenshtein("a.word", "b.word", 1) == 1)).select("a", "b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. Each round doubles the steps taken."""
    reached = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        stepped = reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        reached = materialise(stepped.observe(seen, F.count_if("moved").alias("moved")).drop("moved"), "spelling-roots")
        if not seen.get["moved"]:
            return reached


def group_variants(words: DataFrame, ratio: int = 10, most_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n).

    A word's form is its near word with the largest ``n``, if that is at least ``ratio`` times its own; the root is where forms lead.
    ``ratio`` is above 1, so forms never lead in a circle.
    """
    vocabulary = _hashed(words)
    pairs = near_pairs(vocabulary, most_blocks)
    other = lambda x, y: F.struct(F.col(f"{x}.id").alias("id"), (-F.col(f"{y}.n")).alias("n"), F.col(f"{y}.word").alias("word"))
    both = pairs.select(F.explode(F.array(other("a", "b"), other("b", "a"))).alias("near")).select("near.*")
    best = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct("n", "word")).alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    found = vocabulary.join(best, "id", "left").select(
        "word",
        F.when(is_form, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    found = materialise(found, "spelling-forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def lost_letter(code: int, word: str) -> str:
    """A typing slip that can be repeated: where 31 divides ``code``, the code point at ``code % length`` is lost."""
    if code % 31:
        return word
    at = code % len(word)
    return word[:at] + word[at + 1 :]
