"""Byte-level BPE encoding with a rank queue under a hierarchical bitmap, and decoding.

A pre-token is a linked list of byte positions. Every adjacent pair whose bytes form a token is filed under that token's rank
in a bucket of positions. A bitmap of three levels of 64 marks the ranks in use, so the lowest one is found by three
find-first-set steps. Taking a rank merges its leftmost position; entries whose pair has changed since are stale and
skipped. The cost per merge does not depend on the length of the pre-token, which matters for very long ones.

Short pre-tokens that are new in a batch of texts share one list and one queue: a rank that is taken merges the leftmost
position of every pre-token that has it, in one array operation. Each pre-token still merges its own lowest rank first.

Texts are cut at blanks into chunks that the pre-token pattern never crosses. Chunks are numbered, a text is an array of
numbers until all chunks of the batch are known, and a memory of two generations, bounded in bytes, saves repeated work.

Cases: a null or empty text has no ids. Texts and pre-tokens of any length are encoded whole. There are no special tokens:
their strings are ordinary text. A null id list decodes to no bytes. Repeated rows are encoded one by one; other columns
are not touched.
"""

from __future__ import annotations

import base64
import re
from heapq import heappop, heappush

from pyspark.sql import Column, SparkSession, functions as F

from weftline.llm.workers import fingerprint, once_per_worker

#: Bytes of a generation of chunks whose ids a worker keeps; what a chunk takes besides its characters.
REMEMBERED, EACH = 110_000_000, 250
#: Bytes up to which pre-tokens share a queue, how many of them do, and characters of text that are encoded together.
SHORT, SHARED, TOGETHER = 48, 200_000, 12_000_000
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}


class RankQueue:
    """Buckets of positions by rank, and the bitmap over the ranks in use."""

    def __init__(self, size: int):
        self.low = [0] * ((size >> 6) + 1)
        self.middle = [0] * ((size >> 12) + 1)
        self.top = 0
        self.buckets = _Buckets(self)

    def open(self, rank: int) -> list[int]:
        """A new bucket for a rank that has none."""
        bucket = self.buckets[rank] = []
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)
        return bucket

    def first(self) -> int:
        """The lowest rank in use."""
        at = (self.top & -self.top).bit_length() - 1
        word = self.middle[at]
        at = at << 6 | (word & -word).bit_length() - 1
        word = self.low[at]
        return at << 6 | (word & -word).bit_length() - 1

    def close(self, rank: int) -> list[int]:
        """The bucket of a rank, which is then no longer in use."""
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.middle[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return self.buckets.pop(rank)

    def push(self, rank: int, position: int) -> None:
        heappush(self.buckets[rank], position)

    def pop(self) -> tuple[int, int]:
        """The lowest rank in use and its leftmost position."""
        rank = self.first()
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self.close(rank)
        return rank, position


class _Chunks(dict):
    """Number of each chunk, and its ids by number: None until they are known.

    A chunk stands for itself with a space before; one that begins with a space for itself without that space.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.size, self.ids, self.old, self.new = limit, 0, [], {}, []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self.ids)
        ids = self.old.get(chunk)
        self.ids.append(ids)
        self.size += EACH + 3 * len(chunk)
        if ids is None:
            self.new.append(chunk)
        return number

    def age(self) -> None:
        """To be called when no number is in use: a full generation becomes the old one, without its long chunks."""
        if self.size > self.limit:
            self.old = {c: self.ids[n] for c, n in self.items() if len(c) <= SHORT}
            self.clear()
            self.size, self.ids = 0, []


class _Buckets(dict):
    """Positions by rank; a rank that is asked for is marked as in use."""

    def __init__(self, queue: RankQueue):
        super().__init__()
        self.queue = queue

    def __missing__(self, rank: int) -> list[int]:
        return self.queue.open(rank)


class ByteEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        import numpy as np
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        # Whether the pattern takes ASCII letters after a space as one pre-token.
        self.plain = all(self.find(w) == [w] for w in (" a", " Z", " aZBcdEfGHIj", " " + "qrstuvwxyz" * 9))
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.chunks = _Chunks(remembered)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        # Every way in which a token is two tokens: the pairs that may merge, sorted for look-up.
        splits = {
            (ranks[token[:i]] << 32 | ranks[token[i:]]): rank
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs = np.array(sorted(splits), np.int64)
        self.merged = np.array([splits[p] for p in self.pairs.tolist()], np.int32)
        two = np.arange(1 << 16)
        self.of_bytes = self._rank(self.bytes[two >> 8], self.bytes[two & 255])

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks, queue = self.ranks, self.queue
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        end = list(range(1, n + 1))  # of the token that starts at a position
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that starts at a position
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                queue.push(rank, i)
        while queue.top:
            rank, i = queue.pop()
            if pair[i] != rank:
                continue  # stale
            j = end[i]
            stop = end[i] = end[j]
            pair[j] = pair[i] = -1
            if stop < n:
                before[stop] = i
                rank = ranks.get(piece[i : end[stop]])
                if rank is not None:
                    pair[i] = rank
                    queue.push(rank, i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(piece[h:stop])
                pair[h] = -1 if rank is None else rank
                if rank is not None:
                    queue.push(rank, h)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def _rank(self, left, right):
        """Rank of each pair of token ids, -1 where the pair is no token or one side is missing (-1)."""
        import numpy as np

        wanted = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where((self.pairs[at] == wanted) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of many short pre-tokens, each as 32-bit integers. All of them are in one linked list and one queue."""
        import numpy as np

        sizes = np.array([len(p) for p in pieces])
        n = int(sizes.sum())
        joined = np.frombuffer(b"".join(pieces), np.uint8)
        token = np.append(self.bytes[joined], np.int32(-1))
        owner = np.append(np.repeat(np.arange(len(pieces), dtype=np.int32), sizes), np.int32(-1))
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        firsts = np.cumsum(sizes) - sizes
        after[firsts + sizes - 1], before[firsts], after[n], before[n] = n, n, n, n
        pair = np.full(n + 1, -1, np.int32)
        pair[: n - 1] = self.of_bytes[joined[:-1].astype(np.int32) << 8 | joined[1:]]
        pair[firsts + sizes - 1] = -1
        queue, buckets = self.queue, self.queue.buckets
        # The first pairs are filed all at once: sorted by rank, a bucket's share is a slice.
        filed = np.flatnonzero(pair >= 0).astype(np.int32)
        filed = filed[np.argsort(pair[filed], kind="stable")]
        cuts = np.flatnonzero(np.diff(pair[filed])) + 1
        slices = dict(zip(pair[filed[np.concatenate([[0], cuts])]].tolist(), np.split(filed, cuts))) if len(filed) else {}
        for rank in slices:
            queue.open(rank)

        def push(ranks, places) -> None:
            found = ranks >= 0
            for rank, place in zip(ranks[found].tolist(), places[found].tolist()):
                buckets[rank].append(place)

        while queue.top:
            rank = queue.first()
            places, first = np.array(queue.close(rank), np.int32), slices.pop(rank, None)
            if first is not None:
                places = np.concatenate([first, places]) if len(places) else first
            places = places[pair[places] == rank]  # the others are stale
            if len(places) > 1:
                places = np.sort(places)
                places = places[np.append(True, places[1:] != places[:-1])]
                leftmost = np.append(True, owner[places[1:]] != owner[places[:-1]])
                if not leftmost.all():
                    queue.open(rank)[:] = places[~leftmost].tolist()
                    places = places[leftmost]
            if not len(places):
                continue
            gone = after[places]
            right, left = after[gone], before[places]
            token[places], token[gone], pair[gone] = rank, -1, -1
            after[places], before[right] = right, places
            has_left = left != n
            left = left[has_left]
            ranks = self._rank(np.concatenate([token[places], token[left]]), np.concatenate([token[right], token[places[has_left]]]))
            changed = np.concatenate([places, left])
            pair[changed] = ranks
            push(ranks, changed)
        alive = token[:n] >= 0
        data, counts = token[:n][alive].astype("<u4").tobytes(), np.bincount(owner[:n][alive], minlength=len(pieces))
        ends = (4 * np.cumsum(counts)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _merged(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pre-tokens."""
        found, short = {}, []
        for piece in pieces:
            raw = piece.encode()
            if raw in self.ranks or len(raw) > SHORT:
                found[piece] = b"".join(i.to_bytes(4, "little") for i in self.merge(raw))
            else:
                short.append((piece, raw))
        for i in range(0, len(short), SHARED):
            some = short[i : i + SHARED]
            found.update(zip((p for p, _ in some), self.merge_many([r for _, r in some])))
        return found

    def _learn(self) -> None:
        """The ids of all new chunks."""
        chunks = self.chunks
        find, plain = self.find, self.plain
        parts = [[" " + c] if plain and c.isascii() and c.isalpha() else find(c[1:] if c[:1] == " " else " " + c) for c in chunks.new]
        found = self._merged(list({p for pieces in parts for p in pieces}))
        for chunk, pieces in zip(chunks.new, parts):
            chunks.ids[chunks[chunk]] = found[pieces[0]] if len(pieces) == 1 else b"".join(map(found.__getitem__, pieces))
        chunks.new = []

    def encode_all(self, texts) -> list[bytes]:
        """The ids of each text as unsigned 32-bit integers, little end first. Texts may come one by one."""
        import numpy as np

        chunks = self.chunks
        chunks.age()
        cut = [np.array(list(map(chunks.__getitem__, self._cut(t))), np.int32) for t in texts]
        self._learn()
        return [b"".join(map(chunks.ids.__getitem__, numbers.tolist())) for numbers in cut]

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        if any(c in text for c in _BLANKS):
            return [" " + p for p in self.find(text)]
        if text[0] == " " or text[-1] == " " or "  " in text or "\n " in text or " \n" in text:
            return [" " + p for p in _CHUNK.findall(text)]
        first, *rest = text.split(" ")
        return [" " + first, *rest]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _batches(texts: list[str], most: int):
    """Texts in runs of about ``most`` characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encoded(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Binary column: the ids of each text, 32 bits each, little end first. The ranks are broadcast."""
    ranks = read_ranks(path)
    shared, key = spark.sparkContext.broadcast((ranks, pattern)), fingerprint(ranks, pattern)

    @F.arrow_udf("binary")
    def encode(texts):
        import pyarrow as pa

        encoder = once_per_worker("bpe", key, lambda: ByteEncoder(*shared.value))
        runs = _batches([t or "" for t in texts.to_pylist()], TOGETHER)
        return pa.array([ids for run in runs for ids in encoder.encode_all(run)], pa.binary())

    return encode(text)


def decoded(spark: SparkSession, ids: Column, path: str) -> Column:
    """Binary column: the bytes that the ids stand for."""
    ranks = read_ranks(path)
    shared, key = spark.sparkContext.broadcast(ranks), fingerprint(ranks)

    def table() -> list[bytes]:
        tokens = [b""] * (max(shared.value.values()) + 1)
        for token, rank in shared.value.items():
            tokens[rank] = token
        return tokens

    @F.arrow_udf("binary")
    def decode(lists):
        import numpy as np
        import pyarrow as pa

        tokens = once_per_worker("bpe-tokens", key, table)
        each = (np.frombuffer(x.as_py() or b"", "<u4").tolist() for x in lists)
        return pa.array([b"".join(map(tokens.__getitem__, ids)) for ids in each], pa.binary())

    return decode(ids)
