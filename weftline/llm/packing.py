"""Hierarchical packing of documents into sequences of several lengths.

Documents are cut into full windows of the longest tier and a remainder, which goes to the tier of the smallest window that
holds it. Tiers are packed from the longest down: a remainder opens a window of its tier, and the gap is filled with the
largest shorter remainders that fit; one more is cut where the gap ends, and its rest goes back to the tier of its new length.
Every sequence is thus exactly as long as its window, a power of two, and needs no padding. Sequences of one window length
are dealt to step groups of equal token count, in turns by attention cost, so that groups cost about the same.

Work is local to a partition and needs no shuffle. A task holds at most ``pool_tokens`` ids of waiting documents plus the
current one. What is left at its end is less than one longest window and is cut at powers of two.

Cases: a null or empty text is a document of the closing id alone. A text of any length is packed whole, every id in one
piece. Repeated rows and rows with a null id are packed each by itself. An empty table gives no piece. Other columns are
not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from weftline.llm.workers import fingerprint, once_per_worker

WINDOWS = (256, 512, 1024, 2048, 4096)
POOL_TOKENS = 1 << 20
GROUP_TOKENS = 1 << 18
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "window_tokens bigint, group_id bigint, ids binary"
)
#: Words whose ids a worker keeps.
REMEMBERED = 1_200_000
_STOPS = b".,;:!?"


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space, word by word with a bounded memory.

    Only for tokenizers whose pre-tokens never cross white space and whose normaliser lower-cases by character. A-Z are
    lower-cased before the look-up where that cannot change the result. With ``added_tokens``, as by the library's default,
    a text that holds the string of an added token gets its id there; such strings must hold no blank.
    """

    def __init__(self, tokenizer: str, remembered: int = REMEMBERED, added_tokens: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = self.tokenizer.get_added_tokens_decoder().values() if added_tokens else ()
        self.added = [t.content.encode().lower() for t in added]
        self.memo: dict[bytes, bytes] = {}
        self.remembered = remembered
        self.ends = self._ends()

    def _ends(self):
        """Which ids end a word, if the tokenizer marks them; None otherwise."""
        import json

        import numpy as np

        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        return ends if suffix else None

    def _code(self, words: list[bytes], letters: bool) -> list[bytes]:
        """Ids of each word. Words of letters only, which have one end at least, are encoded as one text and cut there."""
        import numpy as np

        if self.ends is not None and letters:
            ids = np.asarray(self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(words):
                data, at = ids.tobytes(), [0, *(cuts * 4).tolist()]
                return [data[a:b] for a, b in zip(at, at[1:])]
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [_u4(e.ids) for e in coded]

    def _learn(self, found: set[bytes]) -> None:
        """Words not met before. A word that ends in stops is put together from its parts."""
        parts = {}
        held = {w for w in found if self._holds_added(w)}
        for word in found - held:
            core = word.rstrip(_STOPS)
            if len(core) < len(word) and core and _ends_in_letter(core.decode()):
                parts[word] = (core, word[len(core) :])
        wanted = {p for pair in parts.values() for p in pair}.union(found.difference(parts)).difference(self.memo)
        plain = {w for w in wanted - held if w.decode().isalpha()}
        for some, letters in ((list(plain), True), (list(wanted - plain), False)):
            for at in range(0, len(some), 2048):
                part = some[at : at + 2048]
                self.memo.update(zip(part, self._code(part, letters)))
        self.memo.update((word, self.memo[a] + self.memo[b]) for word, (a, b) in parts.items())

    def words(self, text: str) -> list[bytes]:
        import unicodedata

        raw = text.encode()
        low = raw.lower()
        if not text.isascii():
            same = unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low.decode())
            low = low if same else raw
        if not self._holds_added(raw):
            return low.split()
        # Added tokens are found before the normaliser, in their own case.
        return [r if self._holds_added(r) else w for r, w in zip(raw.split(), low.split())]

    def _holds_added(self, raw: bytes) -> bool:
        """Whether an added token may be in it, in any case."""
        if not self.added:
            return False
        low = raw.lower()
        return any(a in low for a in self.added)

    def ids(self, text: str) -> bytes:
        """The ids as unsigned 32-bit integers, little end first."""
        found = self.words(text)
        missing = set(found).difference(self.memo)
        if missing:
            if len(self.memo) + len(missing) > self.remembered:
                self.memo.clear()
                missing = set(found)
            self._learn(missing)
        return b"".join(map(self.memo.__getitem__, found))


def _ends_in_letter(word: str) -> bool:
    """Whether a letter is last after normalisation too: U+0130 lower-cases to a letter and a mark, NFC cuts some letters so."""
    import unicodedata

    return word[-1].isalpha() and unicodedata.normalize("NFC", word[-1]).lower()[-1].isalpha()


def _u4(ids) -> bytes:
    import numpy as np

    return np.asarray(ids, "<u4").tobytes()


class Packer:
    """Packs the documents of one task. Fragments are (length, number, start); ``docs`` holds ids by number."""

    def __init__(self, windows=WINDOWS, pool_tokens=POOL_TOKENS, group_tokens=GROUP_TOKENS):
        self.windows, self.longest = tuple(sorted(windows)), max(windows)
        self.pool_tokens, self.group_tokens = pool_tokens, group_tokens
        self.docs: dict[int, tuple] = {}
        self.left: dict[int, int] = {}  # ids of a document that are not placed yet
        self.waiting: list[tuple[int, int, int]] = []
        self.pooled = self.added = 0
        self.full: list[tuple[int, list]] = []  # (window, fragments)

    def add(self, doc_id, ids: bytes) -> None:
        number, tokens = self.added, len(ids) // 4
        self.added += 1
        self.docs[number], self.left[number] = (doc_id, ids), tokens
        whole = tokens - tokens % self.longest
        self.full += [(self.longest, [(self.longest, number, at)]) for at in range(0, whole, self.longest)]
        if tokens > whole:
            insort(self.waiting, (tokens - whole, number, whole))
            self.pooled += tokens - whole

    def _open(self) -> tuple[int, list] | None:
        """Fill one window from the longest waiting fragment on; None, with nothing changed, if too little waits."""
        largest = self.waiting[-1][0]
        window = self.windows[bisect_left(self.windows, largest)]
        if self.pooled < window:
            return None
        inside, gap = [self.waiting.pop()], window - largest
        while gap:
            at = bisect_right(self.waiting, (gap, self.added, 0))
            if at:
                inside.append(self.waiting.pop(at - 1))
                gap -= inside[-1][0]
            else:  # all that wait are longer than the gap
                length, number, start = self.waiting.pop(0)
                inside.append((gap, number, start))
                insort(self.waiting, (length - gap, number, start + gap))
                gap = 0
        self.pooled -= window
        return window, inside

    def _tail(self) -> None:
        """What is left, cut into sequences whose lengths are powers of two."""
        while self.waiting:
            window, inside, gap = 1 << (self.pooled.bit_length() - 1), [], 0
            window = gap = min(window, self.longest)
            while gap:
                length, number, start = self.waiting.pop()
                taken = min(length, gap)
                inside.append((taken, number, start))
                if length > taken:
                    insort(self.waiting, (length - taken, number, start + taken))
                gap -= taken
            self.pooled -= window
            self.full.append((window, inside))

    def drain(self, last: bool = False) -> Iterator[tuple[int, int, list]]:
        """Finished sequences as (window, group, fragments)."""
        while self.waiting and (filled := self._open()):
            self.full.append(filled)
        if last:
            self._tail()
        done, self.full = self.full, []
        for window in sorted({w for w, _ in done}):
            same = sorted((f for w, f in done if w == window), key=lambda f: -sum(n * n for n, _, _ in f))
            groups = -(-len(same) * window // self.group_tokens)
            for k, fragments in enumerate(same):
                turn, place = divmod(k, groups)
                yield window, place if turn % 2 == 0 else groups - 1 - place, fragments

    def piece(self, fragment) -> tuple:
        """(doc_id, start, length, tokens of the document, ids) of a placed fragment; placed documents are let go."""
        length, number, start = fragment
        doc_id, ids = self.docs[number]
        self.left[number] -= length
        if not self.left[number]:
            del self.docs[number], self.left[number]
        return doc_id, start, length, len(ids) // 4, ids[4 * start : 4 * (start + length)]


def pack(
    docs: DataFrame, tokenizer_path: str, closing_id: int = 2, windows=WINDOWS, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text", pool_tokens: int = POOL_TOKENS, group_tokens: int = GROUP_TOKENS,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece, columns as in ``PIECES`` (``ids`` only if asked for).

    ``added_tokens``: strings of added tokens in a text give their ids, as by the library's default, else ordinary ids.

    Sequence and group numbers hold the task's number in their upper bits: a task that runs again gives the same ones.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    shared, key = docs.sparkSession.sparkContext.broadcast(tokenizer), fingerprint(tokenizer, added_tokens)
    fields = PIECES if with_ids else PIECES.rpartition(",")[0]
    end = closing_id.to_bytes(4, "little")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        coder = once_per_worker("words", key, lambda: WordIds(shared.value, added_tokens=added_tokens))
        packer = Packer(windows, pool_tokens, group_tokens)
        base = TaskContext.get().partitionId() << 40
        state = {"sequence": 0, "group": 0}

        def out(last: bool):
            rows, size, groups = [], 0, state["group"]
            top = groups
            for window, group, fragments in packer.drain(last):
                offset = 0
                group_id = groups + group * len(packer.windows) + max(0, window.bit_length() - packer.windows[0].bit_length())
                top = max(top, group_id)
                for fragment in fragments:
                    doc, start, length, tokens, ids = packer.piece(fragment)
                    row = (doc, start, length, zlib.crc32(ids), tokens, base + state["sequence"], offset, window, base + group_id)
                    rows.append((*row, ids) if with_ids else row)
                    offset += length
                    size += length
                state["sequence"] += 1
                if size > packer.pool_tokens:
                    yield batch(rows)
                    rows, size = [], 0
            state["group"] = top + 1
            if rows:
                yield batch(rows)

        names = [f.split()[0] for f in fields.split(", ")]
        types = [pa.binary() if n == "ids" else pa.int64() for n in names]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for doc, t in zip(b.column(0), b.column(1)):
                packer.add(doc.as_py(), coder.ids(t.as_py() or "") + end)
                if packer.pooled >= pool_tokens or len(packer.full) * packer.longest >= pool_tokens:
                    yield from out(False)
        yield from out(True)

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, fields)
