"""Lengths of greedy word-piece encodings by a linear longest-match automaton.

The vocabulary is a trie with two roots: pieces that start a word and pieces that continue one. A node whose string cannot
be extended follows its failure link, which stands for cutting off the longest pieces greedily; how many pieces
that pops is stored with the node. A word is read once, left to right, and only the counts are added: no piece is built.

A word is a run of characters other than space and the controls from tab to carriage return. A word that the greedy cut
cannot cover counts as one unknown token.

Cases: a null or empty text has no words and no tokens. Texts and words of any length are read whole. Repeated rows are
counted one by one. Other columns of the table are untouched; the counts come as one struct column of a name of choice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.llm.workers import Memo, fingerprint, once_per_worker

COUNTS = "struct<n_words:bigint,n_tokens:bigint,n_unknown:bigint>"
#: Words whose counts a worker keeps.
REMEMBERED = 500_000
_UNKNOWN = 1 << 40


class PieceCounter:
    def __init__(self, starting: Iterable[str], continuing: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        self.is_piece = [False, False]
        for root, pieces in enumerate((starting, continuing)):
            for piece in pieces:
                self._add(root, piece)
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        self._link()

    def _add(self, node: int, piece: str) -> None:
        if not piece:
            return
        for c in piece:
            following = self.next[node].get(c)
            if following is None:
                following = self.next[node][c] = len(self.next)
                self.next.append({})
                self.is_piece.append(False)
            node = following
        self.is_piece[node] = True

    def _link(self) -> None:
        """Breadth first, so that a node's failure chain is complete before the node is reached."""
        layer = [0, 1]
        while layer:
            below = []
            for parent in layer:
                for c, node in self.next[parent].items():
                    below.append(node)
                    if self.is_piece[node]:
                        self.fail[node], self.popped[node] = 1, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at >= 0 and c not in self.next[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][c], count
            layer = below

    def count(self, word: str) -> int:
        """Pieces of the word, or -1 if it cannot be covered."""
        following, fail, popped = self.next, self.fail, self.popped
        node, pieces = 0, 0
        for c in word:
            while c not in following[node]:
                if fail[node] < 0:
                    return -1
                pieces += popped[node]
                node = fail[node]
            node = following[node][c]
        while node != 1:
            if fail[node] < 0:
                return -1
            pieces += popped[node]
            node = fail[node]
        return pieces


def read_pieces(model_path: str) -> tuple[list[str], list[str]]:
    """Starting and continuing pieces of a sentence-piece model; control, byte and unknown pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    pieces = [model.id_to_piece(i) for i in ids]
    mark = "▁"
    return [p[1:] for p in pieces if p.startswith(mark) and len(p) > 1], [p for p in pieces if not p.startswith(mark)]


def piece_counts(spark: SparkSession, text: Column, starting: list[str], continuing: list[str]) -> Column:
    """(n_words, n_tokens, n_unknown) of a text column. The vocabulary is broadcast; its size does not follow the data."""
    vocabulary, key = spark.sparkContext.broadcast((starting, continuing)), fingerprint(starting, continuing)

    @F.arrow_udf(COUNTS)
    def counts(texts):
        import pyarrow as pa

        def build():
            counter = PieceCounter(*vocabulary.value)

            def weigh(word: bytes) -> int:
                n = counter.count(word.decode())
                return _UNKNOWN + 1 if n < 0 else n

            return Memo(weigh, REMEMBERED)

        weights = once_per_worker("pieces", key, build)
        n_words, sums = [], []
        for t in texts:
            found = (t.as_py() or "").encode().split()  # splits at exactly the blanks named above
            n_words.append(len(found))
            sums.append(sum(map(weights.__getitem__, found)))
        arrays = [n_words, [s % _UNKNOWN for s in sums], [s // _UNKNOWN for s in sums]]
        return pa.StructArray.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["n_words", "n_tokens", "n_unknown"])

    return counts(text)


def count_pieces(docs: DataFrame, starting: list[str], continuing: list[str], text="text", into="pieces") -> DataFrame:
    return docs.withColumn(into, piece_counts(docs.sparkSession, F.col(text), starting, continuing))
