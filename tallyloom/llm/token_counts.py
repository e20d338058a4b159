"""Word-piece counts by a linear longest-match automaton (operator 10).

The vocabulary is a trie over word-initial pieces and continuation pieces. When a character has no edge, the automaton follows a failure link to the
state that stands for what is left after the greedy pieces before it are taken off, and adds how many those are, computed beforehand; each
character is read once and no piece is ever built. Words that a worker has counted it remembers.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import slices

#: Distinct words that a worker remembers.
REMEMBERED = 400_000
#: Failure: no greedy piece can be taken off.
STUCK = -1
#: What a word begins with in the vocabulary.
MARK = "▁"


class Automaton:
    """count(word): how many pieces greedy longest match cuts a word into; 1 (one unknown piece) where it cannot."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # 0: before a word, 1: after a piece
        whole = [False, False]
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.edges[at]:
                        self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        whole.append(False)
                    at = self.edges[at][c]
                whole[at] = whole[at] or at > 1
        self.fail, self.popped = [STUCK] * len(self.edges), [0] * len(self.edges)
        queue = deque((child, c, root) for root in (0, 1) for c, child in self.edges[root].items())
        while queue:  # by depth, so that links of shorter strings are there
            at, c, parent = queue.popleft()
            if whole[at]:
                self.fail[at], self.popped[at] = 1, 1
            else:
                z, n = self.fail[parent], self.popped[parent]
                while z != STUCK and c not in self.edges[z]:
                    z, n = self.fail[z], n + self.popped[z]
                if z != STUCK:
                    self.fail[at], self.popped[at] = self.edges[z][c], n
            queue.extend((child, d, at) for d, child in self.edges[at].items())

    def count(self, word: str) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        at, n = 0, 0
        for c in word:
            while c not in edges[at]:
                n += popped[at]
                at = fail[at]
                if at == STUCK:
                    return 1
            at = edges[at][c]
        while at != 1:  # take off what is left
            n += popped[at]
            at = fail[at]
            if at == STUCK:
                return 1
        return n


class Counter(dict):
    """Counts of words, each counted when it first appears."""

    def __init__(self, automaton: Automaton, mark: str = MARK):
        super().__init__()
        self.count, self.mark = automaton.count, mark

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.count(self.mark + word.decode())
        return n


def piece_vocabulary(path: str, mark: str = MARK) -> tuple[list[str], list[str]]:
    """(initial, continuing) pieces of a sentencepiece model: those that begin with the mark of a word's start, and the others."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p for p in pieces if p.startswith(mark)], [p for p in pieces if not p.startswith(mark)]


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary file, kept for its next tasks."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(Automaton(*piece_vocabulary(path)))
    if len(_counters[path]) > REMEMBERED:
        _counters[path].clear()
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of docs (doc_id, text; other columns are ignored).

    Words are runs of characters other than space and U+0009 to U+000D of the whole text; n_tokens adds up each word's number of
    greedy longest-match pieces, 1 for a word that the vocabulary cannot cover. A null or empty text has none. A null doc_id stays null;
    repeated rows stay repeated; an empty table gives no rows.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = counter(vocabulary)
            words = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.array([sum(map(known.__getitem__, w)) for w in words], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, "doc_id bigint, n_words bigint, n_tokens bigint")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pieces of every document."""
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
