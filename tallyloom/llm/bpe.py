"""BPE encoding with forced boundaries, and decoding (operator 9).

A pair of bytes that stand side by side in no vocabulary token can never be merged over: wherever a word has such a pair it is cut, the fragments
are encoded each for itself, and their ids follow one another. Fragments recur far more often than words, so a worker keeps what it has encoded.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import slices
from ._tokens import DIGIT, FOREIGN, LETTER, Pieces

#: The tokenizer's split pattern for characters that FOREIGN does not match, after lower-casing.
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\t\n\r {LETTER}{DIGIT}]+")
#: Distinct words and fragments that a worker remembers.
REMEMBERED = 400_000


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    more = itertools.count(256)
    return [chr(b) if b in set(own) else chr(next(more)) for b in range(256)]


class Bpe:
    """encode() gives the ids of whole texts as the library's encode(text, add_special_tokens=False), decode() its decode(ids)."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.vocabulary, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")" if self.special else r"(?!)")
        size = max([*self.vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*self.vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token
        self.characters = byte_characters()
        together = set()  # neighbours inside any token
        for token in self.vocabulary:
            token = token.removesuffix(self.end)
            together.update(zip(token, token[1:]))
        self.together, self.remembered = together, remembered
        self.forget()

    def forget(self) -> None:
        self.pieces, self.fragments = Pieces(np.dtype(np.int32)), {}

    def merge(self, fragment: str, last: bool) -> list[int]:
        """Ids of one fragment by merging the pair of lowest rank, the leftmost first; last: it ends its word."""
        symbols = [*fragment[:-1], fragment[-1] + self.end * last]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbols[i] != pair[0] or symbols[j] != pair[1]:
                continue
            symbols[i], symbols[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (symbols[a], symbols[b])) in ranks:
                    heapq.heappush(heap, (ranks[p], a, p))
        return [self.vocabulary[s] for s in symbols if s is not None]

    def cut(self, word: str) -> list[str]:
        """A word, in the vocabulary's characters, cut at its forced boundaries."""
        at = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.together]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])]

    def learn(self) -> None:
        """Ids of the words that were numbered last."""
        out: list[int] = []
        counts = []
        for word in self.pieces.number.new:
            before = len(out)
            if word in self.special:
                out.append(self.special[word])
            else:
                fragments = self.cut("".join([self.characters[b] for b in word.encode()]))
                for i, fragment in enumerate(fragments, 1):
                    key = (fragment, i == len(fragments))
                    if key not in self.fragments:
                        self.fragments[key] = self.merge(*key)
                    out += self.fragments[key]
            counts.append(len(out) - before)
        self.pieces.add(np.array(out, dtype=np.int32), np.array(counts, dtype=np.int64))

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised as the tokenizer does; by the library where Unicode versions could matter."""
        if not FOREIGN.search(text):
            return SPLIT.findall(text.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        back = {c: b for b, c in enumerate(self.characters)}
        return [bytes(back[c] for c in piece).decode() for piece, _ in pieces]

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and n + 1 offsets into them; null is empty."""
        if max(len(self.pieces.number), len(self.fragments)) > self.remembered:
            self.forget()
        runs = []  # the words of each text; a special token is a word that no other text gives
        for text in texts:
            if text and any(s in text for s in self.special):
                runs.append([w for piece in self.parts.split(text) if piece for w in ([piece] if piece in self.special else self.split(piece))])
            else:
                runs.append(self.split(text or ""))
        counts = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        at = np.fromiter(map(self.pieces.number.__getitem__, itertools.chain.from_iterable(runs)), dtype=np.int64, count=int(counts.sum()))
        if self.pieces.number.new:
            self.learn()
        return self.pieces.gather(at, counts)

    def decode(self, ids: Sequence[int]) -> str:
        """The tokenizer has no decoder: its tokens joined by one space."""
        return " ".join([self.tokens[i] for i in ids])


_codecs: dict[str, Bpe] = {}


def codec(path: str) -> Bpe:
    """The worker's codec for a vocabulary file, kept for its next tasks."""
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = Bpe(path)
    return _codecs[path]


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row of docs (doc_id, text; other columns are ignored).

    ids: of the whole text; a null or empty text, and one of white space alone, has none, and decoded is then empty. Special tokens written out in a text
    have their own ids, as in the library. A null doc_id stays null; repeated rows stay repeated; an empty table gives no rows.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in slices(batches):
            ids, offsets = c.encode(batch.column("text").to_pylist())
            decoded = [c.decode(part.tolist()) for part in np.split(ids, offsets[1:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(each, "doc_id bigint, ids array<int>, decoded string")


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents encoded and decoded: number of ids, and digests of ids and of decoded texts."""
    import public_tokenizers

    coded = encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
