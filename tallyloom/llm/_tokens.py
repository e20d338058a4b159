"""Token ids of many texts with the tokenizers library, each distinct piece of text encoded once a worker."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

import numpy as np

#: The split pattern of the byte-level tokenizer for the characters that FOREIGN does not match.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
DIGIT = "0-9²³¹¼½¾"
SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^\t\n\r {LETTER}{DIGIT}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
#: Characters on which Unicode versions or definitions of white space could differ: such texts go to the library whole.
FOREIGN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]")
#: Distinct pieces that a worker remembers; about 170 bytes each.
REMEMBERED = 1_500_000


class Numbers(dict):
    """Gives each new piece the next number and lists it in new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        at = self[piece] = len(self)
        return at


class Pieces:
    """Ids of numbered pieces, one array for all, from which the ids of texts are gathered."""

    def __init__(self, dtype: np.dtype):
        self.number = Numbers()
        self.ids = np.empty(1 << 16, dtype=dtype)
        self.offsets = np.zeros(1 << 16, dtype=np.int64)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids of the pieces that were numbered last, and how many each has."""
        first, n = len(self.number) - len(counts), len(self.number)
        start = self.offsets[first]
        end = start + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(max(end, len(self.ids)), dtype=self.ids.dtype)])
        if n >= len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros(max(n, len(self.offsets)), dtype=np.int64)])
        self.ids[start:end] = ids
        self.offsets[first + 1 : n + 1] = start + np.cumsum(counts)
        self.number.new = []

    def gather(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """at: numbers of the pieces of all texts, counts: how many each text has. All ids, and n + 1 offsets of the texts."""
        sizes = self.offsets[at + 1] - self.offsets[at]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.offsets[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


class Encoder:
    """encode() gives the ids of texts as the library's encode(text, add_special_tokens=False) does.

    The library splits a text by a fixed pattern and merges bytes inside each piece only, so equal pieces have equal ids. Pieces
    are numbered as they appear; new ones are encoded by the library in one call; ids of a text are gathered by number.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.remembered = remembered
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() < 1 << 16 else np.dtype("<u4")
        self.pieces = Pieces(self.dtype)
        self.newline = self.whole("\n")

    def learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has."""
        if len(self.newline) != 1 or any(map(str.isspace, new)):
            encoding = self.library.encode(new, is_pretokenized=True, add_special_tokens=False)
            return np.array(encoding.ids, dtype=self.dtype), np.bincount(np.array(encoding.word_ids, dtype=np.int64), minlength=len(new))
        # as lines of one text, which is faster: a line feed between two pieces is always a piece of its own
        ids = np.array(self.library.encode_batch_fast(["\n".join(new)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends = np.flatnonzero(ids == self.newline[0])
        return ids[ids != self.newline[0]], np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and n + 1 offsets into them; null is empty."""
        if len(self.pieces.number) > self.remembered:
            self.pieces = Pieces(self.dtype)
        plain = [t if t and not FOREIGN.search(t) and not any(s in t for s in self.special) else "" for t in texts]
        split = [SPLIT.findall(t) for t in plain]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        number = self.pieces.number
        at = np.fromiter(map(number.__getitem__, itertools.chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
        if number.new:
            self.pieces.add(*self.learn(number.new))
        ids, offsets = self.pieces.gather(at, counts)
        other = [i for i, t in enumerate(texts) if t and not plain[i]]
        if other:
            parts = np.split(ids, offsets[1:-1])
            for i in other:
                parts[i] = self.whole(texts[i])
            ids, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, kept for its next tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
