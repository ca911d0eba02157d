"""Token ids of whole texts with a public vocabulary, each distinct piece between safe boundaries encoded once.

Texts are cut before single spaces, where both vocabularies below start a new piece whatever stands around it. Pieces
repeat, so a worker remembers their ids, in a memory of bounded size that lets go of pieces not seen for long. Texts in
which a cut would not be safe are encoded whole by the library.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterable, Iterator

GENERATION = 300_000  # pieces in each half of a worker's memory; only speed depends on it
BATCH_BYTES = 4_000_000  # texts that are looked up together
SPECIAL = "<|"  # special strings start so; texts that have it are not cut inside words
END_MARKS = ".,"

_READY: dict = {}


def load(path: str):
    """The library's tokenizer, one per worker, without threads of its own."""
    if path not in _READY:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _READY[path] = tokenizer
    return _READY[path]


def byte_batches(texts: Iterable[str], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Position of the first text and texts of about ``limit`` characters together; a longer text stands alone."""
    start, size, batch = 0, 0, []
    for i, text in enumerate(texts):
        if batch and size + len(text) > limit:
            yield start, batch
            start, size, batch = i, 0, []
        batch.append(text)
        size += len(text)
    if batch:
        yield start, batch


def space_cuts(text: str, limit: int) -> Iterator[str]:
    """Pieces of about ``limit`` characters between spaces; the space at each cut is left out."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


class Memory(dict):
    """Known values of pieces in two halves: when the newer is full it becomes the older, which is let go.

    A piece found in the older half moves to the newer, so frequent pieces stay and rare ones go. ``compute`` gives the
    value of a piece that is in neither.
    """

    def __init__(self, compute):
        super().__init__()
        self.before: dict = {}
        self.compute = compute

    def __missing__(self, piece: str):
        value = self.before.get(piece)
        if value is None:
            value = self.compute(piece)
        self[piece] = value
        return value

    def rotate(self) -> None:
        """Call between batches."""
        if len(self) > GENERATION:
            self.before = dict(self)
            self.clear()

    def recall(self, piece: str):
        value = self.get(piece)
        return self.before.get(piece) if value is None else value


class TokenCounter:
    """Numbers of tokens for a vocabulary that drops white space (word_bpe_49k.json)."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.memory = Memory(None)
        self.marks = {m: self._encode([m])[0] for m in END_MARKS}

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        """Counts of new words. A letter run and the mark after it are separate pieces, and A-Z count as a-z."""
        known = self.memory
        stems: dict[str, list[tuple[str, int]]] = {}
        for word in words:
            stem, extra = word, 0
            if word.isascii() and SPECIAL not in word:
                if word[-1:] in self.marks and word[:-1].isalpha():
                    stem, extra = word[:-1], self.marks[word[-1]]
                stem = stem.lower()
            n = known.recall(stem)
            if n is None:
                stems.setdefault(stem, []).append((word, extra))
            else:
                known[word] = n + extra
        for stem, n in zip(stems, self._encode(list(stems))):
            for word, extra in stems[stem]:
                known[word] = n + extra
            known[stem] = n

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out: list[int] = []
        for _, batch in byte_batches(texts):
            if len(batch[0]) > BATCH_BYTES:
                out.append(sum(sum(self._pieces([part])) for part in space_cuts(batch[0], BATCH_BYTES)))
            else:
                out += self._pieces(batch)
        return out

    def _pieces(self, batch: list[str]) -> list[int]:
        self.memory.rotate()
        get = self.memory.get
        found: list[tuple[int, list[str]]] = []
        for text in batch:
            words = text.split(" ")
            counts = list(map(get, words))
            unseen = [w for w, n in zip(words, counts) if n is None] if None in counts else []
            found.append((sum(filter(None, counts)), unseen))
        unseen = set().union(*[x for _, x in found])
        old = {w: n for w in unseen if (n := self.memory.before.get(w)) is not None}
        self.memory.update(old)
        unseen -= old.keys()
        if unseen:
            self._learn(unseen)
        return [n + sum(map(self.memory.__getitem__, rest)) for n, rest in found]


class UnsafeCut(Exception):
    """The text must be encoded whole."""


class TokenIds:
    """Token ids, as little-endian unsigned 32-bit numbers, for byte-level BPE.

    ``path`` is the library's file (byte_bpe_50k.json), ``ranks`` the same vocabulary as ranks (byte_bpe_50k.tiktoken).
    A piece without special strings has the same ids from either; ranks are faster piece by piece.
    """

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN

        self.tokenizer = load(path)
        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines]
        merges = {base64.b64decode(a): int(b) for a, b in pairs}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary
        self.inner = Memory(self._after_space)
        self.first = Memory(self._plain)

    def _plain(self, word: str) -> bytes:
        return array("I", self.encode(word)).tobytes()

    def _after_space(self, word: str) -> bytes:
        # A cut before a space is safe unless a blank follows, because runs of blanks are one piece.
        if not word or is_blank(word[0]):
            raise UnsafeCut
        return array("I", self.encode(" " + word)).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out = []
        for _, batch in byte_batches(texts):
            self.inner.rotate()
            self.first.rotate()
            out += map(self._text, batch)
        return out

    def _text(self, text: str) -> bytes:
        words = text.split(" ")
        try:
            if SPECIAL in text:
                raise UnsafeCut
            return self.first[words[0]] + b"".join(map(self.inner.__getitem__, words[1:]))
        except UnsafeCut:
            return self._whole(text)

    def _whole(self, text: str) -> bytes:
        if SPECIAL not in text:
            return array("I", self.encode(text)).tobytes()
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return array("I", found.ids).tobytes()


def is_blank(c: str) -> bool:
    """White space or a control character, by any library's reckoning."""
    return c.isspace() or c < "!" or c in "\x7f\x85\u180e\u200b\u2060\ufeff"
