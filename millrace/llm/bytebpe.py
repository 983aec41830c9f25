"""Byte-level BPE of a public vocabulary, in linear time.

Bytes become Latin-1 characters, so that an Aho-Corasick automaton over the
vocabulary finds the longest token at every place.  The encoder takes longest
tokens from left to right and steps back where two adjacent tokens could not
stand side by side in a BPE result; that question depends on the two tokens
only and is memoised.  The result is exactly that of applying the merges.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the pre-tokenisation of the byte_bpe_50k vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary lies unless a path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Encoded pieces that a worker remembers.
CACHE = 200_000
#: Texts whose parts are counted at once.
COUNTED = 1024
#: Longer pieces are encoded without being remembered.
CACHED_LENGTH = 40


def _ranges(kind: str) -> str:
    """The characters below U+10000 of a class of ``regex``, as ranges for ``re``."""
    plane = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    out: list[list[int]] = []
    for c in map(ord, regex.findall(kind, plane)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


@lru_cache(maxsize=1)
def _plane_pattern() -> re.Pattern[str]:
    """PATTERN for texts without characters from U+10000 on: the same classes as character sets, which ``re`` matches faster."""
    letter, number, blank = map(_ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(rf" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+")


class _Memo(dict):
    """Remembers what ``make`` says of a piece, unless the piece is long; emptied when full."""

    def __init__(self, make: Callable) -> None:
        self.make = make

    def __missing__(self, word: str):
        made = self.make(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.clear()
            self[word] = made
        return made


class ByteBpe:
    """Encoder for one vocabulary of ranks (``base64(token) rank`` lines)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.pattern = regex.compile(pattern)
        self.ids = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.size = {i: len(t) for i, t in self.tokens.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(t) for i, t in self.tokens.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for i in sorted(self.tokens):  # the parts of a token have smaller ids than it
            self._split(i)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.memo = _Memo(self._word)
        self.counts = _Memo(lambda word: len(self._word(word)))
        self.parts, self.heads = _Memo(self._part), _Memo(self.count)

    @classmethod
    def load(cls, path: str = VOCABULARY) -> ByteBpe:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return cls(ranks)

    def _shorter(self, token: str) -> int | None:
        """The longest token that is a proper prefix."""
        for end in range(len(token) - 1, 0, -1):
            if (i := self.ids.get(token[:end])) is not None:
                return i
        return None

    def _split(self, i: int) -> None:
        """Finds the two tokens whose merge makes token ``i``; itself twice where there are none (single bytes)."""
        token, first = self.tokens[i], self.shorter[i]
        self.halves[i] = (i, i)
        while first is not None:
            second = self.ids.get(token[self.size[first] :])
            if second is not None and first < i and second < i and self._beside(first, second):
                self.halves[i] = (first, second)
                self.merges[first, second] = i
                return
            first = self.shorter[first]

    def _beside(self, a: int, b: int) -> bool:
        """Whether BPE leaves the two tokens next to each other: undo their merges, latest first, and look whether an
        earlier merge across the border would have come before."""
        merges, halves, limit = self.merges, self.halves, 1 << 60
        while True:
            joined = merges.get((a, b))
            if joined is not None and joined < limit:
                return False
            left_first = a > b
            for left in (left_first, not left_first):
                if left:
                    limit, part = a, halves[a][1]
                    if part != a:
                        a = part
                        break
                else:
                    limit, part = b + 1, halves[b][0]
                    if part != b:
                        b = part
                        break
            else:
                return True

    def beside(self, a: int, b: int) -> bool:
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) >= CACHE:
                self.compatible.clear()
            known = self.compatible[a, b] = self._beside(a, b)
        return known

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece of Latin-1 text."""
        whole = self.ids.get(text)
        if whole is not None:
            return (whole,)
        n, size, shorter, compatible, longest_from = len(text), self.size, self.shorter, self.compatible, self.automaton.iter_long
        longest = {end + 1 - k: i for end, (k, i) in longest_from(text)}  # the longest token that starts at a place
        out: list[int] = []
        dead: set[int] = set()  # places from which no way leads to the end
        at, token = 0, longest[0]
        while at < n:
            nxt = at + size[token]
            fits = nxt not in dead
            if fits and out:
                fits = compatible.get((out[-1], token))
                if fits is None:
                    fits = self.beside(out[-1], token)
            if fits:
                out.append(token)
                at = nxt
                if at < n:
                    token = longest.get(at)
                    if token is None:
                        token = longest[at] = next(longest_from(text, at))[1][1]
            elif shorter[token] is not None:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
        return tuple(out)

    def _word(self, word: str) -> tuple[int, ...]:
        return self.piece(word.encode("utf-8", "replace").decode("latin-1"))

    def words(self, text: str) -> list[str]:
        """The pieces of the pre-tokenisation."""
        plane = self.pattern.pattern == PATTERN and (text.isascii() or max(text) < "\U00010000")
        return (_plane_pattern() if plane else self.pattern).findall(text)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; NULL and empty texts have none."""
        return list(chain.from_iterable(map(self.memo.__getitem__, self.words(text)))) if text else []

    def count(self, text: str | None) -> int:
        """Number of ids of a text."""
        return sum(map(self.counts.__getitem__, self.words(text))) if text else 0

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text.

        A single blank between other characters always begins a piece, so texts
        are cut there and different parts are counted once.  A text that has a
        blank at another place (at an end, beside another one or a line end) is
        counted by itself.
        """
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        parts = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), " ")
        coded = parts.flatten().dictionary_encode()
        ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        starts, ends = ends[:-1], ends[1:]
        if not len(starts):
            return np.zeros(0, np.int64)
        code, different = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        size = np.fromiter(map(self.parts.__getitem__, different), np.int64, len(different))[code]
        apart = np.logical_or.reduceat(size < 0, starts)
        out = np.add.reduceat(size, starts)
        # the first part has no blank before it
        heads = [different[k] for k in code[starts]]
        out += np.fromiter(map(self.heads.__getitem__, heads), np.int64, len(heads)) - size[starts]
        for k in np.flatnonzero(apart):
            out[k] = self.count(texts[int(k)].as_py())
        return out

    def _part(self, part: str) -> int:
        """Ids of a part behind its blank; -1 where that blank need not begin a piece."""
        return -1 if not part or part[0].isspace() or part[-1].isspace() else self.count(" " + part)

    def decode(self, ids: list[int]) -> str:
        return "".join(self.tokens[i] for i in ids).encode("latin-1").decode("utf-8")


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> ByteBpe:
    """The encoder of a worker process, built once."""
    return ByteBpe.load(path)


def token_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key, ids``: one row per document, whole texts, no shuffle.  NULL and empty texts have an empty list."""
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for start in range(0, len(batch), 256):  # small batches: lists of long texts take memory
                part = batch.slice(start, 256)
                ids = pa.array([bpe.encode(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens`` of each document."""
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            n = pa.array(np.concatenate([np.zeros(0, np.int64), *(bpe.count_all(batch.column(1).slice(k, COUNTED)) for k in range(0, len(batch), COUNTED))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=[key, "n_tokens"])

    return docs.select(key, text).mapInArrow(run, schema)
