"""Problem 8: encoding of the whole corpus with a public byte-level BPE tokenizer.

Merging inside one pre-token uses a hierarchical-bitmap rank queue (``encode_piece``): every
merge rank that currently occurs has a bucket with the linked-list positions of its pairs; a
three-level bitmap over the ranks finds the lowest set rank by find-first-set, so each merge
costs a constant number of word operations however long the pre-token is; entries whose pair
has changed since are skipped when they come up.

Around it, each task keeps the ids of the pre-tokens and blank-separated chunks it has met,
as bytes, so a text is cut at its blanks, looked up and joined; the tokenizer's regular
expression runs only over chunks not met before.  Nothing is shuffled.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Chunks a task remembers; when full, it starts anew.
CACHE = 400_000
#: Fixed value: the public tokenizer's pre-token pattern.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PIECE = regex.compile(PATTERN)
#: A space before another blank, and a run of blanks; looked for apart, so that long runs cost no more than their length.
_AT_BLANKS = regex.compile(r" \s")
_BLANK = regex.compile(r"\s")
_BLANKS = regex.compile(r"\s+")


def default_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public vocabulary file on the driver: in the folder that SIFTWORK_TOKENIZERS names, or where the package that ships them has it, or in /opt/tokenizers."""
    if folder := os.environ.get("SIFTWORK_TOKENIZERS"):
        return f"{folder}/{name}"
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return f"/opt/tokenizers/{name}"


class Encoder:
    """ids of a text by a vocabulary of merge ranks."""

    def __init__(self, vocabulary: bytes):
        pairs = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.ranks.values()) + 1
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        """ids of one pre-token, by the bitmap rank queue."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        token = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        buckets: dict[int, list[int]] = {}
        low: dict[int, int] = {}  # bit r & 63 of word r >> 6: rank r has a bucket
        mid: dict[int, int] = {}  # bit w & 63 of word w >> 6: word w of low isn't empty
        top = 0  # bit m: word m of mid isn't empty
        wanted = [-1] * n  # the rank of the pair that begins here, -1 for none

        def push(at: int) -> None:
            nonlocal top
            after = right[at]
            rank = ranks.get(token[at] + token[after], -1) if after < n else -1
            wanted[at] = rank
            if rank < 0:
                return
            if rank in buckets:
                buckets[rank].append(at)
                return
            buckets[rank] = [at]
            word = rank >> 6
            low[word] = low.get(word, 0) | 1 << (rank & 63)
            mid[word >> 6] = mid.get(word >> 6, 0) | 1 << (word & 63)
            top |= 1 << (word >> 6)

        for i in range(n - 1):
            push(i)
        while top:
            m = (top & -top).bit_length() - 1
            word = m << 6 | (mid[m] & -mid[m]).bit_length() - 1
            rank = word << 6 | (low[word] & -low[word]).bit_length() - 1
            # pairs of one rank merge from left to right; a merge makes only higher ranks out of later positions or the same rank again, which is queued anew
            for at in sorted(buckets.pop(rank)):
                if wanted[at] != rank:
                    continue  # stale: the pair has changed since it was queued
                after = right[at]
                token[at] += token[after]
                token[after], wanted[after] = b"", -1
                right[at] = right[after]
                if right[at] < n:
                    left[right[at]] = at
                push(at)
                if left[at] >= 0:
                    push(left[at])
            if rank not in buckets:
                low[word] &= ~(1 << (rank & 63))
                if not low[word]:
                    mid[m] &= ~(1 << (word & 63))
                    if not mid[m]:
                        top &= ~(1 << m)
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i]])
            i = right[i]
        return out

    def _piece(self, piece: str) -> bytes:
        if (got := self.pieces.get(piece)) is None:
            got = np.array(self.encode_piece(piece.encode("utf-8", "replace")), np.int32).tobytes()
            if len(piece) < 64:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece, _PIECE.findall(text)))

    def encode_bytes(self, text: str) -> bytes:
        """ids as little-endian int32, one after another."""
        if not _AT_BLANKS.search(text):
            return self._chunks(text)
        # a run of blanks with a space before its end hangs together, but for its last blank
        out, begin, at = [], 0, 0
        while m := _AT_BLANKS.search(text, at):
            first = m.start()
            while first > begin and _BLANK.match(text, first - 1):
                first -= 1
            at = _BLANKS.match(text, m.start()).end()
            if first > begin:
                out.append(self._chunks(text[begin:first]))
            begin = at
            if begin == len(text):
                out.append(self._piece(text[first:at]))
                break
            out.append(self._piece(text[first : at - 1]))
            if text[at - 1] == " ":
                begin -= 1  # goes with what follows
            else:
                out.append(self._piece(text[at - 1]))
        if begin < len(text):
            out.append(self._chunks(text[begin:]))
        return b"".join(out)

    def _chunks(self, text: str) -> bytes:
        chunks = self.chunks
        first, *rest = text.split(" ")
        out = [self._pieces(first)]
        for c in rest:
            got = chunks.get(c)
            if got is None:
                got = self._pieces(" " + c)
                if len(c) < 64:
                    if len(chunks) >= CACHE:
                        chunks.clear()
                    chunks[c] = got
            out.append(got)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def count(self, text: str) -> int:
        return len(self.encode_bytes(text)) // 4


@lru_cache(maxsize=4)
def _encoder(vocabulary: bytes) -> Encoder:
    return Encoder(vocabulary)


def encoder(path: str) -> Encoder:
    return _encoder(Path(path).read_bytes())


def encode_corpus(df: DataFrame, text_col: str = "text", out_col: str = "ids", vocabulary_file: str | None = None) -> DataFrame:
    """The rows with ``out_col``, array<int>: the text's ids without special tokens.

    Null and empty texts get the empty array, so every row has ids and only they have none.
    Strings that look like special tokens are ordinary text.  Very long texts are encoded whole.
    Equal rows stay as many as they are; other columns pass through; a column of the name
    ``out_col`` is replaced.
    """
    path = vocabulary_file or default_vocabulary()
    source = df.drop(out_col) if out_col != text_col else df
    keep = [c for c in source.columns if c != out_col]
    schema = T.StructType([*[source.schema[c] for c in keep], T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    ask = source.select(*keep, F.col(text_col).alias("encode_text")) if text_col not in keep else source.select(*keep)
    at, carry = (ask.columns.index(text_col) if text_col in keep else len(keep)), len(keep)

    # the file, of a megabyte or so, goes to the workers, which need not have it
    shared = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for b in batches:
            got = [enc.encode_bytes(t) if t else b"" for t in b.column(at).to_pylist()]
            offsets = np.zeros(len(got) + 1, np.int32)
            np.cumsum([len(g) // 4 for g in got], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(got), np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[:carry], ids], names=[*keep, out_col])

    return ask.mapInArrow(run, schema)


def count_tokens(df: DataFrame, text_col: str = "text", out_col: str = "n_tokens", vocabulary_file: str | None = None) -> DataFrame:
    """The rows without the text, with its number of tokens (0 for null and empty)."""
    path = vocabulary_file or default_vocabulary()
    keep = [c for c in df.columns if c not in (text_col, out_col)]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out_col, T.LongType())])

    # the file, of a megabyte or so, goes to the workers, which need not have it
    shared = df.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for b in batches:
            n = pa.array([enc.count(t) if t else 0 for t in b.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], n], names=[*keep, out_col])

    return df.select(*keep, text_col).mapInArrow(run, schema)
