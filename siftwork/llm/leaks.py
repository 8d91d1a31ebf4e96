"""Problem 2: evaluation texts leaking into training text.

A prefix-filtered set join.  A window of ``run`` words of an item is the set of its word shingles
(five words each); a text holds the window only if it holds all of them, so one of them, the
necessary prefix, is enough to find it.  Shingles are ordered by rarity: a first pass over all
texts counts those of the items.  Each window is filed under its rarest shingle, with the item's words around it.
A second pass sends every text's occurrences of such prefix shingles, with the words around them; the
two sides are joined on the shingle.  The join has the length and positional bounds (room for ``run`` words
around the shingle on both sides) and verifies by the words next to the shingle, in windows of ``run`` words, that they go on alike.

Both sides may be of any size: texts are scanned twice whatever the number of items, and what
leaves a scan is first looked up in a Bloom filter of the shingles asked for, whose size has a bound (BITS);
beyond it more false occurrences reach the join, which drops them.  Hot shingles: a window is filed under one only
where it has no rarer one, and the join's sides are plain tables that adaptive execution broadcasts or splits.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm import cleanup
from siftwork.operators.checkpoints import cut

SHINGLE = 5
#: Words whose hashes a task remembers; when full, it starts anew.
WORDS = 500_000
#: Bits of a Bloom filter: so many a shingle, and two to this power at most (16 MB, which are broadcast).
BITS_EACH, BITS = 32, 27
_SHIFTS = (0, 18, 37)

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.array([pow(int(_BASE), i, 1 << 64) for i in range(SHINGLE)], np.uint64)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each run of SHINGLE word hashes; 0 where one of them is 0, the mark between texts."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _powers()
    with np.errstate(over="ignore"):
        h = sum(words[i : i + n] * power[i] for i in range(SHINGLE))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    bad = words == 0
    if bad.any():
        seen = np.concatenate([[0], np.cumsum(bad)])
        h[seen[SHINGLE : SHINGLE + n] > seen[:n]] = 0
    return h


class WordHashes:
    """64-bit hashes of words, with a memory."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.new: list[int] = []
        self.known = np.zeros(0, np.uint64)

    def flat(self, columns: list[list[str | None]]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts of a batch, one after another with a 0 behind each, and where each text begins; the texts of a row follow each other."""
        if len(self.place) > WORDS:
            self.__init__()
        if not self.place:
            self.place[""] = 0  # the mark
            self.known = np.zeros(1, np.uint64)
        places: list[int] = []
        starts = []
        place = self.place
        for row in zip(*columns, strict=True):
            for t in row:
                starts.append(len(places))
                if t:
                    for w in cleanup.words(t):
                        k = place.get(w)
                        if k is None:
                            k = place[w] = len(place)
                            self.new.append(int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little") or 1)
                        places.append(k)
                places.append(0)
        starts.append(len(places))
        if self.new:
            self.known = np.concatenate([self.known, np.array(self.new, np.uint64)])
            self.new = []
        return self.known[np.array(places, np.int64)], np.array(starts, np.int64)


class Bloom:
    """A filter of shingle hashes, made on the executors; a false answer has a chance below one in a thousand while BITS suffice."""

    def __init__(self, hashes: DataFrame):
        n = hashes.count()
        self.bits = 1 << min(BITS, max(12, (BITS_EACH * n).bit_length()))
        at = F.explode(F.array(*[F.expr(f"shiftrightunsigned(h, {s}) & {self.bits - 1}L") for s in _SHIFTS])).alias("at")
        cells = hashes.select(at).select(F.expr("shiftright(at, 6)").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
        self.words = np.zeros(self.bits // 64, np.uint64)
        self.words[cells["word"].to_numpy()] = cells["bit"].to_numpy().view(np.uint64)

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that are in it, or seem so; never of 0."""
        at = np.flatnonzero(h)
        for s in _SHIFTS:
            bit = (h[at] >> np.uint64(s)) & np.uint64(self.bits - 1)
            at = at[(self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return at


def _fields(benchmark: DataFrame, key_col: str, text_cols: list[str], run: int) -> DataFrame:
    """(item, field, words): the items' fields of at least ``run`` words, as word hashes; equal ones of an item once."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        width = len(text_cols)
        for b in batches:
            flat, starts = words.flat([c.to_pylist() for c in b.columns[1:]])
            some = np.flatnonzero(np.diff(starts) - 1 >= run)
            out = [flat[starts[k] : starts[k + 1] - 1].view(np.int64) for k in some]
            names = [int.from_bytes(hashlib.blake2b(w.tobytes(), digest_size=8).digest(), "little", signed=True) for w in out]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some // width)), pa.array(names, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["item", "field", "words"])

    asked = benchmark.where(F.col(key_col).isNotNull()).select(F.col(key_col).cast("bigint").alias("item"), *text_cols)
    return asked.mapInArrow(hashed, "item bigint, field bigint, words array<bigint>").dropDuplicates(["item", "field"])


def _shingles(fields: DataFrame) -> DataFrame:
    """(h, item, field, at) of every shingle of the fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, field, words in zip(*[c.to_pylist() for c in b.columns], strict=True):
                h = shingle_hashes(np.array(words, np.int64).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), item)), pa.array(np.full(len(h), field)), pa.array(np.arange(len(h), dtype=np.int32))], names=["h", "item", "field", "at"])

    return fields.mapInArrow(run, "h bigint, item bigint, field bigint, at int")


def shingle_counts(corpus: DataFrame, text_cols: list[str], bloom: Bloom) -> DataFrame:
    """(h, n): how often each shingle of the filter stands in the corpus, over all its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            h = shingle_hashes(words.flat([c.to_pylist() for c in b.columns])[0])
            found, n = np.unique(h[bloom.hits(h)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return corpus.select(*text_cols).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _around(words: np.ndarray, begin: int, stop: int, p: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """The words before the shingle at p, from it outwards, and those behind it, as far as a window of ``run`` words with the shingle goes."""
    reach = run - SHINGLE
    return words[max(begin, p - reach) : p][::-1].view(np.int64), words[p + SHINGLE : min(stop, p + run)].view(np.int64)


def prefixes(fields: DataFrame, counts: DataFrame, run: int) -> DataFrame:
    """(h, item, item_left, item_right): the rarest shingle of every window of the fields, with the words around it."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
            for item, words, counted in zip(*[b.column(c).to_pylist() for c in ("item", "words", "counted")], strict=True):
                own = np.array(words, np.int64).view(np.uint64)
                h = shingle_hashes(own)
                n = np.array([c["n"] for c in sorted(counted, key=lambda c: c["at"])], np.int64)
                rank = np.empty(len(h), np.int64)
                rank[np.lexsort((np.arange(len(h)), h, n))] = np.arange(len(h))
                first = np.lib.stride_tricks.sliding_window_view(rank, run - SHINGLE + 1).argmin(1) + np.arange(len(own) - run + 1)
                out += [(int(h[q].view(np.int64)), item, *_around(own, 0, len(own), q, run)) for q in np.unique(first).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ([],) * 4, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)], names=["h", "item", "item_left", "item_right"])

    counted = _shingles(fields).join(counts, "h", "left").groupBy("item", "field").agg(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"))).alias("counted"))
    return fields.join(counted, ["item", "field"]).select("item", "words", "counted").mapInArrow(rarest, "h bigint, item bigint, item_left array<bigint>, item_right array<bigint>")


def occurrences(corpus: DataFrame, text_cols: list[str], bloom: Bloom, run: int) -> DataFrame:
    """(h, id, left, right): where shingles of the filter stand in a text that has room for ``run`` words around them, with the words there."""
    reach = run - SHINGLE
    width = len(text_cols)
    words_type = pa.list_(pa.int64())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            flat, starts = words.flat([c.to_pylist() for c in b.columns[1:]])
            h = shingle_hashes(flat)
            at = bloom.hits(h)
            text = np.searchsorted(starts, at, side="right") - 1
            begin, stop = starts[text], starts[text + 1] - 1
            room = np.minimum(at - begin, reach) + np.minimum(stop - at, run) >= run
            at, text, begin, stop = at[room], text[room], begin[room], stop[room]
            around = [_around(flat, int(x), int(y), int(p), run) for p, x, y in zip(at, begin, stop, strict=True)]
            rows = pa.array((text // width).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), b.column(0).take(rows), pa.array([x for x, _ in around], words_type), pa.array([y for _, y in around], words_type)], names=["h", "id", "left", "right"])

    return corpus.select("id", *text_cols).mapInArrow(find, "h bigint, id bigint, left array<bigint>, right array<bigint>")


def _alike(x: Column, y: Column) -> Column:
    """How many words two lists have in common before they differ or one ends."""
    differ = F.array_position(F.zip_with(x, y, lambda a, b: a != b), F.lit(True))
    return F.when(differ == 0, F.least(F.size(x), F.size(y))).otherwise(differ - 1)


def leaked(corpus: DataFrame, id_col: str, text_cols: list[str], benchmark: DataFrame, key_col: str, item_cols: list[str], run: int = 13) -> DataFrame:
    """(id, item): records of which a text holds at least ``run`` words in a row that stand in a row in a field of the item.

    Words are those of cleanup.words; a run does not leave its field on either side.  Null and
    empty texts hold nothing, items shorter than ``run`` words leak nowhere, rows without id are
    left out, repeated rows count once, and an empty side gives no rows.  Ids are whole numbers; ``run`` is at least SHINGLE.
    """
    given = corpus.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), *[F.col(c).alias(f"leak_text{i}") for i, c in enumerate(text_cols)])
    texts = given.columns[1:]
    fields = cut(_fields(benchmark, key_col, item_cols, run))
    if fields.isEmpty():
        return corpus.sparkSession.createDataFrame([], T.StructType([T.StructField("id", T.LongType()), T.StructField("item", T.LongType())]))
    counts = shingle_counts(given, texts, Bloom(_shingles(fields).select("h").distinct()))
    filed = cut(prefixes(fields, counts, run))
    found = occurrences(given, texts, Bloom(filed.select("h").distinct()), run)
    least = F.least(F.size("left"), F.size("item_left")) + F.least(F.size("right"), F.size("item_right")) + SHINGLE
    same = _alike(F.col("left"), F.col("item_left")) + _alike(F.col("right"), F.col("item_right")) + SHINGLE
    return found.join(filed, "h").where((least >= run) & (same >= run)).select("id", "item").distinct()
