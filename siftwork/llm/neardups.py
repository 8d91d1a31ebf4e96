"""Problem 1: near-duplicate records with small edits, by a chosen-path set-similarity join.

A record is the set of its words.  Equal sets are one class from the start.  A run starts with all
sets in one node and splits recursively on sampled shared words: a node draws random orders of
all words, each set goes to the child named by its first word in an order, and two sets of similarity s
share a child of one order with probability s.  The root draws one order, every other node one or more, 1 / threshold on
average, so a pair at the threshold stays in one child on average (its chance to be still together
after k levels falls like 1 / k, not exponentially).  A node of at most ``limit`` sets (twice as many on each further level) is brute-forced.  Nodes draw
their orders independently of each other and of other runs, and runs repeat until a pair at the
threshold has met with probability ``recall``, counted for the deepest level any node came to and with what the sketch loses.

A node whose members are alike all over, by a sum over all of them, is not made smaller by splits: it is compared whole,
by wider sketches, in pairs of blocks spread over the cluster, and so is what ``max_depth`` levels could not split, and a leaf in which the rows' own sketches tell too few pairs apart.  No pair is lost to a cap.

Hot nodes never meet in one task.  Before anything is shuffled, each level's nodes are counted (partial counts are combined in the map); those with more than a
CELLS-th of the level's rows, at most CELLS of them, are known to all tasks, which take their members on to the next
level where they stand.  What is shuffled to a node, once a run, has below a CELLS-th of the rows.  Nodes between
``limit`` and that are split by another shuffle of their members alone.

Candidates pass two sketches that travel with the rows: a 128-bit odd sketch, whose differing bits are a
lower bound of the differing words, so it loses nothing, and 64 two-bit min-hashes, for long texts.  Then
they are compared exactly, by their words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm import cleanup
from siftwork.operators.checkpoints import cut
from siftwork.operators.components import connected_components

#: Two-bit parts of the min-hash sketch, in two words.
SKETCH = 64
#: Nodes of a level that all tasks know, at most: 8 bytes each are broadcast.
CELLS = 16_384
#: Rows a task gathers before it compares them.
CHUNK = 120_000
#: Rows of a block of a node that is compared whole.
BLOCK = 16_384
#: Pairs a member that the sketches of a leaf may let through; a leaf with more is compared whole, by wider sketches.
CROWDED = 8
#: Rows that are compared at a time with all others of a node.
ROWS = 32
#: Words whose hashes a task remembers; when full, it starts anew.
WORDS = 500_000
#: A node is compared whole where its members' mean similarity is above this share of the threshold.
ALIKE = 0.9
#: Levels for which the first runs are counted; where nodes lie deeper, more runs follow.
FIRST = 2
#: Min-hashes by which the mean similarity is summed.
TOLD = 16

_TOLD_BITS = np.arange(0, 2 * TOLD, 2, dtype=np.uint64)

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M1
        x = (x ^ (x >> np.uint64(33))) * _M2
        return x ^ (x >> np.uint64(33))


def _sampled(words: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The word of each set that comes first in an order (one for all, or one for each word), as its place in it."""
    with np.errstate(over="ignore"):
        x = words * a + b
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(12)
    return np.minimum.reduceat(x, starts)


def sketch_bound(recall: float, threshold: float) -> tuple[int, float]:
    """Parts of a sketch that a candidate must agree in, and the share of pairs at the threshold that this loses, at most half of what ``recall`` allows."""
    agree, least, lost = threshold + (1 - threshold) / 4, 0, 0.0
    while (p := math.comb(SKETCH, least) * agree**least * (1 - agree) ** (SKETCH - least)) + lost <= (1 - recall) / 2:
        least, lost = least + 1, lost + p
    return least, lost


def met(threshold: float, depth: int) -> float:
    """Chance that one run brings a pair at the threshold into one node of level ``depth``."""
    few, more = int(1 / threshold), 1 / threshold - int(1 / threshold)
    kept = 1.0
    for _ in range(depth - 1):
        apart = 1 - threshold * kept
        kept = 1 - ((1 - more) * apart**few + more * apart ** (few + 1))
    return threshold * kept


def runs_for(recall: float, threshold: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, if no node lies deeper than ``depth``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met(threshold, depth))))


def limit_at(limit: int, level: int) -> int:
    """Sets of a node of a level that is brute-forced: twice as many a level, as each level asks for more runs of all; 16 times at most."""
    return limit << min(level - 1, 4)


def word_sets(df: DataFrame, min_words: int) -> DataFrame:
    """(field, id, sig, words) of texts with at least ``min_words`` distinct words; words as sorted 32-bit hashes, sig a hash of field and set.

    Two words of a pair of records share a hash with a probability below one in a million.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in batches:
            rows, sigs, out = [], [], []
            if len(known) > WORDS:
                known.clear()
            for i, (field, text) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
                found = set(cleanup.words(text))
                if len(found) < min_words:
                    continue
                hashes = []
                for w in found:
                    if (h := known.get(w)) is None:
                        h = known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=4).digest(), "little")
                    hashes.append(h)
                got = np.sort(np.array(hashes, np.uint32))
                rows.append(i)
                out.append(got)
                sigs.append(int.from_bytes(hashlib.blake2b(got.tobytes(), digest_size=8, key=field.encode()).digest(), "little", signed=True))
            take = pa.array(rows, pa.int64())
            offsets = np.zeros(len(out) + 1, np.int32)
            np.cumsum([len(o) for o in out], out=offsets[1:])
            flat = np.concatenate(out).view(np.int32) if out else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(sigs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["field", "id", "sig", "words"])

    return df.select("field", "id", "text").mapInArrow(run, "field string, id bigint, sig bigint, words array<int>")


def _arrays(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    col = b.column(name)
    offsets = col.offsets.to_numpy()
    return col.values.to_numpy().view(np.uint32)[offsets[0] : offsets[-1]], (offsets[:-1] - offsets[0]).astype(np.int64)


def _odd(words: np.ndarray, starts: np.ndarray, wide: int) -> list[np.ndarray]:
    """Odd sketches of ``wide`` words: each bit is the parity of the set's words that hash to it."""
    with np.errstate(over="ignore"):
        h = words * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(16)
    bit, at = np.uint64(1) << (h & np.uint32(63)).astype(np.uint64), (h >> np.uint32(6)) % np.uint32(wide)
    return [np.bitwise_xor.reduceat(np.where(at == k, bit, np.uint64(0)), starts) for k in range(wide)]


def with_sketches(sets: DataFrame, seed: int) -> DataFrame:
    """(sig, words, s0, s1, o0, o1, size): the sets with their min-hash sketch, odd sketch and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        a, b_ = rng.integers(0, 1 << 31, SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, SKETCH, dtype=np.uint32)
        for b in batches:
            if not b.num_rows:
                continue
            words, starts = _arrays(b, "words")
            sketch = np.zeros((2, b.num_rows), np.uint64)
            for i in range(SKETCH):
                sketch[i // 32] |= (_sampled(words, starts, a[i], b_[i]).astype(np.uint64) & np.uint64(3)) << np.uint64(2 * (i % 32))
            size = np.diff(np.append(starts, len(words))).astype(np.int32)
            columns = [pa.array(c.view(np.int64)) for c in (*sketch, *_odd(words, starts, 2))]
            yield pa.RecordBatch.from_arrays([b.column("sig"), b.column("words"), *columns, pa.array(size)], names=["sig", "words", "s0", "s1", "o0", "o1", "size"])

    return sets.select("sig", "words").mapInArrow(run, "sig bigint, words array<int>, s0 bigint, s1 bigint, o0 bigint, o1 bigint, size int")


def _in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among sorted ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def _root(run: int, seed: int) -> np.uint64:
    return _mix(np.array([(seed << 32) + run + 1], np.uint64))[0]


def _branches(keys: np.ndarray, threshold: float) -> np.ndarray:
    """How many orders each node draws: 1 / threshold on average."""
    few = int(1 / threshold)
    coin = (_mix(keys ^ _M1) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return few + (coin < 1 / threshold - few).astype(np.int64)


def _children(keys: np.ndarray, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, j: int) -> np.ndarray:
    """The child on branch j for each set in its node; words of the sets follow each other."""
    with np.errstate(over="ignore"):
        node = _mix(keys + np.uint64(j + 1))
        drawn = _mix(node ^ _M2)
        first = _sampled(words, starts, np.repeat(drawn.astype(np.uint32) | np.uint32(1), lengths), np.repeat((drawn >> np.uint64(32)).astype(np.uint32), lengths))
        return _mix(node * np.uint64(31) + first.astype(np.uint64))


@dataclass
class Tree:
    """What all tasks know of some runs: the hot nodes of each level, which are split where they stand, and those to compare whole."""

    runs: range
    threshold: float
    seed: int
    hot: list[np.ndarray] = field(default_factory=list)
    whole: list[np.ndarray] = field(default_factory=list)

    def descend(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, run: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(level, rows, nodes, hot): where the sets of a batch stand in a run, level by level, and which of these nodes are split further."""
        rows, level = np.arange(len(starts)), 1
        keys = np.full(len(starts), _root(run, self.seed), np.uint64)
        with np.errstate(over="ignore"):
            node = _mix(keys[:1] + np.uint64(1))
            drawn = _mix(node ^ _M2)[0]
            first = _sampled(words, starts, np.uint32(drawn & np.uint64(0xFFFFFFFF)) | np.uint32(1), np.uint32(drawn >> np.uint64(32)))
            keys = _mix(node * np.uint64(31) + first.astype(np.uint64))
        while True:
            hot = _in(keys, self.hot[level - 1]) if level <= len(self.hot) else np.zeros(len(keys), bool)
            yield level, rows, keys, hot
            rows, keys = rows[hot], keys[hot]
            if not len(rows):
                return
            several = _branches(keys, self.threshold)
            next_rows, next_keys = [], []
            for j in range(int(several.max())):
                some = several > j
                r, k = rows[some], keys[some]
                n = lengths[r]
                begins = np.cumsum(n) - n
                own = words[np.repeat(starts[r] - begins, n) + np.arange(n.sum())]
                next_rows.append(r)
                next_keys.append(_children(k, own, begins, n, j))
            rows, keys = np.concatenate(next_rows), np.concatenate(next_keys)
            level += 1


def _tallied(sets: DataFrame, tree: Tree, level: int) -> DataFrame:
    """(kind, key, n): sets in each node of a level (kind -1), and for the nodes above it, their number (kind TOLD) and how many have a one in each of TOLD min-hash bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words, starts = _arrays(b, "words")
            lengths = np.diff(np.append(starts, len(words)))
            s0 = b.column("s0").to_numpy().view(np.uint64)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for r in tree.runs:
                for at, rows, keys, hot in tree.descend(words, starts, lengths, r):
                    if at == level:
                        key, n = np.unique(keys, return_counts=True)
                        out.append((np.full(len(key), -1), key, n))
                    elif at == level - 1 and hot.any():
                        order = np.argsort(keys[hot])
                        own = keys[hot][order]
                        begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                        bits = (s0[rows[hot][order], None] >> _TOLD_BITS & np.uint64(1)).astype(np.int64)
                        sums = np.column_stack([np.add.reduceat(bits, begins, axis=0), np.diff(np.append(begins, len(own)))])
                        out.append((np.tile(np.arange(TOLD + 1), len(begins)), np.repeat(own[begins], TOLD + 1), sums.ravel()))
            if out:
                kind, key, n = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "key", "n"])

    counted = sets.select("words", "s0").mapInArrow(run, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _likeness(n, ones: list):
    """Mean similarity of a node's members over all pairs, from how many have a one in each min-hash bit (columns)."""
    agree = sum((one * one + (n - one) * (n - one)) / (n * n) for one in ones) / len(ones)
    return 2 * agree - 1


def _alike(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """As _likeness, for arrays."""
    n = n[:, None].astype(float)
    return 2 * ((ones * ones + (n - ones) * (n - ones)) / (n * n)).mean(1) - 1


def grown(sets: DataFrame, count: int, tree: Tree, limit: int, cells: int, max_depth: int) -> Tree:
    """The tree of ``count`` sets down to the level where no node is hot.

    One job a level; what comes to the driver are at most ``cells`` hot nodes of the level, and TOLD + 1 numbers for each of the level above.
    """
    total = count * len(tree.runs)
    while True:
        level = len(tree.hot) + 1
        bound = max(limit_at(limit, level), total // cells)
        found = _tallied(sets, tree, level).where((F.col("kind") >= 0) | (F.col("n") > bound)).toArrow()
        kind, key, n = found["kind"].to_numpy(), found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
        if level > 1:
            nodes = tree.hot[-1]
            told = np.zeros((len(nodes), TOLD + 1), np.int64)
            some = kind >= 0
            told[np.searchsorted(nodes, key[some]), kind[some]] = n[some]
            met_ = told[:, TOLD] > 0  # children of a node to compare whole are met by none
            nodes, told = nodes[met_], told[met_]
            whole = _alike(told[:, TOLD], told[:, :TOLD]) >= ALIKE * tree.threshold
            tree.whole[-1], tree.hot[-1] = nodes[whole], nodes[~whole]
            if whole.all():
                tree.hot.pop()
                return tree
        hot = np.sort(key[kind < 0])
        if not len(hot):
            return tree
        if level >= max_depth:
            tree.whole.append(hot)
            return tree
        total = int((n[kind < 0] * _branches(key[kind < 0], tree.threshold)).sum())
        tree.hot.append(hot)
        tree.whole.append(np.zeros(0, np.uint64))


_ROWS = "key bigint, sig bigint, s0 bigint, s1 bigint, o0 bigint, o1 bigint, size int"
_CARRIED = ("sig", "s0", "s1", "o0", "o1", "size")


def _leaves(sets: DataFrame, tree: Tree, whole: bool) -> DataFrame:
    """The sets in each node where their descent ends: those to shuffle, or those to compare whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            words, starts = _arrays(b, "words")
            lengths = np.diff(np.append(starts, len(words)))
            for r in tree.runs:
                for level, rows, keys, hot in tree.descend(words, starts, lengths, r):
                    entire = _in(keys, tree.whole[level - 1]) if level <= len(tree.whole) else np.zeros(len(keys), bool)
                    some = entire if whole else ~hot & ~entire
                    if some.any():
                        take = pa.array(rows[some])
                        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), *[b.column(c).take(take) for c in _CARRIED]], names=["key", *_CARRIED])

    return sets.select("words", *_CARRIED).mapInArrow(run, _ROWS)


def _next(heavy: DataFrame, threshold: float) -> DataFrame:
    """Members of nodes to split, with their words, one level further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("key").to_numpy().view(np.uint64)
            several = _branches(keys, threshold)
            for j in range(int(several.max())):
                some = b.filter(pa.array(several > j))
                words, starts = _arrays(some, "words")
                child = _children(keys[several > j], words, starts, np.diff(np.append(starts, len(words))), j)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *[some.column(c) for c in _CARRIED]], names=["key", *_CARRIED])

    return heavy.select("key", *_CARRIED, "words").mapInArrow(run, _ROWS)


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of a word's 32 two-bit parts agree."""
    d = x ^ y
    return 32 - np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555)).astype(np.int16)


@dataclass
class Filter:
    """Which pairs of rows can be close: by sizes, by odd sketches (without loss), by ``least`` agreeing min-hash parts."""

    threshold: float
    least: int

    def differing(self, sizes):
        """How many words of two sets may differ, given the sum of their sizes."""
        return sizes * ((1 - self.threshold) / (1 + self.threshold)) + 1e-6

    def passing(self, rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = rows["sig"][i] != rows["sig"][j]
        i, j = i[ok], j[ok]
        size = rows["size"]
        small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        apart = sum(np.bitwise_count(rows[o][i] ^ rows[o][j]).astype(np.int16) for o in rows if o[0] == "o")
        ok = (small >= self.threshold * large - 1e-9) & (apart <= self.differing(small + large))
        i, j = i[ok], j[ok]
        ok = _agreeing(rows["s0"][i], rows["s0"][j]) + _agreeing(rows["s1"][i], rows["s1"][j]) >= self.least
        return i[ok], j[ok]

    def pairs(self, rows: dict[str, np.ndarray], most_hits: float = math.inf, crowded: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(a, b), a < b, of all close pairs within the nodes of rows sorted by key and size, some at a time; nodes whose odd sketches let more than ``most_hits`` pairs a member through are left out and put into ``crowded``."""
        key, size, sig = rows["key"], rows["size"].astype(np.int64), rows["sig"]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(begins[1:], len(key))
        odd = [rows[f"o{k}"] for k in range(4) if f"o{k}" in rows]

        def kept(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            i, j = self.passing(rows, i, j)
            return np.minimum(sig[i], sig[j]), np.maximum(sig[i], sig[j])

        def joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            return kept(*(np.concatenate(c) for c in zip(*found, strict=True)))

        # small nodes: each row with the d-th after it, all nodes at once
        at, d = np.flatnonzero(np.repeat(ends - begins <= 64, ends - begins)), 1
        while True:
            at = at[at + d < len(key)]
            at = at[key[at] == key[at + d]]
            if not len(at):
                break
            hit = at[sum(np.bitwise_count(o[at] ^ o[at + d]) for o in odd) <= self.differing(size[at] + size[at + d])]
            yield kept(hit, hit + d)
            d += 1
        # large ones: some rows at a time with all after them that aren't too large for one of them
        for begin, end in zip(begins[ends - begins > 64].tolist(), ends[ends - begins > 64].tolist(), strict=True):
            own = size[begin:end]
            stops = begin + np.searchsorted(own, own / self.threshold + 1e-9, side="right")
            most = np.minimum(self.differing(own + own / self.threshold), 255).astype(np.uint8)
            found, held = [], 0
            step = max(2, min(ROWS, 65_536 // (end - begin)))
            for k in range(begin, end - 1, step):
                rows_ = slice(k, min(k + step, end))
                after = slice(k + 1, int(stops[rows_.stop - 1 - begin]))
                wide = after.stop - after.start
                if not wide:
                    continue
                count = np.bitwise_count(odd[0][rows_, None] ^ odd[0][None, after])
                for o in odd[1:]:
                    count += np.bitwise_count(o[rows_, None] ^ o[None, after])
                hit = np.flatnonzero(count <= most[rows_.start - begin : rows_.stop - begin, None])
                if not len(hit):
                    continue
                i, j = k + hit // wide, k + 1 + hit % wide
                found.append((i[j > i], j[j > i]))
                held += len(found[-1][0])
                if crowded is not None and held > most_hits * (end - begin):
                    crowded.append(int(key[begin]))
                    found = []
                    break
                if crowded is None and held > 200_000:
                    yield joined(found)
                    found, held = [], 0
            if found:
                yield joined(found)


def _rows(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {n: c.to_numpy().view(np.uint64) if n[0] in "so" and n not in ("sig", "size") else c.to_numpy() for n, c in zip(b.schema.names, b.columns, strict=True)}


def _joined(held: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([h[n] for h in held]) for n in held[0]}


def _part(rows: dict[str, np.ndarray], which) -> dict[str, np.ndarray]:
    return {n: c[which] for n, c in rows.items()}


def _together(pairs: Iterator[tuple[np.ndarray, np.ndarray]], least: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, in parts of some size."""
    held, n = [], 0
    for a, b in pairs:
        held.append((a, b))
        n += len(a)
        if n >= least:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), *[none] * 4, pa.nulls(len(a), pa.int32())], names=["key", "sig", "b", "s0", "s1", "o0", "o1", "size"])


def _bucketed(rows: DataFrame, limit: int, check: Filter) -> DataFrame:
    """Sends nodes together; candidates (sig, b; no key) of those within ``limit``, the members of larger ones (no b) and of crowded ones (b is 0) as they are."""

    def handle(part: dict[str, np.ndarray], open_key: int | None) -> Iterator[pa.RecordBatch]:
        key = part["key"]
        if not len(key):
            return
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begins, len(key)))
        large = size > limit
        large[0] |= open_key is not None and int(key[0]) == open_key  # the node began in an earlier chunk
        split = np.repeat(large, size)
        crowded: list[int] = []
        for a, b in _together(check.pairs(_part(part, ~split), CROWDED, crowded)):
            yield _pair_batch(a, b)
        whole = np.isin(key, np.array(crowded, key.dtype))
        if split.any() or whole.any():
            some = _part(part, split | whole)
            n = len(some["key"])
            yield pa.RecordBatch.from_arrays([pa.array(some["key"]), pa.array(some["sig"]), pa.array(np.zeros(n, np.int64), mask=split[split | whole]), *[pa.array(some[c].view(np.int64)) for c in ("s0", "s1", "o0", "o1")], pa.array(some["size"])], names=["key", "sig", "b", "s0", "s1", "o0", "o1", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n, open_key = 0, None
        for b in batches:
            held.append(_rows(b))
            n += b.num_rows
            if n < CHUNK:
                continue
            part = _joined(held)
            key = part["key"]
            last = int(np.searchsorted(key, key[-1]))
            # an open node that is large already goes on as it is, and its rest follows in later chunks
            whole = n - last > limit or int(key[-1]) == open_key
            stop = n if whole else last
            yield from handle(_part(part, slice(stop)), open_key)
            open_key = int(key[-1]) if whole else None
            held, n = [_part(part, slice(stop, None))], n - stop
        if n:
            yield from handle(_joined(held), open_key)

    schema = "key bigint, sig bigint, b bigint, s0 bigint, s1 bigint, o0 bigint, o1 bigint, size int"
    return rows.repartition("key").sortWithinPartitions("key", "size").mapInArrow(run, schema)


#: Words of the odd sketch by which nodes are compared whole.
WIDE = 8


def _whole(members: DataFrame, sets: DataFrame, block: int, check: Filter) -> DataFrame:
    """Candidates of whole nodes (key, sig): each is cut into blocks, and each pair of blocks is one group.  Odd sketches of 512 bits let hardly any other than the true pairs through."""

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                wide = np.stack(_odd(*_arrays(b, "words"), WIDE), axis=1).tobytes()
                offsets = pa.py_buffer(np.arange(0, (b.num_rows + 1) * WIDE * 8, WIDE * 8, dtype=np.int32).tobytes())
                odd = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, offsets, pa.py_buffer(wide)])
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("key", "sig", "s0", "s1", "size")], odd], names=["key", "sig", "s0", "s1", "size", "odd"])

    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    with_words = members.select("key", "sig").join(sets.select("sig", "s0", "s1", "size", "words"), "sig")
    wide = with_words.mapInArrow(widened, "key bigint, sig bigint, s0 bigint, s1 bigint, size int, odd binary").join(sizes, "key")
    placed = wide.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = placed.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "sig", "s0", "s1", "size", "odd")

    def rows_of(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = _rows(b.drop_columns(["odd"]))
        col = b.column("odd")
        offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
        odd = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(np.uint64).reshape(-1, WIDE)
        return out | {f"o{k}": np.ascontiguousarray(odd[:, k]) for k in range(WIDE)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(rows_of(b))
            n += b.num_rows
            if n >= CHUNK:
                part = _joined(held)
                if last := int(np.searchsorted(part["key"], part["key"][-1])):
                    yield from (_two(a, b) for a, b in _together(check.pairs(_part(part, slice(last)))))
                held, n = [_part(part, slice(last, None))], n - last
        if n:
            yield from (_two(a, b) for a, b in _together(check.pairs(_joined(held))))

    return cells.repartition("key").sortWithinPartitions("key", "size").mapInArrow(run, "a bigint, b bigint")


def _two(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _met_in(sets: DataFrame, count: int, runs: range, check: Filter, limit: int, cells: int, block: int, max_depth: int, seed: int) -> tuple[list[DataFrame], int]:
    """Candidates (a, b) of some runs, and the deepest level of their nodes."""
    tree = grown(sets, count, Tree(runs, check.threshold, seed), limit, cells, max_depth)
    depth = len(tree.hot) + 1
    out = [_whole(_leaves(sets, tree, whole=True), sets, block, check)] if any(map(len, tree.whole)) else []
    rows = _leaves(sets, tree, whole=False)
    while True:
        found = cut(_bucketed(rows, limit_at(limit, depth), check))
        out.append(found.where("key is null").select(F.col("sig").alias("a"), "b"))
        crowded = found.where("key is not null and b is not null")
        if not crowded.isEmpty():
            out.append(_whole(crowded, sets, block, check))
        heavy = found.where("key is not null and b is null")
        if heavy.isEmpty():
            return out, depth
        ones = [F.sum(F.shiftrightunsigned("s0", 2 * i).bitwiseAND(F.lit(1))).cast("double") for i in range(TOLD)]
        entire = heavy.groupBy("key").agg(_likeness(F.count("*").cast("double"), ones).alias("alike")).where((F.col("alike") >= ALIKE * check.threshold) | F.lit(depth >= max_depth)).select("key")
        entire = cut(entire)
        if not entire.isEmpty():
            out.append(_whole(heavy.join(entire, "key", "left_semi"), sets, block, check))
        if depth >= max_depth:
            return out, depth
        rows = _next(heavy.join(entire, "key", "left_anti").join(sets.select("sig", "words"), "sig"), check.threshold)
        depth += 1


def similar_sets(raw: DataFrame, threshold: float = 0.7, recall: float = 0.995, limit: int = 4000, max_depth: int = 30, seed: int = 7, cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity) of different sets, a < b by sig, of ``raw`` (columns sig, words, kept where it can be read twice)."""
    sets = cut(with_sketches(raw.select("sig", "words").dropDuplicates(["sig"]), seed))
    least, lost = sketch_bound(recall, threshold)
    check = Filter(threshold, least)
    count = sets.count()
    done, depth, candidates = 0, FIRST, []
    while done < (need := runs_for(recall / (1 - lost), threshold, depth)):
        found, deepest = _met_in(sets, count, range(done, need), check, limit, cells, block, max_depth, seed)
        candidates += found
        done, depth = need, max(depth, deepest)
    pairs = candidates[0]
    for c in candidates[1:]:
        pairs = pairs.unionByName(c)
    pairs = pairs.distinct()
    one = sets.select(F.col("sig").alias("a"), F.col("words").alias("wa"))
    two = sets.select(F.col("sig").alias("b"), F.col("words").alias("wb"))
    both = F.size(F.array_intersect("wa", "wb"))
    done_ = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("wa") + F.size("wb") - both).alias("either"))
    return done_.where(F.col("both") >= F.col("either") * F.lit(threshold) - 1e-9).select("a", "b", (F.col("both") / F.col("either")).alias("similarity"))


def near_duplicate_pairs(df: DataFrame, threshold: float = 0.7, min_words: int = 30, **how) -> DataFrame:
    """(field, id_a, id_b), id_a < id_b, of every two records of one field whose word sets have at least ``threshold`` of their union in common.

    ``df`` has field, id, text.  Texts with fewer than ``min_words`` distinct words (null and empty ones
    among them) are in no pair; a key that repeats with one text counts once; other columns
    don't matter; an empty table gives no pairs.  Equal sets pair with similarity 1.
    """
    raw = cut(word_sets(df.where("id is not null and text is not null and field is not null"), min_words))
    links = similar_sets(raw, threshold, **how).select("a", "b")
    members = raw.select("field", "id", "sig").distinct()
    one = members.select("field", F.col("id").alias("id_a"), F.col("sig").alias("a"))
    two = members.select(F.col("id").alias("id_b"), F.col("sig").alias("b"))
    across = links.join(one, "a").join(two, "b").select("field", "id_a", "id_b")
    shared = members.groupBy("sig").count().where("count > 1").select(F.col("sig").alias("a"), F.col("sig").alias("b"))
    within = shared.join(one, "a").join(two, "b").select("field", "id_a", "id_b").where("id_a < id_b")
    both = across.select("field", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).where("id_a < id_b")
    return both.unionByName(within)


def near_duplicate_groups(df: DataFrame, threshold: float = 0.7, min_words: int = 30, **how) -> DataFrame:
    """(field, id, group_id, links): every record with its group, the least id reachable by links, and its number of links to other texts (classes of equal sets count once)."""
    raw = cut(word_sets(df.where("id is not null and text is not null and field is not null"), min_words))
    links = cut(similar_sets(raw, threshold, **how).select("a", "b"))
    members = raw.select("field", "id", "sig").distinct()
    component = connected_components(links).select(F.col("node").alias("sig"), "component")
    degree = links.select(F.col("a").alias("sig")).unionByName(links.select(F.col("b").alias("sig"))).groupBy("sig").agg(F.count("*").alias("links"))
    of = members.join(component, "sig", "left").join(degree, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = of.groupBy("field", "component").agg(F.min("id").alias("group_id"))
    return of.join(least, ["field", "component"]).select("field", "id", "group_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
