"""Problem 3: train, validation and test splits that keep related records together.

Components, their weights, then largest differencing over many equal bins, then whole bins to
splits.  K components of one weight, one to each of K bins, have no difference, so the
executors deal full rounds of K components of (nearly) one weight, and sum what each bin got.  Only the rest of each range
of weights, fewer than K components, goes through the pairwise differencing on the driver, together
with the dealt bins as one partition of their own.  Weights below EXACT are a range each, above it there
are PER_OCTAVE ranges to a factor of two: some 700 ranges at most, so the driver sees no more than these times K weights, however many rows or
different weights there are.
"""

from __future__ import annotations

import heapq
import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.operators.checkpoints import cut
from siftwork.operators.components import connected_components

DEFAULT = {"train": 0.8, "validation": 0.1, "test": 0.1}

#: Weights below it are a range of their own.
EXACT = 128
#: Ranges to a factor of two above.
PER_OCTAVE = 16
#: Components of a slice of a range, about.
SLICE = 500_000

#: The ways a thread's address is written, after the host.
_ADDRESS = (
    r"^(?:https?://)?(?:(?:www|m)\.)*([a-z0-9.-]+?)(?::\d+)?/"
    r"(?:temat/(\d+)|(?:[^?#]*-)?t(\d+)\.html|viewtopic\.php\?(?:[^#]*&)?t=(\d+)|forum\.php\?(?:[^#]*&)?id=(\d+))(?!\w)"
)
_HOST = r"^(?:https?://)?(?:(?:www|m)\.)*([a-z0-9.-]+?)(?::\d+)?(?:[/?#]|$)"


def _tidy(url):
    return F.replace(F.lower(F.trim(F.regexp_replace(url, r"\s+", " "))), F.lit("&amp;"), F.lit("&"))


def thread_of(url):
    """(host, thread_no) columns of an address; null where it leads to no thread."""
    u = _tidy(url)
    no = F.coalesce(*[F.try_to_number(F.nullif(F.regexp_extract(u, _ADDRESS, i), F.lit("")), F.lit("9" * 18)).cast("bigint") for i in (2, 3, 4, 5)])
    return F.nullif(F.regexp_extract(u, _ADDRESS, 1), F.lit("")), no


def host_of(url):
    return F.nullif(F.regexp_extract(_tidy(url), _HOST, 1), F.lit(""))


def sites(forum: DataFrame) -> DataFrame:
    """(host, site): the source under which the forum table files each host."""
    seen = forum.select(host_of(F.col("url")).alias("host"), F.col("source").alias("site")).where("host is not null and site is not null")
    return seen.groupBy("host", "site").count().groupBy("host").agg(F.max_by("site", F.struct("count", "site")).alias("site"))


def differencing(weights: list[int], bins: int, start: list[int] | None = None) -> list[int]:
    """Bin of each weight by the largest differencing method; the spread of the bins ends near its least.  ``start`` has what the bins hold already."""
    if not weights:
        return []
    order = itertools.count()
    # a partition is its bin sums in falling order, each with the tree of what is in it; a bin of the start is a negative leaf
    heap = [(-w, next(order), [(w, i)] + [(0, None)] * (bins - 1)) for i, w in enumerate(weights)]
    held = sorted(((w, -k - 1) for k, w in enumerate(start or [0] * bins)), key=lambda t: -t[0])
    heap.append((held[-1][0] - held[0][0], next(order), held))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = sorted(((x + y, p if q is None else q if p is None else (p, q)) for (x, p), (y, q) in zip(a, reversed(b), strict=True)), key=lambda t: -t[0])
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], next(order), merged))
    out = [0] * len(weights)
    for _, tree in heap[0][2]:
        leaves, stack = [], [tree]
        while stack:
            t = stack.pop()
            if isinstance(t, tuple):
                stack.extend(t)
            else:
                leaves.append(t)
        bin_ = next(-x - 1 for x in leaves if x < 0)
        for x in leaves:
            if x >= 0:
                out[x] = bin_
    return out


def weight_range(weight):
    """The range of a weight: itself below EXACT, then PER_OCTAVE to a factor of two."""
    return F.when(weight < EXACT, weight).otherwise(EXACT + F.floor(F.log2(weight / EXACT) * PER_OCTAVE)).cast("int")


def allot(sums: list[float], proportions: dict[str, float]) -> list[str]:
    """Whole bins to splits: the heaviest bin first, each to the split that lacks most of its target."""
    total, share = sum(sums), sum(proportions.values())
    lack = {k: total * v / share for k, v in proportions.items()}
    out = [""] * len(sums)
    for i in sorted(range(len(sums)), key=lambda i: (-sums[i], i)):
        best = max(lack, key=lambda k: (lack[k], proportions[k], k))
        out[i] = best
        lack[best] -= sums[i]
    return out


def component_keys(df: DataFrame, id_col: str, key_cols: list[str]) -> DataFrame:
    """The rows with ``split_key``: equal for rows tied by any chain of equal keys.  Null and empty keys tie nothing."""
    own = F.concat(F.lit("row:"), F.coalesce(F.col(id_col).cast("string"), F.sha2(F.to_json(F.struct(*df.columns)), 256)))
    keys = [F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in key_cols]
    if len(keys) == 1:
        return df.withColumn("split_key", F.coalesce(keys[0], own))
    first = df.withColumn("split_first", F.coalesce(*keys, own))
    edges = first.select(F.col("split_first").alias("a"), F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull())).alias("b"))
    found = connected_components(edges.distinct()).select(F.col("node").alias("split_first"), "component")
    return first.join(found, "split_first", "left").withColumn("split_key", F.coalesce("component", "split_first")).drop("component", "split_first")


def related_splits(df: DataFrame, id_col: str, key_cols: list[str], proportions: dict[str, float] | None = None, bins: int = 100, seed: int = 42, slice_rows: int = SLICE) -> DataFrame:
    """The rows with ``split``: one split for all rows tied by equal keys, sizes near ``proportions``.

    Rows whose keys are all null or empty stand alone by ``id_col`` (equal rows together where that is null too).
    Repeated rows stay and weigh as often as they stand.  No rows give no rows.  A component heavier than a split's
    target goes where most is lacking.  The names split, split_key and split_first are taken.
    """
    proportions = proportions or DEFAULT
    spark = df.sparkSession
    keyed = component_keys(df.drop("split"), id_col, key_cols)
    groups = cut(keyed.groupBy("split_key").agg(F.count("*").alias("weight")).withColumn("hash", F.xxhash64("split_key", F.lit(seed))).withColumn("range", weight_range(F.col("weight"))))
    counts = {r["range"]: r["n"] for r in groups.groupBy("range").agg(F.count("*").alias("n")).collect()}  # some 700 at most

    # where each slice of a range begins in the range's order; a slice is short enough for one window
    sliced = spark.createDataFrame([(r, -(-n // slice_rows), n // bins * bins) for r, n in counts.items()], "range int, slices int, full bigint")
    placed = groups.join(F.broadcast(sliced), "range").withColumn("slice", F.pmod("hash", F.col("slices")).cast("int"))
    cells = sorted(tuple(r) for r in placed.groupBy("range", "slice").count().collect())
    before, seen = [], dict.fromkeys(counts, 0)
    for r, k, n in cells:
        before.append((r, k, seen[r]))
        seen[r] += n
    begins = spark.createDataFrame(before, "range int, slice int, before bigint")
    order = Window.partitionBy("range", "slice").orderBy("hash", "split_key")
    at = F.col("before") + F.row_number().over(order) - 1
    dealt = cut(placed.join(F.broadcast(begins), ["range", "slice"]).select("split_key", "weight", "range", "full", at.alias("at")))

    full = F.col("at") < F.col("full")
    sums = [0] * bins
    for r in dealt.where(full).groupBy((F.col("at") % bins).alias("bin")).agg(F.sum("weight").alias("n")).collect():
        sums[r["bin"]] = r["n"]
    rest = sorted((tuple(r) for r in dealt.where(~full).select("range", "at", "weight").collect()), key=lambda t: (-t[2], t))  # fewer than bins a range
    where = differencing([w for _, _, w in rest], bins, sums)
    for (_, _, w), k in zip(rest, where, strict=True):
        sums[k] += w
    split_of = allot(sums, proportions)
    single = spark.createDataFrame([(r, a, split_of[k]) for (r, a, _), k in zip(rest, where, strict=True)], "range int, at bigint, rest string")
    names = F.array(*[F.lit(s) for s in split_of])
    split = F.when(full, F.element_at(names, (F.col("at") % bins + 1).cast("int"))).otherwise(F.col("rest"))
    known = dealt.join(F.broadcast(single), ["range", "at"], "left").select("split_key", split.alias("split"))
    return keyed.join(known, "split_key").drop("split_key")
