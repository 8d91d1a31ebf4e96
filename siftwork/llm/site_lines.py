"""Problem 4: lines that a site puts into its documents.

The texts are read once: every line becomes a 64-bit hash of its normal form, and a thread the lists of its posts'
hashes.  Only these narrow rows are shuffled, to count a thread delivered twice once, and kept in the shared folder.
Pass 1 keeps, in each task and for each source, a Misra-Gries summary of the lines (one count a post).  Summaries merge
into one with no more counters, first within groups of tasks, then by source, so none grows with the
number of tasks.  A summary's counters grow with the lines a post has, so that what a line can lose in all
summaries together stays below half of the share looked for: every line at or above the share
is a candidate.  Pass 2 counts the candidates exactly.  Confirmed lines (per source at most the
mean lines of a post over the share) are removed with broadcast sets while their number is within
BROADCAST_LINES, by a join on the source beyond.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm import cleanup
from siftwork.operators.checkpoints import cut

#: Least counters of a summary.
COUNTERS = 2_000
#: Most confirmed lines that are broadcast.
BROADCAST_LINES = 50_000
#: Groups of tasks whose summaries are merged first.
GROUPS = 256
#: Lines a task remembers the keys of; when full, it starts anew.
SEEN_LINES = 100_000

_DIGITS = re.compile(r"\d+")


def line_form(line: str) -> str:
    """Equal for lines that differ only in case, white space, characters the clean-up changes and the value of numbers; empty for blank lines."""
    return _DIGITS.sub("0", "".join(cleanup.fold(line).lower().split()))


def line_key(line: str) -> int | None:
    """64-bit hash of a line's form; None for blank lines."""
    form = line_form(line)
    return int.from_bytes(hashlib.blake2b(form.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) if form else None


class Keys(dict):
    """line_key with a memory."""

    def __missing__(self, line: str) -> int | None:
        key = line_key(line)
        if len(line) <= 200:
            if len(self) >= SEEN_LINES:
                self.clear()
            self[line] = key
        return key


def _room(lines: int, posts: int, share: float) -> int:
    """Counters with which lost <= lines / counters < share / 2 of the posts."""
    return max(COUNTERS, int(2 * lines / (posts * share)) + 1) if posts else COUNTERS


class Summary:
    """Misra-Gries counts of the lines of one source in one task."""

    def __init__(self, share: float):
        self.share, self.counts, self.lost, self.lines, self.posts = share, {}, 0, 0, 0

    def add(self, keys: set[int]) -> None:
        self.posts += 1
        self.lines += len(keys)
        for k in keys:
            self.counts[k] = self.counts.get(k, 0) + 1
        # cut back at twice the room, so that a cut costs little for each line
        if len(self.counts) > 2 * (room := _room(self.lines, self.posts, self.share)):
            self.cut(room)

    def cut(self, room: int) -> None:
        """Down to ``room`` counters: what the next largest one has is taken from all."""
        if len(self.counts) > room:
            least = sorted(self.counts.values(), reverse=True)[room]
            self.lost += least
            self.counts = {k: n - least for k, n in self.counts.items() if n > least}

    def merge(self, keys: Iterable[int], counts: Iterable[int], lost: int, lines: int, posts: int) -> None:
        for k, n in zip(keys, counts, strict=True):
            self.counts[k] = self.counts.get(k, 0) + n
        self.lost, self.lines, self.posts = self.lost + lost, self.lines + lines, self.posts + posts
        self.cut(_room(self.lines, self.posts, self.share))


def _slim(forum: DataFrame) -> DataFrame:
    """source, thread_id, posts(index, content) of the rows that have them."""
    slim = forum.where(F.col("source").isNotNull() & F.col("thread_id").isNotNull() & F.col("posts").isNotNull())
    return slim.select("source", "thread_id", F.transform("posts", lambda p: F.struct(p["index"].alias("index"), p["content"].alias("content"))).alias("posts"))


def _unique(posts: list[dict]) -> dict[int, str | None]:
    out: dict[int, str | None] = {}
    for p in posts:
        if p is not None and p["index"] is not None:
            out.setdefault(p["index"], p["content"])
    return out


def marked(forum: DataFrame) -> DataFrame:
    """(source, thread_id, posts(index, keys)): the posts with the keys of their lines, null for blank ones; rows delivered again count once."""
    slim = _slim(forum)
    post = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    schema = T.StructType([slim.schema["source"], slim.schema["thread_id"], T.StructField("posts", T.ArrayType(post))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Keys()
        for b in batches:
            index, keys, ends, key_ends = [], [], [0], [0]
            for posts in b.column("posts").to_pylist():
                for k, content in _unique(posts).items():
                    index.append(k)
                    if content:
                        keys += [known[line] for line in content.split("\n")]
                    key_ends.append(len(keys))
                ends.append(len(index))
            lists = pa.ListArray.from_arrays(pa.array(key_ends, pa.int32()), pa.array(keys, pa.int64()))
            structs = pa.StructArray.from_arrays([pa.array(index, pa.int32()), lists], names=["index", "keys"])
            yield pa.RecordBatch.from_arrays([b.column("source"), b.column("thread_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)], names=["source", "thread_id", "posts"])

    return slim.mapInArrow(run, schema).dropDuplicates(["thread_id"])


_SUMMARY = "source string, keys array<bigint>, counts array<bigint>, lost bigint, lines bigint, posts bigint"


def summaries(threads: DataFrame, share: float) -> DataFrame:
    """One merged summary for each source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Summary] = defaultdict(lambda: Summary(share))
        for b in batches:
            for source, posts in zip(b.column("source").to_pylist(), b.column("posts").to_pylist(), strict=True):
                own = seen[source]
                for p in posts:
                    own.add({k for k in p["keys"] if k is not None})
        for source, s in seen.items():
            s.cut(_room(s.lines, s.posts, share))
            yield pa.RecordBatch.from_pylist([{"source": source, "keys": list(s.counts), "counts": list(s.counts.values()), "lost": s.lost, "lines": s.lines, "posts": s.posts}], schema=pa.schema([("source", pa.string()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("lost", pa.int64()), ("lines", pa.int64()), ("posts", pa.int64())]))

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        out = Summary(share)
        for r in rows.itertuples(index=False):
            out.merge(r.keys.tolist(), r.counts.tolist(), r.lost, r.lines, r.posts)
        return pd.DataFrame([{"source": rows["source"].iloc[0], "keys": list(out.counts), "counts": list(out.counts.values()), "lost": out.lost, "lines": out.lines, "posts": out.posts}])

    own = threads.select(F.col("source").cast("string").alias("source"), "posts").mapInArrow(run, _SUMMARY)
    groups = own.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    return groups.groupBy("source", "group").applyInPandas(merged, _SUMMARY).groupBy("source").applyInPandas(merged, _SUMMARY)


def _confirmed(threads: DataFrame, share: float, least: int) -> DataFrame:
    merged = summaries(threads, share).withColumn("need", F.greatest(F.lit(float(least)), F.col("posts") * F.lit(share)))
    upto = merged.select("source", "need", "lost", F.explode(F.arrays_zip("keys", "counts")).alias("c"))
    candidates = upto.where(F.col("c.counts") + F.col("lost") >= F.col("need")).select("source", F.col("c.keys").alias("key"), "need")
    posts = threads.select("source", F.explode("posts").alias("p")).select("source", F.explode(F.array_distinct("p.keys")).alias("key"))
    return posts.join(candidates, ["source", "key"]).groupBy("source", "key", "need").agg(F.count("*").alias("n")).where(F.col("n") >= F.col("need") - 1e-9).select("source", "key", "n")


def confirmed_lines(forum: DataFrame, share: float = 0.05, least: int = 5) -> DataFrame:
    """(source, key, n): lines in at least ``least`` posts and ``share`` of the source's posts, with their number of posts."""
    return _confirmed(cut(marked(forum)), share, least)


def site_lines(forum: DataFrame, share: float = 0.05, least: int = 5) -> DataFrame:
    """(source, thread_id, post_index, line_no, key) of every line found in a post.

    Threads delivered again count once, as does a post index that a thread repeats; posts with
    null or empty content count as posts without lines; rows without source or thread_id are left
    out; an empty table gives no rows.  Other columns of the table don't matter.
    """
    threads = cut(marked(forum))
    found = _confirmed(threads, share, least).select("source", "key")
    posts = threads.select("source", "thread_id", F.explode("posts").alias("p"))
    lines = posts.select("source", "thread_id", F.col("p.index").alias("post_index"), F.posexplode("p.keys").alias("line_no", "key"))
    return lines.where("key is not null").join(found, ["source", "key"]).select("source", "thread_id", "post_index", (F.col("line_no") + 1).alias("line_no"), "key")


def without_site_lines(forum: DataFrame, share: float = 0.05, least: int = 5) -> DataFrame:
    """(thread_id, post_index, content, n_removed): every post's content without its source's lines; null contents stay null."""
    found = cut(confirmed_lines(forum, share, least))
    threads = _slim(forum).dropDuplicates(["thread_id"])
    schema = T.StructType([threads.schema["thread_id"], T.StructField("post_index", T.IntegerType()), T.StructField("content", T.StringType()), T.StructField("n_removed", T.IntegerType())])
    head = found.limit(BROADCAST_LINES + 1).collect()
    small = len(head) <= BROADCAST_LINES
    sets: dict[str, set[int]] = defaultdict(set)
    if small:
        for r in head:
            sets[r["source"]].add(r["key"])
        shared = threads.sparkSession.sparkContext.broadcast(dict(sets))
        given = threads.withColumn("keys", F.lit(None).cast("array<bigint>"))
    else:
        shared = None
        given = threads.join(found.groupBy("source").agg(F.collect_set("key").alias("keys")), "source", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Keys()
        for b in batches:
            ids, index, out, removed = [], [], [], []
            for source, thread, posts, keys in zip(*[b.column(c).to_pylist() for c in ("source", "thread_id", "posts", "keys")], strict=True):
                drop = shared.value.get(source, set()) if shared else set(keys or ())
                for k, content in _unique(posts).items():
                    lines = content.split("\n") if content is not None else []
                    kept = [line for line in lines if not drop or known[line] not in drop]
                    ids.append(thread)
                    index.append(k)
                    out.append(None if content is None else "\n".join(kept))
                    removed.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field("thread_id").type), pa.array(index, pa.int32()), pa.array(out, pa.string()), pa.array(removed, pa.int32())], names=["thread_id", "post_index", "content", "n_removed"])

    return given.select("source", "thread_id", "posts", "keys").mapInArrow(run, schema)
