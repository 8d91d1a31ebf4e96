"""Problem 9: mixing sources to target weights.

Weighted fair queueing.  Each source's documents are shuffled by a seeded hash; a document's
virtual finish time is the tokens its source has sent when it is through, whole earlier passes
included, over the source's weight.  The queue of all documents and passes in the order of
these times gives every source its share at any point, until a source has been sent
``max_repeats`` times; what it then lacks goes to the others in proportion.  The queue is cut
at the total budget.

No window runs over a whole source: documents are summed by (source, slice of the hash), the
slices' sums are accumulated, and a window within a slice adds the rest.  How many passes each
source can need within the budget follows from one sum a source, and only these are written out.  The cut is found in
two histograms of the finish times, so only one sliver of the queue is ever summed in one task.
The mix comes out range-partitioned and sorted by finish time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.llm.encode import count_tokens
from siftwork.operators.checkpoints import cut

#: Documents of a slice, about.
SLICE = 20_000
#: Cells of each histogram of finish times.
CELLS = 4096


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary_file: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents with tokens; a key that repeats counts once."""
    given = docs.where(F.col(text_col).isNotNull() & F.col(source_col).isNotNull() & F.col(id_col).isNotNull())
    counted = count_tokens(given.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")), vocabulary_file=vocabulary_file)
    return counted.where("n_tokens > 0").dropDuplicates(["doc_id"])


def reached(sources: list[tuple[float, float, float]], tokens: float) -> float:
    """Virtual time by which the sources (weight, tokens of a pass, passes) have sent so many tokens; infinite where they never do."""
    ends = sorted((passes * size / weight, weight) for weight, size, passes in sources)
    rate, at, sent = sum(w for _, w in ends), 0.0, 0.0
    for end, weight in ends:
        if rate > 0 and sent + rate * (end - at) >= tokens:
            return at + (tokens - sent) / rate
        sent, at, rate = sent + rate * (end - at), end, rate - weight
    return math.inf


def queue(sized: DataFrame, targets: DataFrame, seed: int = 17, budget: int | None = None) -> DataFrame:
    """(doc_id, copy, source, n_tokens, finish): the documents and passes with their virtual finish times; with a budget only those that can lie within it.

    A source sends its weight's share until it ends, and what it has sent at a time is short of its due by less than a
    document; so by the time at which budget and the largest document of each source are due, the budget is spent.
    """
    rows = sized.count()
    slices = max(16, rows // SLICE)
    want = targets.where("target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("weight"), F.max("max_repeats").alias("repeats"))
    hashed = sized.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("slice", F.floor(F.shiftrightunsigned("h", 33) * F.lit(float(slices)) / F.lit(float(1 << 31))).cast("int"))
    sums = hashed.groupBy("source", "slice").agg(F.sum("n_tokens").alias("tokens"))
    before = sums.withColumn("before", F.sum("tokens").over(Window.partitionBy("source").orderBy("slice")) - F.col("tokens"))
    before = before.withColumn("all", F.sum("tokens").over(Window.partitionBy("source"))).join(want, "source")
    order = Window.partitionBy("source", "slice").orderBy(F.shiftrightunsigned("h", 1), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sent = hashed.withColumn("within", F.sum("n_tokens").over(order)).join(before.drop("tokens"), ["source", "slice"])
    finish = ((F.col("copy") - 1) * F.col("all") + F.col("before") + F.col("within")) / F.col("weight")
    needed, last = F.col("repeats"), F.lit(math.inf)
    if budget is not None:
        # a row a target
        found = hashed.groupBy("source").agg(F.sum("n_tokens").alias("all"), F.max("n_tokens").alias("largest")).join(want, "source").select("weight", "all", "repeats", "largest").collect()
        until = reached([(r["weight"], r["all"], r["repeats"]) for r in found], budget + sum(r["largest"] for r in found))
        last = F.lit(until * (1 + 1e-9))
        needed = F.floor(F.least(needed.cast("double"), last * F.col("weight") / F.col("all") + 1)).cast("int")
    passes = sent.withColumn("copy", F.explode(F.sequence(F.lit(1), needed)))
    return passes.select("doc_id", "copy", "source", "n_tokens", finish.alias("finish")).where(F.col("finish") <= last)


def _cells(q: DataFrame, low: float, high: float) -> tuple[DataFrame, list[tuple[int, int]]]:
    width = (high - low) / CELLS or 1.0
    placed = q.withColumn("cell", F.least(F.floor((F.col("finish") - low) / width), F.lit(CELLS - 1)))
    return placed, [(r["cell"], r["n"]) for r in placed.groupBy("cell").agg(F.sum("n_tokens").alias("n")).orderBy("cell").collect()]


def mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", budget: int | None = None, vocabulary_file: str | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, copy, source, n_tokens, finish) of the mix, sorted by finish time.

    ``targets`` has source, target_share, max_repeats.  ``budget`` is the mix's size in tokens; without it, as many
    as the documents of the target sources have.  Documents of other or null sources, and null or empty texts,
    are in no mix; an exact copy under another key is a document of its own; a repeated key counts once.
    The first document that would pass the budget ends the mix.  No documents give no rows.
    """
    want = targets.where("target_share > 0 and max_repeats > 0").select("source").distinct()
    sized = cut(sizes(docs, id_col, text_col, source_col, vocabulary_file).join(want, "source", "left_semi").select("doc_id", "source", "n_tokens"))
    total = sized.agg(F.sum("n_tokens")).first()[0] or 0
    budget = total if budget is None else budget
    q = queue(sized, targets, seed, budget)
    if total:
        q = cut(q)
        room, parts, rest, low, high = budget, [], q, 0.0, q.agg(F.max("finish")).first()[0]
        for _ in range(2):
            placed, found = _cells(rest, low, high)
            full, at = [], None
            for cell, n in found:
                if n > room:
                    at = cell
                    break
                room -= n
                full.append(cell)
            parts.append(placed.where(F.col("cell") <= F.lit(full[-1] if full else -1)).drop("cell"))
            if at is None:
                rest = None
                break
            width = (high - low) / CELLS
            rest, low, high = placed.where(F.col("cell") == at).drop("cell"), low + at * width, low + (at + 1) * width
        if rest is not None:
            # one cell of one cell: a 16-millionth of the queue
            sent = F.sum("n_tokens").over(Window.orderBy("finish", "source", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0))
            parts.append(rest.withColumn("sent", sent).where(F.col("sent") <= room).drop("sent"))
        q = parts[0]
        for p in parts[1:]:
            q = q.unionByName(p)
    return q.repartitionByRange("finish", "source", "doc_id").sortWithinPartitions("finish", "source", "doc_id")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, tokens, actual_share, documents, most_copies) of a mix, a row for each target."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_distinct("doc_id").alias("documents"), F.max("copy").alias("most_copies"))
    # as many rows as there are targets
    rows = targets.select("source", "target_share").join(got, "source", "left").withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    return rows.select("source", "target_share", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
