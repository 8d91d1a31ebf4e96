"""Multiset Jaccard of word grams, and the most similar kept document of a removed one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import ngrams, space_tokens

#: Grams of a block of queries, about; some 20 bytes each are broadcast.
BLOCK_GRAMS = 1_000_000


def gram_counts(docs: DataFrame, id_col: str, text: Column, n: int = 3) -> DataFrame:
    """(id, gram, n) with how often each gram stands in the text."""
    tokens = docs.select(F.col(id_col).alias("id"), space_tokens(text).alias("w"))  # a column of its own, else each gram would split the text again
    grams = tokens.select("id", F.explode(ngrams(F.col("w"), n)).alias("gram"))
    return grams.groupBy("id", "gram").agg(F.count("*").alias("n"))


def gram_lists(docs: DataFrame, id_col: str, text: Column, n: int = 3) -> DataFrame:
    """(id, grams): 64-bit hashes of all grams of each text."""
    tokens = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), space_tokens(text).alias("w"))
    return tokens.select("id", F.transform(ngrams(F.col("w"), n), lambda g: F.xxhash64(g)).alias("grams"))


class Queries:
    """A block of queries: their grams in order, for each the queries that have it and how often."""

    def __init__(self, ids: list, grams: list[np.ndarray]):
        self.ids = ids
        self.place = {x: i for i, x in enumerate(ids)}
        self.total = np.array([len(g) for g in grams], np.int64)
        query = np.repeat(np.arange(len(ids)), self.total)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.int64)
        order = np.lexsort((query, flat))
        flat, query = flat[order], query[order]
        new = np.concatenate([[True], (flat[1:] != flat[:-1]) | (query[1:] != query[:-1])]) if len(flat) else np.zeros(0, bool)
        begins = np.flatnonzero(new)
        self.query, self.count = query[begins].astype(np.int32), np.diff(np.append(begins, len(flat))).astype(np.int32)
        self.gram, first = np.unique(flat[begins], return_index=True)
        self.first = np.append(first, len(begins))

    def shared(self, grams: np.ndarray) -> np.ndarray:
        """How many grams a document has in common with each query, as often as both have them."""
        own, often = np.unique(grams, return_counts=True)
        at = np.searchsorted(self.gram, own)
        at[at == len(self.gram)] = 0
        known = self.gram[at] == own
        at, often = at[known], often[known]
        length = self.first[at + 1] - self.first[at]
        begins = np.cumsum(length) - length
        places = np.repeat(self.first[at] - begins, length) + np.arange(length.sum())
        return np.bincount(self.query[places], np.minimum(self.count[places], np.repeat(often, length)), len(self.ids))


def best_matches(queries: DataFrame, kept: DataFrame, id_col: str, text: Column, n: int = 3, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """(id, best_id, score) of each query: the kept document of greatest multiset Jaccard but for the query's own id, the least id among equals; null and 0 where no gram is shared.

    The queries are the small side, stated by the caller.  They are taken in blocks of bounded size, whose grams all tasks get; every
    kept document is compared with all of a block, and a task sends one row a query.  Nothing else is shuffled.
    Grams are compared by 64-bit hashes.  Null ids are left out; ids are unique on either side.
    """
    asked = gram_lists(queries, id_col, text, n)
    kind = asked.schema["id"].dataType
    every = gram_lists(kept, id_col, text, n).withColumnRenamed("id", "kid")
    size = asked.agg(F.sum(F.size("grams"))).first()[0] or 0
    blocks = -(-size // block_grams)
    schema = f"id {kind.simpleString()}, kid {kind.simpleString()}, score double"
    parts = []
    for k in range(blocks):
        # a condition on the grams would have them made for every row before the others are looked at
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toArrow()
        some = [(i, np.asarray(g, np.int64)) for i, g in zip(rows["id"].to_pylist(), rows["grams"].to_pylist(), strict=True) if g]
        if not some:
            continue
        block = Queries([i for i, _ in some], [g for _, g in some])
        shared = kept.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            best, where = np.zeros(len(block.ids)), [None] * len(block.ids)
            types = None
            for b in batches:
                types = b.schema.field("kid").type
                grams = b.column("grams")
                offsets, values = grams.offsets.to_numpy(), grams.values.to_numpy()
                for i, kid in enumerate(b.column("kid").to_pylist()):
                    own = values[offsets[i] : offsets[i + 1]]
                    if not len(own):
                        continue
                    both = block.shared(own)
                    if (self_ := block.place.get(kid)) is not None:
                        both[self_] = 0
                    some = np.flatnonzero(both)
                    score = both[some] / (block.total[some] + len(own) - both[some])
                    for q, x in zip(some[score >= best[some]].tolist(), score[score >= best[some]].tolist(), strict=True):
                        if x > best[q] or kid < where[q]:
                            best[q], where[q] = x, kid
            found = [q for q, kid in enumerate(where) if kid is not None]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([block.ids[q] for q in found], types), pa.array([where[q] for q in found], types), pa.array(best[found])], names=["id", "kid", "score"])

        parts.append(every.mapInArrow(run, schema))
    ids = queries.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    if not parts:
        return ids.select("id", F.lit(None).cast(kind).alias("best_id"), F.lit(0.0).alias("score"))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    best = scored.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("minus"), "kid")).alias("b"))
    return ids.join(best.select("id", F.col("b.kid").alias("best_id"), (-F.col("b.minus")).alias("score")), "id", "left").select("id", "best_id", F.coalesce("score", F.lit(0.0)).alias("score"))
