"""MinHash-LSH deduplication: signatures, bands, star edges, components, one document kept of each.

Shingle hashes and bands are column expressions; only the minima over the family's
permutations are taken in numpy, a batch of documents at a time, so the signatures never
exist as rows of (document, seed).  A bucket contributes a star around its least id, never its
pairs, so a hot bucket costs its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import PRIME, gram_hash, ngrams, norm_tokens
from siftwork.operators.checkpoints import cut
from siftwork.operators.components import connected_components


def family(count: int) -> list[tuple[int, int]]:
    """(a, b) of the maps a * h + b mod PRIME, from md5 so that any engine can have them."""

    def part(s: str) -> int:
        return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)

    return [(1 + part(f"a{s}") % (PRIME - 1), part(f"b{s}") % PRIME) for s in range(count)]


def shingles(docs: DataFrame, id_col: str, text: Column, n: int = 3, numbers: bool = True) -> DataFrame:
    """(id, hashes): distinct hashes of each text's grams; texts of fewer than n tokens are left out."""
    tokens = docs.select(F.col(id_col).alias("id"), norm_tokens(text, numbers).alias("w")).where(F.size("w") >= n)
    return tokens.select("id", F.array_distinct(F.transform(ngrams(F.col("w"), n), gram_hash)).alias("hashes"))


def signatures(docs: DataFrame, id_col: str, text: Column, bands: int = 14, rows: int = 3, n: int = 3, numbers: bool = True) -> DataFrame:
    """(id, signature): bands * rows minima."""
    if bands < 1 or rows < 1:
        raise ValueError("bands and rows must be at least 1")
    maps = family(bands * rows)
    hashed = shingles(docs, id_col, text, n, numbers)
    kind = hashed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column("hashes")
            offsets = col.offsets.to_numpy()
            h, starts = col.values.to_numpy()[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0]
            found = np.stack([np.minimum.reduceat((h * a + c) % PRIME, starts) for a, c in maps], axis=1)
            ends = pa.array(np.arange(0, found.size + 1, len(maps), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], names=["id", "signature"])

    return hashed.mapInArrow(run, f"id {kind}, signature array<bigint>")


def band_keys(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, band, key)."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.array_join(F.slice("signature", k * rows + 1, rows).cast("array<string>"), "-"))
    return signed.select("id", F.posexplode(keys).alias("band", "key"))


def candidate_edges(signed: DataFrame, bands: int = 14, rows: int = 3) -> DataFrame:
    """(a, b), distinct: every member of a bucket with the bucket's least id.

    The least id comes from an aggregation that combines before the shuffle, so a hot bucket is
    no hot task; its members then meet one row.
    """
    keyed = band_keys(cut(signed), bands, rows)  # read twice, so kept in the shared folder
    least = keyed.groupBy("band", "key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keyed.join(least, ["band", "key"]).where("id <> a").select("a", F.col("id").alias("b")).distinct()


def clusters(docs: DataFrame, id_col: str, text: Column, bands: int = 14, rows: int = 3, n: int = 3, numbers: bool = True) -> DataFrame:
    """(id, component) of documents that have a near duplicate; the component is its least id."""
    edges = candidate_edges(signatures(docs, id_col, text, bands, rows, n, numbers), bands, rows)
    return connected_components(edges).withColumnRenamed("node", "id")


def deduplicate(docs: DataFrame, id_col: str, text: Column, bands: int = 14, rows: int = 3, n: int = 3, numbers: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): all documents but those whose cluster has a lesser id, and those with that id as ``duplicate_of``."""
    gone = clusters(docs, id_col, text, bands, rows, n, numbers).where("id <> component").select(F.col("id").alias(id_col), F.col("component").alias("duplicate_of"))
    return docs.join(gone.select(id_col), id_col, "left_anti"), docs.join(gone, id_col)


def flagged(docs: DataFrame, id_col: str, text: Column, bands: int = 14, rows: int = 3, n: int = 3, numbers: bool = True) -> DataFrame:
    """All documents with duplicate_of, null for those that stay, and ``removed``; for sinks that write both sides in one pass."""
    gone = clusters(docs, id_col, text, bands, rows, n, numbers).where("id <> component").select(F.col("id").alias(id_col), F.col("component").alias("duplicate_of"))
    return docs.join(gone, id_col, "left").withColumn("removed", F.col("duplicate_of").isNotNull())
