"""Decontamination by word n-grams.

The index of a benchmark (grams of task, solution and across both) is small and joins the
corpus's grams by value; Spark broadcasts it while its size is below the session's threshold and
shuffles both sides by gram beyond.  Grams are exploded from one column of tokens; the
documents' other columns never travel with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import ngrams, norm_tokens, overlap_ngrams


def task_name(stem: str | Column, task_id: Column, ordinal: Column | None = None) -> Column:
    """``stem_taskID``; for a null id ``stem_N`` by the ordinal."""
    return F.concat(F.lit(stem) if isinstance(stem, str) else stem, F.coalesce(F.concat(F.lit("_task"), task_id.cast("string")), F.concat(F.lit("_"), (ordinal if ordinal is not None else F.lit(0)).cast("string"))))


def build_index(benchmark: DataFrame, n: int = 9, stem: str = "benchmark", task_col: str = "task", solution_col: str = "solution", id_col: str = "task_id", numbers: bool = True) -> DataFrame:
    """(gram, task_name), distinct: grams of the task, of the solution and over their seam.

    Columns benchmark_name and ordinal, where the benchmark has them, name its items: the first in place of ``stem``, the second for those without an id.
    """
    q, s = norm_tokens(F.col(task_col), numbers), norm_tokens(F.col(solution_col), numbers)
    name = F.col("benchmark_name") if "benchmark_name" in benchmark.columns else stem
    named = benchmark.select(task_name(name, F.col(id_col), F.col("ordinal") if "ordinal" in benchmark.columns else None).alias("task_name"), q.alias("q"), s.alias("s"))
    grams = F.array_distinct(F.concat(ngrams(F.col("s"), n), ngrams(F.col("q"), n), overlap_ngrams(F.col("q"), F.col("s"), n)))
    return named.select(F.explode(grams).alias("gram"), "task_name").distinct()


def document_grams(docs: DataFrame, id_col: str, text: Column, n: int, numbers: bool = True) -> DataFrame:
    """(id, pos, gram); texts of fewer than n tokens have none."""
    tokens = docs.select(F.col(id_col).alias("id"), norm_tokens(text, numbers).alias("w"))
    return tokens.select("id", F.posexplode(ngrams(F.col("w"), n)).alias("pos", "gram"))


def contamination(docs: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = 9, numbers: bool = True) -> DataFrame:
    """(id, contaminated_task, contaminated_ngram) of documents that share a gram: the first by position, its greatest task name."""
    tagged = index.groupBy("gram").agg(F.max("task_name").alias("task_name"))
    hits = document_grams(docs, id_col, text, n, numbers).join(tagged, "gram")
    return hits.groupBy("id").agg(F.min_by("task_name", "pos").alias("contaminated_task"), F.min_by("gram", "pos").alias("contaminated_ngram"))


def decontaminate(docs: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = 9, numbers: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean, removed): the documents without a shared gram as they are, and the others with what they share."""
    hits = contamination(docs, index, id_col, text, n, numbers).withColumnRenamed("id", id_col)
    return docs.join(hits.select(id_col), id_col, "left_anti"), docs.join(hits, id_col)


def flagged(docs: DataFrame, index: DataFrame, id_col: str, text: Column, n: int = 9, numbers: bool = True) -> DataFrame:
    """All documents with contaminated_task and contaminated_ngram, null for clean ones, and ``removed``; for sinks that write both sides in one pass."""
    hits = contamination(docs, index, id_col, text, n, numbers).withColumnRenamed("id", id_col)
    return docs.join(hits, id_col, "left").withColumn("removed", F.col("contaminated_task").isNotNull())
