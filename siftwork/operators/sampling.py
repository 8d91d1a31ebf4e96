"""Exact, seeded splits and heads; records of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shuffle_key(seed: int, key: Column) -> Column:
    """Order of a seeded shuffle that any engine with md5 gives."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def exact_split(df: DataFrame, key_col: str, size: int | None = None, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """The rows with ``split``: exactly ``size`` rows, or the ceiling of ``fraction``, are ``validation``, the others ``train``.

    The validation rows are the first of the shuffle order.  Where they end is found in two counts of the order's
    next three hexadecimal digits (4,096 cells each), so rows are only compared one by one within a
    16-millionth of the order, whatever the size; nothing is sorted as a whole.  Keys are unique.
    """
    n = df.count()
    take = min(n, size if size is not None else -(-int(round(fraction * n * 1_000_000)) // 1_000_000))
    keyed = df.withColumn("shuffle_key", shuffle_key(seed, F.col(key_col)))
    inside, rest, edge = F.lit(False), take, F.lit(True)
    for level in range(2):
        cell = F.substring("shuffle_key", 3 * level + 1, 3)
        at = None
        for c, rows in keyed.where(edge).groupBy(cell.alias("cell")).count().orderBy("cell").collect():
            if rows > rest:
                at = c
                break
            rest -= rows
        if at is None:
            inside, edge = inside | edge, F.lit(False)
            break
        inside, edge = inside | (edge & (cell < at)), edge & (cell == at)
    chosen = keyed.where(edge).select(key_col, "shuffle_key").orderBy("shuffle_key", key_col).limit(rest).select(key_col, F.lit(True).alias("chosen"))
    marked = keyed.join(chosen, key_col, "left")
    return marked.withColumn("split", F.when(inside | F.coalesce("chosen", F.lit(False)), "validation").otherwise("train")).drop("chosen", "shuffle_key")


def head_per_source(df: DataFrame, source_col: str, order_cols: list[str], n: int) -> DataFrame:
    """The first n rows of each source."""
    rank = F.row_number().over(Window.partitionBy(source_col).orderBy(*order_cols))
    return df.withColumn("source_rank", rank).where(F.col("source_rank") <= n).drop("source_rank")


def chat(query: Column, response: Column) -> Column:
    """Two messages, of the user and the assistant."""
    return F.array(F.struct(F.lit("user").alias("role"), query.alias("content")), F.struct(F.lit("assistant").alias("role"), response.alias("content")))


def rendered_chat(messages: Column, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> Column:
    """Messages as one text with role marks."""
    return F.concat(F.array_join(F.transform(messages, lambda m: F.concat(F.lit(begin), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(end))), "\n"), F.lit("\n"))
