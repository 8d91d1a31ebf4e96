"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.schema import CLEAN_FIELDS


def append_json(df: DataFrame, path: str) -> None:
    """Rows added as JSON lines that keep their nulls."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_json_gz(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def write_sides(flagged: DataFrame, flag_col: str, path: str) -> None:
    """Kept and removed rows by one pass, in folders status=clean and status=removed."""
    flagged.withColumn("status", F.when(F.col(flag_col), "removed").otherwise("clean")).drop(flag_col).write.mode("overwrite").partitionBy("status").parquet(path)


def flatten(df: DataFrame, nested: str = "metadata") -> DataFrame:
    """The metadata's fields as columns, without the marks of where a row came from."""
    flat = df.select(f"{nested}.*") if nested in df.columns else df
    return flat.drop("_source_path", "_source_repo")


def write_index(index: DataFrame, path: str) -> None:
    """A gram index with its task names, in files by their rows, not by task."""
    index.write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(gram, task_name) of an index that was written."""
    return spark.read.parquet(path).select("gram", "task_name")


def write_splits(df: DataFrame, path: str) -> bool:
    """A folder a split; nothing for an empty frame, which is told."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    return True


def write_predictions(rows: DataFrame, gold: str, predicted: str, path: str) -> DataFrame:
    """The samples with ``same`` as JSON lines; (n, accuracy) of what was written."""
    from siftwork.operators.metrics import accuracy, same_answer

    rows.withColumn("same", same_answer(F.col(gold), F.col(predicted))).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return accuracy(rows.sparkSession.read.schema(rows.schema).json(path), gold, predicted)


def write_records(full: DataFrame, clean_path: str, log_path: str | None, order_cols: list[str]) -> None:
    """Clean records and, if asked, the full log, both in the order of threads and tasks."""
    ordered = full.orderBy(*order_cols)
    ordered.where("status = 'kept'").select(*CLEAN_FIELDS).write.mode("overwrite").option("ignoreNullFields", "false").json(clean_path)
    if log_path:
        ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(log_path)
