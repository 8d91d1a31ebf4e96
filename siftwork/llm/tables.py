"""The project's tables as the text operators read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators.layout import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work that is heavy for each row."""
    return dealt(table(spark, sf_dir, name))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per post and delivery: source, thread_id, scraped_at, post_index, id (the post's key), author, date, content."""
    return (
        table(spark, sf_dir, "forum_example_fixed")
        .select("source", "thread_id", "scraped_at", F.explode("posts").alias("p"))
        .select(
            "source",
            "thread_id",
            "scraped_at",
            F.col("p.index").alias("post_index"),
            (F.col("thread_id") * 1000 + F.col("p.index")).alias("id"),
            F.col("p.author").alias("author"),
            F.col("p.date").alias("date"),
            F.col("p.content").alias("content"),
        )
    )


def questions_and_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, id, text) of every question and post, null texts left out; a row may be there twice."""
    q = table(spark, sf_dir, "pipeline_output").select(F.lit("question").alias("field"), F.col("record_id").alias("id"), F.col("question").alias("text"))
    p = posts(spark, sf_dir).select(F.lit("post").alias("field"), "id", F.col("content").alias("text"))
    return q.unionByName(p).where(F.col("text").isNotNull() & F.col("id").isNotNull())
