"""Row shapes of the curation pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

POST = T.StructType(
    [
        T.StructField("index", T.IntegerType()),
        T.StructField("author", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("contains_images", T.BooleanType()),
    ]
)
THREAD = T.StructType([*[T.StructField(c, T.StringType()) for c in ("source", "url", "title", "scraped_at")], T.StructField("posts", T.ArrayType(POST))])
TASK = T.StructType([T.StructField("question", T.StringType()), T.StructField("post_indices", T.ArrayType(T.IntegerType())), T.StructField("has_inline_solution", T.BooleanType())])
BENCHMARK = T.StructType([T.StructField("task_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("task", "solution", "answer", "type")]])

#: The categories of a kept task.
CATEGORIES = ("EXACT_VALUE", "EXPRESSION", "PROOF", "COMPLEX")
#: Columns of a full and of a clean record.
FULL_FIELDS = ("source_url", "source_title", "question", "kept", "filter_reason", "category", "category_reason", "raw_answer", "answer_post_index", "solution")
CLEAN_FIELDS = ("source_url", "question", "category", "solution")
