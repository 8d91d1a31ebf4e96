"""Threads: assembly from posts, lookups in their posts, crawl bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.operators.checkpoints import cut


def assemble(posts: DataFrame, thread_cols: list[str], order_cols: list[str], post_cols: list[str]) -> DataFrame:
    """One row per thread with its posts in order, numbered from 0."""
    ordered = F.sort_array(F.collect_list(F.struct(*order_cols, F.struct(*post_cols).alias("post"))))
    together = posts.groupBy(*thread_cols).agg(ordered.alias("ordered"))
    return together.select(*thread_cols, F.transform("ordered", lambda x, i: F.struct(i.cast("int").alias("index"), *[x["post"][c].alias(c) for c in post_cols if c != "index"])).alias("posts"))


def across_pages(pages: DataFrame, thread_col: str, page_col: str, posts_col: str) -> DataFrame:
    """(thread, index, post): the posts of a thread's pages in one running count."""
    flat = pages.select(thread_col, page_col, F.posexplode(posts_col).alias("at", "post"))
    running = F.row_number().over(Window.partitionBy(thread_col).orderBy(page_col, "at")) - 1
    return flat.select(thread_col, running.cast("int").alias("index"), "post")


def totals(threads: DataFrame, group_cols: list[str]) -> DataFrame:
    """(..., threads, posts): how many threads and posts there are of each group; null lists of posts count none."""
    return threads.groupBy(*group_cols).agg(F.count("*").alias("threads"), F.coalesce(F.sum(F.size(F.coalesce("posts", F.array().cast(threads.schema["posts"].dataType)))), F.lit(0)).cast("bigint").alias("posts"))


def titled(title: Column, number: Column) -> Column:
    """The title, or the problem's number where it has none."""
    return F.coalesce(F.nullif(F.trim(title), F.lit("")), F.concat(F.lit("Zadanie nr "), number.cast("string")))


def relevant(posts: Column, indices: Column) -> Column:
    return F.filter(posts, lambda p: F.array_contains(indices, p["index"]))


def any_images(posts: Column) -> Column:
    return F.coalesce(F.exists(posts, lambda p: F.coalesce(p["contains_images"], F.lit(False))), F.lit(False))


def post_content(posts: Column, index: Column) -> Column:
    """Content of the post with that index, the last one where it repeats; null where there is none."""
    return F.try_element_at(F.filter(posts, lambda p: p["index"] == index), F.lit(-1))["content"]


def with_contents(posts: Column, contents: Column) -> Column:
    """The posts with these contents, in order."""
    return F.transform(posts, lambda p, i: p.withField("content", F.get(contents, i)))


def brief(posts: Column, chars: int = 500) -> Column:
    """The posts as a model gets them: index, author and the first ``chars`` characters of the text."""
    return F.transform(posts, lambda p: F.struct(p["index"].alias("index"), F.coalesce(p["author"], F.lit("")).alias("author"), F.substring(F.coalesce(p["content"], F.lit("")), 1, chars).alias("text")))


def not_done(found: DataFrame, done: DataFrame, col: str = "url") -> DataFrame:
    """Rows whose address isn't among those done."""
    return found.join(done.where(F.col(col).isNotNull()).select(col).distinct(), col, "left_anti")


def id_range(spark, first: int, last: int, template: str) -> DataFrame:
    """(id, url) of all ids in a range, by a printf template."""
    return spark.range(first, last + 1).select("id", F.format_string(template, "id").alias("url"))


def id_grid(spans: DataFrame, first_col: str, last_col: str, out_col: str, block: int = 100_000) -> DataFrame:
    """A row for each id of each span, its ends among them; spans are dealt out in blocks before they are written out."""
    begins = spans.withColumn("block_begin", F.explode(F.sequence(F.col(first_col), F.greatest(first_col, last_col), F.lit(block)))).where(F.col(first_col) <= F.col(last_col))
    return begins.repartition("block_begin").withColumn(out_col, F.explode(F.sequence("block_begin", F.least(F.col("block_begin") + block - 1, F.col(last_col))))).drop("block_begin")


def until_misses(df: DataFrame, group_col: str, id_col: str, hit_col: str, misses: int = 5, block: int = 100_000) -> DataFrame:
    """The rows of each group up to where ``misses`` ids in a row miss; the row of the last of them is there too.

    Runs of misses are counted within blocks of ids; what a run brings along from the blocks before follows from one row a block, so no window is longer than
    a block or than a group has blocks.
    """
    given = df.withColumn("block", F.floor(F.col(id_col) / block))
    inner = Window.partitionBy(group_col, "block").orderBy(id_col)
    island = given.withColumn("island", F.sum(F.col(hit_col).cast("int")).over(inner))
    run = F.row_number().over(Window.partitionBy(group_col, "block", "island").orderBy(id_col)) - F.when(F.col("island") > 0, 1).otherwise(0)
    counted = island.withColumn("run", run)
    blocks = counted.groupBy(group_col, "block").agg(F.max("island").alias("hits"), F.max_by("run", id_col).alias("open"))
    outer = Window.partitionBy(group_col).orderBy("block")
    chained = blocks.withColumn("chain", F.sum((F.col("hits") > 0).cast("int")).over(outer))
    carried = chained.withColumn("through", F.sum("open").over(Window.partitionBy(group_col, "chain").orderBy("block"))).withColumn("before", F.coalesce(F.lag("through").over(outer), F.lit(0)))
    whole = counted.join(carried.select(group_col, "block", "before"), [group_col, "block"]).withColumn("run", F.col("run") + F.when(F.col("island") == 0, F.col("before")).otherwise(0))
    stop = whole.where(F.col("run") >= misses).groupBy(group_col).agg(F.min(id_col).alias("stop_id"))
    return df.join(stop, group_col, "left").where(F.col("stop_id").isNull() | (F.col(id_col) <= F.col("stop_id"))).drop("stop_id")


def from_checkpoint(df: DataFrame, order_col: str, reached: str | None, values: list[str]) -> DataFrame:
    """The rows of the categories from the one that was reached on, in the given order; all without one."""
    if reached is None or reached not in values:
        return df
    return df.where(F.col(order_col).isin(values[values.index(reached) :]))


def problem_thread(source: Column, url: Column, section: Column, title: Column, problem: Column, solution: Column, images: Column, scraped_at: Column) -> Column:
    """A thread of two posts, problem and solution, under a title of section and name."""

    def post(i: int, content: Column, image: Column) -> Column:
        return F.struct(F.lit(i).alias("index"), source.alias("author"), F.lit(None).cast("string").alias("date"), content.alias("content"), image.alias("contains_images"))

    return F.struct(source.alias("source"), url.alias("url"), F.concat_ws(" – ", section, title).alias("title"), scraped_at.alias("scraped_at"), F.array(post(0, problem, images), post(1, solution, F.lit(False))).alias("posts"))


def batches(df: DataFrame, order_cols: list[str], size: int) -> DataFrame:
    """The rows with ``batch``: runs of ``size`` rows in the given order, numbered by a sort and partition offsets, not by one window over all."""
    ordered = df.orderBy(*order_cols)
    spread = ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    kept = cut(spread)
    sizes = kept.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy("part").collect()  # a row a partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], r["first"], before))
        before += r["n"]
    table = df.sparkSession.createDataFrame(offsets, "part int, first bigint, before bigint")
    return kept.join(table, "part").withColumn("batch", F.floor((F.col("at") - F.col("first") + F.col("before")) / size)).drop("part", "at", "first", "before")


def metadata_keys(df: DataFrame, col: str) -> list[str]:
    """All keys that the rows' maps have, sorted; the columns of a flat table."""
    found = df.select(F.explode(F.map_keys(col)).alias("key")).distinct()
    return sorted(r["key"] for r in found.collect())


def flat_metadata(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    """A column for each key, null where a row lacks it; marks of where a row came from are left out."""
    keep = [k for k in (keys or metadata_keys(df, col)) if k not in ("_source_path", "_source_repo")]
    return df.select(*[c for c in df.columns if c != col], *[F.try_element_at(F.col(col), F.lit(k)).alias(k) for k in keep])
