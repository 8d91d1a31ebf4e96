"""Command line: ``python -m siftwork.cli dedup|decontaminate|preview|curate|crawl|split ...``."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions.text import build_text
from siftwork.operators import dedup, ngrams, sampling
from siftwork.plans import curation
from siftwork.session import ship
from siftwork.sources import readers, remote, writers

log = logging.getLogger("siftwork")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftwork")
    p.add_argument("--verbose", action="store_true", help="tell what each step does and has counted")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("dedup", "decontaminate", "preview"):
        q = sub.add_parser(name)
        q.add_argument("paths", nargs="+")
        q.add_argument("--text-key", nargs="+", default=["question", "raw_answer"])
        q.add_argument("--id-key")
        q.add_argument("--limit", type=int, help="rows of each source at most")
        q.add_argument("--output", default="out")
    sub.choices["dedup"].add_argument("--ngram", type=int, default=3)
    sub.choices["dedup"].add_argument("--bands", type=int, default=14)
    sub.choices["dedup"].add_argument("--rows", type=int, default=3)
    q = sub.choices["decontaminate"]
    q.add_argument("--ngram", type=int, default=9)
    q.add_argument("--benchmark", nargs="*", default=[], help="files, folders or saved datasets; none where an index is there")
    q.add_argument("--index-dir", help="where the index is written and read")
    for key, name in (("task", "task"), ("solution", "solution"), ("id", "task_id")):
        q.add_argument(f"--benchmark-{key}-key", default=name)
    q = sub.add_parser("curate")
    q.add_argument("threads")
    q.add_argument("--model-url", help="base address of an endpoint that takes chat messages")
    q.add_argument("--model-name", default="")
    q.add_argument("--dry-run", action="store_true", help="go by words and lengths instead of asking a model")
    q.add_argument("--output", default="out")
    q = sub.add_parser("crawl")
    q.add_argument("urls", help="text file, an address a line")
    q.add_argument("--done", help="records already written; their addresses are left out")
    q.add_argument("--output", default="out")
    q = sub.add_parser("split")
    q.add_argument("path")
    q.add_argument("--key", required=True)
    q.add_argument("--fraction", type=float, default=0.1)
    q.add_argument("--seed", type=int, default=42)
    q.add_argument("--output", default="out")
    return p


def _numbered(rows: DataFrame, id_key: str | None) -> DataFrame:
    """The rows with siftwork_row, a number of each row's own by where it lies in its files, and siftwork_id, the key that reports name."""
    numbered = rows.withColumn("siftwork_row", F.monotonically_increasing_id())
    return numbered.withColumn("siftwork_id", F.col(id_key).cast("string") if id_key else F.col("siftwork_row").cast("string"))


def _index(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if not a.benchmark:
        if not a.index_dir:
            raise SystemExit("give --benchmark or the --index-dir of an index")
        return writers.read_index(spark, a.index_dir)
    keys = (a.benchmark_task_key, a.benchmark_solution_key, a.benchmark_id_key)
    index = ngrams.build_index(readers.union_sources([readers.read_benchmark(spark, b, *keys) for b in a.benchmark]), a.ngram)
    if not a.index_dir:
        return index
    writers.write_index(index, a.index_dir)
    return writers.read_index(spark, a.index_dir)


def _write(flagged: DataFrame, output: str) -> None:
    writers.write_sides(writers.flatten(flagged).drop("siftwork_id"), "removed", output)
    if log.isEnabledFor(logging.INFO):
        for r in flagged.sparkSession.read.parquet(output).groupBy("status").count().collect():
            log.info("%s: %d rows", r["status"], r["count"])


def _model(a: argparse.Namespace) -> curation.Model:
    if a.dry_run:
        return curation.rule_model
    url = a.model_url or os.environ.get("SIFTWORK_MODEL_URL")
    if not url:
        raise SystemExit("give --model-url (or SIFTWORK_MODEL_URL), or --dry-run")
    return remote.ChatModel(url, a.model_name or os.environ.get("SIFTWORK_MODEL", ""), os.environ.get("SIFTWORK_MODEL_KEY", ""))


def main(argv: list[str] | None = None, spark: SparkSession | None = None, model: curation.Model | None = None, get=remote.http_get) -> None:
    a = parser().parse_args(argv)
    if a.verbose:
        logging.basicConfig()
        log.setLevel(logging.INFO)
    spark = spark or SparkSession.builder.appName("siftwork").getOrCreate()
    ship(spark)
    if a.command == "curate":
        full = curation.curate(readers.read_threads(spark, a.threads), "url", model or _model(a), curation.Config.from_env(os.environ))
        writers.write_records(full, f"{a.output}/clean", f"{a.output}/log", ["url", "task_idx"])
        if log.isEnabledFor(logging.INFO):
            log.info("%s", curation.statistics(full, "url").first().asDict())
        return
    if a.command == "crawl":
        urls = spark.read.text(a.urls).select(F.trim("value").alias("url")).where("url <> ''").distinct()
        if a.done:
            urls = urls.join(readers.done_urls(spark, a.done), "url", "left_anti")
        pages = remote.fetch_pages(urls, "url", remote.PageFetcher(get))
        pages.where("body is not null").write.mode("append").parquet(a.output)
        return
    if a.command == "split":
        written = writers.write_splits(sampling.exact_split(readers.read_source(spark, a.path), a.key, fraction=a.fraction, seed=a.seed), a.output)
        log.info("splits written" if written else "no rows, nothing written")
        return
    rows = readers.read_sources(spark, a.paths, a.limit)
    missing = [k for k in a.text_key if k not in rows.columns]
    if missing:
        print(f"no column {', '.join(missing)}; the text is made of the others")
    text = build_text(*[F.col(k) if k in rows.columns else F.lit("") for k in a.text_key])
    rows = _numbered(rows, a.id_key)
    if a.command == "preview":
        rows.groupBy("_source_path").count().show(truncate=False)
        rows.select("siftwork_id", F.substring(text, 1, 120).alias("text")).show(3, truncate=False, vertical=True)
    elif a.command == "dedup":
        _write(dedup.flagged(rows, "siftwork_row", text, a.bands, a.rows, a.ngram), a.output)
    else:
        _write(ngrams.flagged(rows, _index(spark, a), "siftwork_row", text, a.ngram), a.output)


if __name__ == "__main__":
    main()
