"""Sources: tables, JSON lines (tolerant), Arrow dataset folders, and unions of several of them."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siftwork.functions.latex import repair_json_escapes
from siftwork.schema import BENCHMARK, THREAD
from siftwork.sources import paths

#: Fixed value: the file that marks a folder as a saved dataset.
MARKER = "dataset_info.json"
_LINES = (".json", ".jsonl")


def is_dataset_dir(spark: SparkSession, path: str) -> bool:
    return paths.entry(spark, f"{path}/{MARKER}") is not None


class _ArrowFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _batches(path: str, schema_only: bool = False):
    """Record batches of an Arrow file or stream on any filesystem that Arrow knows; local ones are mapped, not read."""
    import pyarrow as pa
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    with pa.memory_map(inner) if isinstance(filesystem, fs.LocalFileSystem) else filesystem.open_input_file(inner) as source:
        try:
            stream = pa.ipc.open_stream(source)
            if schema_only:
                yield stream.schema
            else:
                yield from stream
        except pa.ArrowInvalid:
            source.seek(0)
            file = pa.ipc.open_file(source)
            if schema_only:
                yield file.schema
            else:
                for i in range(file.num_record_batches):
                    yield file.get_batch(i)


class _ArrowReader(DataSourceReader):
    def __init__(self, shards: list[str]):
        self.shards = shards

    def partitions(self) -> list[InputPartition]:
        return [_ArrowFile(p) for p in self.shards]

    def read(self, partition: InputPartition) -> Iterator:
        yield from _batches(partition.path)


class ArrowDataset(DataSource):
    """``spark.read.format("arrow_dataset").option("shards", <JSON list of paths>).load()``: a partition a shard file, batches read without conversion to rows."""

    @classmethod
    def name(cls) -> str:
        return "arrow_dataset"

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(next(_batches(json.loads(self.options["shards"])[0], schema_only=True)))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ArrowReader(json.loads(self.options["shards"]))


def read_arrow(spark: SparkSession, folder: str) -> DataFrame:
    """A saved dataset: the shards ``*.arrow`` of a folder."""
    shards = [c.path for c in paths.children(spark, folder) if c.name.endswith(".arrow")]
    if not shards:
        raise FileNotFoundError(f"no shards in {folder}")
    spark.dataSource.register(ArrowDataset)
    return spark.read.format("arrow_dataset").option("shards", json.dumps(shards)).load()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, of which one whose backslashes are no escapes is repaired; blank and hopeless lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    sound = F.try_parse_json("value").isNotNull()
    asked = F.from_json(F.when(sound, F.col("value")).otherwise(repair_json_escapes(F.col("value"))), schema)
    return lines.select(asked.alias("row")).where(F.exists(F.array(*[F.col(f"row.`{f.name}`").isNotNull() for f in schema.fields]), lambda x: x)).select("row.*")


def read_benchmark(spark: SparkSession, path: str, task_key: str = "task", solution_key: str = "solution", id_key: str = "task_id") -> DataFrame:
    """task_id, task, solution, answer, type, benchmark_name and ordinal of a file, a folder of ``*.jsonl`` or a saved dataset.

    Task, solution and id are read from the columns of those names.  ``ordinal`` numbers the rows of a file of one piece from 0; beyond, the numbers are still all different.
    """
    found = paths.entry(spark, path)
    if found is None:
        raise FileNotFoundError(path)
    names = {"task_id": id_key, "task": task_key, "solution": solution_key}
    asked = T.StructType([T.StructField(names.get(f.name, f.name), f.dataType) for f in BENCHMARK.fields])

    def named(df: DataFrame, stem: str) -> DataFrame:
        have = [(F.col(names.get(f.name, f.name)) if names.get(f.name, f.name) in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in BENCHMARK.fields]
        return df.select(*have, F.lit(stem).alias("benchmark_name"), F.monotonically_increasing_id().alias("ordinal"))

    if found.is_dir and is_dataset_dir(spark, path):
        return named(read_arrow(spark, path), found.name)
    files = [c for c in paths.children(spark, path) if c.name.endswith(".jsonl")] if found.is_dir else [found]
    return union_sources([named(read_json_lines(spark, f.path, asked), f.stem) for f in files])


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, THREAD)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """One source by what it is: JSON lines (gzip too), a Parquet file or folder, a saved dataset, a folder of saved datasets; on any filesystem of the session."""
    found = paths.entry(spark, path)
    if found is None:
        raise FileNotFoundError(f"no dataset in {path}")
    if not found.is_dir:
        if any(s in _LINES for s in found.suffixes):
            df = spark.read.json(path)
        elif found.suffixes[-1:] == [".parquet"]:
            df = spark.read.parquet(path)
        else:
            raise FileNotFoundError(f"no dataset in {path}")
    elif is_dataset_dir(spark, path):
        df = read_arrow(spark, path)
    else:
        inside = paths.children(spark, path)
        if parts := [c for c in inside if c.is_dir and is_dataset_dir(spark, c.path)]:
            return union_sources([read_source(spark, c.path) for c in parts])
        if any(c.name.endswith(".parquet") for c in inside):
            df = spark.read.parquet(path)
        else:
            raise FileNotFoundError(f"no dataset in {path}")
    return df.withColumn("_source_path", F.lit(path))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows; a column that a source lacks is null in its rows."""
    if not frames:
        raise ValueError("no sources")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_sources(spark: SparkSession, paths_: list[str], limit: int | None = None, order_cols: list[str] | None = None) -> DataFrame:
    """Several sources, at most ``limit`` rows of each: the first by ``order_cols``, else by a hash of the whole row, so the same ones each time."""
    frames = [read_source(spark, p) for p in paths_]
    if limit is not None:
        frames = [f.orderBy(*(order_cols or [F.xxhash64(F.to_json(F.struct(*f.columns)))])).limit(limit) for f in frames]
    return union_sources(frames)


def done_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url) of the records already written; lines that don't parse or have none are left out."""
    lines = spark.read.text(path)
    return lines.select(F.try_parse_json("value").alias("v")).select(F.expr("try_variant_get(v, '$.url', 'string')").alias("url")).where("url is not null").distinct()
