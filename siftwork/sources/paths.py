"""Files and folders of any filesystem that the session's Hadoop configuration knows: local paths, file://, hdfs://, s3a:// and others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool

    @property
    def suffixes(self) -> list[str]:
        return ["." + s for s in self.name.split(".")[1:]]

    @property
    def stem(self) -> str:
        return self.name.split(".")[0] if self.suffixes[-1:] in ([".gz"], [".bz2"], [".zst"]) else self.name.rpartition(".")[0] or self.name


def _status(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entry(spark: SparkSession, path: str) -> Entry | None:
    """What lies there; None where nothing does."""
    fs, p = _status(spark, path)
    if not fs.exists(p):
        return None
    found = fs.getFileStatus(p)
    return Entry(path, p.getName(), found.isDirectory())


def children(spark: SparkSession, path: str) -> list[Entry]:
    """What lies in a folder, by name."""
    fs, p = _status(spark, path)
    return sorted((Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)), key=lambda e: e.name)
