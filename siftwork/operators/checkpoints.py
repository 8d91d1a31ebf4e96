"""Cutting lineage in a folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the session names in spark.checkpoint.dir; sets a temporary one only where none is named, as in tests on one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if named := spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(named)
        return
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="siftwork-")
    atexit.register(shutil.rmtree, own, True)
    sc.setCheckpointDir(own)


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder; it survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop(df: DataFrame) -> None:
    """Removes what ``cut`` kept for a frame that nothing reads any more."""
    spark = df.sparkSession
    kept = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if kept.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(kept.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
