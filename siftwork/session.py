"""Session factory for local work and tests, and the package for the workers of any session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    return SparkSession.builder.master(f"local[{cores}]").config(map=conf).getOrCreate()


#: Applications that have the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the application's Python workers, once, so they can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    if not package.is_dir():
        return  # it runs from an archive that was shipped already
    folder = tempfile.mkdtemp(prefix="siftwork-ship-")
    atexit.register(shutil.rmtree, folder, True)
    archive = Path(folder) / "siftwork.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, str(p.relative_to(package.parent)))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
