"""How a scan is spread over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Session setting: into how many pieces work that is heavy for each row deals out its scans.
DEAL = "spark.siftwork.deal"


def dealt(scan: DataFrame) -> DataFrame:
    """The scan as its files lie; dealt out into as many pieces as the session asks for in DEAL, where it does.

    Nothing goes by the size of the input: a session over a few small files may set DEAL so that all its cores have work, one over a large corpus leaves it unset and shuffles no text.
    """
    pieces = scan.sparkSession.conf.get(DEAL, None)
    return scan.repartition(int(pieces)) if pieces else scan
