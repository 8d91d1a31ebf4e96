"""What is reached over a network: models, pages, dataset hubs.  Transports are given by the caller, but for a plain HTTP one."""

from __future__ import annotations

import io
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: Answers of a server that may be better the next time.
AGAIN = (500, 502, 503, 504)


def http_get(url: str, timeout: float = 15.0, agent: str = "siftwork") -> tuple[int, bytes]:
    """(status, body) of a GET; raises OSError where there is no answer."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


class ChatModel:
    """A model behind an endpoint that takes chat messages: (system, user) -> answer.  Retries and time limits are those of curation.ask."""

    def __init__(self, base_url: str, model: str, key: str = "", temperature: float = 0.0, timeout: float = 60.0):
        self.url, self.model, self.key, self.temperature, self.timeout = base_url.rstrip("/") + "/chat/completions", model, key, temperature, timeout

    def __call__(self, system: str, user: str) -> str:
        asked = {"model": self.model, "temperature": self.temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(asked).encode(), headers), timeout=self.timeout) as r:
            answer = json.load(r)["choices"][0]["message"]["content"]
        if not answer:
            raise ValueError("the model said nothing")
        return answer


class PageFetcher:
    """Pages by a given ``get`` (url -> status, body).

    429 doubles the wait each time; 5xx and errors of the network wait ``step`` seconds longer each time; 404 and other answers
    are no page.  ``pause`` has the bounds of a random wait before each page.
    """

    def __init__(self, get: Callable, sleep: Callable[[float], None] = time.sleep, attempts: int = 5, first_wait: float = 5.0, step: float = 3.0, pause: tuple[float, float] | None = None):
        self.get, self.sleep, self.attempts, self.first_wait, self.step, self.pause = get, sleep, attempts, first_wait, step, pause

    def __call__(self, url: str):
        if self.pause:
            self.sleep(random.uniform(*self.pause))
        wait = self.first_wait
        for k in range(1, self.attempts + 1):
            try:
                status, body = self.get(url)
            except OSError:
                status, body = 0, None
            if status == 200:
                return body
            if status == 429:
                self.sleep(wait)
                wait *= 2
            elif status == 0 or status in AGAIN:
                if k < self.attempts:
                    self.sleep(self.step * k)
            else:
                return None
        return None


def fetch_pages(urls: DataFrame, url_col: str, fetcher: Callable) -> DataFrame:
    """The rows with ``body``, binary; null where there is no page."""

    @F.pandas_udf("binary")
    def fetch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            got = [fetcher(u) if u is not None else None for u in b]
            yield pd.Series([x.encode() if isinstance(x, str) else x for x in got], dtype=object)

    return urls.withColumn("body", fetch.asNondeterministic()(F.col(url_col)))


def read_remote(spark: SparkSession, name: str, shards: list[str], fetch: Callable[[str], bytes], limit: int | None = None) -> DataFrame:
    """Rows of a remote dataset given as Parquet shards, each fetched by the task that reads it; ``limit`` rows of a shard at most.

    The schema is that of the first shard.  ``_source_repo`` has the dataset's name.
    """
    if not shards:
        raise FileNotFoundError(f"no shards of {name}")
    schema = pq.read_schema(io.BytesIO(fetch(shards[0])))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column(0).to_pylist():
                left = limit
                for rows in pq.ParquetFile(io.BytesIO(fetch(shard))).iter_batches():
                    if left is not None:
                        rows, left = rows.slice(0, left), max(0, left - rows.num_rows)
                    yield rows.cast(schema)

    listed = spark.createDataFrame([(s,) for s in shards], "shard string").repartition(len(shards))
    return listed.mapInArrow(read, from_arrow_schema(schema)).withColumn("_source_repo", F.lit(name))
