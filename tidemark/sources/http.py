"""Fetching by a Python data source: one partition per slice of urls, retries inside the reader."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Statuses that are tried again, and the limits of waiting.
RETRY = (429, 500, 502, 503, 504)
RETRIES, TIMEOUT, FIRST_WAIT, LONGEST_WAIT = 3, 60.0, 0.5, 30.0


def backoff(attempt: int, retry_after: str | None = None, jitter: float | None = None) -> float:
    """Seconds to wait: what the server asks for, else twice as long each time, never over the limit."""
    if retry_after and retry_after.strip().isdigit():
        return min(float(retry_after), LONGEST_WAIT)
    wait = min(FIRST_WAIT * 2**attempt, LONGEST_WAIT)
    return min(LONGEST_WAIT, wait + (random.uniform(0, wait / 4) if jitter is None else jitter))


def fetch(url: str, open_=urllib.request.urlopen, sleep=time.sleep) -> tuple[int | None, bytes | None, str | None]:
    """(status, body, error) of a url after its retries."""
    for attempt in range(RETRIES + 1):
        try:
            with open_(url, timeout=TIMEOUT) as r:
                return r.status, r.read(), None
        except urllib.error.HTTPError as e:
            if e.code not in RETRY or attempt == RETRIES:
                return e.code, None, str(e)
            sleep(backoff(attempt, e.headers.get("Retry-After") if e.headers else None))
        except OSError as e:
            if attempt == RETRIES:
                return None, None, str(e)
            sleep(backoff(attempt))
    return None, None, "no attempt"


def exists(url: str, open_=urllib.request.urlopen) -> bool:
    """Whether a url answers 200: asked by HEAD, and by GET without reading the body where HEAD is not allowed (405)."""
    for method in ("HEAD", "GET"):
        try:
            with open_(urllib.request.Request(url, method=method), timeout=TIMEOUT) as r:
                return r.status == 200
        except urllib.error.HTTPError as e:
            if e.code != 405:
                return False
        except (OSError, ValueError):
            return False
    return False


def probed(df: DataFrame, url: str = "url", name: str = "exists", probe: Callable[[str], bool] = exists, wait: float = 0.0) -> DataFrame:
    """``df`` with a column that says whether each url exists; a null url does not.  A batch asks once for a url it holds often, each after ``wait`` seconds."""

    @F.pandas_udf("boolean")
    def asked(urls: pd.Series) -> pd.Series:
        known: dict[str, bool] = {}
        for u in urls.dropna().unique():
            time.sleep(wait)
            known[u] = probe(u)
        return urls.map(lambda u: known.get(u, False)).astype(bool)

    return df.withColumn(name, asked(F.col(url)))


class _Slice(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.slices = max(1, int(options.get("slices", "8")))

    def partitions(self):
        return [_Slice(self.urls[i :: self.slices]) for i in range(self.slices) if self.urls[i :: self.slices]]

    def read(self, partition):
        for url in partition.urls:
            yield (url, *fetch(url))


class HttpDataSource(DataSource):
    """``spark.read.format("tidemark_http").option("urls", newline-separated)``: (url, status, body, error)."""

    @classmethod
    def name(cls):
        return "tidemark_http"

    def schema(self):
        return "url string, status int, body binary, error string"

    def reader(self, schema):
        return _Reader(self.options)
