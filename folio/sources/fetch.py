"""The fetch job: addresses in, response rows out."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Mapping
from itertools import chain

import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.number import number_in_groups
from folio.schemas import FETCH_LOG
from folio.session import materialize

# Request header, request timeout and pause, in seconds.
HEADERS = {"User-Agent": "Mozilla/5.0"}
TIMEOUT_S = 10.0
INTERVAL_S = 1.0

# (address, headers, timeout) -> (status, body) or (status, body, charset); raises when the request fails
Transport = Callable[[str, Mapping[str, str], float], tuple]

FLUSH_BYTES = 16 << 20
START_S = 1.5


def stated_charset(content_type: str | None) -> str | None:
    """The charset a Content-Type header names."""
    found = re.search(r"""charset\s*=\s*["']?([^\s;"']+)""", content_type or "", re.I)
    return found[1] if found else None


def requests_transport(url: str, headers: Mapping[str, str], timeout: float) -> tuple[int, bytes, str | None]:
    """Transport over the ``requests`` package, where the executors have it."""
    import requests

    response = requests.get(url, headers=dict(headers), timeout=timeout)
    return response.status_code, response.content, stated_charset(response.headers.get("Content-Type"))


class Pace:
    """When a task may ask a host: at the address's place in the host's row, counted from a start all tasks share.

    A task that is late asks at once, but keeps the distance its lane has to keep, so the lanes of a host never
    ask more often than once an interval between them.
    """

    def __init__(self, interval: float, start: float):
        self.interval, self.start, self.last = interval, start, {}

    def due(self, host: str, place: int, lanes: int) -> float:
        planned = self.start + place * self.interval
        return max(planned, self.last[host] + lanes * self.interval) if host in self.last else planned

    def asked(self, host: str, now: float) -> None:
        self.last[host] = now


def _fetch_batches(transport: Transport, kind: str, attempt: int, headers, timeout: float, interval: float):
    columns = [field.name for field in FETCH_LOG.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next(batches, None)  # sorted and at hand before the lanes start together
        ready = BarrierTaskContext.get().allGather(repr(time.time()))
        # Tasks hear of each other with a delay of up to a second, so the start they agree on lies ahead.
        pace = Pace(interval, max(map(float, ready)) + START_S - time.time() + time.monotonic())
        rows: list[tuple] = []
        held = 0
        for batch in chain([] if first is None else [first], batches):
            for url, host, place, lanes in zip(batch["url"], batch["host"], batch["place"], batch["lanes"]):
                wait = pace.due(host, place, lanes) - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                pace.asked(host, time.monotonic())
                try:
                    status, body, *charset = transport(url, headers, timeout)
                    row = (url, kind, attempt, status, body, None, *(charset or [None]))
                    held += len(body)
                except Exception as error:  # a failed request is a row, not a failed job
                    row = (url, kind, attempt, None, None, f"{type(error).__name__}: {error}", None)
                rows.append(row)
                if held >= FLUSH_BYTES:
                    yield _frame(rows, columns)
                    rows, held = [], 0
        if rows:
            yield _frame(rows, columns)

    return run


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    frame["status"] = frame["status"].astype("Int32")
    return frame


def fetch(
    urls: DataFrame,
    transport: Transport,
    kind: str,
    attempt: int,
    headers: Mapping[str, str] = HEADERS,
    timeout: float = TIMEOUT_S,
    interval: float = INTERVAL_S,
    tasks: int | None = None,
) -> DataFrame:
    """Response rows for the distinct addresses of ``urls``.

    A host is asked once an ``interval``, however many tasks there are. The job is one barrier stage of ``tasks`` tasks
    (those that can run at once, by default), which start together. The addresses of a host are numbered, dealt to the
    tasks in turn, and each is asked when its number is due: a host of ``n`` addresses takes ``n`` intervals, a large host is
    in all tasks, and hosts are asked side by side. The result has to be read whole, as a barrier stage is.
    """
    asked = (
        urls.select("url")
        .where(F.col("url").isNotNull())
        .distinct()
        .withColumn("host", F.coalesce(F.try_parse_url(F.col("url"), F.lit("HOST")), F.lit("")))
    )
    placed = number_in_groups(asked.withColumn("mix", F.xxhash64("url")), ["host"], ["mix"], "place", "asked")
    placed = materialize(placed, "asked")
    tasks = min(tasks or urls.sparkSession.sparkContext.defaultParallelism, max(placed.count(), 1))
    return (
        placed.withColumn("task", F.pmod(F.xxhash64("host") + F.col("place"), F.lit(tasks)).cast("int"))
        .repartitionById(tasks, "task")
        .sortWithinPartitions("place")
        .select("url", "host", "place", F.least("asked", F.lit(tasks)).alias("lanes"))
        .mapInPandas(_fetch_batches(transport, kind, attempt, dict(headers), timeout, interval), FETCH_LOG, barrier=True)
    )
