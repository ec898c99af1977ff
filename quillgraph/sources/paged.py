"""A source that pulls pages by a resumption token, as a stream or, in date ranges side by side, as a batch.

The transport is a class that fetches one page for a token: over HTTP in production, from a list in tests. Pages that
fail are tried again. The offset of the stream is the token, so a restart resumes at the page that was not stored; as
each token comes with the page before, the stream reads one page after the other. A batch has a task for each range of
the option ``ranges``, which follows that range's tokens to the end; a task that is lost starts its range again.
"""

from __future__ import annotations

import importlib
import time
import urllib.parse
import urllib.request
from collections import deque
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


@dataclass
class Page:
    rows: list[tuple]
    next_token: str
    total: int = 0


class RateLimit:
    """At most ``most`` requests in any ``seconds``; the limit can follow what a server announces."""

    def __init__(self, most: int = 49, seconds: float = 2.1, clock=time.monotonic, sleep=time.sleep):
        self.most, self.seconds, self.clock, self.sleep = most, seconds, clock, sleep
        self.times: deque[float] = deque()

    def adapt(self, headers: dict[str, str]) -> None:
        """Follow X-Rate-Limit-Limit and X-Rate-Limit-Interval ('1s')."""
        most, interval = headers.get("X-Rate-Limit-Limit"), headers.get("X-Rate-Limit-Interval")
        if most and most.isdigit() and interval and interval.rstrip("s").isdigit():
            self.most, self.seconds = int(most), float(interval.rstrip("s"))

    def wait(self) -> None:
        while self.times and self.clock() - self.times[0] >= self.seconds:
            self.times.popleft()
        if len(self.times) >= self.most:
            self.sleep(max(0.0, self.seconds - (self.clock() - self.times.popleft())))
        self.times.append(self.clock())


def with_retry(call, tries: int = 3, pause: float = 2.0, sleep=time.sleep):
    """Call until it succeeds, at most ``tries`` times."""
    for n in range(tries):
        try:
            return call()
        except Exception:
            if n + 1 == tries:
                raise
            sleep(pause)


class HttpPages:
    """OAI-PMH over HTTP: the first request by date, the others by token; 503 waits and tries again, others raise."""

    def __init__(self, options: dict[str, str]):
        self.base, self.start, self.prefix, self.until = options["url"], options.get("from", ""), options.get("prefix", "arXiv"), options.get("until", "")

    def address(self, token: str) -> str:
        query = {"verb": "ListRecords", "resumptionToken": token} if token else {"verb": "ListRecords", "from": self.start, "metadataPrefix": self.prefix}
        if self.until and not token:
            query["until"] = self.until
        return f"{self.base}?{urllib.parse.urlencode(query)}"

    def fetch(self, token: str) -> Page:
        import re

        while True:
            try:
                with urllib.request.urlopen(self.address(token), timeout=60) as r:  # noqa: S310
                    text = r.read().decode("utf-8", "replace")
                break
            except urllib.error.HTTPError as e:
                if e.code != 503:
                    raise
                time.sleep(float(e.headers.get("Retry-After", 10)))
        token_found = re.search(r"(?s)<resumptionToken[^>]*>(.*?)</resumptionToken>", text)
        size = re.search(r'completeListSize="(\d+)"', text)
        return Page([(text,)], token_found[1].strip() if token_found else "", int(size[1]) if size else 0)


def transport(options: dict[str, str]):
    """The transport that the options name as module:class."""
    module, _, name = options.get("transport", f"{__name__}:HttpPages").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Range(InputPartition):
    start: str
    until: str


class RangeReader(DataSourceReader):
    """A task for each range of dates, from..until inclusive, parted by commas; without ranges one task reads all.

    The service's limit of requests is shared out evenly, as tasks may all run at once.
    """

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[Range]:
        bounds = [r.strip().partition("..") for r in self.options.get("ranges", "").split(",") if r.strip()]
        return [Range(start, until) for start, _, until in bounds] or [Range(self.options.get("from", ""), self.options.get("until", ""))]

    def read(self, partition: Range):
        pages, tasks = transport(self.options | {"from": partition.start, "until": partition.until}), len(self.partitions())
        limit, token = RateLimit(1, RateLimit().seconds * tasks / RateLimit().most), ""
        while True:
            limit.wait()
            page = with_retry(lambda at=token: pages.fetch(at))
            yield from page.rows
            token = page.next_token
            if not token:
                return


class PagedReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.transport = transport(options)
        self.first, self.limit = options.get("token", ""), RateLimit()

    def initialOffset(self) -> dict:
        return {"token": self.first, "pages": 0, "done": False}

    def read(self, start: dict) -> tuple:
        if start["done"]:
            return iter(()), start
        self.limit.wait()
        page = with_retry(lambda: self.transport.fetch(start["token"]))
        return iter(page.rows), {"token": page.next_token, "pages": start["pages"] + 1, "done": not page.next_token}

    def readBetweenOffsets(self, start: dict, end: dict):
        rows, at = [], start
        while at["pages"] < end["pages"]:
            more, at = self.read(at)
            rows += list(more)
        return iter(rows)


class PagedSource(DataSource):
    """spark.dataSource.register(PagedSource); spark.readStream or spark.read.format("paged").option("transport", "module:Class")"""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options.get("schema", "page string")

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)

    def simpleStreamReader(self, schema) -> PagedReader:
        return PagedReader(self.options)
