"""Paged sources (A1, A11, A20): a service that answers in pages of JSON lists, as a Spark data source for batches and streams.

``spark.read.format("paged")`` takes an address with the places {season}, {week} and {page} (or {offset}, in rows), over http, https or file. Each season and week is an
endpoint and one partition: its pages are read in turn until one is short, empty or missing. Filters on season and week are pushed down, so endpoints that they
rule out are never asked. A page that fails is asked again, a few times, before the task fails and Spark repeats it.

As a stream the offset is a mark of rows for each endpoint: a batch takes what lies between two marks, a page that was short is looked at again later, and a restart goes on
from the marks in the checkpoint. ``pagesPerTrigger`` bounds what one batch takes of an endpoint.

Options: url, seasons, weeks (comma-separated, either may be missing), pageSize (1000), retries (3), wait (0.2 s, doubled each time), pagesPerTrigger (100).
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any
from urllib.error import HTTPError, URLError
from urllib.request import urlopen

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

KEYS = ("season", "week")


@dataclass(frozen=True)
class Endpoint(InputPartition):
    season: int | None
    week: int | None
    first: int = 0  # rows
    last: int | None = None

    @property
    def name(self) -> str:
        return f"{'' if self.season is None else self.season}/{'' if self.week is None else self.week}"


class Pages:
    """What both readers share: the endpoints and how a page is asked for."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        held = {k.lower(): v for k, v in options.items()}
        numbers = lambda k: [int(x) for x in held.get(k, "").split(",") if x.strip()] or [None]
        self.schema, self.url, self.size = schema, held["url"], int(held.get("pagesize", 1000))
        self.retries, self.wait, self.most = int(held.get("retries", 3)), float(held.get("wait", 0.2)), int(held.get("pagespertrigger", 100))
        self.endpoints = [Endpoint(s, w) for s in numbers("seasons") for w in numbers("weeks")]
        if self.size < 1:
            raise ValueError("pageSize must be positive")

    def page(self, at: Endpoint, number: int) -> list[dict]:
        """The rows of one page; a page that is not there is empty."""
        address = self.url.format(season=at.season, week=at.week, page=number, offset=number * self.size)
        for turn in range(self.retries + 1):
            try:
                with urlopen(address, timeout=30) as reply:
                    rows = json.loads(reply.read() or b"[]")
                return rows if isinstance(rows, list) else rows.get("data") or []
            except HTTPError as e:
                if e.code == 404:
                    return []
                if turn == self.retries or e.code < 500 and e.code != 429:
                    raise
            except URLError as e:
                if isinstance(e.reason, FileNotFoundError) or "No such file" in str(e.reason):
                    return []
                if turn == self.retries:
                    raise
            except (ValueError, TimeoutError):
                if turn == self.retries:
                    raise
            time.sleep(self.wait * 2**turn)
        return []

    def rows(self, at: Endpoint) -> Iterator[list[dict]]:
        """Rows from the endpoint's first to its last one, page by page, until a page is short."""
        number = at.first // self.size
        while at.last is None or number * self.size < at.last:
            page = self.page(at, number)
            start = max(0, at.first - number * self.size)
            yield page[start : None if at.last is None else at.last - number * self.size]
            if len(page) < self.size:
                return
            number += 1

    def tuples(self, at: Endpoint) -> Iterator[tuple]:
        for page in self.rows(at):
            for row in page:
                yield tuple(self._value(f, row.get(f.name), at) for f in self.schema.fields)

    @staticmethod
    def _value(field: T.StructField, value: Any, at: Endpoint) -> Any:
        """A value as its column wants it; season and week are the endpoint's where a row lacks them."""
        if value is None and field.name in KEYS:
            value = getattr(at, field.name)
        if value is None:
            return None
        kind = field.dataType
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
        if isinstance(kind, T.IntegralType):
            return int(value)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return float(value)
        if isinstance(kind, T.DateType):
            return date.fromisoformat(value)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return datetime.fromisoformat(value)
        return value


class PagedReader(DataSourceReader):
    def __init__(self, pages: Pages):
        self.pages = pages

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equalities on season and week choose endpoints. Where rows bring their own values, Spark still has to compare them, so all filters stay."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in KEYS:
                wanted = set(f.value) if isinstance(f, In) else {f.value}
                name = f.attribute[0]
                self.pages.endpoints = [e for e in self.pages.endpoints if getattr(e, name) is None or getattr(e, name) in wanted]
            yield f

    def partitions(self) -> list[InputPartition]:
        return list(self.pages.endpoints) or [Endpoint(None, None, 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.pages.tuples(partition)


class PagedStream(DataSourceStreamReader):
    def __init__(self, pages: Pages):
        self.pages = pages
        self.marks: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {e.name: 0 for e in self.pages.endpoints}

    def latestOffset(self) -> dict:
        """How far each endpoint goes now, looked at from the last mark on."""
        for e in self.pages.endpoints:
            number = self.marks.get(e.name, 0) // self.pages.size
            for _ in range(self.pages.most):
                n = len(self.pages.page(e, number))
                self.marks[e.name] = max(self.marks.get(e.name, 0), number * self.pages.size + n)
                if n < self.pages.size:
                    break
                number += 1
        return dict(self.marks)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.marks = {k: max(v, self.marks.get(k, 0)) for k, v in end.items()}
        return [Endpoint(e.season, e.week, start.get(e.name, 0), end.get(e.name, 0)) for e in self.pages.endpoints if end.get(e.name, 0) > start.get(e.name, 0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.pages.tuples(partition)

    def commit(self, end: dict) -> None:
        self.marks = {k: max(v, self.marks.get(k, 0)) for k, v in end.items()}

    def stop(self) -> None:
        pass


class Paged(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> T.StructType:
        raise ValueError("state the columns by .schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(Pages(schema, self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedStream(Pages(schema, self.options))


def use_pages(spark: SparkSession) -> None:
    """Make the format known, and filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Paged)
