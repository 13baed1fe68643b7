"""A paged service as a Spark data source, for batches and streams.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").option("service", "my_module:fetch").option("resources", "a,b").load()

``service`` names a function ``fetch(resource, cursor, page_size)`` that gives a dict of
results (dicts), next_cursor and has_more, or raises ``Busy``. A cursor is known only
from the page before, so a resource is read in order by one task; resources are read
beside each other. In a stream the cursor after the last page is where later results
begin; the offset of a stream is each resource's cursor, so that one which fails goes on
where its last finished batch ended, and its batches can be read again.

Columns are ``resource`` and ``result``, a result's JSON, unless a schema is given: then
they are the results' fields of these names, and ``resource``.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructType

from threadloom.sources.exports import SourceError


class Busy(RuntimeError):
    """The service asks to wait."""

    def __init__(self, seconds: float = 0.0):
        super().__init__(f"busy for {seconds} s")
        self.seconds = seconds


def one_page(fetch: Callable[[str | None], dict], cursor: str | None, page_size: int, attempts: int, wait: Callable[[float], None]) -> dict:
    for attempt in range(attempts):
        try:
            page = fetch(cursor)
            break
        except Busy as busy:
            if attempt == attempts - 1:
                raise SourceError("the service stays busy") from busy
            wait(busy.seconds or 2.0**attempt)
    if len(page["results"]) > page_size:
        raise SourceError(f"a page of more than {page_size} results")
    return page


def paged(fetch: Callable[[str | None], dict], cursor: str | None = None, stop: str | None = None, page_size: int = 100, attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """Results from ``cursor`` on, page by page, up to the cursor ``stop`` or the end."""
    while True:
        page = one_page(fetch, cursor, page_size, attempts, wait)
        yield from page["results"]
        before, cursor = cursor, page.get("next_cursor")
        if not page.get("has_more") or (stop is not None and cursor == stop):
            return
        if cursor is None or cursor == before:
            raise SourceError("more results, but no way to them")


@dataclass
class Range(InputPartition):
    resource: str
    start: str | None
    stop: str | None


class _Reader:
    def __init__(self, schema: StructType, options: dict):
        self.fields = [(f.name, isinstance(f.dataType, StringType)) for f in schema.fields]
        self.raw = schema.fieldNames() == ["resource", "result"]
        module, _, name = options.get("service", "").partition(":")
        if not module or not name:
            raise SourceError("the option service names a function as module:function")
        self.module, self.name = module, name
        self.resources = [r.strip() for r in options.get("resources", "").split(",") if r.strip()]
        self.page_size, self.attempts = int(options.get("page_size", 100)), int(options.get("attempts", 5))

    def fetch(self, resource: str) -> Callable[[str | None], dict]:
        service = getattr(importlib.import_module(self.module), self.name)
        return lambda cursor: service(resource, cursor, self.page_size)

    def row(self, resource: str, result: dict) -> tuple:
        if self.raw:
            return resource, json.dumps(result, sort_keys=True)
        given = {**result, "resource": resource}
        # What isn't text where text is asked for stays readable as JSON.
        return tuple(v if v is None or not text or isinstance(v, str) else json.dumps(v, sort_keys=True) for v, text in ((given.get(name), text) for name, text in self.fields))

    def read(self, partition: Range) -> Iterator[tuple]:
        for result in paged(self.fetch(partition.resource), partition.start, partition.stop, self.page_size, self.attempts):
            yield self.row(partition.resource, result)


class PagedReader(_Reader, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [Range(r, None, None) for r in self.resources]


class PagedStreamReader(_Reader, DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        super().__init__(schema, options)
        self.reached: dict | None = None

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.resources)

    def latestOffset(self) -> dict:
        """Each resource's cursor after its last page. Only cursors are kept; tasks read the results.

        A reader that is new walks from the beginning, as cursors can't be compared: an end
        part of the way might lie before the checkpoint's start.
        """
        at = dict(self.reached or self.initialOffset())
        for resource in self.resources:
            while True:
                page = one_page(self.fetch(resource), at[resource], self.page_size, self.attempts, time.sleep)
                if page.get("next_cursor") is not None:
                    at[resource] = page["next_cursor"]
                if not page.get("has_more"):
                    break
        self.reached = at
        return dict(at)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Range(r, start.get(r), end[r]) for r in end if start.get(r) != end[r]]

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "resource string, result string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PagedStreamReader(schema, self.options)
