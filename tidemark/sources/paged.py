"""A source of records that come in pages, as a Python data source.

Pages are partitions: each is fetched by a task, with retries and growing
pauses, and a page that is short ends its run. `maxpages` is a limit asked for;
without it a source that doesn't end within a million pages is an error. What fetches a page is given by
name, `module:function`, and called with (page, page_size); it returns a list
of dicts. No network client is part of this library.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PageRange(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    def __init__(self, schema, options: dict) -> None:
        self.names = schema.fieldNames()
        self.fetch = options["fetch"]
        self.size = int(options.get("pagesize", 1000))
        self.pages = int(options.get("maxpages", 1_000_000))
        self.limited = "maxpages" in options
        self.tasks = int(options.get("tasks", 1))
        self.tries = int(options.get("tries", 4))
        self.pause = float(options.get("pause", 1.0))

    def partitions(self) -> list[PageRange]:
        each = -(-self.pages // self.tasks)
        return [PageRange(a, min(a + each, self.pages)) for a in range(0, self.pages, each)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        for page in range(partition.first, partition.last):
            rows = self._retried(fetch, page)
            for row in rows:
                yield tuple(row.get(n) for n in self.names)
            if len(rows) < self.size:
                return
        if partition.last == self.pages and not self.limited:
            raise RuntimeError(f"no end within {self.pages} pages; set maxpages to stop there")

    def _retried(self, fetch, page: int) -> list[dict]:
        for attempt in range(self.tries):
            try:
                return fetch(page, self.size)
            except OSError:
                if attempt + 1 == self.tries:
                    raise
                time.sleep(self.pause * 2**attempt)
        return []


class PagedSource(DataSource):
    """`spark.read.format("paged").schema(...).option("fetch", "module:function").load()`"""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)
