"""``paged_json``: a Spark Python data source for paged JSON endpoints.

A page is ``{"sumary": {"total_pages", "current_page", "total_records"}, "data": [records]}``.
The planner fetches page 1 once (for ``total_pages``) and hands its payload to the first
input partition, so page 1 is never fetched twice; the remaining pages are spread over
partitions of ``pages_per_partition`` pages, fetched in parallel by the executors. The
page fetcher is pluggable (``fetcher`` option, ``module:function`` taking
``(options, page) -> dict``); the built-in one reads ``<path>/page_%05d.json`` files.

Every field is delivered as text, to be cleaned by the Silver functions (tolerant numbers, dates
and booleans), so one odd value never stops a read.

Options: ``columns`` (field names, comma-separated), ``path``, ``max_pages``, ``pages_per_partition``,
``start`` / ``end`` (ISO dates, passed to the fetcher as ``dd/MM/yyyy`` in ``params``),
``pause_seconds`` (pause between two page requests of the same partition: the endpoint's
rate limit applies per task, and total request rate = tasks running x 1 / pause).
"""
from __future__ import annotations

import datetime as _dt
import importlib
import json
import os
import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def to_api_date(iso: str) -> str:
    """ISO date to the ``dd/MM/yyyy`` request parameter."""
    return _dt.date.fromisoformat(iso[:10]).strftime("%d/%m/%Y")


def file_fetcher(options: dict, page: int) -> dict:
    """Reads ``<path>/page_%05d.json`` (a folder that every executor sees)."""
    with open(os.path.join(options["path"], f"page_{page:05d}.json"), encoding="utf-8") as fh:
        return json.load(fh)


def _resolve(options: dict):
    spec = options.get("fetcher")
    if not spec:
        return file_fetcher
    mod, fn = spec.split(":")
    return getattr(importlib.import_module(mod), fn)


class PageBlock(InputPartition):
    def __init__(self, pages: list[int], first_payload: str | None = None):
        self.pages = pages
        self.first_payload = first_payload


class PagedJsonReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.options = dict(options)
        params = {}
        # The endpoint's request parameters.
        if self.options.get("start"):
            params["data_assinatura_inicio"] = to_api_date(self.options["start"])
        if self.options.get("end"):
            params["data_assinatura_fim"] = to_api_date(self.options["end"])
        self.options["params"] = json.dumps(params)

    def partitions(self):
        fetch = _resolve(self.options)
        first = fetch(self.options, 1)
        total = int(first.get("sumary", {}).get("total_pages") or 1)
        if self.options.get("max_pages"):
            total = min(total, int(self.options["max_pages"]))
        per = max(1, int(self.options.get("pages_per_partition", 1)))
        blocks = [PageBlock([1], json.dumps(first))]
        rest = list(range(2, total + 1))
        blocks += [PageBlock(rest[i:i + per]) for i in range(0, len(rest), per)]
        return blocks

    def read(self, partition: PageBlock):
        fetch = _resolve(self.options)
        fields = self.schema.fields
        pause = float(self.options.get("pause_seconds", 0) or 0)
        for i, page in enumerate(partition.pages):
            if i and pause:
                time.sleep(pause)
            payload = (json.loads(partition.first_payload) if page == 1 and partition.first_payload
                       else fetch(self.options, page))
            for rec in payload.get("data") or []:
                yield tuple(page if f.name == "_page" else as_text(rec.get(f.name)) for f in fields)


def as_text(value) -> str | None:
    """A JSON value as text: booleans in lower case, nested values as JSON."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


class PagedJsonDataSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return ", ".join(f"{c} string" for c in self.options.get("columns", "id").split(",")) + ", _page int"

    def reader(self, schema: StructType):
        return PagedJsonReader(schema, self.options)


def register(spark) -> None:
    spark.dataSource.register(PagedJsonDataSource)
