"""S3 as a source: pages of a ``$limit`` / ``$offset`` API, complete or not read at all.

Pages are landed as ``<path>/offset=<n>/<file>``: what the API answered for
that offset, as a JSON array of records or as JSON lines.  The source plans
one partition a page, of many pages one for a run of them (``pages_a_task``),
and proves from the folder names, before anything is read, that the offsets
run 0, limit, 2 * limit, ... without gap or overlap.
The tasks prove the rest from the records: every page but the last is full,
and the last one is not -- an API shows its end by a page with fewer records
(an empty one, if the number of records is a multiple of the limit).  A page
that breaks this fails the query with its offset.

Names and pages are read through the Arrow file systems (local, HDFS, S3,
GCS, ...); a task reads its pages one after another, so a page is its memory.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").schema("state string, date string").option("limit", 50000).load(path)

Fields of type string take any JSON value as its text (objects and arrays as
JSON), other fields take the value as it is; fields that a record lacks are
NULL and fields outside the schema are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "paged_json"
_FOLDER = re.compile(r"offset=(\d+)$")
FEW_PAGES = 64                  # so many pages have a partition each
TASK_RECORDS = 64_000           # a run of pages stops at so many records


class IncompletePages(ValueError):
    """The landed pages are not the whole answer of the API."""


@dataclass(frozen=True)
class Page:
    """The files of one offset range; ``last`` marks the page that ends the answer."""
    offset: int
    folder: str
    last: bool


class PageRun(InputPartition):
    """Pages that one task reads, in the order of their offsets."""

    def __init__(self, pages: list[Page]):
        super().__init__(pages)
        self.pages = pages


def pages_a_task(n_pages: int, limit: int) -> int:
    """How many pages one task reads: a task has a fixed cost, which a page of many would pay each time."""
    return max(1, min(-(-n_pages // FEW_PAGES), TASK_RECORDS // limit))


def page_gaps(offsets: list[int], limit: int) -> list[str]:
    """What is wrong with a list of page offsets, in words; empty if they are complete."""
    out, expected = [], 0
    for offset in sorted(offsets):
        if offset > expected:
            out.append(f"no page for records {expected} to {offset - 1}")
        elif offset < expected:
            out.append(f"the page at offset {offset} overlaps the one before it")
        expected = offset + limit
    return out if offsets else ["no pages"]


def landed_pages(path: str) -> list[tuple[int, str]]:
    """(offset, folder) of every landed page, by offset."""
    store, root = arrow_fs.FileSystem.from_uri(path)
    found = []
    for info in store.get_file_info(arrow_fs.FileSelector(root)):
        named = _FOLDER.search(info.path)
        if named and info.type == arrow_fs.FileType.Directory:
            found.append((int(named.group(1)), info.path))
    return sorted(found)


def page_records(store: arrow_fs.FileSystem, folder: str) -> list[dict]:
    """The records of one page's files."""
    records: list[dict] = []
    for info in sorted(store.get_file_info(arrow_fs.FileSelector(folder)), key=lambda i: i.path):
        if info.base_name.startswith(("_", ".")):
            continue
        with store.open_input_stream(info.path) as stream:
            text = stream.read().decode("utf-8").strip()
        if text.startswith("["):
            found = json.loads(text)
        else:
            found = [json.loads(line) for line in text.splitlines() if line.strip()]
        if not all(isinstance(r, dict) for r in found):
            raise ValueError("not an array of records")
        records += found
    return records


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


class PagedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        if "path" not in options or "limit" not in options:
            raise ValueError("give the folder of the pages and the option 'limit'")
        self.schema, self.path, self.limit = schema, options["path"], int(options["limit"])
        if self.limit < 1:
            raise ValueError("limit must be positive")

    def partitions(self) -> list[PageRun]:
        pages = landed_pages(self.path)
        issues = page_gaps([offset for offset, _ in pages], self.limit)
        if issues:
            more = f" and {len(issues) - 5} more" if len(issues) > 5 else ""
            raise IncompletePages(f"{self.path}: {'; '.join(issues[:5])}{more}")
        found = [Page(offset, folder, i + 1 == len(pages)) for i, (offset, folder) in enumerate(pages)]
        step = pages_a_task(len(found), self.limit)
        return [PageRun(found[i:i + step]) for i in range(0, len(found), step)]

    def read(self, run: PageRun) -> Iterator[pa.RecordBatch]:
        store, _ = arrow_fs.FileSystem.from_uri(self.path)
        for page in run.pages:
            yield self._page(store, page)

    def _page(self, store: arrow_fs.FileSystem, page: Page) -> pa.RecordBatch:
        where = f"page at offset {page.offset}"
        try:
            records = page_records(store, page.folder)
        except ValueError as bad:
            raise IncompletePages(f"{where}: {bad}") from bad
        n = len(records)
        if page.last and n >= self.limit:
            raise IncompletePages(f"{where}: the last page is full ({n} records), so more records may follow")
        if not page.last and n != self.limit:
            raise IncompletePages(f"{where}: {n} records instead of {self.limit}")
        arrow = to_arrow_schema(self.schema)
        columns = []
        for field, kind in zip(self.schema.fields, arrow.types):
            values = [r.get(field.name) for r in records]
            if isinstance(field.dataType, T.StringType):
                values = [_text(v) for v in values]
            columns.append(pa.array(values, kind))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)


class PagedJson(DataSource):
    """``spark.read.format("paged_json")``: see the module."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("give a schema: the pages are not read to find one")

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))
