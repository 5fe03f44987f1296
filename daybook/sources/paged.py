"""Paged requests as a Spark data source, and pulls of a day as a streaming source.

``spark.read.format("paged")`` reads a source that answers a request for one day page by page.
A day's first page declares how many rows the day has; that sets the pages to ask for, which are
dealt to partitions in groups, and a group ends as soon as its rows are there. A partition is one
group, or several where there are very many. Conditions on the day reach the source, so other days
are not asked for.

``spark.readStream.format("pulls")`` reads landed pulls of the current day, with the number of
the pull as its offset.

How pages come is a transport. The one here reads landed files; another one is a class with the
same methods, named as ``package.module:Class``. What runs in workers travels by value, so
executors need no copy of this package.
"""

from __future__ import annotations

import io
import json
import sys
from collections.abc import Iterable, Iterator
from importlib import import_module
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The names of the count and of the rows in a page, rows of a page.
FIELDS = {"post": ("count", "items"), "get": ("Count", "Result")}
PAGE_ROWS = 5000
#: Pages of a group.
GROUP_PAGES = 20
#: More groups than this share partitions, as long as those declare no more rows than this.
PARTITIONS, PARTITION_ROWS = 1_000, 1_000_000


# --- transports ----------------------------------------------------------------

class FolderTransport:
    """Landed requests: ``<path>/<key>=<day>/page=<number>/`` with one document each, from page 1.

    A folder ``page=<first>-<last>`` holds one file with a line for each of these pages, in order:
    its number, a tab and the document. It is read forward once for pages asked for in order.
    Any file system that pyarrow knows by its address will do.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.key = options["path"], options.get("key", "date")
        self.blocks: tuple[str, list[tuple[int, int, str]]] = ("", [])
        self.lines: tuple[str, int, Iterator[bytes]] = ("", 0, iter(()))

    def open(self) -> tuple[fs.FileSystem, str]:
        scheme, _, rest = self.path.partition(":/")
        if not rest or "/" in scheme:
            return fs.LocalFileSystem(), self.path
        # Spark writes file:/folder, an address has two more slashes.
        return fs.FileSystem.from_uri(self.path if rest.startswith("/") else f"{scheme}:///{rest}")

    def days(self) -> list[str]:
        files, root = self.open()
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        start = f"{self.key}="
        return sorted(unquote(i.base_name[len(start):]) for i in found if i.base_name.startswith(start))

    def fetch(self, day: str, page: int) -> str | None:
        """The text of a page, None if there is no such page."""
        files, root = self.open()
        folder = f"{root}/{self.key}={_folder_name(day)}"
        for first, last, block in self._blocks(files, folder):
            if first <= page <= last:
                return self._line(files, block, page)
        found = _held(files, f"{folder}/page={page}")
        if not found:
            return None
        with files.open_input_stream(found[0]) as stream:
            return stream.read().decode()

    def _blocks(self, files: fs.FileSystem, folder: str) -> list[tuple[int, int, str]]:
        """First page, last page and folder of the blocks of a day."""
        if self.blocks[0] != folder:
            found = []
            for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                first, dash, last = i.base_name.removeprefix("page=").partition("-")
                if dash and first.isdigit() and last.isdigit():
                    found.append((int(first), int(last), i.path))
            self.blocks = folder, found
        return self.blocks[1]

    def _line(self, files: fs.FileSystem, block: str, page: int) -> str | None:
        """The text of a page of a block; lines behind the last one read are not read again."""
        path, last, lines = self.lines
        if path != block or last >= page:
            found = _held(files, block)
            lines = io.BufferedReader(files.open_input_stream(found[0])) if found else iter(())
        for line in lines:
            number, _, text = line.partition(b"\t")
            if int(number) >= page:
                self.lines = block, int(number), lines
                return text.decode().rstrip("\n") if int(number) == page else None
        self.lines = "", 0, iter(())
        return None


def _held(files: fs.FileSystem, folder: str) -> list[str]:
    return [
        i.path for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        if i.is_file and i.size and not i.base_name.startswith((".", "_"))
    ]


def _folder_name(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in text)


def _transport(options: dict[str, str]):
    name = options.get("transport", "folder")
    if name == "folder":
        return FolderTransport(options)
    module, _, cls = name.partition(":")
    return getattr(import_module(module), cls)(options)


# --- pages ---------------------------------------------------------------------

def _rows_of(text: str, envelope: str, where: str) -> tuple[int | None, list[dict]]:
    """Declared count and rows of a page; what is not a page is an error that names it."""
    count, array = FIELDS[envelope]
    try:
        page = json.loads(text)
        rows = page.get(array) or []
        if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
            raise ValueError(f"{array} is no array of rows")
        return page.get(count), rows
    except (ValueError, AttributeError) as error:
        raise ValueError(f"{where} is not a page: {error}") from None


def _batch(rows: list[dict], schema: StructType, where: str) -> pa.RecordBatch:
    def value(row: dict, field: StructField):
        found = row.get(field.name)
        if isinstance(field.dataType, BooleanType) and isinstance(found, str):
            return {"true": True, "false": False}.get(found.strip().lower())
        if isinstance(field.dataType, StringType) and found is not None and not isinstance(found, str):
            return json.dumps(found, ensure_ascii=False, separators=(",", ":"))
        return found

    columns = {f.name: [value(r, f) for r in rows] for f in schema.fields}
    try:
        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
    except (pa.ArrowInvalid, pa.ArrowTypeError) as error:
        raise ValueError(f"{where} has values of other types: {error}") from None


class PageGroup(NamedTuple):
    """Pages ``first`` to ``last`` of a day, and the rows that they hold together."""

    day: str
    first: int
    last: int
    rows: int | None


class PageGroups(InputPartition):
    def __init__(self, groups: list[PageGroup]):
        super().__init__([tuple(g) for g in groups])
        self.groups = groups


def _dealt(groups: list[PageGroup]) -> list[PageGroups]:
    """Groups to partitions: one each, or neighbours together where there are very many."""
    most, dealt, rows = -(-len(groups) // PARTITIONS), [], 0
    for group in groups:
        # A group without a declared number of rows stays alone.
        rows = rows + group.rows if group.rows is not None and dealt else PARTITION_ROWS + 1
        if rows > PARTITION_ROWS or len(dealt[-1]) >= most:
            dealt.append([])
            rows = PARTITION_ROWS + 1 if group.rows is None else group.rows
        dealt[-1].append(group)
    return [PageGroups(d) for d in dealt]


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options
        self.conditions: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Conditions on the day choose the days to ask for; Spark still checks every row."""
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        key = self.options.get("key", "date")
        for f in filters:
            if type(f) in kinds and f.attribute == (key,):
                self.conditions.append((kinds[type(f)], f.value))
            yield f

    def _asked(self, day: str) -> bool:
        checks = {
            "=": lambda v: day == v, ">": lambda v: day > v, ">=": lambda v: day >= v, "<": lambda v: day < v,
            "<=": lambda v: day <= v, "in": lambda v: day in v,
        }
        return all(checks[kind](value) for kind, value in self.conditions)

    def partitions(self) -> list[PageGroups]:
        """One request per day for the declared count; the pages follow from it."""
        size, group = int(self.options.get("page_rows", PAGE_ROWS)), int(self.options.get("group_pages", GROUP_PAGES))
        transport, envelope, groups = _transport(self.options), self.options.get("envelope", "post"), []
        for day in filter(self._asked, transport.days()):
            text = transport.fetch(day, 1)
            if text is None:
                continue
            total, held = _rows_of(text, envelope, f"page 1 of {day}")
            if total is None:  # nothing is declared: ask until a page is empty
                groups.append(PageGroup(day, 1, sys.maxsize, None))
                continue
            pages = -(-int(total) // size)
            if not pages and held:
                raise ValueError(f"page 1 of {day} declares no rows and holds {len(held)}")
            for first in range(1, pages + 1, group):
                last = min(first + group - 1, pages)
                groups.append(PageGroup(day, first, last, min(int(total), last * size) - (first - 1) * size))
        return _dealt(groups)

    def read(self, partition: PageGroups) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        transport = _transport(self.options)
        for group in partition.groups:
            yield from self._read(transport, group)

    def _read(self, transport, group: PageGroup) -> Iterator[pa.RecordBatch]:
        envelope = self.options.get("envelope", "post")
        held, page = 0, group.first
        while page <= group.last and (group.rows is None or held < group.rows):
            where = f"page {page} of {group.day}"
            text = transport.fetch(group.day, page)
            rows = _rows_of(text, envelope, where)[1] if text is not None else []
            if not rows:
                break
            yield _batch(rows, self.schema, where)
            held, page = held + len(rows), page + 1
        if group.rows is not None and held != group.rows:
            raise ValueError(
                f"pages {group.first} to {group.last} of {group.day} hold {held} rows, "
                f"but {group.rows} are declared"
            )


class PagedSource(DataSource):
    """Options: path, key (``date``), envelope, page_rows, group_pages, transport. The schema is given."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> StructType:
        raise ValueError("give the schema of the rows: spark.read.format('paged').schema(...)")

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))


# --- pulls ---------------------------------------------------------------------

class PullFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class PullReader(DataSourceStreamReader):
    """Pulls ``<path>/pull=<number>/`` of landed pages, complete once they hold ``_SUCCESS``.

    The offset is the largest number of a complete pull. A batch reads that pull alone, as it
    holds the day in full: a pull that lands late, behind a larger number, is never read, and
    one that broke off is not seen.
    """

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def open(self) -> tuple[fs.FileSystem, str]:
        return FolderTransport(self.options).open()

    def complete(self) -> dict[int, str]:
        """Numbers and folders of the complete pulls."""
        files, root = self.open()
        found = {}
        for i in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            number = i.base_name.removeprefix("pull=")
            if i.base_name.startswith("pull=") and number.isdigit():
                if files.get_file_info(f"{i.path}/_SUCCESS").is_file:
                    found[int(number)] = i.path
        return found

    def initialOffset(self) -> dict:
        return {"pull": -1}

    def latestOffset(self) -> dict:
        return {"pull": max(self.complete(), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[PullFile]:
        if end["pull"] <= start["pull"]:
            return []
        files, _ = self.open()
        folder = self.complete()[end["pull"]]
        return [
            PullFile(i.path) for i in files.get_file_info(fs.FileSelector(folder))
            if i.is_file and i.size and not i.base_name.startswith((".", "_"))
        ]

    def read(self, partition: PullFile) -> Iterator[pa.RecordBatch]:
        files, _ = self.open()
        envelope = self.options.get("envelope", "post")
        with files.open_input_stream(partition.path) as stream:
            lines = stream.read().decode().splitlines()
        for number, line in enumerate(filter(str.strip, lines), 1):
            where = f"page {number} of {partition.path}"
            declared, rows = _rows_of(line, envelope, where)
            if declared is not None and int(declared) != len(rows):
                raise ValueError(f"{where} has {len(rows)} rows, but says {declared}")
            if rows:
                yield _batch(rows, self.schema, where)

    def commit(self, end: dict) -> None:
        """Nothing to do: landed pulls stay."""


class PullSource(DataSource):
    """Options: path, envelope. The schema is given."""

    @classmethod
    def name(cls) -> str:
        return "pulls"

    def schema(self) -> StructType:
        raise ValueError("give the schema of the rows: spark.readStream.format('pulls').schema(...)")

    def streamReader(self, schema: StructType) -> PullReader:
        return PullReader(schema, dict(self.options))


# --- use -------------------------------------------------------------------------

#: Without it Spark keeps conditions to itself and every day is asked for.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark) -> None:
    """Make both formats known to a session, and let conditions reach them."""
    spark.dataSource.register(PagedSource)
    spark.dataSource.register(PullSource)
    if spark.conf.get(PUSHDOWN).lower() != "true":
        spark.conf.set(PUSHDOWN, "true")
