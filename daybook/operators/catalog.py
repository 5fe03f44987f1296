"""What the catalog and the file system say about a table, and small changes to both.

Only names, locations and a few small files of the journal pass through the driver; data
files are neither listed nor read.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Partitions named in one statement.
AT_ONCE = 500

#: Characters that are escaped in the name of a partition's folder, as Spark writes it.
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}


# --- tables --------------------------------------------------------------------

def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def existing_partitions(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """Partition values held by the catalog, as text; data files are not read."""
    return {
        tuple(unquote(part.split("=", 1)[1]) for part in row["partition"].split("/"))
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }


def description(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def location(spark: SparkSession, table: str) -> str:
    return description(spark, table)["Location"].rstrip("/")


def bucket_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns that a bucketed table is bucketed by; none for another table."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isBucket]


def partition_spec(columns: list[str], values: Iterable[str]) -> str:
    terms = [
        f"`{c}` = null" if v == NULL_PARTITION else f"`{c}` = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        for c, v in zip(columns, values)
    ]
    return f"PARTITION ({', '.join(terms)})"


def partition_path(columns: list[str], values: Iterable[str]) -> str:
    """The folder of a partition below its table, as Spark names it."""
    return "/".join(f"{_escaped(c)}={_escaped(v)}" for c, v in zip(columns, values))


def _escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)


def drop_partitions(
    spark: SparkSession, table: str, columns: list[str], values: Iterable[tuple[str, ...]]
) -> None:
    specs = [partition_spec(columns, v) for v in sorted(values)]
    for first in range(0, len(specs), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[first:first + AT_ONCE])}")


def add_partitions(
    spark: SparkSession, table: str, columns: list[str], folders: dict[tuple[str, ...], str]
) -> None:
    specs = [
        f"{partition_spec(columns, v)} LOCATION '{_quoted(f)}'" for v, f in sorted(folders.items())
    ]
    for first in range(0, len(specs), AT_ONCE):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[first:first + AT_ONCE])}")


def set_location(
    spark: SparkSession, table: str, columns: list[str], values: tuple[str, ...], folder: str
) -> None:
    spark.sql(f"ALTER TABLE {table} {partition_spec(columns, values)} SET LOCATION '{_quoted(folder)}'")


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


# --- files ---------------------------------------------------------------------

def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory() == folders)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    return _names(spark, path, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    return _names(spark, path, False)


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below a path, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}" for f in found for n in folder_names(spark, path + f)]
    return [f[1:] for f in found]


def delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so that it is there whole or not."""
    place, files = _place(spark, f"{path}.part")
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _place(spark, path)
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
