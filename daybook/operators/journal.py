"""Replacing many partitions so that a job that breaks off is finished or undone.

The catalog changes one partition at a time, so a replacement of many days cannot be one
commit. It is made in steps, and what each step needs is on disk before it begins:

1. An intent names the replacement. Nothing of the table has changed.
2. The new rows are written aside, as partitions of a stage table with the table's own
   format, partitioning and buckets. Nothing of the table has changed.
3. A manifest lists the partitions written and those to be emptied. From here on the
   replacement will happen.
4. The catalog is pointed to the new files, partition by partition, and the emptied ones
   are dropped. Each call can be made again.
5. The replacement is marked done, and files that no partition points to any more go.

:func:`recover` brings a table into order: without a manifest a replacement is undone, with
one steps 4 and 5 are made again. Every replacement begins with it. Readers see old or new
partitions, never a partition half written.

The journal lies in the table's folder, one folder per replacement, which also holds the new
files. A table has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from daybook.operators import catalog, statistics
from daybook.session import ensure_dynamic_overwrite

FOLDER = "_replacements"
INTENT, MANIFEST, DONE = "intent.json", "manifest.json", "done.json"


def replace(
    rows: DataFrame, table: str, keys: list[str], emptied: Iterable[tuple[str, ...]] | None = None
) -> set[tuple[str, ...]]:
    """Replace the partitions that the rows fall in, and empty the others of ``emptied``.

    Without ``emptied`` every other partition is emptied. The rows have the table's columns
    in its order. Returns the partitions written.
    """
    entry = begin(rows.sparkSession, table)
    staged = stage(rows, table, entry)
    prepare(rows.sparkSession, table, entry, keys, staged, emptied)
    finish(rows.sparkSession, table, entry)
    return staged.written


def recover(spark: SparkSession, table: str) -> dict[str, str]:
    """Finish or undo what broke off: what happened to each such replacement."""
    found = {}
    root = _root(spark, table)
    for entry in catalog.folder_names(spark, root):
        held = set(catalog.file_names(spark, f"{root}/{entry}"))
        if DONE in held:
            continue
        if MANIFEST in held:
            finish(spark, table, entry)
            found[entry] = "finished"
        else:
            spark.sql(f"DROP TABLE IF EXISTS {_stage_table(table, entry)}")
            catalog.delete(spark, f"{root}/{entry}")
            found[entry] = "undone"
    return found


# --- the steps ---------------------------------------------------------------

def begin(spark: SparkSession, table: str) -> str:
    """Step 1: the name of a new replacement, after what broke off before is in order."""
    recover(spark, table)
    entry = statistics.entry_name()
    catalog.write_text(spark, f"{_root(spark, table)}/{entry}/{INTENT}", json.dumps({"table": table}))
    return entry


@dataclass(frozen=True)
class Staged:
    """Partitions that got rows, and their statistics if the table is tracked."""

    written: set[tuple[str, ...]]
    statistics: list[dict] | None


def stage(rows: DataFrame, table: str, entry: str) -> Staged:
    """Step 2: write the rows aside.

    A stage table that is external leaves its files when it is dropped. Files are cut like
    the table's: by its partitions, and in its buckets if it has any. Statistics are taken
    from the tracked columns of the files just written.
    """
    spark = rows.sparkSession
    ensure_dynamic_overwrite(spark)
    aside = _stage_table(table, entry)
    spark.sql(f"CREATE TABLE {aside} LIKE {table} LOCATION '{_root(spark, table)}/{entry}/rows'")
    # Rows of a bucket together, so that a day has few files for each; a hot one is cut up.
    keys = catalog.partition_columns(spark, table)
    deal = catalog.bucket_columns(spark, table) or keys
    rows.hint("rebalance", *deal).write.insertInto(aside, overwrite=True)
    columns = statistics.tracked(spark, table)
    staged = Staged(
        catalog.existing_partitions(spark, aside),
        statistics.measured(spark.table(aside), keys, columns) if columns else None,
    )
    spark.sql(f"DROP TABLE {aside}")
    return staged


def prepare(
    spark: SparkSession, table: str, entry: str, keys: list[str], staged: Staged,
    emptied: Iterable[tuple[str, ...]] | None,
) -> None:
    """Step 3: the manifest, in one atomic rename."""
    gone = catalog.existing_partitions(spark, table) if emptied is None else set(emptied)
    manifest = {
        "keys": keys, "written": sorted(staged.written), "emptied": sorted(gone - staged.written),
        "statistics": staged.statistics,
    }
    catalog.write_text(spark, f"{_root(spark, table)}/{entry}/{MANIFEST}", json.dumps(manifest))


def finish(spark: SparkSession, table: str, entry: str) -> None:
    """Steps 4 and 5, which may be made again."""
    root = _root(spark, table)
    manifest = json.loads(catalog.read_text(spark, f"{root}/{entry}/{MANIFEST}"))
    keys = manifest["keys"]
    existing = catalog.existing_partitions(spark, table)
    folders = {tuple(v): f"{root}/{entry}/rows/{catalog.partition_path(keys, v)}" for v in manifest["written"]}
    catalog.add_partitions(spark, table, keys, {v: f for v, f in folders.items() if v not in existing})
    for values, folder in folders.items():
        if values in existing:
            catalog.set_location(spark, table, keys, values, folder)
    gone = {tuple(v) for v in manifest["emptied"]} & existing
    catalog.drop_partitions(spark, table, keys, gone)
    if manifest["statistics"] is not None:
        statistics.record(spark, table, entry, manifest["statistics"] + statistics.emptied(sorted(gone)))
    spark.catalog.refreshTable(table)
    catalog.write_text(spark, f"{root}/{entry}/{DONE}", "{}")
    _sweep(spark, table, entry, manifest)


def _sweep(spark: SparkSession, table: str, entry: str, manifest: dict) -> None:
    """Delete the files that this replacement put out of use."""
    root = _root(spark, table)
    place = catalog.location(spark, table)
    paths = {catalog.partition_path(manifest["keys"], v) for v in manifest["written"] + manifest["emptied"]}
    for path in paths:
        catalog.delete(spark, f"{place}/{path}")
    for other in catalog.folder_names(spark, root):
        if other == entry:
            continue
        rows = f"{root}/{other}/rows"
        held = set(catalog.leaf_folders(spark, rows, len(manifest["keys"])))
        for path in paths & held:
            catalog.delete(spark, f"{rows}/{path}")
        if held <= paths:
            catalog.delete(spark, f"{root}/{other}")
    if not manifest["written"]:
        catalog.delete(spark, f"{root}/{entry}")


def _root(spark: SparkSession, table: str) -> str:
    return f"{catalog.location(spark, table)}/{FOLDER}"


def _stage_table(table: str, entry: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{database}{'.' if database else ''}{name}_stage_{entry}"
