"""Data written once beside its target, and published when it is known to be good.

A load writes its rows in the layout of the target into a hidden folder below it. Publishing renames files or folders, or
points partitions of a table to the new folder; no row is written again. What publishing does is noted in a journal first.
If a step fails, the steps before it are taken back in reverse order, so the target is as it was; after the loss
of the driver, ``take_back`` does the same.

Renames of single files and changes of single partitions are atomic, all of them together are not: a reader that starts in
between may see a part of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ferryline.runtime import remove

# Fixed value: the folder name of a NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_JOURNAL = "_steps"
_PROVIDERS = ("parquet", "orc")


@dataclass(frozen=True)
class Place:
    """Where a target's files lie: its folder, partition columns and format; ``table`` is None for a plain folder."""

    folder: str
    columns: tuple[str, ...]
    provider: str
    table: str | None


def place_of(spark: SparkSession, target: str, partition_by: tuple[str, ...] = ()) -> Place | None:
    """The place of a folder or table; None for tables that only Spark's own insert can write (buckets, other formats)."""
    if "/" in target:
        return Place(target.rstrip("/"), tuple(partition_by), "parquet", None)
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    provider = details.get("Provider", "").lower()
    if provider not in _PROVIDERS or "Num Buckets" in details or "Location" not in details:
        return None
    columns = tuple(c.name for c in spark.catalog.listColumns(target) if c.isPartition)
    return Place(details["Location"].rstrip("/"), columns, provider, target)


def stage(rows: DataFrame, place: Place) -> str:
    """Write rows in the target's layout into a new hidden folder below it."""
    folder = f"{place.folder}/_data-{uuid.uuid4().hex}"
    if place.columns:
        # Few files per partition value; an oversized value is split over several tasks.
        rows = rows.hint("rebalance", *place.columns)
    rows.write.format(place.provider).partitionBy(*place.columns).save(folder)
    return folder


class Files:
    """The file system of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def below(self, folder: str) -> list[str]:
        """Files below a folder, relative to it, without hidden ones."""
        if not self.exists(folder):
            return []
        root, found = self.system.makeQualified(self.path(folder)).toUri().getPath().rstrip("/") + "/", []
        each = self.system.listFiles(self.path(folder), True)
        while each.hasNext():
            name = each.next().getPath().toUri().getPath().removeprefix(root)
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(name)
        return sorted(found)

    def same(self, one: str | None, other: str) -> bool:
        return one is not None and self.system.makeQualified(self.path(one)).equals(self.system.makeQualified(self.path(other)))

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def move(self, old: str, new: str) -> None:
        self.system.mkdirs(self.path(new).getParent())
        if not self.system.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def write(self, name: str, text: str) -> None:
        out = self.system.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text


def partition_spec(folder: str) -> str:
    """``a=1/b=x`` as a partition of a statement."""
    parts = [p.partition("=")[::2] for p in folder.split("/")]
    return "PARTITION (" + ", ".join(f"`{name}` = {_literal(unquote(value))}" for name, value in parts) + ")"


def _literal(value: str) -> str:
    return "NULL" if value == NULL_PARTITION else _text(value)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_location(spark: SparkSession, table: str, folder: str) -> str | None:
    """Where the partition named like a folder lies, or None if the table does not have it."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition_spec(folder)}").collect()
    except AnalysisException:
        return None
    # The partition's own details come before those of the table.
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


# A step: ("move", from, to), ("point", partition, from, to) or ("add", partition, to).
def _do(spark: SparkSession, files: Files, table: str | None, step: list) -> None:
    if step[0] == "move":
        files.move(step[1], step[2])
    elif step[0] == "point":
        spark.sql(f"ALTER TABLE {table} {partition_spec(step[1])} SET LOCATION {_text(step[3])}")
    else:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition_spec(step[1])} LOCATION {_text(step[2])}")


def _undo(spark: SparkSession, files: Files, table: str | None, step: list) -> None:
    """Take a step back; nothing happens if it was not taken."""
    if step[0] == "move":
        if files.exists(step[2]) and not files.exists(step[1]):
            files.move(step[2], step[1])
    elif step[0] == "point":
        spark.sql(f"ALTER TABLE {table} {partition_spec(step[1])} SET LOCATION {_text(step[2])}")
    elif files.same(partition_location(spark, table, step[1]), step[2]) and ("/_data-" in step[2] or not files.below(step[2])):
        # Dropping a partition removes its folder, so that may hold nothing but staged data.
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partition_spec(step[1])}")


def _append_steps(spark: SparkSession, place: Place, staged: str, files: Files) -> list[list]:
    names = files.below(staged)
    if not place.columns:
        return [["move", f"{staged}/{n}", f"{place.folder}/{n}"] for n in names]
    steps, where = [], {}
    for folder in sorted({n.rpartition("/")[0] for n in names}):
        known = partition_location(spark, place.table, folder) if place.table else None
        where[folder] = (known or f"{place.folder}/{folder}").rstrip("/")
        if place.table and not known:
            steps.append(["add", folder, where[folder]])
    for n in names:
        folder, _, name = n.rpartition("/")
        steps.append(["move", f"{staged}/{n}", f"{where[folder]}/{name}"])
    return steps


def _replace_steps(spark: SparkSession, place: Place, staged: str, files: Files) -> tuple[list[list], list[str]]:
    """Steps, and folders that are no longer needed after them."""
    steps, old = [], []
    for folder in sorted({n.rpartition("/")[0] for n in files.below(staged)}):
        if place.table:
            lies = partition_location(spark, place.table, folder)
            steps.append(["point", folder, lies, f"{staged}/{folder}"] if lies else ["add", folder, f"{staged}/{folder}"])
            old += [lies] if lies else []
        else:
            if files.exists(f"{place.folder}/{folder}"):
                steps.append(["move", f"{place.folder}/{folder}", f"{staged}/_before/{folder}"])
            steps.append(["move", f"{staged}/{folder}", f"{place.folder}/{folder}"])
    return steps, old


def publish(spark: SparkSession, place: Place, staged: str, replace: bool, step: Callable | None = None) -> None:
    """Make staged data part of the target; ``replace`` puts it in the place of the partitions it touches.

    A failure takes back what was done and leaves the staged data to the caller. ``step`` is called before each step (for tests).
    """
    files, old = Files(spark, place.folder), []
    if replace:
        steps, old = _replace_steps(spark, place, staged, files)
    else:
        steps = _append_steps(spark, place, staged, files)
    files.write(f"{staged}/{_JOURNAL}", json.dumps({"table": place.table, "steps": steps}))
    done = 0
    try:
        for done, one in enumerate(steps):
            if step:
                step(one)
            _do(spark, files, place.table, one)
    except Exception:
        for one in reversed(steps[: done + 1]):
            _undo(spark, files, place.table, one)
        raise
    files.system.delete(files.path(f"{staged}/{_JOURNAL}"), False)
    for folder in old:
        remove(spark, folder)
    if not (replace and place.table):
        remove(spark, staged)
    if place.table:
        spark.catalog.refreshTable(place.table)


def take_back(spark: SparkSession, target: str) -> int:
    """Take back publications of a target that were cut off by the loss of their driver; how many there were.

    Call it while no load of the target is running.
    """
    place = place_of(spark, target)
    files, count = Files(spark, place.folder), 0
    for found in files.system.globStatus(files.path(place.folder, "_data-*/" + _JOURNAL)) or []:
        journal = json.loads(files.read(found.getPath().toString()))
        for one in reversed(journal["steps"]):
            _undo(spark, files, journal["table"], one)
        remove(spark, found.getPath().getParent().toString())
        count += 1
    return count
