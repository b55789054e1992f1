"""All-or-nothing loads into tables and parquet folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferryline.functions.cells import quoted
from ferryline.operators.publish import Place, place_of, publish, stage
from ferryline.runtime import SETTINGS, materialize, remove, session_settings, shared_folder
from ferryline.sources.feed_reader import REJECT_LINE, REJECT_REASON

MODES = ("append", "replace_partition")



class RejectLimitExceeded(Exception):
    """More malformed records than allowed; nothing was published."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did: counts, and the malformed records if they were allowed."""

    target: str
    mode: str
    rows_loaded: int
    rows_rejected: int
    published: bool
    errors: DataFrame | None = None

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.target, self.mode, self.rows_loaded, self.rows_rejected, self.published)],
            "target string, mode string, rows_loaded bigint, rows_rejected bigint, published boolean",
        )


def _is_path(target: str) -> bool:
    return "/" in target


def _aligned(df: DataFrame, target: str, columns: Sequence[str] | None) -> DataFrame:
    """Columns by name, in the order of the target table; unnamed ones become NULL.

    A differing type is an error: an insert never casts.
    """
    df = df.select(*[quoted(c) for c in columns or [c for c in df.columns if c not in (REJECT_REASON, REJECT_LINE)]])
    if _is_path(target):
        return _same_types(df, target)
    given = {f.name: f.dataType for f in df.schema}
    wanted = df.sparkSession.table(target).schema
    unknown = set(given) - set(wanted.names)
    if unknown:
        raise ValueError(f"{target} has no column {', '.join(sorted(unknown))}")
    for f in wanted:
        if f.name in given and given[f.name] != f.dataType:
            raise TypeError(
                f"{f.name} is {given[f.name].simpleString()} in the feed, "
                f"{f.dataType.simpleString()} in {target}"
            )
    return df.select(
        *[
            quoted(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )


def _same_types(df: DataFrame, folder: str) -> DataFrame:
    """The rows, if their types are those of the folder's files; a new folder takes any."""
    try:
        wanted = {f.name: f.dataType for f in df.sparkSession.read.parquet(folder).schema}
    except AnalysisException:
        return df
    for f in df.schema:
        if f.name in wanted and wanted[f.name] != f.dataType and not _partition_text(folder, f.name, df):
            raise TypeError(f"{f.name} is {f.dataType.simpleString()} in the feed, {wanted[f.name].simpleString()} in {folder}")
    return df


def _partition_text(folder: str, name: str, df: DataFrame) -> bool:
    """Whether a column is in the folder names, whose types are guessed from their texts."""
    names = df.sparkSession.read.parquet(folder).inputFiles()[:1]
    return any(f"/{name}=" in n for n in names)


def _observed(counted: Observation) -> dict[str, int]:
    """The observed counts; none where adaptive execution found nothing to write and dropped the plan with its observation."""
    try:
        return counted.get
    except Py4JError:
        return {}


def write_counted(
    df: DataFrame, target: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> int:
    """Write in one job and return the number of affected rows, counted on the way."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    if mode == "replace_partition" and _is_path(target) and not partition_by:
        raise ValueError("replace_partition needs partition_by")
    spark, spread_by = df.sparkSession, list(partition_by)
    replace = mode == "replace_partition"
    place = place_of(spark, target, tuple(partition_by)) if replace else None
    if place and not place.columns:
        raise ValueError(f"replace_partition needs a partitioned table, {target} is not")
    if place:
        counted = Observation()
        staged = stage(df.observe(counted, F.count(F.lit(1)).alias("rows")), place)
        _publish(spark, place, staged, True)
        return _observed(counted).get("rows", 0)
    if not _is_path(target):
        spread_by = [c.name for c in df.sparkSession.catalog.listColumns(target) if c.isPartition]
    if spread_by:
        # Few files per partition value; an oversized value is split over several tasks.
        df = df.hint("rebalance", *spread_by)
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
    if _is_path(target):
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode("append").parquet(target)
    elif not replace:
        with SETTINGS:  # or a replacement's setting would be in force
            writer.insertInto(target)
    elif not spread_by:
        raise ValueError(f"replace_partition needs a partitioned table, {target} is not")
    else:
        # An insert into a table takes the overwrite mode from the session only.
        with session_settings(df.sparkSession, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            writer.insertInto(target, overwrite=True)
    return _observed(counted).get("rows", 0)


def _publish(spark: SparkSession, place: Place, staged: str, replace: bool) -> None:
    try:
        publish(spark, place, staged, replace)
    except Exception:
        remove(spark, staged)
        raise


def load(
    feed: DataFrame,
    target: str,
    columns: Sequence[str] | None = None,
    *,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    reject_limit: int | None = None,
    dry_run: bool = False,
) -> LoadResult:
    """Load a feed into a catalog table, or into a parquet folder (a target with ``/``).

    The files of the one publishing job appear at its commit; if a task fails for
    good, none does. ``mode="replace_partition"`` replaces exactly the partitions
    the feed touches.

    With ``reject_limit`` the feed comes from ``read_feed(..., on_error="flag")``. Its good
    records are written once, beside the target and in its layout, and all are counted on the way. Above the limit the load
    stops before anything is published; otherwise the files are moved into place. Only a feed with malformed
    records is read once more, for their report.

    ``dry_run`` does all the work except publishing. On a feed read with
    ``on_error="fail"`` a bad record fails the dry run too.
    """
    spark = feed.sparkSession
    if reject_limit is None:
        if REJECT_REASON in feed.columns:
            raise ValueError("a feed with flagged records needs a reject_limit")
        rows = _aligned(feed, target, columns)
        if not dry_run:
            return LoadResult(target, mode, write_counted(rows, target, mode, partition_by), 0, True)
        counted = Observation()
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.format("noop").mode(
            "overwrite"
        ).save()
        return LoadResult(target, mode, counted.get.get("rows", 0), 0, False)

    if REJECT_REASON not in feed.columns:
        raise ValueError("reject_limit needs a feed read with on_error='flag'")
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    replace = mode == "replace_partition"
    if replace and _is_path(target) and not partition_by:
        raise ValueError("replace_partition needs partition_by")
    is_bad = F.col(REJECT_REASON).isNotNull()
    counted = Observation()
    watched = feed.observe(counted, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad"))
    good_columns = [c for c in feed.columns if c not in (REJECT_REASON, REJECT_LINE)]
    rows = _aligned(watched.where(~is_bad).select(*[quoted(c) for c in good_columns]), target, columns)
    place = place_of(spark, target, tuple(partition_by))
    if replace and place and not place.columns:
        raise ValueError(f"replace_partition needs a partitioned table, {target} is not")
    # A table that only an insert can write gets its rows from a copy in the work folder.
    staged = stage(rows, place or Place(shared_folder(spark, "staged-load"), (), "parquet", None))
    try:
        got = _observed(counted)
        if "bad" not in got:
            got = feed.agg(F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad")).first().asDict()
        good, bad = got["good"], got["bad"]
        errors = feed.where(is_bad).select(REJECT_REASON, REJECT_LINE)
        errors = materialize(errors if bad else errors.limit(0), "rejected")
        if bad > reject_limit:
            raise RejectLimitExceeded(f"{bad} malformed records, {reject_limit} allowed; see {errors.inputFiles()[0].rpartition('/')[0]}")
        if dry_run:
            remove(spark, staged)
        elif place:
            publish(spark, place, staged, replace)
        else:
            write_counted(spark.read.schema(rows.schema).parquet(staged), target, mode, partition_by)
            remove(spark, staged)
    except Exception:
        remove(spark, staged)
        raise
    return LoadResult(target, mode, good, bad, not dry_run, errors)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
