"""Pick up files that arrived since the last run."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ferryline.operators.load import LoadResult, load
from ferryline.runtime import data_file_names, depth, folders_with, remove
from ferryline.sources.feed_format import LOAD_FORMAT, FeedFormat
from ferryline.sources.feed_reader import drop_headers, parse_lines


# Fixed value: the columns of Spark's file source.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: FeedFormat = LOAD_FORMAT,
    *,
    partition_by: Sequence[str] = (),
    max_files_per_batch: int | None = None,
    on_error: str = "fail",
) -> StreamingQuery:
    """Append the new feed files below ``source`` to the parquet folder ``target``.

    Each run takes what has arrived and then stops; the checkpoint remembers the
    files, so every record is loaded once even after a failed run. ``source`` may
    hold any tree of run directories. A writer should move a finished run directory
    into place; files whose names start with ``_`` or ``.`` are not read.

    A malformed record stops the run before its batch is committed. With
    ``on_error="flag"`` it is stored too, marked by ``reject_reason`` and
    ``reject_line``; readers of good rows ask for ``reject_reason IS NULL``.

    Rows are only appended, so there is no state and no watermark.
    """
    if fmt.quote:
        raise ValueError("quoted feeds cannot be split into records by line; load them in batch")
    reader = (
        spark.readStream.schema("value string")
        .option("lineSep", fmt.line_sep)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    lines = reader.text(source)
    if fmt.header:
        lines = drop_headers(lines, schema, fmt)
    writer = (
        parse_lines(lines, schema, fmt, on_error)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(target)


def ingest_table(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    fmt: FeedFormat = LOAD_FORMAT,
    *,
    batch_column: str = "batch",
    marker: str | None = None,
    reject_limit: int | None = None,
    max_files_per_batch: int | None = None,
) -> list[LoadResult]:
    """Load the files below ``source`` that arrived since the last call into the table ``target``, a batch at a time.

    Files are found by a stream, whose checkpoint remembers their names; ``max_files_per_batch`` bounds how many reach the driver at
    once. Its batches are loads: the table is partitioned by ``batch_column``,
    a text, and a batch replaces the partition of its number. So a batch that is repeated after a failure
    adds nothing, and rows that ``load`` puts into other partitions stand beside it.

    With ``marker``, files of a run directory directly below ``source`` are loaded only if it holds a file of that name. The others are
    put off in the checkpoint and loaded by the first call that finds their run finished, each run as a batch of its own.

    ``reject_limit`` holds for each batch. Above it, or on a malformed record without a limit, the batch is not
    loaded and the call fails; the next one repeats it.
    """
    if fmt.quote or fmt.header:
        raise ValueError("feeds of a stream of loads are unquoted and have no header")
    columns = {c.name: c for c in spark.catalog.listColumns(target)}
    if batch_column not in columns or not columns[batch_column].isPartition or columns[batch_column].dataType != "string":
        raise ValueError(f"{target} has no partition column {batch_column} of texts")
    results: list[LoadResult] = []
    put_off, level = f"{checkpoint}/put-off", depth(spark, source) + 1

    def finished() -> list[str]:
        return folders_with(spark, source, marker)

    def load_files(names: list[str], name: str) -> None:
        lines = spark.read.schema("value string").option("lineSep", fmt.line_sep).text(names)
        feed = parse_lines(lines.withColumn(batch_column, F.lit(name)), schema, fmt, "fail" if reject_limit is None else "flag", [batch_column])
        results.append(load(feed, target, mode="replace_partition", reject_limit=reject_limit))

    def load_late() -> None:
        for batch in data_file_names(spark, put_off, "*"):
            waiting = spark.read.parquet(batch)
            runs = [r.run for r in waiting.select("run").distinct().collect()]
            ready = set(finished())
            for run in sorted(set(runs) & ready):
                names = [r.file for r in waiting.where(F.col("run") == run).select("file").toLocalIterator()]
                load_files(names, f"{batch.rpartition('/')[2]}-{run}")
            left = sorted(set(runs) - ready)
            if len(left) < len(runs):
                # Loaded runs go; were the call cut off before, they would be loaded again in their own partitions.
                rest = waiting.where(F.col("run").isin(left)).collect() if left else []
                remove(spark, batch)
                if rest:
                    spark.createDataFrame(rest, "file string, run string").write.mode("overwrite").parquet(batch)

    def load_batch(files: DataFrame, number: int) -> None:
        found = [(r.file, r.run) for r in files.distinct().collect()]
        ready = set(finished()) if marker else {run for _, run in found}
        if waiting := [(file, run) for file, run in found if run not in ready]:
            spark.createDataFrame(waiting, "file string, run string").coalesce(1).write.mode("overwrite").parquet(f"{put_off}/{number}")
        if names := sorted(file for file, run in found if run in ready):
            load_files(names, str(number))

    if marker:
        load_late()
    # Only names are asked of this source, so it does not open the files.
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    folders = F.split(F.expr("parse_url(_metadata.file_path, 'PATH')"), "/")
    files = reader.load(source).select(F.col("path").alias("file"), F.get(folders, F.lit(level)).alias("run"))
    query = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return results


def ingest_ready(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    fmt: FeedFormat = LOAD_FORMAT,
    *,
    run_column: str = "run",
    marker: str = "_SUCCESS",
    reject_limit: int | None = None,
) -> LoadResult:
    """Load the finished run directories below ``source`` that the table ``target`` does not have yet.

    A run is finished once its directory holds the file ``marker``; others are left alone until
    then. All new runs are read in one job. The table is partitioned by ``run_column``, a text
    that holds the name of the run. These partitions are the memory of what was loaded, and a load replaces
    its own ones, so a call after a failure neither loses nor doubles a row. Rows that
    ``load`` puts beside them are visible as in any table. A run without good rows leaves no
    partition and is read again.

    ``reject_limit`` and the result are those of ``load``; without a new run nothing is published.
    Names of runs have letters, digits, ``_``, ``-`` and ``.``.
    """
    if fmt.quote or fmt.header:
        raise ValueError("feeds of runs are unquoted and have no header")
    columns = {c.name: c for c in spark.catalog.listColumns(target)}
    if run_column not in columns or not columns[run_column].isPartition or columns[run_column].dataType != "string":
        raise ValueError(f"{target} has no partition column {run_column} of texts")
    loaded = {
        value.removeprefix(f"{run_column}=")
        for row in spark.sql(f"SHOW PARTITIONS {target}").toLocalIterator()
        for value in row[0].split("/")
        if value.startswith(f"{run_column}=")
    }
    runs = [name for name in folders_with(spark, source, marker) if name not in loaded]
    if odd := [name for name in runs if not re.fullmatch(r"[\w.-]+", name, re.ASCII)]:
        raise ValueError(f"names of runs: {', '.join(odd)}")
    if not runs:
        return LoadResult(target, "replace_partition", 0, 0, False)
    folders = F.split(F.expr("parse_url(_metadata.file_path, 'PATH')"), "/")
    lines = (
        spark.read.schema("value string")
        .option("lineSep", fmt.line_sep)
        .option("recursiveFileLookup", "true")
        .text([f"{source.rstrip('/')}/{name}" for name in runs])
        .select("value", F.get(folders, F.lit(depth(spark, source) + 1)).alias(run_column))
    )
    feed = parse_lines(lines, schema, fmt, "fail" if reject_limit is None else "flag", [run_column])
    return load(feed, target, mode="replace_partition", reject_limit=reject_limit)
