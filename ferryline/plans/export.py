"""A named query straight into a feed, with a report of the run."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.operators.inventory import list_files
from ferryline.plans.catalog import QUERIES, NamedQuery, run_query
from ferryline.sources.feed_format import FeedFormat
from ferryline.sources.feed_writer import write_feed

# Phases of an export, in the order of its report.
EXPORT_PHASES = ("plan", "run and write", "list files")


@dataclass(frozen=True)
class ExportResult:
    path: str
    rows: int
    files: int
    bytes: int
    seconds: tuple[float, ...]

    def phase_log(self, spark: SparkSession, run_id: str) -> DataFrame:
        """Rows for the phase report: ``run_id, phase, seconds``."""
        rows = [(run_id, phase, f"{s:.6f}") for phase, s in zip(EXPORT_PHASES, self.seconds)]
        log = spark.createDataFrame(rows, "run_id string, phase string, s string")
        return log.select("run_id", "phase", F.col("s").cast("decimal(18,6)").alias("seconds"))

    def run_log(self, spark: SparkSession, run_id: str) -> DataFrame:
        """One row for the phase report: ``run_id, total_seconds``."""
        return self.phase_log(spark, run_id).groupBy("run_id").agg(F.sum("seconds").cast("decimal(18,6)").alias("total_seconds"))


def export_query(
    spark: SparkSession,
    name: str,
    parameters: Mapping[str, object],
    path: str,
    fmt: FeedFormat = FeedFormat(),
    queries: Mapping[str, NamedQuery] = QUERIES,
    **options: object,
) -> ExportResult:
    """Run a named query and write its result as a feed; rows go from the executors to the files.

    ``options`` are those of ``write_feed``.
    """
    marks = [time.time()]
    result = run_query(spark, name, parameters, queries)
    marks.append(time.time())
    rows = write_feed(result, path, fmt, **options)
    marks.append(time.time())
    data = list_files(spark, path).where(~F.substring_index("key", "/", -1).startswith("_"))
    size = data.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    marks.append(time.time())
    return ExportResult(path, rows, size["files"], size["bytes"], tuple(b - a for a, b in zip(marks, marks[1:])))
