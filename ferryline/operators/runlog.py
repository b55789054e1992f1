"""Reports over a log of runs: where the time went, how fast, how far.

A phase log is a DataFrame ``run_id, phase, seconds`` with decimal seconds and one
row per measured stretch; a run log has ``run_id, total_seconds``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a residual up to this many seconds is not shown.
SMALLEST_OTHER = 0.001


def _share(part: Column, whole: Column) -> Column:
    percent = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100
    return F.round(F.coalesce(percent, F.lit(0.0)), 1)


def phase_breakdown(
    phases: DataFrame,
    runs: DataFrame,
    order: Sequence[str] = (),
    labels: tuple[str, str] = ("other", "total"),
    first_use: str | None = None,
) -> DataFrame:
    """Seconds and share of each phase of each run, the unmeasured rest, and the total.

    Declared phases come first in their order, others in the order of their first
    use (column ``first_use``, or by name). Phases of zero seconds do not appear, and
    runs without any phase do not appear at all. ``line_no`` is the order of the
    report; ``place`` numbers its phases only.

    All per-row work is one partial aggregation by (run, phase); what remains is one
    row per phase of a run.
    """
    other_label, total_label = labels
    first = F.min(first_use) if first_use else F.min("phase")
    # Decimal seconds keep the sums exact.
    per_phase = (
        phases.groupBy("run_id", "phase")
        .agg(F.sum("seconds").alias("seconds"), first.alias("first"))
        .where("seconds > 0")
    )
    declared = F.array_position(F.array(*[F.lit(p) for p in order]), F.col("phase")) if order else F.lit(0)
    rank = F.when(declared > 0, declared).otherwise(len(order) + 1)
    run = Window.partitionBy("run_id")
    placed = (
        per_phase.withColumn("place", F.row_number().over(run.orderBy(rank, "first", "phase")))
        .withColumn("measured", F.sum("seconds").over(run))
        .withColumn("phases", F.count(F.lit(1)).over(run))
        .join(runs.select("run_id", F.col("total_seconds").alias("whole")), "run_id")
    )

    def line(number: Column, place: Column, label: Column, seconds: Column) -> Column:
        seconds = seconds.cast("decimal(18,3)")
        return F.struct(
            number.cast("int").alias("line_no"),
            place.cast("int").alias("place"),
            label.alias("phase"),
            seconds.alias("seconds"),
            _share(seconds, F.col("whole")).alias("share_pct"),
        )

    own = line(F.col("place"), F.col("place"), F.col("phase"), F.col("seconds"))
    rest = F.col("whole") - F.col("measured")
    other = line(F.col("phases") + 1, F.lit(None), F.lit(other_label), rest)
    total = line(F.col("phases") + 2, F.lit(None), F.lit(total_label), F.col("whole"))
    # The first phase of a run also brings the closing lines.
    lines = (
        F.when((F.col("place") == 1) & (rest > SMALLEST_OTHER), F.array(own, other, total))
        .when(F.col("place") == 1, F.array(own, total))
        .otherwise(F.array(own))
    )
    return placed.select("run_id", F.inline(lines))


def throughput(transfers: DataFrame) -> DataFrame:
    """Rows, bytes and rows per second of each run; no rate where no time passed.

    Input ``run_id, rows, bytes, seconds``, one row per batch.
    """
    totals = transfers.groupBy("run_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.sum("seconds").alias("seconds"),
    )
    seconds = F.when(F.col("seconds") > 0, F.col("seconds").cast("double"))
    return totals.select(
        "run_id",
        "rows",
        "bytes",
        F.col("seconds").cast("decimal(18,3)").alias("seconds"),
        F.round(F.col("rows") / seconds, 1).alias("rows_per_second"),
    )


def latest_progress(reports: DataFrame) -> DataFrame:
    """Last report of each run and label with its share of the total.

    Input ``run_id, label, at, seq, done, total``; ``seq`` decides between reports of
    the same moment. The maximum is taken inside the tasks first.
    """
    last = F.max(F.struct("at", "seq", "done", "total"))
    return reports.groupBy("run_id", "label").agg(last.alias("l")).select(
        "run_id",
        "label",
        F.col("l.done").alias("done"),
        F.col("l.total").alias("total"),
        F.round(F.col("l.done") / F.nullif(F.col("l.total"), F.lit(0)) * 100, 1).alias("share_pct"),
    )
