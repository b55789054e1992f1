"""Reports over run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline.checks.registry import PHASES, RUNS, check, phases, runs
from ferryline.operators import runlog

DECLARED = ["view", "click", "purchase"]


@check(
    f"""WITH p AS (SELECT run_id, phase, CAST(sum(seconds) AS DECIMAL(18,3)) AS seconds, min(ts) AS first FROM {PHASES}
    GROUP BY ALL HAVING sum(seconds) > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY run_id
    ORDER BY coalesce(nullif(list_position({DECLARED}, phase), 0), {len(DECLARED) + 1}), first, phase) AS place FROM p),
m AS (SELECT run_id, count(*) AS n, CAST(sum(seconds) AS DECIMAL(18,3)) AS measured FROM p GROUP BY run_id),
l AS (SELECT run_id, place AS line_no, place, phase, seconds, total_seconds FROM n JOIN {RUNS} USING (run_id)
  UNION ALL SELECT run_id, n + 1, NULL, 'other', total_seconds - measured, total_seconds FROM m JOIN {RUNS} USING (run_id)
    WHERE total_seconds - measured > 0.001
  UNION ALL SELECT run_id, n + 2, NULL, 'total', total_seconds, total_seconds FROM m JOIN {RUNS} USING (run_id))
SELECT run_id, CAST(line_no AS INTEGER) AS line_no, CAST(place AS INTEGER) AS place, phase, CAST(seconds AS DECIMAL(18,3)) AS seconds,
  round(coalesce(CAST(seconds AS DOUBLE) / nullif(CAST(total_seconds AS DOUBLE), 0) * 100, 0), 1) AS share_pct FROM l"""
)
def phase_breakdown(spark, sf):
    return runlog.phase_breakdown(phases(spark, sf), runs(spark, sf), DECLARED, first_use="ts")


TRANSFERS = f"""(SELECT run_id, event_id % 100 AS rows, event_id % 100 * 147 AS bytes,
  CASE WHEN run_id % 10 = 0 THEN 0 ELSE seconds END AS seconds FROM {PHASES})"""


@check(
    f"""SELECT run_id, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes,
  CAST(sum(seconds) AS DECIMAL(18,3)) AS seconds,
  round(sum(rows)::DOUBLE / nullif(CAST(sum(seconds) AS DOUBLE), 0), 1) AS rows_per_second
FROM {TRANSFERS} GROUP BY run_id"""
)
def throughput(spark, sf):
    rows = F.col("event_id") % 100
    transfers = phases(spark, sf).select(
        "run_id",
        rows.alias("rows"),
        (rows * 147).alias("bytes"),
        F.when(F.col("run_id") % 10 == 0, F.lit(0)).otherwise(F.col("seconds")).alias("seconds"),
    )
    return runlog.throughput(transfers)


@check(
    f"""SELECT run_id, phase AS label, done, total, round(done::DOUBLE / total * 100, 1) AS share_pct FROM
(SELECT run_id, phase, event_id % 977 AS done, 1000 AS total FROM {PHASES}
 QUALIFY row_number() OVER (PARTITION BY run_id, phase ORDER BY ts DESC, event_id DESC) = 1)"""
)
def latest_progress(spark, sf):
    reports = phases(spark, sf).select(
        "run_id",
        F.col("phase").alias("label"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 977).alias("done"),
        F.lit(1000).alias("total"),
    )
    return runlog.latest_progress(reports)
