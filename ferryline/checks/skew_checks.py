"""Distribution-key analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline.checks.registry import ORDERS, SEGMENTS, check, md5_bucket, orders, table
from ferryline.operators import skew
from ferryline.operators import stored_profiles
from ferryline.operators.distribution import distributed_tables, stored_segments, write_distributed
from ferryline.runtime import scratch_database, shared_folder

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "maybe_key",
]
LINES = "(SELECT *, nullif(l_suppkey % 7, 0) AS maybe_key FROM lineitem)"


def _lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.withColumn("maybe_key", F.nullif(F.col("l_suppkey") % 7, F.lit(0)))


PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE v IS NOT NULL) AS BIGINT) AS ndv,
    coalesce(sum(n) FILTER (WHERE v IS NULL), 0) AS nulls,
    coalesce(max(n) FILTER (WHERE v IS NOT NULL), 0) AS top, sum(n) AS total
    FROM (SELECT {c} AS v, count(*) AS n FROM {LINES} GROUP BY 1)"""
    for c in LINE_COLUMNS
)


SCAN = f"""SELECT column_name, ndv, round(nulls::DOUBLE / total, 4) AS null_frac,
  round(top::DOUBLE / total, 4) AS top_value_frac, {SEGMENTS} AS segments,
  CASE WHEN ndv < {SEGMENTS * 10} THEN '{skew.VERDICT_FEW}'
       WHEN nulls::DOUBLE / total > 0.05 THEN '{skew.VERDICT_NULL}'
       WHEN top::DOUBLE / total > 1.0::DOUBLE / {SEGMENTS} THEN '{skew.VERDICT_TOP}'
       ELSE '{skew.VERDICT_GOOD}' END AS verdict FROM ({PROFILE})"""


@check(SCAN)
def key_scan(spark, sf):
    return skew.key_scan(_lines(spark, sf), SEGMENTS)


def _compared(estimate, exact):
    """Estimates next to exact figures: distinct values within 2 %, the top value's share within its bound."""
    figures = exact.select("column_name", F.col("ndv").alias("n"), F.col("top_value_frac").alias("t"))
    return estimate.join(figures, "column_name").select(
        "column_name",
        "null_frac",
        "segments",
        "verdict",
        (F.abs(F.col("ndv") - F.col("n")) <= 0.02 * F.col("n")).alias("ndv_close"),
        (F.abs(F.col("top_value_frac") - F.col("t")) <= 4 / stored_profiles.TRACKED + 0.0001).alias("top_close"),
    )


COMPARED = f"SELECT column_name, null_frac, segments, verdict, true AS ndv_close, true AS top_close FROM ({SCAN})"


@check(COMPARED)
def key_scan_estimate(spark, sf):
    lines = _lines(spark, sf)
    return _compared(skew.key_scan(lines, SEGMENTS, exact=False), skew.key_scan(lines, SEGMENTS))


@check(COMPARED)
def key_scan_stored(spark, sf):
    # Profiles of the earlier years are stored first; the second scan reads the later years only.
    name, store = f"{scratch_database(spark)}.lines", shared_folder(spark, "profiles")
    lines = _lines(spark, sf).withColumn("y", F.year("l_shipdate"))
    early = F.col("y") < 1995
    lines.where(early).hint("rebalance", "y").write.partitionBy("y").saveAsTable(name)
    stored_profiles.store_profiles(spark, name, store, LINE_COLUMNS)
    lines.where(~early).hint("rebalance", "y").write.mode("append").partitionBy("y").saveAsTable(name)
    estimate = stored_profiles.key_scan_stored(spark, name, store, SEGMENTS, LINE_COLUMNS)
    return _compared(estimate, skew.key_scan(_lines(spark, sf), SEGMENTS, columns=LINE_COLUMNS))


NO_TOP = SCAN.replace(f"WHEN top::DOUBLE / total > 1.0::DOUBLE / {SEGMENTS} THEN '{skew.VERDICT_TOP}'", "").replace(skew.VERDICT_GOOD, skew.VERDICT_TOP_UNKNOWN)


@check(f"SELECT column_name, null_frac, segments, verdict FROM ({NO_TOP})")
def key_scan_statistics(spark, sf):
    name = f"{scratch_database(spark)}.lines"
    _lines(spark, sf).write.saveAsTable(name)
    skew.analyze(spark, name)
    return skew.key_scan_statistics(spark, name, SEGMENTS).drop("ndv", "top_value_frac")


@check(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact_ndv, true AS within_5_percent FROM lineitem"
        for c in LINE_COLUMNS[:-1]
    )
)
def approx_ndv(spark, sf):
    lines = table(spark, sf, "lineitem")
    estimate = skew.approx_ndv(lines, LINE_COLUMNS[:-1])
    exact = skew.key_scan(lines, SEGMENTS).select("column_name", F.col("ndv").alias("exact_ndv"))
    close = F.abs(F.col("ndv") - F.col("exact_ndv")) <= 0.05 * F.col("exact_ndv")
    return exact.join(estimate, "column_name").select(
        "column_name", "exact_ndv", close.alias("within_5_percent")
    )


def _worst_sql(keys: str) -> str:
    return f"""SELECT count(*) AS ndv, CAST(sum(n) AS BIGINT) AS total_rows, max(n) AS max_freq,
  CAST(round(max(n)::DOUBLE * {SEGMENTS} / sum(n), 2) AS DECIMAL(18,2)) AS worst_skew_ratio
FROM (SELECT count(*) AS n FROM {ORDERS} GROUP BY {keys})"""


@check(_worst_sql("customer_id"))
def worst_skew(spark, sf):
    return skew.worst_skew(orders(spark, sf), ["customer_id"], SEGMENTS)


@check(_worst_sql("customer_id, order_dt"))
def worst_skew_composite(spark, sf):
    return skew.worst_skew(orders(spark, sf), ["customer_id", "order_dt"], SEGMENTS)


def _segments_sql(key: str, source: str = ORDERS) -> str:
    return f"SELECT {md5_bucket(key, SEGMENTS)} AS segment, count(*) AS rows FROM {source} GROUP BY 1"


@check(_segments_sql("customer_id"))
def segment_rows(spark, sf):
    return skew.segment_rows(orders(spark, sf), ["customer_id"], SEGMENTS)


@check()
def segment_rows_spark_hash(spark, sf):
    return skew.segment_rows(orders(spark, sf), ["customer_id"], SEGMENTS, portable=False)


def _summary_sql(key: str, source: str = ORDERS) -> str:
    return f"""SELECT CAST(count(rows) AS BIGINT) AS segments_with_data,
  CAST(count(*) - count(rows) AS BIGINT) AS empty_segments, min(rows) AS min_rows, max(rows) AS max_rows,
  round(avg(rows), 1) AS avg_rows,
  round(stddev_samp(rows) / nullif(avg(rows), 0) * 100, 2) AS skew_pct,
  round((max(rows) / nullif(avg(rows), 0) - 1) * 100, 2) AS max_over_avg_pct,
  round(stddev_samp(coalesce(rows, 0)) / nullif(avg(coalesce(rows, 0)), 0) * 100, 2) AS skew_pct_all
FROM range({SEGMENTS}) e(segment) LEFT JOIN ({_segments_sql(key, source)}) USING (segment)"""


def _graded(sql: str) -> str:
    return f"""SELECT *, CASE WHEN skew_pct_all <= 10 THEN '{skew.GRADE_GOOD}'
  WHEN skew_pct_all > 30 THEN '{skew.GRADE_BAD}' ELSE '{skew.GRADE_FAIR}' END AS grade FROM ({sql})"""


@check(_graded(_summary_sql("customer_id")))
def skew_summary(spark, sf):
    rows = skew.segment_rows(orders(spark, sf), ["customer_id"], SEGMENTS)
    return skew.skew_summary(rows, SEGMENTS)


@check(_graded(_summary_sql("status")))
def skew_summary_idle(spark, sf):
    # A key of three values leaves most segments without rows.
    rows = skew.segment_rows(orders(spark, sf), ["status"], SEGMENTS)
    return skew.skew_summary(rows, SEGMENTS)


SKEW_TABLES = [
    ("orders", "o_orderkey"), ("orders", "o_custkey"), ("orders", "o_orderstatus"),
    ("lineitem", "l_orderkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_returnflag"),
    ("customer", "c_custkey"), ("customer", "c_nationkey"), ("part", "p_partkey"), ("part", "p_brand"),
    ("supplier", "s_suppkey"), ("supplier", "s_nationkey"), ("events", "event_id"),
    ("events", "user_id"), ("events", "event_type"), ("documents", "doc_id"), ("documents", "lang"),
    ("documents", "source"), ("pages", "page_id"), ("embeddings", "vec_id"), ("embeddings", "label"),
    ("conversations", "conv_id"), ("conversations", "role"),
]


@check(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS distribution_key, skew_pct_all AS skew_coeff FROM ({_summary_sql(k, t)})"
        for t, k in SKEW_TABLES
    )
    + " ORDER BY skew_coeff DESC, table_name, distribution_key LIMIT 20"
)
def table_skew_topk(spark, sf):
    tables = {t: table(spark, sf, t) for t in dict.fromkeys(t for t, _ in SKEW_TABLES)}
    return skew.table_skew([(t, tables[t], [k]) for t, k in SKEW_TABLES], SEGMENTS)


@check(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS distribution_key, skew_pct_all AS skew_coeff FROM ({_summary_sql(k, t)})"
        for t, k in (("orders", "o_custkey"), ("customer", "c_nationkey"))
    )
)
def table_skew_database(spark, sf):
    # Names and keys come from the catalog; the randomly spread table has no key to judge.
    database = scratch_database(spark)
    write_distributed(table(spark, sf, "orders"), f"{database}.orders", 8, ["o_custkey"])
    write_distributed(table(spark, sf, "customer"), f"{database}.customer", 8, ["c_nationkey"])
    write_distributed(table(spark, sf, "part"), f"{database}.part", 8)
    return skew.table_skew(distributed_tables(spark, database), SEGMENTS)


@check()
def table_skew_stored(spark, sf):
    # Each table by its own buckets and by the hash that placed its rows.
    database = scratch_database(spark)
    write_distributed(table(spark, sf, "orders"), f"{database}.orders", 8, ["o_custkey"])
    write_distributed(table(spark, sf, "customer"), f"{database}.customer", 5, ["c_nationkey"])
    return skew.table_skew(distributed_tables(spark, database), stored_segments(spark, database), portable=False)


@check(f"SELECT 'status=' || status AS folder, count(*) AS rows FROM {ORDERS} GROUP BY status")
def partition_rows(spark, sf):
    path = shared_folder(spark, "table")
    orders(spark, sf).hint("rebalance", "status").write.partitionBy("status").parquet(path)
    rows = skew.partition_rows(spark.read.parquet(path), "folder")
    return rows.withColumn("folder", F.substring_index("folder", "/", -1))


@check(f"SELECT CAST(8 AS BIGINT) AS files, count(*) AS rows FROM {ORDERS}")
def partition_rows_by_file(spark, sf):
    # How the rows fall on the files is Spark's choice, their sum is not.
    path = shared_folder(spark, "table")
    orders(spark, sf).repartition(8).write.parquet(path)
    per_file = skew.partition_rows(spark.read.parquet(path), "file")
    return per_file.agg(F.count("file").alias("files"), F.sum("rows").alias("rows"))


def _moved_sql(name: str, source: str, own: str, join: str) -> str:
    moved = f"count(*) FILTER (WHERE {md5_bucket(own, SEGMENTS)} <> {md5_bucket(join, SEGMENTS)})"
    return f"""SELECT '{name}' AS table_name, '{own}' AS distribution_key, '{join}' AS join_key,
  count(*) AS total_rows, {moved} AS moved_rows, round({moved}::DOUBLE / count(*), 4) AS moved_share
FROM {source}"""


@check(
    _moved_sql("lineitem", "lineitem", "l_orderkey", "l_orderkey")
    + " UNION ALL "
    + _moved_sql("orders", "orders", "o_custkey", "o_orderkey")
)
def rows_to_move(spark, sf):
    return skew.rows_to_move(
        [
            ("lineitem", table(spark, sf, "lineitem"), ["l_orderkey"], ["l_orderkey"]),
            ("orders", table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey"]),
        ],
        SEGMENTS,
    )
