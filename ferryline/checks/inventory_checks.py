"""Object listings: summaries, retention, deletes and transfers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ferryline.checks.registry import INVENTORY, ORDERS, SEGMENTS, check, inventory, orders, table
from ferryline.operators import inventory as inv
from ferryline.operators.load import load
from ferryline.functions.text import duration_seconds
from ferryline.plans.catalog import ORDERS_SCHEMA
from ferryline.runtime import materialize, scratch_database, shared_folder
from ferryline.sources.feed_format import LOAD_FORMAT
from ferryline.sources.feed_writer import write_feed

AS_OF = datetime(2024, 1, 31)
PREFIX = "orders/2024-01-1"


def _shown(column: str) -> str:
    return f"""CASE WHEN {column} < 1024 THEN format('{{:,.1f}}', {column}::DOUBLE) || 'B'
  WHEN {column} < 1048576 THEN format('{{:,.1f}}', {column}::DOUBLE / 1024) || 'KB'
  WHEN {column} < 1073741824 THEN format('{{:,.1f}}', {column}::DOUBLE / 1048576) || 'MB'
  ELSE format('{{:,.1f}}', {column}::DOUBLE / 1073741824) || 'GB' END"""


@check(
    f"""SELECT key, size, last_modified, ends_with(key, '/') AS marker FROM {INVENTORY}
WHERE starts_with(key, '{PREFIX}') ORDER BY key"""
)
def inventory_list(spark, sf):
    return inv.listing(inventory(spark, sf), PREFIX)


@check(
    f"""SELECT count(*) AS objects, CAST(sum(size) AS BIGINT) AS total_bytes, {_shown('sum(size)')} AS total_text
FROM {INVENTORY} WHERE starts_with(key, '{PREFIX}')"""
)
def inventory_totals(spark, sf):
    return inv.totals(inventory(spark, sf), PREFIX)


@check(
    f"""SELECT *, {_shown('total_bytes')} AS total_text, {_shown('min_bytes')} AS min_text,
  {_shown('avg_bytes')} AS avg_text, {_shown('max_bytes')} AS max_text FROM
(SELECT count(*) AS objects, CAST(sum(size) AS BIGINT) AS total_bytes, min(size) AS min_bytes,
  avg(size) AS avg_bytes, max(size) AS max_bytes FROM {INVENTORY})"""
)
def inventory_summary(spark, sf):
    return inv.summary(inventory(spark, sf))


@check(
    f"""SELECT 'orders/' || split_part(key, '/', 2) || '/' AS directory, count(*) AS objects,
  CAST(sum(size) AS BIGINT) AS total_bytes FROM {INVENTORY} GROUP BY 1 ORDER BY 1"""
)
def dir_rollup(spark, sf):
    return inv.child_directories(inventory(spark, sf), "orders")


RUN_LISTING = f"""(SELECT key, size FROM {INVENTORY}
  UNION ALL SELECT DISTINCT 'orders/' || strftime(ts, '%Y-%m-%d') || '/_DONE', 0 FROM events WHERE day(ts) % 3 > 0)"""


@check(
    f"""SELECT 'orders/' || split_part(key, '/', 2) || '/' AS run, bool_or(ends_with(key, '/_DONE')) AS done,
  count(*) FILTER (WHERE NOT ends_with(key, '/_DONE') AND NOT ends_with(key, '/')) AS objects,
  CAST(sum(size) AS BIGINT) AS total_bytes FROM {RUN_LISTING} GROUP BY 1"""
)
def run_states(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    markers = (
        table(spark, sf, "events")
        .where(F.dayofmonth("ts") % 3 > 0)
        .select(F.concat(F.lit("orders/"), day, F.lit("/_DONE")).alias("key"), F.lit(0).alias("size"))
        .distinct()
    )
    return inv.run_states(inventory(spark, sf).select("key", "size").unionByName(markers), "orders")


@check(
    f"SELECT key, size, last_modified FROM {INVENTORY} WHERE last_modified < TIMESTAMP '2024-01-31' - INTERVAL 252 HOUR"
)
def older_than(spark, sf):
    return inv.older_than(inventory(spark, sf), duration_seconds(F.lit("10.5d")), AS_OF)


@check(f"SELECT *, ends_with(key, '/') AS marker FROM {INVENTORY}")
def marker_flag(spark, sf):
    return inv.flag_markers(inventory(spark, sf))


DOOMED = f"(SELECT * FROM {INVENTORY} WHERE starts_with(key, 'orders/2024-01-05/'))"


@check(
    f"""SELECT key, size, n AS total_objects, b AS total_bytes, greatest(n - 10, 0) AS more FROM
(SELECT key, size FROM {DOOMED} ORDER BY key LIMIT 10) CROSS JOIN
(SELECT count(*) AS n, CAST(sum(size) AS BIGINT) AS b FROM {DOOMED})"""
)
def delete_preview(spark, sf):
    return inv.delete_preview(inv.delete_candidates(inventory(spark, sf), "orders/2024-01-05"))


BATCHES = f"(SELECT key, (row_number() OVER (ORDER BY key) - 1) // 1000 AS batch FROM {INVENTORY})"


@check(
    f"SELECT batch, count(*) AS keys, min(key) AS first_key, max(key) AS last_key FROM {BATCHES} GROUP BY batch"
)
def delete_batches(spark, sf):
    batches = inv.delete_batches(inv.delete_candidates(inventory(spark, sf), "orders"))
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("keys"), F.min("key").alias("first_key"), F.max("key").alias("last_key")
    )


@check(
    f"""SELECT count(*) AS requested, count(*) - count(*) FILTER (WHERE size % 11 = 3) AS deleted,
  count(*) FILTER (WHERE size % 11 = 3) AS failed, 'partial' AS status FROM {INVENTORY}"""
)
def delete_reconcile(spark, sf):
    listed = inventory(spark, sf)
    errors = listed.where("size % 11 = 3").select("key", F.lit("AccessDenied").alias("message"))
    return inv.delete_outcome(listed, errors)


PLAN = f"""(SELECT key AS source_key, 'archive/' || substr(key, 8) AS target_key, size FROM {INVENTORY}
WHERE NOT ends_with(key, '/'))"""


def _plan(spark, sf):
    return inv.transfer_plan(inventory(spark, sf), "orders", "archive", recursive=True, drop_markers=True)


@check(f"SELECT * FROM {PLAN}")
def transfer_plan(spark, sf):
    return _plan(spark, sf)


@check(f"SELECT key AS source_key, 'archive/part-7.csv' AS target_key, size FROM {INVENTORY} WHERE key LIKE '%/part-7.csv'")
def transfer_plan_single(spark, sf):
    return inv.transfer_plan(inventory(spark, sf), "orders/2024-01-01/part-7.csv", "archive/")


@check(
    f"""SELECT source_key, target_key, size,
  CASE WHEN source_key = target_key THEN 'skip: same key' WHEN size % 3 = 0 THEN 'skip: exists' ELSE 'copy' END
  AS action
FROM (SELECT * FROM {PLAN} UNION ALL
      SELECT key, key, size FROM {INVENTORY} WHERE size % 7 = 1 AND NOT ends_with(key, '/'))"""
)
def transfer_skips(spark, sf):
    listed = inventory(spark, sf).where(~inv.is_marker(F.col("key")))
    plan = _plan(spark, sf)
    in_place = listed.where("size % 7 = 1").select(
        F.col("key").alias("source_key"), F.col("key").alias("target_key"), "size"
    )
    archived = inv.transfer_plan(listed.where("size % 3 = 0"), "orders/", "archive/").select(
        F.col("target_key").alias("key")
    )
    return inv.transfer_actions(plan.union(in_place), archived)


@check(f"SELECT source_key AS key FROM {PLAN} WHERE size % 3 <> 1")
def move_deletes(spark, sf):
    plan = _plan(spark, sf)
    return inv.move_deletes(plan, plan.where("size % 3 <> 1"))


_HEAD_FILES = """SELECT o_orderkey AS k, o_orderstatus AS status, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS r,
  concat_ws('`', o_orderkey, o_custkey, CAST(o_orderdate AS DATE), CAST(o_totalprice AS DECIMAL(18,2))) AS value FROM orders"""


@check(
    f"""WITH o AS ({_HEAD_FILES}),
h AS (SELECT DISTINCT status, CAST(1 AS INTEGER) AS line_no, 'order_id`customer_id`order_dt`amount' AS value FROM o
      UNION ALL SELECT status, CAST(r + 1 AS INTEGER), value FROM o WHERE r <= 2)
SELECT form || '/' || status AS file, line_no, value FROM h, (VALUES ('plain'), ('packed')) f(form)"""
)
def file_head(spark, sf):
    # One file for each status, plain and packed, in the order of its keys.
    path = shared_folder(spark, "feed")
    for status in ("F", "O", "P"):
        own = orders(spark, sf).where(F.col("status") == status).drop("status")
        write_feed(own, f"{path}/plain/{status}", files=1, order_by=["order_id"])
        write_feed(own, f"{path}/packed/{status}", gzip=True, files=1, order_by=["order_id"])
    heads = inv.file_head(spark, path, 3, "\r\n")
    return heads.withColumn("file", F.array_join(F.slice(F.split("file", "/"), -3, 2), "/"))


@check("SELECT CAST(1 AS INTEGER) AS line_no, 'order_id`customer_id`order_dt`amount`status' AS value")
def file_head_header(spark, sf):
    path = shared_folder(spark, "feed")
    write_feed(orders(spark, sf), f"{path}/plain", files=4)
    write_feed(orders(spark, sf), f"{path}/packed", gzip=True, files=4)
    return inv.file_head(spark, path, 1, "\r\n").select("line_no", "value").distinct()


@check(
    f"""WITH e AS (SELECT DISTINCT 'orders/' || strftime(ts, '%Y-%m-%d') || '/part-' || (event_id + 1) || '.csv' AS key,
   event_id % 13 = 0 AS refused FROM events)
SELECT e.key, CASE WHEN refused THEN 'forbidden' WHEN i.key IS NOT NULL THEN 'present' ELSE 'missing' END AS state,
  CASE WHEN NOT refused THEN i.size END AS size
FROM e LEFT JOIN {INVENTORY} i ON e.key = i.key"""
)
def run_readiness(spark, sf):
    key = F.concat(
        F.lit("orders/"), F.date_format("ts", "yyyy-MM-dd"), F.lit("/part-"), F.col("event_id") + 1, F.lit(".csv")
    )
    wanted = table(spark, sf, "events").select(key.alias("key"), (F.col("event_id") % 13 == 0).alias("refused"))
    return inv.run_readiness(wanted, inventory(spark, sf), wanted.where("refused"))


@check(
    f"""SELECT count(*) AS files, 20000 AS segments, greatest(20000 - count(*), 0) AS idle_segments,
  min(size) AS min_bytes, avg(size) AS avg_bytes, max(size) AS max_bytes
FROM {INVENTORY} WHERE NOT ends_with(key, '/')"""
)
def idle_segments(spark, sf):
    return inv.parallelism(inventory(spark, sf), 20000)


@check(f"SELECT CAST(count(*) AS BIGINT) AS files, CAST({SEGMENTS} AS INTEGER) AS wanted FROM range({SEGMENTS})")
def list_files(spark, sf):
    # The files of a real export: as many as asked for, all below the prefix.
    path = shared_folder(spark, "feed")
    write_feed(orders(spark, sf), path, LOAD_FORMAT, gzip=True, files=SEGMENTS)
    files = inv.list_files(spark, path).where(F.col("key").endswith(".gz") & (F.col("size") > 0))
    return files.agg(F.count(F.lit(1)).alias("files"), F.lit(SEGMENTS).alias("wanted"))


def _yearly_table(spark, sf):
    """Orders in a catalog table partitioned by year."""
    name = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {name} ({columns}, y int) USING parquet PARTITIONED BY (y)")
    load(orders(spark, sf).withColumn("y", F.year("order_dt")), name)
    return name


YEARLY = f"SELECT CAST(year(order_dt) AS INTEGER) AS y, count(*) AS n FROM {ORDERS} GROUP BY 1"


@check(f"SELECT *, y < 1998 AS expired FROM ({YEARLY})")
def retention_split(spark, sf):
    name = _yearly_table(spark, sf)
    per_year = spark.table(name).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return inv.retention_split(per_year, "y", F.lit(1998))


@check(f"SELECT * FROM ({YEARLY}) WHERE y >= 1998")
def retention_drop(spark, sf):
    name = _yearly_table(spark, sf)
    inv.drop_partitions(spark, name, F.col("y") < 1998)
    return spark.table(name).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@check(f"SELECT CASE WHEN y < 1997 THEN 'archive' ELSE 'table' END AS place, y, n FROM ({YEARLY})")
def archive_partition(spark, sf):
    name, archive = _yearly_table(spark, sf), shared_folder(spark, "archive")
    moved = inv.archive_partitions(spark, name, archive, F.col("y") < 1997)
    left = spark.table(name).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    archived = moved.select(F.lit("archive").alias("place"), "y", F.col("archived_rows").alias("n"))
    return archived.unionByName(left.withColumn("place", F.lit("table")))


@check(f"SELECT y, (2 * n)::BIGINT AS n FROM ({YEARLY}) WHERE y < 1997")
def archive_twice(spark, sf):
    # Late rows of an archived partition join the earlier ones in the archive.
    name, archive = _yearly_table(spark, sf), shared_folder(spark, "archive")
    late = materialize(spark.table(name), "late")
    inv.archive_partitions(spark, name, archive, F.col("y") < 1997)
    late.where("y < 1997").write.insertInto(name)
    inv.archive_partitions(spark, name, archive, F.col("y") < 1997)
    return spark.read.parquet(archive).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
