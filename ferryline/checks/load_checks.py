"""Loads, distributed tables and the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline.checks.registry import ORDERS, check, orders, table
from ferryline.operators import distribution
from ferryline.operators.load import RejectLimitExceeded, load, truncate, write_counted
from ferryline.plans.catalog import ORDERS_SCHEMA, load_orders
from ferryline.runtime import materialize, remove, scratch_database, shared_folder
from ferryline.sources.feed_format import LOAD_FORMAT
from ferryline.sources.feed_reader import read_feed
from ferryline.sources.feed_writer import write_feed
from ferryline.streaming.ingest import ingest_ready, ingest_stream, ingest_table

PER_STATUS = f"""SELECT status, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
FROM {ORDERS} GROUP BY status"""


def _per_status(df):
    return df.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount")
    )


def _orders_table(spark, *, partitioned=False):
    """An empty orders table in a scratch database."""
    name = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    tail = " PARTITIONED BY (status)" if partitioned else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{tail}")
    return name


def _spoiled_feed(spark, sf):
    """An order feed in which every 50th amount is no number and every 75th day no date."""
    path = shared_folder(spark, "feed")
    key = F.col("order_id")
    spoiled = orders(spark, sf).select(
        "order_id",
        "customer_id",
        F.when(key % 75 == 0, F.lit("1998-13-01")).otherwise(F.col("order_dt").cast("string")).alias("order_dt"),
        F.when(key % 50 == 0, F.lit("bad")).otherwise(F.col("amount").cast("string")).alias("amount"),
        "status",
    )
    write_feed(spoiled, path, LOAD_FORMAT)
    return read_feed(spark, path, ORDERS_SCHEMA, LOAD_FORMAT, on_error="flag")


@check(PER_STATUS)
def load_append(spark, sf):
    root, target = shared_folder(spark, "root"), _orders_table(spark)
    data = orders(spark, sf)
    write_feed(data.where("order_dt < '1998-01-01'"), f"{root}/orders/run-1", LOAD_FORMAT, gzip=True, files=4)
    write_feed(data.where("order_dt >= '1998-01-01'"), f"{root}/orders/run-2", LOAD_FORMAT, gzip=True, files=4)
    schema = target.split(".")[0]
    for run in ("run-1", "run-2"):
        load_orders(spark, run, root=root, schema=schema)
    return _per_status(spark.table(target))


@check(f"SELECT order_id, NULL::BIGINT AS customer_id, NULL::DATE AS order_dt, amount, status FROM {ORDERS}")
def load_columns(spark, sf):
    # A load of some columns leaves the others NULL.
    target = _orders_table(spark)
    load(orders(spark, sf), target, ["status", "order_id", "amount"])
    return spark.table(target)


@check(PER_STATUS)
def truncate_reload(spark, sf):
    target = _orders_table(spark)
    load(orders(spark, sf).where("status = 'O'"), target)
    truncate(spark, target)
    load(orders(spark, sf), target)
    return _per_status(spark.table(target))


@check(
    f"""SELECT status, count(*) AS n, CAST(sum(CASE WHEN status = 'F' THEN amount + 1 ELSE amount END)
AS DECIMAL(18,2)) AS amount FROM {ORDERS} GROUP BY status"""
)
def load_replace_partition(spark, sf):
    # The second load replaces the partition it touches and leaves the others alone.
    target = _orders_table(spark, partitioned=True)
    load(orders(spark, sf), target)
    new = orders(spark, sf).where("status = 'F'")
    raised = (F.col("amount") + 1).cast("decimal(18,2)")
    load(new.withColumn("amount", raised), target, mode="replace_partition")
    return _per_status(spark.table(target))


@check(
    f"""SELECT 'append' AS mode, CAST(count(*) AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected,
       false AS published, CAST(0 AS BIGINT) AS rows_in_target FROM {ORDERS}"""
)
def load_dry_run_report(spark, sf):
    target = _orders_table(spark)
    result = load(orders(spark, sf), target, dry_run=True)
    stored = spark.table(target).agg(F.count(F.lit(1)).alias("n")).scalar()
    return result.report(spark).drop("target").withColumn("rows_in_target", stored)


@check(
    f"""SELECT CASE WHEN order_id % 75 = 0 THEN 'order_dt: not a date' ELSE 'amount: not a decimal(18,2)' END
         AS reject_reason,
       order_id || chr(9) || customer_id || chr(9) ||
       CASE WHEN order_id % 75 = 0 THEN '1998-13-01' ELSE CAST(order_dt AS VARCHAR) END || chr(9) ||
       CASE WHEN order_id % 50 = 0 THEN 'bad' ELSE CAST(amount AS VARCHAR) END || chr(9) || status
         AS reject_line
FROM {ORDERS} WHERE order_id % 50 = 0 OR order_id % 75 = 0"""
)
def load_rejects(spark, sf):
    feed = _spoiled_feed(spark, sf)
    return load(feed, shared_folder(spark, "target"), reject_limit=10**12).errors


@check(f"SELECT * FROM {ORDERS} WHERE order_id % 50 <> 0 AND order_id % 75 <> 0")
def load_good(spark, sf):
    target = _orders_table(spark)
    load(_spoiled_feed(spark, sf), target, reject_limit=10**12)
    return spark.table(target)


@check(
    f"""SELECT count(*) FILTER (WHERE order_id % 50 = 0 OR order_id % 75 = 0) > 10 AS stopped,
       CAST(1 AS BIGINT) AS rows_in_target FROM {ORDERS}"""
)
def load_limit_exceeded(spark, sf):
    # The target keeps the one row it had.
    target = _orders_table(spark)
    load(orders(spark, sf).orderBy("order_id").limit(1), target)
    try:
        load(_spoiled_feed(spark, sf), target, reject_limit=10)
        stopped = False
    except RejectLimitExceeded:
        stopped = True
    return spark.table(target).agg(F.lit(stopped).alias("stopped"), F.count(F.lit(1)).alias("rows_in_target"))


@check(f"SELECT CAST(count(*) AS BIGINT) AS affected_rows FROM {ORDERS}")
def affected_rows(spark, sf):
    rows = write_counted(orders(spark, sf), shared_folder(spark, "target"))
    return spark.createDataFrame([(rows,)], "affected_rows bigint")


@check(PER_STATUS)
def stream_ingest(spark, sf):
    source, target, checkpoint = (shared_folder(spark, n) for n in ("source", "target", "checkpoint"))
    data = orders(spark, sf)
    for run, part in (("run-1", "status <> 'O'"), ("run-2", "status = 'O'")):
        write_feed(data.where(part), f"{source}/{run}", LOAD_FORMAT, gzip=True, files=3)
        ingest_stream(spark, source, ORDERS_SCHEMA, target, checkpoint).awaitTermination()
    # A run without news adds nothing.
    ingest_stream(spark, source, ORDERS_SCHEMA, target, checkpoint).awaitTermination()
    return _per_status(spark.read.schema(ORDERS_SCHEMA).parquet(target))


@check(
    f"""SELECT CAST(1 AS INTEGER) AS step, run, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
FROM (SELECT 'run-1' AS run, * FROM {ORDERS} WHERE status <> 'O') GROUP BY run
UNION ALL
SELECT CAST(2 AS INTEGER), run, count(*), CAST(sum(amount) AS DECIMAL(18,2))
FROM (SELECT CASE WHEN status = 'O' THEN 'run-2' ELSE 'run-1' END AS run, * FROM {ORDERS}
      UNION ALL SELECT 'by hand', * FROM {ORDERS} WHERE order_id < 100) GROUP BY run"""
)
def ingest_ready_runs(spark, sf):
    # The second run is half written at the first call. Rows loaded by hand stand beside the runs.
    source, target = shared_folder(spark, "source"), f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {target} ({columns}, run STRING) USING parquet PARTITIONED BY (run)")
    data = orders(spark, sf)

    def totals(step):
        per_run = spark.table(target).groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))
        return materialize(per_run.select(F.lit(step).alias("step"), "run", "n", "amount"), "totals")

    write_feed(data.where("status <> 'O'"), f"{source}/run-1", LOAD_FORMAT, gzip=True, files=3)
    write_feed(data.where("status = 'O' AND order_id % 2 = 0"), f"{source}/run-2", LOAD_FORMAT, files=3)
    remove(spark, f"{source}/run-2/_SUCCESS")
    ingest_ready(spark, source, ORDERS_SCHEMA, target)
    first = totals(1)
    load(data.where("order_id < 100").withColumn("run", F.lit("by hand")), target)
    write_feed(data.where("status = 'O' AND order_id % 2 <> 0"), f"{source}/run-2", LOAD_FORMAT, files=3, mode="append")
    ingest_ready(spark, source, ORDERS_SCHEMA, target, reject_limit=0)
    # A call without news adds nothing.
    ingest_ready(spark, source, ORDERS_SCHEMA, target)
    return first.unionByName(totals(2))


def _bucketed_pair(spark, sf):
    database = scratch_database(spark)
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "order_id")
    distribution.write_distributed(orders(spark, sf), f"{database}.orders", 16, ["order_id"])
    distribution.write_distributed(
        lines.select("order_id", "l_quantity"), f"{database}.lines", 16, ["order_id"]
    )
    return f"{database}.orders", f"{database}.lines"


@check(
    f"""SELECT status, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM {ORDERS} JOIN lineitem ON l_orderkey = order_id GROUP BY status"""
)
def bucketed_join(spark, sf):
    left, right = _bucketed_pair(spark, sf)
    joined = distribution.distributed_join(spark, left, right, ["order_id"])
    return joined.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("quantity"),
    )


def _hot(key):
    """Two orders in five get one key, one in twenty-five another one."""
    return f"CASE WHEN {key} % 5 < 2 THEN 1 WHEN {key} % 25 = 4 THEN 2 ELSE {key} END"


def _joined_per_status(totals):
    return totals.groupBy("status").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("l_quantity").cast("decimal(18,2)").alias("quantity"),
    )


@check(
    f"""WITH l AS (SELECT {_hot("l_orderkey")} AS k, l_quantity FROM lineitem),
r AS (SELECT {_hot("order_id")} AS k, status FROM {ORDERS} WHERE order_id % 5 >= 2 OR order_id < 100)
SELECT status, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM l LEFT JOIN r USING (k) GROUP BY status"""
)
def bucketed_join_hot(spark, sf):
    database = scratch_database(spark)
    lines = table(spark, sf, "lineitem").select(F.expr(_hot("l_orderkey")).alias("k"), "l_quantity")
    some = orders(spark, sf).where("order_id % 5 >= 2 OR order_id < 100").select(F.expr(_hot("order_id")).alias("k"), "status")
    distribution.write_distributed(lines, f"{database}.lines", 16, ["k"])
    distribution.write_distributed(some, f"{database}.some", 16, ["k"])
    # The joined rows are counted, as their number grows with the square of a hot key's rows.
    joined = distribution.distributed_join(
        spark, f"{database}.lines", f"{database}.some", ["k"], "left", heavy_rows=100, by=["status"], sums={"l_quantity": "decimal(18,2)"}
    )
    return _joined_per_status(joined)


@check(
    f"""SELECT status, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM (SELECT {_hot("order_id")} AS k, status FROM {ORDERS}) o
JOIN (SELECT {_hot("l_orderkey")} AS k, l_quantity FROM lineitem WHERE l_orderkey % 5 >= 2 OR l_orderkey < 100) USING (k)
GROUP BY status"""
)
def bucketed_join_stored_keys(spark, sf):
    # Heavy keys are stored after each write; the second write makes those of its table stale.
    database, store = scratch_database(spark), shared_folder(spark, "heavy")
    left, right = f"{database}.orders", f"{database}.lines"
    some = table(spark, sf, "lineitem").where("l_orderkey % 5 >= 2 OR l_orderkey < 100")
    lines = some.select(F.expr(_hot("l_orderkey")).alias("k"), "l_quantity", (F.col("l_orderkey") < 100).alias("early"))
    distribution.write_distributed(orders(spark, sf).select(F.expr(_hot("order_id")).alias("k"), "status"), left, 16, ["k"])
    distribution.write_distributed(lines.where("NOT early").drop("early"), right, 16, ["k"])
    for name in (left, right):
        distribution.store_heavy_keys(spark, name, ["k"], store, 100)
    lines.where("early").drop("early").write.mode("append").bucketBy(16, "k").saveAsTable(right)
    joined = distribution.distributed_join(
        spark, left, right, ["k"], heavy_rows=100, store=store, by=["status"], sums={"l_quantity": "decimal(18,2)"}
    )
    return _joined_per_status(joined)


@check(PER_STATUS)
def redistribute(spark, sf):
    database = scratch_database(spark)
    distribution.write_distributed(orders(spark, sf), f"{database}.orders", 8)
    distribution.redistribute(spark, f"{database}.orders", 16, ["customer_id"])
    return _per_status(spark.table(f"{database}.orders"))


@check(PER_STATUS)
def stream_into_table(spark, sf):
    # Two runs, the second finished after the first call; rows of a load stand beside the batches.
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    target = f"{scratch_database(spark)}.orders"
    spark.sql(f"CREATE TABLE {target} ({columns}, batch STRING) USING parquet PARTITIONED BY (batch)")
    source, state = shared_folder(spark, "in"), shared_folder(spark, "state")
    data = orders(spark, sf)
    for status in ("F", "O"):
        write_feed(data.where(F.col("status") == status), f"{source}/run-{status}", LOAD_FORMAT, gzip=True, files=3)
    remove(spark, f"{source}/run-O/_SUCCESS")
    take = lambda: ingest_table(spark, source, ORDERS_SCHEMA, target, state, marker="_SUCCESS", reject_limit=0, max_files_per_batch=4)
    take()
    load(data.where("status = 'P'").withColumn("batch", F.lit("by hand")), target)
    spark.createDataFrame([], "value string").write.mode("append").text(f"{source}/run-O")
    take()
    return _per_status(spark.table(target))
