"""The table of checks and the views they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Run
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under its function name; ``sql`` is the same query for DuckDB."""

    def register(run: Run) -> Run:
        if run.__name__ in CHECKS:
            raise ValueError(f"two checks named {run.__name__}")
        CHECKS[run.__name__] = Check(run, sql)
        return run

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the file once, as a catalog would keep it."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# -- orders in the shape of the order feed ----------------------------------------

ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_dt,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status FROM orders)"""


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_dt"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


# -- events in the shape of an object listing -------------------------------------

INVENTORY = """(SELECT 'orders/' || strftime(ts, '%Y-%m-%d') ||
            CASE WHEN event_id % 500 = 0 THEN '/run-' || event_id || '/'
                 ELSE '/part-' || event_id || '.csv' END AS key,
       CASE WHEN event_id % 500 = 0 THEN 0
            ELSE CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS BIGINT) END AS size,
       ts AS last_modified FROM events)"""


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    marker = F.col("event_id") % 500 == 0
    name = F.when(marker, F.concat(F.lit("/run-"), "event_id", F.lit("/"))).otherwise(
        F.concat(F.lit("/part-"), "event_id", F.lit(".csv"))
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("orders/"), F.date_format("ts", "yyyy-MM-dd"), name).alias("key"),
        F.when(marker, F.lit(0))
        .otherwise((F.col("value").cast("decimal(18,2)") * 1000).cast("bigint"))
        .alias("size"),
        F.col("ts").alias("last_modified"),
    )


# -- events in the shape of a run log ----------------------------------------------

PHASES = """(SELECT user_id AS run_id, event_type AS phase, ts, event_id,
       CAST(value AS DECIMAL(18,2)) AS seconds FROM events)"""
RUNS = f"""(SELECT run_id, CAST(sum(seconds) * 1.25 AS DECIMAL(18,3)) AS total_seconds
       FROM {PHASES} GROUP BY run_id)"""


def phases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("phase"),
        "ts",
        "event_id",
        F.col("value").cast("decimal(18,2)").alias("seconds"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    total = (F.sum("seconds") * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(18,3)")
    return phases(spark, sf).groupBy("run_id").agg(total.alias("total_seconds"))


def md5_bucket(key: str, n: int) -> str:
    """DuckDB spelling of the portable segment of a key."""
    return f"CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {n} AS INTEGER)"


SEGMENTS = 16
