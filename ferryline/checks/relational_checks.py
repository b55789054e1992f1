"""Projections, filters, joins, aggregates, sorts and named queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ferryline.checks.registry import ORDERS, check, md5_bucket, orders, table
from ferryline.functions.segments import segment_of
from ferryline.operators import preview as pv
from ferryline.plans import export
from ferryline.plans.catalog import QUERIES, parse_parameters, run_query
from ferryline.runtime import scratch_database, shared_folder
from ferryline.sources.feed_format import LOAD_FORMAT
from ferryline.sources.feed_reader import read_feed
from ferryline.sources.profiles import scan

DAY = "1998-06-15"

DAILY = f"""SELECT order_id, customer_id, order_dt, amount, status FROM {ORDERS}
WHERE order_dt = DATE '{DAY}'"""
RANGE = f"""SELECT order_dt, status, count(*) AS order_cnt,
       CAST(sum(amount) AS DECIMAL(18,2)) AS amount_sum FROM {ORDERS}
WHERE order_dt BETWEEN DATE '{{}}' AND DATE '{{}}'
GROUP BY order_dt, status ORDER BY order_dt, status"""


def _orders_view(spark, sf):
    orders(spark, sf).createOrReplaceTempView("ferryline_orders")
    return "ferryline_orders"


@check(f"SELECT * FROM {ORDERS}")
def scan_orders(spark, sf):
    return scan(spark, f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_dt"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


@check(DAILY)
def daily_orders(spark, sf):
    return run_query(spark, "daily_orders", {"dt": DAY, "orders": _orders_view(spark, sf)})


@check(DAILY + " AND status = 'F'")
def daily_orders_status(spark, sf):
    return run_query(
        spark, "daily_orders", {"dt": DAY, "status": "F", "orders": _orders_view(spark, sf)}
    )


@check(RANGE.format("1996-01-01", "1996-12-31"))
def order_range(spark, sf):
    return run_query(
        spark,
        "order_range",
        {"from_dt": "1996-01-01", "to_dt": "1996-12-31", "orders": _orders_view(spark, sf)},
    )


@check(RANGE.format("1999-01-01", "1999-03-31"))
def named_query(spark, sf):
    given = parse_parameters(["from_dt=1997-01-01", "to_dt=1999-03-31", "from_dt=1999-01-01"])
    return run_query(spark, "order_range", {**given, "orders": _orders_view(spark, sf)})


@check(RANGE.format("1995-01-01", "2001-12-31"))
def export_query(spark, sf):
    # A named query into a feed, and the feed read back.
    given = {"from_dt": "1995-01-01", "to_dt": "2001-12-31", "orders": _orders_view(spark, sf)}
    path = shared_folder(spark, "feed")
    export.export_query(spark, "order_range", given, path, LOAD_FORMAT, gzip=True)
    return read_feed(spark, path, run_query(spark, "order_range", given).schema, LOAD_FORMAT)


@check(RANGE.format(DAY, DAY))
def order_summary(spark, sf):
    schema = scratch_database(spark)
    orders(spark, sf).write.saveAsTable(f"{schema}.orders")
    return run_query(spark, "order_summary", {"dt": DAY, "schema": schema})


@check(RANGE.format(DAY, DAY))
def order_summary_default(spark, sf):
    # The default schema is swapped for a scratch one, so no real schema is touched.
    schema = scratch_database(spark)
    orders(spark, sf).write.saveAsTable(f"{schema}.orders")
    query = dataclasses.replace(QUERIES["order_summary"], defaults={"schema": schema})
    return run_query(spark, "order_summary", {"dt": DAY}, {"order_summary": query})


@check("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment LIKE '%U%L_'")
def like_filter(spark, sf):
    return (
        table(spark, sf, "customer")
        .where(F.col("c_mktsegment").like("%U%L_"))
        .select("c_custkey", "c_name", "c_mktsegment")
    )


@check(f"SELECT order_id, status FROM {ORDERS} WHERE status NOT IN ('F', 'P')")
def not_in_filter(spark, sf):
    return orders(spark, sf).where(~F.col("status").isin("F", "P")).select("order_id", "status")


@check(
    f"""SELECT status, CAST(count(*) FILTER (WHERE k IS NULL) AS BIGINT) AS nulls,
       CAST(count(*) FILTER (WHERE k IS NOT NULL) AS BIGINT) AS given,
       CAST(count(*) FILTER (WHERE NOT big) AS BIGINT) AS not_big
FROM (SELECT status, nullif(customer_id % 7, 0) AS k, amount > 100000 AS big FROM {ORDERS})
GROUP BY status"""
)
def null_tests(spark, sf):
    k, big = F.nullif(F.col("customer_id") % 7, F.lit(0)), F.col("amount") > 100000
    return (
        orders(spark, sf)
        .select("status", k.alias("k"), big.alias("big"))
        .groupBy("status")
        .agg(
            F.count_if(F.col("k").isNull()).alias("nulls"),
            F.count_if(F.col("k").isNotNull()).alias("given"),
            F.count_if(~F.col("big")).alias("not_big"),
        )
    )


@check(f"SELECT order_id, amount FROM {ORDERS} WHERE {md5_bucket('order_id', 100)} < 5")
def hash_sample(spark, sf):
    return orders(spark, sf).where(segment_of(["order_id"], 100) < 5).select("order_id", "amount")


@check()
def bernoulli_sample(spark, sf):
    return orders(spark, sf).sample(fraction=0.05, seed=7)


@check(
    """SELECT o_orderstatus AS status, l_returnflag AS flag, count(*) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_quantity > 10 AND o_orderstatus <> 'P'
GROUP BY ALL"""
)
def inner_join_cond(spark, sf):
    lines, heads = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    on = (
        (F.col("l_orderkey") == F.col("o_orderkey"))
        & (F.col("l_quantity") > 10)
        & (F.col("o_orderstatus") != "P")
    )
    return (
        lines.join(heads, on)
        .groupBy(F.col("o_orderstatus").alias("status"), F.col("l_returnflag").alias("flag"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("quantity"),
        )
    )


@check(
    f"""SELECT order_id, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT order_id, order_id % 7 + 1 AS line FROM {ORDERS}) o
LEFT JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) l
  ON l.l_orderkey = o.order_id AND l.l_linenumber = o.line"""
)
def left_join_default(spark, sf):
    wanted = orders(spark, sf).select(
        "order_id", (F.col("order_id") % 7 + 1).cast("int").alias("line")
    )
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return wanted.join(lines, ["order_id", "line"], "left").select(
        "order_id", F.coalesce("n", F.lit(0)).alias("n")
    )


@check(
    f"""SELECT status, count(*) AS n, any_value(rows) AS total_rows,
       round(count(*) / any_value(rows), 4) AS share
FROM {ORDERS} CROSS JOIN (SELECT count(*) AS rows FROM {ORDERS}) GROUP BY status"""
)
def cross_join_scalar(spark, sf):
    # The one-row relation comes in as a scalar subquery, not as a join.
    data = orders(spark, sf)
    total = data.agg(F.count(F.lit(1)).alias("total_rows")).scalar()
    return (
        data.groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total_rows", total)
        .withColumn("share", F.round(F.col("n") / F.col("total_rows"), 4))
    )


@check(
    f"""SELECT status, max(amount) AS max_amount,
       CAST(count(*) * 16 - (SELECT count(*) FROM {ORDERS}) AS BIGINT) AS over_fair_share
FROM {ORDERS} GROUP BY status"""
)
def scalar_subquery(spark, sf):
    return spark.sql(
        """SELECT status, max(amount) AS max_amount,
           count(*) * 16 - (SELECT count(*) FROM {orders}) AS over_fair_share
        FROM {orders} GROUP BY status""",
        orders=orders(spark, sf),
    )


@check(
    f"""SELECT min(amount) AS min_amount, max(amount) AS max_amount,
       CAST(round(avg(amount), 2) AS DECIMAL(18,2)) AS avg_amount, min(order_dt) AS first_day,
       max(order_dt) AS last_day FROM {ORDERS}"""
)
def min_max_avg(spark, sf):
    return orders(spark, sf).agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.round(F.avg("amount"), 2).cast("decimal(18,2)").alias("avg_amount"),
        F.min("order_dt").alias("first_day"),
        F.max("order_dt").alias("last_day"),
    )


@check(
    f"""SELECT order_dt, string_agg(status || ':' || n, ', ' ORDER BY status) AS statuses
FROM (SELECT order_dt, status, count(*) AS n FROM {ORDERS} GROUP BY ALL) GROUP BY order_dt"""
)
def ordered_string_agg(spark, sf):
    # Counted per (day, status) first: the list of a day has one entry per status.
    counted = orders(spark, sf).groupBy("order_dt", "status").agg(F.count(F.lit(1)).alias("n"))
    return spark.sql(
        """SELECT order_dt,
           listagg(status || ':' || n, ', ') WITHIN GROUP (ORDER BY status) AS statuses
        FROM {counted} GROUP BY order_dt""",
        counted=counted,
    )


@check(
    f"""SELECT status, CAST(year(order_dt) AS INTEGER) AS y, count(*) AS n FROM {ORDERS}
GROUP BY 1, 2 ORDER BY 2 DESC, 1"""
)
def group_by_ordinal(spark, sf):
    return spark.sql(
        """SELECT status, year(order_dt) AS y, count(*) AS n FROM {orders}
        GROUP BY 1, 2 ORDER BY 2 DESC, 1""",
        orders=orders(spark, sf),
    )


@check(
    """SELECT c_mktsegment AS name FROM customer
UNION SELECT n_name || '.' || c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def union_distinct(spark, sf):
    customers = table(spark, sf, "customer")
    qualified = customers.join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.concat_ws(".", "n_name", "c_mktsegment").alias("name"))
    return customers.select(F.col("c_mktsegment").alias("name")).union(qualified).distinct()


@check(f'SELECT order_id AS "주문번호", status AS "상태", amount AS "금액" FROM {ORDERS}')
def unicode_alias(spark, sf):
    return spark.sql(
        "SELECT order_id AS `주문번호`, status AS `상태`, amount AS `금액` FROM {orders}",
        orders=orders(spark, sf),
    )


# -- previews -----------------------------------------------------------------------


@check(
    f"""SELECT order_id, amount, true AS truncated FROM
(SELECT order_id, amount FROM {ORDERS} ORDER BY amount DESC, order_id LIMIT 100)"""
)
def preview_truncated(spark, sf):
    ordered = orders(spark, sf).select("order_id", "amount").orderBy(F.desc("amount"), "order_id")
    return pv.preview(ordered)


@check(f"SELECT order_id, amount, false AS truncated FROM {ORDERS}")
def preview_all(spark, sf):
    return pv.preview(orders(spark, sf).select("order_id", "amount"), max_rows=0)


@check(
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id,
       coalesce(CAST(nullif(customer_id % 7, 0) AS VARCHAR), 'NULL') AS k,
       CAST(amount AS VARCHAR) AS amount, CAST(order_dt AS VARCHAR) AS order_dt,
       CASE WHEN amount > 100000 THEN 'true' ELSE 'false' END AS big FROM {ORDERS}"""
)
def format_cells(spark, sf):
    k = F.nullif(F.col("customer_id") % 7, F.lit(0))
    data = orders(spark, sf).select(
        "order_id", k.alias("k"), "amount", "order_dt", (F.col("amount") > 100000).alias("big")
    )
    return pv.preview_cells(data, max_rows=0)


@check(
    f"""WITH r AS (SELECT row_number() OVER (ORDER BY order_id) AS record_no, * FROM {ORDERS})
SELECT record_no, 1 AS column_no, 'order_id' AS column_name, CAST(order_id AS VARCHAR) AS value FROM r
UNION ALL SELECT record_no, 2, 'order_dt', CAST(order_dt AS VARCHAR) FROM r
UNION ALL SELECT record_no, 3, 'amount', CAST(amount AS VARCHAR) FROM r
UNION ALL SELECT record_no, 4, 'k', coalesce(CAST(nullif(customer_id % 7, 0) AS VARCHAR), '(null)') FROM r"""
)
def vertical_all(spark, sf):
    k = F.nullif(F.col("customer_id") % 7, F.lit(0))
    data = orders(spark, sf).select("order_id", "order_dt", "amount", k.alias("k"))
    return pv.vertical_rows(data, ["order_id"], max_rows=0, null_text="(null)")


@check(
    f"""WITH r AS (SELECT row_number() OVER (ORDER BY amount, order_id) AS record_no, *
    FROM {ORDERS} QUALIFY record_no <= 100)
SELECT record_no, 1 AS column_no, 'amount' AS column_name, CAST(amount AS VARCHAR) AS value FROM r
UNION ALL SELECT record_no, 2, 'order_id', CAST(order_id AS VARCHAR) FROM r
UNION ALL SELECT record_no, 3, 'status', status FROM r"""
)
def vertical_rows(spark, sf):
    return pv.vertical_rows(orders(spark, sf).select("amount", "order_id", "status"), ["amount", "order_id"])
