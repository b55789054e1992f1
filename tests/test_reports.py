"""Named queries, previews, run logs and plans."""

import warnings
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ferryline.operators import preview as pv
from ferryline.operators import runlog
from ferryline.operators.numbering import number_rows
from ferryline.plans.export import EXPORT_PHASES, export_query
from ferryline.plans.catalog import QUERIES, parse_parameters, run_query
from ferryline.sources.profiles import read_profile, scan


# -- named queries ------------------------------------------------------------------


@pytest.fixture(scope="module")
def orders(spark):
    rows = [(1, 7, "2026-08-01", "10.5", "PAID"), (2, 8, "2026-08-01", "1", "OPEN"), (3, 7, "2026-08-08", "2", "PAID")]
    df = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, d string, a string, status string")
    df.select(
        "order_id", "customer_id", F.col("d").cast("date").alias("order_dt"), F.col("a").cast("decimal(18,2)").alias("amount"), "status"
    ).createOrReplaceTempView("test_orders")
    return "test_orders"


def test_optional_status(spark, orders):
    day = {"dt": "2026-08-01", "orders": orders}
    assert [r.order_id for r in run_query(spark, "daily_orders", day).collect()] == [1, 2]
    assert [r.order_id for r in run_query(spark, "daily_orders", {**day, "status": "PAID"}).collect()] == [1]
    assert [r.order_id for r in run_query(spark, "daily_orders", {**day, "status": ""}).collect()] == [1, 2]


def test_range_is_closed(spark, orders):
    rows = run_query(spark, "order_range", {"from_dt": "2026-08-01", "to_dt": "2026-08-08", "orders": orders}).collect()
    assert [(r.status, r.order_cnt, r.amount_sum) for r in rows] == [
        ("OPEN", 1, Decimal("1.00")), ("PAID", 1, Decimal("10.50")), ("PAID", 1, Decimal("2.00")),
    ]


def test_missing_parameter(spark):
    with pytest.raises(KeyError, match="missing parameter: dt"):
        run_query(spark, "daily_orders")
    with pytest.raises(KeyError, match="no query 'x'"):
        run_query(spark, "x")


def test_unused_parameter_warns(spark, orders):
    with pytest.warns(UserWarning, match="unused parameter: typo"):
        run_query(spark, "daily_orders", {"dt": "2026-08-01", "orders": orders, "typo": "1"})
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        run_query(spark, "daily_orders", {"dt": "2026-08-01", "orders": orders})


def test_values_are_bound_not_pasted(spark, orders):
    odd = {"dt": "2026-08-01", "orders": orders, "status": "x' OR '1' = '1"}
    assert run_query(spark, "daily_orders", odd).isEmpty()


def test_parameter_texts():
    assert parse_parameters(["a=1", "b=x = y", "a= 2 ", " c =z"]) == {"a": " 2 ", "b": "x = y", "c": "z"}
    for bad in ("dt", "=x", " =x"):
        with pytest.raises(ValueError):
            parse_parameters([bad])


def test_defaults():
    assert QUERIES["order_summary"].bind({"dt": "d"}) == {"schema": "staging", "dt": "d"}


def test_partition_pruning_and_no_python(spark, folder, plan):
    spark.range(50).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("1.00").cast("decimal(18,2)").alias("amount"),
        F.lit("PAID").alias("status"), F.expr("date_add(date'2026-08-01', int(id % 5))").alias("order_dt"),
    ).write.partitionBy("order_dt").parquet(folder)
    spark.read.parquet(folder).createOrReplaceTempView("partitioned_orders")
    df = run_query(
        spark, "order_range", {"from_dt": "2026-08-02", "to_dt": "2026-08-03", "orders": "partitioned_orders"}
    )
    text = plan(df)
    assert "PartitionFilters: [isnotnull(order_dt" in text and "ReadSchema: struct<amount:decimal(18,2),status:string>" in text
    assert sum(r.order_cnt for r in df.collect()) == 20


# -- previews -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "rows, most, shown, more",
    [(100_000, 10, 10, True), (5, 10, 5, False), (10, 10, 10, False), (1000, 0, 1000, False), (0, 10, 0, False)],
)
def test_preview(spark, rows, most, shown, more):
    got = pv.preview(spark.range(rows).orderBy("id"), most).collect()
    assert [r.id for r in got] == list(range(shown))
    assert {r.truncated for r in got} == ({more} if got else set())


def test_preview_reads_only_a_small_part(spark):
    # 2000 tasks of 10^9 rows each would never finish.
    assert len(pv.preview(spark.range(0, 2 * 10**12, 1, 2000), 10).collect()) == 10


def test_preview_columns_of_an_empty_result(spark):
    assert pv.preview_cells(spark.range(0), 5).columns == ["id"]
    with pytest.raises(ValueError):
        pv.preview(spark.range(1), -1)


def test_cells(spark):
    df = spark.createDataFrame([(None, True, Decimal("10.50"), "x")], "a int, b boolean, c decimal(18,2), d string")
    assert tuple(pv.preview_cells(df).first()) == ("NULL", "true", "10.50", "x")
    assert pv.preview_cells(df, null_text="-").first().a == "-"


@pytest.mark.parametrize("most", [2, 0])
def test_vertical(spark, most):
    df = spark.createDataFrame([(2, None), (1, True)], "id int, ok boolean")
    got = sorted(map(tuple, pv.vertical_rows(df, ["id"], most).collect()))
    assert got == [(1, 1, "id", "1"), (1, 2, "ok", "true"), (2, 1, "id", "2"), (2, 2, "ok", "NULL")]


def test_numbering_is_dense_and_ordered(spark):
    df = spark.range(20_000, numPartitions=9).select((F.col("id") * 7919 % 20011).alias("k"))
    got = sorted((r.position, r.k) for r in number_rows(df, ["k"]).collect())
    assert [p for p, _ in got] == list(range(20_000))
    assert [k for _, k in got] == sorted(k for _, k in got)


# -- run logs -------------------------------------------------------------------------


def breakdown(spark, phases, total, order=()):
    log = spark.createDataFrame(
        [(1, p, Decimal(s), i) for i, (p, s) in enumerate(phases)], "run_id int, phase string, seconds decimal(18,3), at int"
    )
    runs = spark.createDataFrame([(1, Decimal(total))], "run_id int, total_seconds decimal(18,3)")
    rows = runlog.phase_breakdown(log, runs, order, first_use="at").orderBy("line_no").collect()
    return [(r.place, r.phase, str(r.seconds), r.share_pct) for r in rows]


def test_worked_example(spark):
    steps = [("open", "0.500"), ("parse", "1.500"), ("save", "1.500"), ("scan", "8.000"), ("merge", "6.000"), ("save", "2.500")]
    order = ["open", "parse", "scan", "merge", "save"]
    assert breakdown(spark, steps, "20.040", order) == [
        (1, "open", "0.500", 2.5),
        (2, "parse", "1.500", 7.5),
        (3, "scan", "8.000", 39.9),
        (4, "merge", "6.000", 29.9),
        (5, "save", "4.000", 20.0),
        (None, "other", "0.040", 0.2),
        (None, "total", "20.040", 100.0),
    ]


def test_zero_phases_and_small_rest_are_hidden(spark):
    rows = breakdown(spark, [("b", "1"), ("a", "1"), ("idle", "0")], "2.001", ["idle"])
    assert [r[1] for r in rows] == ["b", "a", "total"]
    assert breakdown(spark, [("idle", "0")], "5") == []


def test_throughput_and_progress(spark):
    df = spark.createDataFrame(
        [(1, 100, 10, Decimal("2")), (1, 100, 10, Decimal("2")), (2, 5, 1, Decimal("0"))],
        "run_id int, rows bigint, bytes bigint, seconds decimal(18,3)",
    )
    got = {r.run_id: (r.rows, r.bytes, r.rows_per_second) for r in runlog.throughput(df).collect()}
    assert got == {1: (200, 20, 50.0), 2: (5, 1, None)}
    reports = spark.createDataFrame(
        [(1, "x", datetime(2026, 1, 1), 1, 5, 10), (1, "x", datetime(2026, 1, 1), 2, 7, 10), (1, "y", datetime(2026, 1, 1), 1, 3, 0)],
        "run_id int, label string, at timestamp, seq int, done int, total int",
    )
    got = {r.label: (r.done, r.share_pct) for r in runlog.latest_progress(reports).collect()}
    assert got == {"x": (7, 70.0), "y": (3, None)}


def test_export_reports_rows_files_bytes_and_phases(spark, orders, folder):
    given = {"from_dt": "2026-08-01", "to_dt": "2026-08-08", "orders": orders}
    result = export_query(spark, "order_range", given, folder, files=2)
    assert (result.rows, result.files) == (3, 2) and result.bytes > 100
    log, run = result.phase_log(spark, "r"), result.run_log(spark, "r")
    lines = runlog.phase_breakdown(log, run, EXPORT_PHASES).orderBy("line_no").collect()
    assert [r.phase for r in lines][:3] == list(EXPORT_PHASES) and lines[-1].phase == "total"


# -- profiles --------------------------------------------------------------------------


def test_profiles(spark, folder):
    with pytest.raises(ValueError, match="unknown profile"):
        read_profile(spark, "xls", folder)
    with pytest.raises(ValueError, match="schema"):
        read_profile(spark, "csv", folder)
    spark.range(3).write.parquet(folder)
    assert scan(spark, folder).count() == 3
    with pytest.raises(PySparkException):
        scan(spark, "no_such_table").count()
