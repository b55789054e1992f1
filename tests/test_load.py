"""Loads: all or nothing, dry run, reject limit, partitions, increments."""

import glob
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ferryline.checks import CHECKS
from ferryline.operators import distribution
from ferryline.operators import publish as publishing
from ferryline.operators.load import RejectLimitExceeded, load, truncate, write_counted
from ferryline.operators.publish import place_of, publish, stage, take_back
from ferryline.plans.catalog import ORDERS_SCHEMA, load_orders
from ferryline.runtime import data_file_names, remove, scratch_database, shared_folder
from ferryline.sources.feed_format import LOAD_FORMAT, FeedFormat
from ferryline.sources.feed_reader import read_feed
from ferryline.sources.feed_writer import write_feed
from ferryline.streaming.ingest import ingest_ready, ingest_stream, ingest_table

LINES = [
    "1\t10\t2026-08-01\t10.50\tPAID",
    "2\t11\t2026-08-01\t\\N\tPAID",
    "3\tx\t2026-08-02\t1.00\tOPEN",
    "4\t12\t2026-08-02\tmuch\tOPEN",
    "5\t13\t2026-08-03\t2.00\tO\\\tK",
]


@pytest.fixture
def feed_dir(spark, folder):
    spark.createDataFrame([(v,) for v in LINES], "value string").write.option("lineSep", "\r\n").text(folder)
    return folder


@pytest.fixture
def table(spark):
    name = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
    return name


def flagged(spark, path):
    return read_feed(spark, path, ORDERS_SCHEMA, LOAD_FORMAT, on_error="flag")


def test_rejects_within_the_limit(spark, feed_dir, table):
    result = load(flagged(spark, feed_dir), table, reject_limit=2)
    assert (result.rows_loaded, result.rows_rejected, result.published) == (3, 2, True)
    assert sorted(r.reject_reason for r in result.errors.collect()) == [
        "amount: not a decimal(18,2)",
        "customer_id: not a bigint",
    ]
    assert sorted(r.order_id for r in spark.table(table).collect()) == [1, 2, 5]
    assert spark.table(table).where("order_id = 5").first().status == "O\tK"
    assert spark.table(table).where("order_id = 2").first().amount is None


def test_over_the_limit_publishes_nothing(spark, feed_dir, table):
    with pytest.raises(RejectLimitExceeded, match="2 malformed"):
        load(flagged(spark, feed_dir), table, reject_limit=1)
    assert spark.table(table).isEmpty()


def test_without_limit_the_first_bad_value_fails_and_nothing_is_published(spark, feed_dir, table):
    with pytest.raises(PySparkException):
        load(read_feed(spark, feed_dir, ORDERS_SCHEMA, LOAD_FORMAT), table)
    assert spark.table(table).isEmpty()


@pytest.mark.parametrize("limit", [None, 5])
def test_dry_run_counts_and_publishes_nothing(spark, feed_dir, table, limit):
    feed = flagged(spark, feed_dir)
    if limit is None:
        feed = feed.where("reject_reason IS NULL").drop("reject_reason", "reject_line")
    result = load(feed, table, reject_limit=limit, dry_run=True)
    assert (result.rows_loaded, result.published) == (3, False)
    assert result.report(spark).first().published is False
    assert spark.table(table).isEmpty()


def test_load_appends(spark, table):
    rows = [(1, 10, date(2026, 8, 1), Decimal("1.00"), "PAID")]
    for _ in range(2):
        load(spark.createDataFrame(rows, ORDERS_SCHEMA), table)
    assert spark.table(table).count() == 2
    truncate(spark, table)
    assert spark.table(table).isEmpty()


def test_types_must_agree_and_columns_must_exist(spark, table):
    with pytest.raises(TypeError, match="order_id"):
        load(spark.createDataFrame([("1",)], "order_id string"), table)
    with pytest.raises(ValueError, match="no column other"):
        load(spark.createDataFrame([(1,)], "other bigint"), table)


def test_columns_are_matched_by_name(spark, table):
    load(spark.createDataFrame([("PAID", 7)], "status string, order_id bigint"), table)
    assert tuple(spark.table(table).first()) == (7, None, None, None, "PAID")


@pytest.mark.parametrize("kind", ["table", "folder"])
def test_replace_partition_touches_only_its_partitions(spark, folder, kind):
    schema = "id bigint, day string"
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema)
    new = spark.createDataFrame([(9, "a")], schema)
    if kind == "table":
        target = f"{scratch_database(spark)}.t"
        spark.sql(f"CREATE TABLE {target} ({schema}) USING parquet PARTITIONED BY (day)")
        by = []
    else:
        target, by = folder, ["day"]
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    load(old, target, partition_by=by)
    load(new, target, mode="replace_partition", partition_by=by)
    stored = spark.table(target) if kind == "table" else spark.read.schema(schema).parquet(target)
    assert sorted(map(tuple, stored.collect())) == [(3, "b"), (9, "a")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_replace_partition_needs_partitions(spark, table, folder):
    df = spark.createDataFrame([(1,)], "order_id bigint")
    for target in (table, folder):
        with pytest.raises(ValueError, match="partition"):
            load(df, target, mode="replace_partition")
    with pytest.raises(ValueError, match="mode"):
        write_counted(df, folder, "merge")


def test_affected_rows(spark, folder):
    assert write_counted(spark.range(42), folder) == 42
    assert write_counted(spark.range(0), folder) == 0


def test_named_load_reads_one_run_directory(spark, folder, table):
    for day, text in (("2026-08-01", LINES[0]), ("2026-08-02", LINES[4])):
        lines = spark.createDataFrame([(text,)], "value string")
        lines.write.option("lineSep", "\r\n").option("compression", "gzip").text(f"{folder}/orders/{day}")
    result = load_orders(spark, "2026-08-01", root=folder, schema=table.split(".")[0])
    assert result.rows_loaded == 1 and [r.order_id for r in spark.table(table).collect()] == [1]


def test_stream_takes_every_record_once(spark, folder):
    target, checkpoint = shared_folder(spark, "target"), shared_folder(spark, "checkpoint")
    data = spark.range(1000).select("id", F.concat(F.lit("a\r\n`"), "id").alias("text"))
    fmt = FeedFormat()
    for run in range(3):
        write_feed(data.where(F.col("id") % 3 == run), f"{folder}/run-{run}", fmt, files=3)
        for _ in range(2):
            ingest_stream(
                spark, folder, data.schema, target, checkpoint, fmt, max_files_per_batch=2
            ).awaitTermination()
    stored = spark.read.schema(data.schema).parquet(target)
    assert stored.count() == 1000 and stored.exceptAll(data).isEmpty()


def test_stream_with_bad_records(spark, feed_dir):
    def run(target, checkpoint, on_error):
        ingest_stream(spark, feed_dir, ORDERS_SCHEMA, target, checkpoint, on_error=on_error).awaitTermination()

    target, checkpoint = shared_folder(spark, "target"), shared_folder(spark, "checkpoint")
    with pytest.raises(PySparkException):
        run(target, checkpoint, "fail")
    run(target, checkpoint, "flag")  # the failed run has taken nothing
    stored = spark.read.parquet(target)
    assert sorted(r.order_id for r in stored.where("reject_reason IS NULL").collect()) == [1, 2, 5]
    assert stored.where("reject_reason IS NOT NULL").count() == 2


def bucketed(spark, left, right):
    database = scratch_database(spark)
    distribution.write_distributed(left, f"{database}.l", 8, ["k"])
    distribution.write_distributed(right, f"{database}.r", 8, ["k"])
    return f"{database}.l", f"{database}.r"


def test_counting_heavy_keys_needs_no_exchange(spark, plan):
    left = spark.range(5000).select((F.col("id") % 997).alias("k"), F.col("id").alias("a"))
    name, _ = bucketed(spark, left, left)
    found = distribution.heavy_keys(spark, name, ["k"], 5)
    assert "Exchange" not in plan(found)
    assert sorted(r.k for r in found.collect()) == list(range(15))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy_rows", [3, 10**6])
def test_join_of_bucketed_tables_with_hot_keys(spark, how, heavy_rows):
    def hot(odd):
        key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == odd, F.lit(None))
        return key.when(F.col("id") % 10 == 4, F.lit(-odd)).otherwise(F.col("id"))

    left = spark.range(600).select(hot(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select(hot(2).alias("k"), (F.col("id") * 2).alias("b"))
    tables = bucketed(spark, left, right)
    joined = distribution.distributed_join(spark, *tables, ["k"], how, heavy_rows, pieces=4)
    wanted = left.join(right, "k", how)
    assert sorted(map(str, joined.collect())) == sorted(map(str, wanted.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy_rows", [3, 10**6])
@pytest.mark.parametrize("by, sums", [(["s"], {"a": "decimal(18,2)"}), (["s", "t"], {"a": "bigint", "b": "decimal(9,6)"}), (["k"], {}), ([], {"b": "bigint"})])
def test_totals_of_a_join_of_bucketed_tables(spark, how, heavy_rows, by, sums):
    def hot(odd):
        key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == odd, F.lit(None))
        return key.when(F.col("id") % 10 == 4, F.lit(-odd)).otherwise(F.col("id"))

    def maybe(n):
        return F.nullif(F.col("id") % n, F.lit(0))

    left = spark.range(600).select(hot(1).alias("k"), maybe(11).alias("a"), maybe(3).cast("string").alias("t"))
    right = spark.range(300).select(hot(2).alias("k"), maybe(5).alias("b"), maybe(4).cast("string").alias("s"))
    tables = bucketed(spark, left, right)
    totals = distribution.distributed_join(spark, *tables, ["k"], how, heavy_rows, pieces=4, by=by, sums=sums)
    assert totals.columns == list(dict.fromkeys(["k", *by, "n", *sums]))
    groups = [c for c in by if c != "k"] or ["k"]
    got = totals.groupBy(*groups).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(18,2)").alias(c) for c in sums])
    wanted = left.join(right, "k", how).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("decimal(18,2)").alias(c) for c in sums])
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_totals_of_a_join_refuse_unknown_columns_and_rounding(spark):
    left, right = spark.range(3).selectExpr("id AS k", "id AS a"), spark.range(3).selectExpr("id AS k", "id AS b")
    tables = bucketed(spark, left, right)
    for by, sums in ((["c"], {}), (["b"], {"c": "bigint"}), (["b"], {"b": "bigint"}), ([], {"k": "bigint"})):
        with pytest.raises(ValueError, match="columns of no table"):
            distribution.distributed_join(spark, *tables, ["k"], by=by, sums=sums)
    with pytest.raises(ValueError, match="rounded"):
        distribution.distributed_join(spark, *tables, ["k"], by=["b"], sums={"a": "decimal(18,7)"})


@pytest.mark.parametrize("name", ["bucketed_join_hot", "bucketed_join_stored_keys"])
def test_queries_on_hot_keys_make_no_row_for_each_pair(spark, plan, folder, name):
    # All orders but a few have the hot key 2; their 40 million pairs with the lines would take many times as long as the rest.
    keys = spark.range(2000).select((F.col("id") * 25 + 104).alias("o_orderkey"))
    orders = keys.selectExpr("o_orderkey", "1L AS o_custkey", "DATE'1998-01-01' AS o_orderdate", "1.5D AS o_totalprice", "IF(o_orderkey % 2 = 0, 'O', NULL) AS o_orderstatus")
    orders.write.parquet(f"{folder}/orders.parquet")
    lines = keys.selectExpr("o_orderkey AS l_orderkey", "IF(o_orderkey % 4 = 0, 0.5D, NULL) AS l_quantity", "explode(sequence(1, 10)) AS l_linenumber")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    joined = CHECKS[name].run(spark, str(folder))
    got = {r.status: (r.n, float(r.quantity)) for r in joined.collect()}
    assert got == {"O": (20_000_000, 2_500_000.0), None: (20_000_000, 2_500_000.0)}
    assert most_joined_rows(joined) <= 20_000


def most_joined_rows(df):
    """The most rows that a join of a finished query made."""
    found, work = [0], [df._jdf.queryExecution().executedPlan()]
    while work:
        node = work.pop()
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        inner += [node.children().apply(n) for n in range(node.children().size())]
        work += inner
    return max(found)


def test_join_of_bucketed_tables_refuses_what_it_cannot_cut(spark):
    tables = bucketed(spark, spark.range(3).toDF("k").withColumn("a", F.lit(1)), spark.range(3).toDF("k").withColumn("a", F.lit(1)))
    with pytest.raises(ValueError, match="columns of both"):
        distribution.distributed_join(spark, *tables, ["k"])
    with pytest.raises(ValueError, match="inner"):
        distribution.distributed_join(spark, *tables, ["k"], "full")


def test_heavy_keys_are_counted_once_for_each_state_of_a_table(spark, monkeypatch):
    store = shared_folder(spark, "heavy")
    left = spark.range(300).select(F.expr("CASE WHEN id < 200 THEN 1 WHEN id < 210 THEN NULL ELSE id END").alias("k"), F.col("id").alias("a"))
    right = spark.range(30).select(F.expr("CASE WHEN id < 20 THEN 1 ELSE 200 + id END").alias("k"), F.col("id").alias("b"))
    tables = bucketed(spark, left, right)
    counted = []
    count = distribution.heavy_keys
    monkeypatch.setattr(distribution, "heavy_keys", lambda session, table, *rest: counted.append(table) or count(session, table, *rest))
    assert [distribution.store_heavy_keys(spark, t, ["k"], store, 50).collect() for t in tables] == [[(1,)], []]
    wanted = sorted(map(str, left.join(right, "k", "left").collect()))
    for _ in range(2):
        joined = distribution.distributed_join(spark, *tables, ["k"], "left", 50, 3, store)
        assert sorted(map(str, joined.collect())) == wanted
    assert counted == list(tables)
    # Another limit and changed files are counted anew, and only for the table that they concern.
    distribution.store_heavy_keys(spark, tables[0], ["k"], store, 500)
    more = spark.range(60).select(F.lit(210).cast("long").alias("k"), (F.col("id") + 100).alias("b"))
    buckets = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {tables[1]}").collect() if r.col_name == "Num Buckets")
    more.write.mode("append").bucketBy(int(buckets), "k").saveAsTable(tables[1])
    joined = distribution.distributed_join(spark, *tables, ["k"], "left", 50, 3, store)
    assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right.union(more), "k", "left").collect()))
    assert counted == [*tables, tables[0], tables[1]]


def test_keys_of_a_table_that_changes_meanwhile_are_not_stored(spark, monkeypatch):
    store = shared_folder(spark, "heavy")
    table, _ = bucketed(spark, spark.range(20).toDF("k"), spark.range(20).toDF("k"))
    states = iter(["one", "two"])
    monkeypatch.setattr(distribution, "partition_states", lambda *_: {"": next(states)})
    with pytest.raises(RuntimeError, match="changed"):
        distribution.store_heavy_keys(spark, table, ["k"], store, 5)
    monkeypatch.setattr(distribution, "partition_states", lambda *_: {"": "one"})
    assert distribution.store_heavy_keys(spark, table, ["k"], store, 0).count() == 20


def test_redistribute_keeps_format_and_properties(spark):
    table = f"{scratch_database(spark)}.t"
    data = spark.range(100).withColumn("p", F.col("id") % 3)
    data.write.format("orc").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('owner team' = 'it''s')".replace("''", "\\'"))
    distribution.redistribute(spark, table, 4, ["id"])
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert details["Provider"].lower() == "orc" and details["Num Buckets"] == "4"
    assert {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}["owner team"] == "it's"
    assert spark.table(table).exceptAll(data).isEmpty() and spark.table(table).count() == 100
    assert [t.name for t in spark.catalog.listTables(table.split(".")[0])] == ["t"]


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_redistribute_keeps_partitions(spark, format):
    table = f"{scratch_database(spark)}.t"
    data = spark.range(100).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("a b/"), F.col("id") % 4)).alias("p"))
    data.write.format(format).partitionBy("p").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (p = 'empty')")
    partitions = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    for buckets in (4, 3):
        distribution.redistribute(spark, table, buckets, ["id"])
        details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert details["Provider"].lower() == format and details["Num Buckets"] == str(buckets)
        assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) == partitions
        assert sorted(map(str, spark.table(table).collect())) == sorted(map(str, data.collect()))
        assert spark.table(table).where("p = 'a b/1'").count() == 25
    for name in partitions:
        assert publishing.partition_location(spark, table, name).startswith(details["Location"])
    spark.createDataFrame([(1000, "a b/1")], data.schema).write.insertInto(table)
    assert spark.table(table).where("p = 'a b/1'").count() == 26
    with pytest.raises(ValueError, match="partition columns"):
        distribution.redistribute(spark, table, 4, ["p"])


def test_redistribute_of_an_external_table(spark):
    table, first, second = f"{scratch_database(spark)}.t", shared_folder(spark, "first"), shared_folder(spark, "second")
    data = spark.range(60).withColumn("p", (F.col("id") % 3).cast("int"))
    data.write.option("path", first).partitionBy("p").saveAsTable(table)
    with pytest.raises(ValueError, match="external"):
        distribution.redistribute(spark, table, 4, ["id"])
    distribution.redistribute(spark, table, 4, ["id"], location=second)
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert details["Type"] == "EXTERNAL" and details["Location"].endswith(second) and details["Num Buckets"] == "4"
    assert sorted(map(tuple, spark.table(table).collect())) == sorted(map(tuple, data.collect()))
    # The old files are not the catalog's to remove.
    assert spark.read.parquet(first).count() == 60


def test_redistribute_gives_the_name_back(spark, monkeypatch):
    table = f"{scratch_database(spark)}.t"
    data = spark.range(60).withColumn("p", (F.col("id") % 3).cast("int"))
    data.write.partitionBy("p").saveAsTable(table)
    rename = distribution._rename

    def fail(session, old, new, by):
        if new == table and "__new_" in old:
            raise RuntimeError("lost")
        rename(session, old, new, by)

    monkeypatch.setattr(distribution, "_rename", fail)
    with pytest.raises(RuntimeError, match="lost"):
        distribution.redistribute(spark, table, 4, ["id"])
    assert sorted(map(tuple, spark.table(table).collect())) == sorted(map(tuple, data.collect()))


def test_redistribute_keeps_the_rows(spark):
    table = f"{scratch_database(spark)}.t"
    distribution.write_distributed(spark.range(1000), table, 4)
    distribution.redistribute(spark, table, 8, ["id"])
    assert spark.table(table).exceptAll(spark.range(1000).toDF("id")).isEmpty()
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert details["Num Buckets"] == "8" and "id" in details["Bucket Columns"]


def test_distribution_key_from_the_catalog(spark):
    database = scratch_database(spark)
    distribution.write_distributed(spark.range(10).withColumn("b", F.lit(1)), f"{database}.two", 4, ["id", "b"])
    distribution.write_distributed(spark.range(10), f"{database}.none", 4)
    assert distribution.distribution_key(spark, f"{database}.two") == ["id", "b"]
    assert [(n, k) for n, _, k in distribution.distributed_tables(spark, database)] == [("two", ["id", "b"])]


@pytest.mark.parametrize(
    "kind, bad, good",
    [
        ("date", ["2026", "2026-8", "2026-08-01 garbage", "2026-08-01Txyz"], ["2026-08-01"]),
        ("double", ["3d", "4f", "0x1p3"], ["3", "-4.5e3", ".5", "NaN"]),
        ("timestamp", ["2026", "12:30:00"], ["2026-08-01", "2026-08-01 12:30:00", "2026-08-01T12:30:00.25Z"]),
    ],
)
def test_values_that_only_look_like_the_type_are_rejected(spark, kind, bad, good):
    path = shared_folder(spark, "shapes")
    spark.createDataFrame([(v,) for v in bad + good], "value string").write.option("lineSep", "\r\n").text(path)
    feed = read_feed(spark, path, StructType.fromDDL("v " + kind), LOAD_FORMAT, on_error="flag")
    rows = feed.select(F.col("reject_line"), F.col("v").isNull().alias("none")).collect()
    assert sorted(r.reject_line for r in rows if r.reject_line) == sorted(bad)
    assert [r.none for r in rows if not r.reject_line] == [False] * len(good)
    with pytest.raises(PySparkException):
        read_feed(spark, path, StructType.fromDDL("v " + kind), LOAD_FORMAT).collect()


def test_replacements_in_threads_keep_partitions_and_the_setting(spark):
    from concurrent.futures import ThreadPoolExecutor

    database, before = scratch_database(spark), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    names = [f"{database}.t{n}" for n in range(4)]
    for name in names:
        spark.sql(f"CREATE TABLE {name} (v bigint, p int) USING parquet PARTITIONED BY (p)")
        load(spark.range(4).select(F.col("id").alias("v"), F.col("id").cast("int").alias("p")), name)
    new = spark.range(1).select(F.lit(9).cast("bigint").alias("v"), F.lit(0).alias("p"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda name: load(new, name, mode="replace_partition"), names))
    for name in names:
        assert sorted(r.v for r in spark.table(name).collect()) == [1, 2, 3, 9]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_a_folder_keeps_its_types(spark):
    path = shared_folder(spark, "typed")
    load(spark.range(3), path)
    with pytest.raises(TypeError, match="id is string"):
        load(spark.range(3).select(F.col("id").cast("string")), path)
    assert spark.read.parquet(path).count() == 3


# -- publishing ------------------------------------------------------------------------------


def contents(spark, target):
    rows = spark.table(target) if "/" not in target else spark.read.schema("id bigint, day string").parquet(target)
    return sorted((r["id"], r["day"] or "") for r in rows.select("id", "day").collect())


def days(spark, folder, kind):
    """A target with three days, and its partition columns for a folder."""
    old = spark.createDataFrame([(1, "a"), (2, "b=/ %c"), (3, None)], "id bigint, day string")
    target, by = folder, ["day"]
    if kind == "table":
        target, by = f"{scratch_database(spark)}.t", []
        spark.sql(f"CREATE TABLE {target} (id bigint, day string) USING parquet PARTITIONED BY (day)")
    load(old, target, partition_by=by)
    return target, by


def hidden(spark, target):
    place = place_of(spark, target)
    return [n for n in data_file_names(spark, place.folder, "_data-*")]


@pytest.mark.parametrize("kind", ["table", "folder"])
@pytest.mark.parametrize("mode", ["append", "replace_partition"])
@pytest.mark.parametrize("lost", [False, True])
def test_a_publication_that_fails_leaves_the_target_as_it_was(spark, folder, kind, mode, lost):
    target, by = days(spark, folder, kind)
    before = contents(spark, target)
    new = spark.createDataFrame([(7, "a"), (8, "b=/ %c"), (9, None), (10, "new")], "id bigint, day string")
    place = place_of(spark, target, tuple(by))
    for fails_at in range(4):
        staged = stage(new, place)
        seen = []

        def step(one):
            if len(seen) == fails_at:
                raise KeyboardInterrupt if lost else OSError("injected")
            seen.append(one)

        # An interrupt stands for the loss of the driver: nothing is taken back until the next one looks.
        with pytest.raises(KeyboardInterrupt if lost else OSError):
            publish(spark, place, staged, mode == "replace_partition", step)
        if lost:
            assert take_back(spark, target) == 1 and hidden(spark, target) == []
        else:
            remove(spark, staged)
        if kind == "table":
            spark.catalog.refreshTable(target)
        assert contents(spark, target) == before
    load(new, target, mode=mode, partition_by=by)
    wanted = [(7, "a"), (8, "b=/ %c"), (9, ""), (10, "new")]
    assert contents(spark, target) == sorted(wanted + (before if mode == "append" else []))
    load(new.where("id = 7"), target, mode="replace_partition", partition_by=by)
    load(new.where("id = 7"), target, mode="append", partition_by=by)
    assert [r for r in contents(spark, target) if r[1] == "a"] == [(7, "a"), (7, "a")]


@pytest.mark.parametrize("tail", ["", "PARTITIONED BY (status)", "CLUSTERED BY (order_id) INTO 2 BUCKETS"])
def test_limited_loads_write_good_records_once(spark, feed_dir, tail):
    target = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet {tail}")
    with pytest.raises(RejectLimitExceeded):
        load(flagged(spark, feed_dir), target, reject_limit=0)
    assert spark.table(target).isEmpty() and hidden_or_none(spark, target) == []
    outcome = load(flagged(spark, feed_dir), target, reject_limit=2)
    assert spark.table(target).count() == outcome.rows_loaded > 0 and outcome.errors.count() == outcome.rows_rejected
    assert hidden_or_none(spark, target) == []


def test_a_partitioned_load_of_malformed_records_only(spark, folder):
    target = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet PARTITIONED BY (status)")
    spark.createDataFrame([("bad",)] * 3, "value string").write.option("lineSep", "\r\n").text(folder)
    with pytest.raises(RejectLimitExceeded, match="3 malformed"):
        load(flagged(spark, folder), target, reject_limit=2)
    outcome = load(flagged(spark, folder), target, reject_limit=3)
    assert (outcome.rows_loaded, outcome.rows_rejected, outcome.errors.count()) == (0, 3, 3)
    empty = spark.table(target).where("false")
    assert load(empty, target, mode="replace_partition").rows_loaded == load(empty, target).rows_loaded == 0


def hidden_or_none(spark, target):
    return hidden(spark, target) if place_of(spark, target) else []


def test_a_stream_of_loads(spark, folder):
    target = f"{scratch_database(spark)}.orders"
    spark.sql(f"CREATE TABLE {target} (id bigint, v string, batch string) USING parquet PARTITIONED BY (batch)")
    schema, source, state = "id bigint, v string", f"{folder}/in", f"{folder}/state"

    def run(name, rows, done=True):
        write_feed(spark.createDataFrame(rows, schema).coalesce(1), f"{source}/{name}", LOAD_FORMAT)
        if not done:
            remove(spark, f"{source}/{name}/_SUCCESS")

    def take(**options):
        return ingest_table(spark, source, spark.table(target).drop("batch").schema, target, state, marker="_SUCCESS", **options)

    def stored():
        return sorted((r.id, r.v) for r in spark.table(target).collect())

    run("a", [(1, "x")])
    run("b", [(2, "y")], done=False)
    assert [r.rows_loaded for r in take()] == [1] and stored() == [(1, "x")]
    load(spark.createDataFrame([(5, "z", "own")], schema + ", batch string"), target)
    spark.createDataFrame([], "value string").write.mode("append").text(f"{source}/b")  # its marker
    assert [r.rows_loaded for r in take()] == [1] and stored() == [(1, "x"), (2, "y"), (5, "z")]
    assert take() == []
    # A batch that was loaded, but whose end the checkpoint does not know, is repeated.
    run("c", [(3, "w")])
    take()
    for log in glob.glob(f"{state.removeprefix('file:')}/commits/*1*"):
        os.remove(log)
    take()
    assert stored() == [(1, "x"), (2, "y"), (3, "w"), (5, "z")]
    # Above the limit nothing is loaded, and the batch comes again.
    spark.createDataFrame([("bad",)], "value string").write.option("lineSep", "\r\n").text(f"{source}/d")
    for _ in range(2):
        with pytest.raises(Exception, match="malformed"):
            take(reject_limit=0)
    assert [r.rows_rejected for r in take(reject_limit=1)] == [1] and len(stored()) == 4


@pytest.fixture
def run_table(spark):
    name = f"{scratch_database(spark)}.orders"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA)
    spark.sql(f"CREATE TABLE {name} ({columns}, run STRING) USING parquet PARTITIONED BY (run)")
    return name


def _run(spark, path, lines):
    spark.createDataFrame([(v,) for v in lines], "value string").write.option("lineSep", "\r\n").text(path)


def test_ready_runs_are_loaded_once(spark, folder, run_table):
    good = [LINES[0], LINES[4]]
    source = f"{folder}/some runs%20here"
    _run(spark, f"{source}/run-1", good)
    _run(spark, f"{source}/run.2/inner", good)  # its marker is not at the top of the run
    assert ingest_ready(spark, source, ORDERS_SCHEMA, run_table).rows_loaded == 2
    assert [r.run for r in spark.table(run_table).select("run").distinct().collect()] == ["run-1"]
    spark.createDataFrame([("",)], "value string").write.mode("append").text(f"{source}/run.2/other")
    nothing = ingest_ready(spark, source, ORDERS_SCHEMA, run_table)
    assert (nothing.rows_loaded, nothing.published) == (0, False)


def test_ready_runs_with_bad_records(spark, folder, run_table):
    _run(spark, f"{folder}/a", [LINES[0]])
    ingest_ready(spark, folder, ORDERS_SCHEMA, run_table)
    _run(spark, f"{folder}/b", LINES)
    with pytest.raises(PySparkException):
        ingest_ready(spark, folder, ORDERS_SCHEMA, run_table)
    with pytest.raises(RejectLimitExceeded):
        ingest_ready(spark, folder, ORDERS_SCHEMA, run_table, reject_limit=1)
    assert spark.table(run_table).count() == 1
    result = ingest_ready(spark, folder, ORDERS_SCHEMA, run_table, reject_limit=2)
    assert (result.rows_loaded, result.rows_rejected, result.errors.count()) == (3, 2, 2)
    assert {r.run: r["count"] for r in spark.table(run_table).groupBy("run").count().collect()} == {"a": 1, "b": 3}


def test_ready_runs_need_their_partition_column(spark, folder, table):
    with pytest.raises(ValueError, match="partition column"):
        ingest_ready(spark, folder, ORDERS_SCHEMA, table)
