"""Key verdicts and skew figures on tables with a known answer."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.functions.segments import segment_of
from ferryline.operators import distribution, skew, stored_profiles
from ferryline.runtime import scratch_database, shared_folder

SEGMENTS = 16


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(1600).select(
        i.alias("unique_key"),
        (i % 3).alias("three_values"),
        F.when(i % 10 > 0, i).alias("tenth_null"),
        F.when(i % 5 == 0, F.lit(-1)).otherwise(i).alias("fifth_same"),
        F.lit("x").alias("one_value"),
        F.lit(None).cast("string").alias("always_null"),
    )


@pytest.mark.parametrize("exact", [True, False])
def test_key_scan(table, exact):
    rows = {r.column_name: r for r in skew.key_scan(table, SEGMENTS, exact).collect()}
    assert {name: r.verdict for name, r in rows.items()} == {
        "unique_key": skew.VERDICT_GOOD,
        "three_values": skew.VERDICT_FEW,
        "tenth_null": skew.VERDICT_NULL,
        "fifth_same": skew.VERDICT_TOP,
        "one_value": skew.VERDICT_FEW,
        "always_null": skew.VERDICT_FEW,
    }
    assert rows["tenth_null"].null_frac == 0.1 and rows["fifth_same"].top_value_frac == 0.2
    assert rows["always_null"].null_frac == 1 and rows["always_null"].ndv == 0
    if exact:
        assert [rows[n].ndv for n in ("unique_key", "three_values", "tenth_null", "fifth_same")] == [
            1600, 3, 1440, 1281,
        ]


def test_key_scan_orders_by_distinct_values(table):
    found = [r.ndv for r in skew.key_scan(table, SEGMENTS).collect()]
    assert found == sorted(found, reverse=True)


def test_key_scan_of_an_empty_table(table):
    rows = skew.key_scan(table.where("unique_key < 0"), SEGMENTS).collect()
    assert {(r.ndv, r.null_frac, r.top_value_frac) for r in rows} == {(0, 0.0, 0.0)}


def test_estimate_shuffles_no_values(table, plan):
    text = plan(skew.key_scan(table, SEGMENTS, exact=False))
    assert text.count("Range (") == 2 and "hashpartitioning" not in text


def test_segment_is_hashed_once(table, plan):
    rows = skew.segment_rows(table, ["unique_key"], SEGMENTS)
    assert plan(skew.skew_summary(rows, SEGMENTS)).count("md5") == 1


def test_exact_scan_reads_one_column_per_branch(spark, plan):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    text = skew.key_scan(lines, SEGMENTS)._jdf.queryExecution().toString()
    assert text.count("ReadSchema: struct<l_orderkey:bigint>") == 1


def test_worst_skew(table):
    row = skew.worst_skew(table, ["one_value"], SEGMENTS).first()
    assert (row.ndv, row.total_rows, row.max_freq, float(row.worst_skew_ratio)) == (1, 1600, 1600, 16.0)
    assert skew.worst_skew(table, ["tenth_null"], SEGMENTS).first().ndv == 1441
    assert skew.worst_skew(table, ["three_values", "unique_key"], SEGMENTS).first().ndv == 1600
    empty = skew.worst_skew(table.where("1 = 0"), ["unique_key"], SEGMENTS).first()
    assert (empty.ndv, empty.total_rows, empty.worst_skew_ratio) == (0, 0, None)


def test_summary_counts_idle_segments(table):
    row = skew.skew_summary(skew.segment_rows(table, ["one_value"], SEGMENTS), SEGMENTS).first()
    assert (row.segments_with_data, row.empty_segments, row.max_rows) == (1, 15, 1600)
    assert row.grade == skew.GRADE_BAD and row.skew_pct_all == 400.0


def test_grades(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (20.0,), (30.0,), (30.1,), (None,)], "p double")
    assert [r[0] for r in df.select(skew.skew_grade(F.col("p"))).collect()] == [
        skew.GRADE_GOOD, skew.GRADE_GOOD, skew.GRADE_FAIR, skew.GRADE_FAIR, skew.GRADE_BAD, None,
    ]


def test_spark_hash_is_the_layout_spark_really_produces(spark, table):
    want = {
        r.p: r["count"]
        for r in table.repartition(SEGMENTS, "unique_key")
        .groupBy(F.spark_partition_id().alias("p"))
        .count()
        .collect()
    }
    got = {r.segment: r.rows for r in skew.segment_rows(table, ["unique_key"], SEGMENTS, portable=False).collect()}
    assert got == want


def test_segments_of_composite_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None), (None, None)], "k int, t string")
    got = [r[0] for r in df.select(segment_of(["k", "t"], SEGMENTS)).collect()]
    assert all(0 <= s < SEGMENTS for s in got)


def test_table_skew_ranks_and_cuts(table):
    ranked = skew.table_skew(
        [("t", table, ["unique_key"]), ("t", table, ["one_value"]), ("t", table, ["three_values"])], SEGMENTS, 2
    ).collect()
    assert [r.distribution_key for r in ranked] == ["one_value", "three_values"]


def test_table_skew_has_one_shuffle_for_all_tables(table, plan):
    tables = [(f"t{i}", table.where(F.col("unique_key") > i), ["unique_key"]) for i in range(4)]
    text = plan(skew.table_skew(tables, SEGMENTS))
    assert "TakeOrderedAndProject" in text and text.count("partial_count(1)") == 1


def test_partition_rows(spark, table, folder):
    table.repartition(5).write.parquet(folder)
    stored = spark.read.parquet(folder)
    per_file = skew.partition_rows(stored, "file").collect()
    assert len(per_file) == 5 and sum(r.rows for r in per_file) == 1600
    assert sum(r.rows for r in skew.partition_rows(stored, "task").collect()) == 1600


def test_rows_to_move_against_a_count_by_hand(spark, table):
    pair = table.select("unique_key", "fifth_same")
    moved = sum(
        r.a != r.b
        for r in pair.select(
            segment_of(["fifth_same"], SEGMENTS).alias("a"), segment_of(["unique_key"], SEGMENTS).alias("b")
        ).collect()
    )
    got = skew.rows_to_move(
        [("x", pair, ["fifth_same"], ["unique_key"]), ("y", pair, ["unique_key"], ["unique_key"])], SEGMENTS
    )
    rows = {r.table_name: r for r in got.collect()}
    assert rows["x"].moved_rows == moved > 0 and rows["y"].moved_rows == 0
    assert rows["x"].moved_share == round(moved / 1600, 4)


def test_estimates_are_close(spark):
    df = spark.range(200_000).select("id", (F.col("id") % 777).alias("k"), (F.col("id") / 3).alias("d"))
    got = {r.column_name: r.ndv for r in skew.approx_ndv(df, df.columns).collect()}
    for name, exact in (("id", 200_000), ("k", 777), ("d", 200_000)):
        assert abs(got[name] - exact) <= 0.05 * exact


def test_wide_table_union(spark):
    wide = reduce(DataFrame.withColumn, [], spark.range(10)).select(
        *[(F.col("id") % (n + 1)).alias(f"c{n}") for n in range(12)]
    )
    got = {r.column_name: r.ndv for r in skew.key_scan(wide, 2).collect()}
    assert got == {f"c{n}": min(n + 1, 10) for n in range(12)}


def test_skew_of_tables_as_stored(spark):
    database = scratch_database(spark)
    frames = {"even": (spark.range(5000).select("id"), 8), "few": (spark.range(5000).select((F.col("id") % 3).alias("id")), 5)}
    for name, (df, buckets) in frames.items():
        distribution.write_distributed(df, f"{database}.{name}", buckets, ["id"])
    segments = distribution.stored_segments(spark, database)
    assert segments == {"even": 8, "few": 5}
    got = {r.table_name: r.skew_coeff for r in skew.table_skew(distribution.distributed_tables(spark, database), segments, portable=False).collect()}
    for name, (_, buckets) in frames.items():
        bucket = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)\.c000", 1).cast("int").alias("segment")
        stored = spark.table(f"{database}.{name}").groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))
        assert got[name] == skew.skew_summary(stored, buckets).first().skew_pct_all


def test_stored_profiles_are_taken_once(spark):
    name, store = f"{scratch_database(spark)}.t", shared_folder(spark, "profiles")
    i = F.col("id")
    rows = spark.range(3000).select(i.alias("k"), F.when(i % 4 > 0, i % 7).alias("v"), F.lit(None).cast("string").alias("e"), F.when(i % 3 > 0, F.date_add(F.lit("2026-08-01").cast("date"), (i % 3).cast("int"))).alias("d"))
    rows.where("d is null or d < '2026-08-03'").write.partitionBy("d").saveAsTable(name)
    assert stored_profiles.store_profiles(spark, name, store) == ["d=2026-08-02", "d=__HIVE_DEFAULT_PARTITION__"]
    assert stored_profiles.store_profiles(spark, name, store) == []
    rows.where("d = '2026-08-03'").write.insertInto(name)
    assert stored_profiles.store_profiles(spark, name, store) == ["d=2026-08-03"]
    # A changed partition is read again, and its earlier profile no longer counts.
    rows.where("d = '2026-08-03' and k < 300").write.insertInto(name)
    found = {r.column_name: r for r in stored_profiles.key_scan_stored(spark, name, store, 4).collect()}
    wanted = {r.column_name: r for r in skew.key_scan(spark.table(name), 4, columns=["k", "v", "e"]).collect()}
    assert found.keys() == wanted.keys()
    for column, row in wanted.items():
        assert abs(found[column].ndv - row.ndv) <= 0.02 * row.ndv
        assert (found[column].null_frac, found[column].verdict) == (row.null_frac, row.verdict)
        assert abs(found[column].top_value_frac - row.top_value_frac) <= 0.001
    # A column the store lacks is added for every partition; a dropped partition no longer counts.
    assert stored_profiles.store_profiles(spark, name, shared_folder(spark, "other"), ["k"]) == sorted(stored_profiles.partition_states(spark, name))
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (d = '2026-08-02')")
    left = {r.column_name: r for r in stored_profiles.key_scan_stored(spark, name, store, 4).collect()}
    assert abs(left["k"].ndv - 2000) <= 40


def test_stored_profiles_of_plain_and_empty_tables(spark):
    database = scratch_database(spark)
    spark.range(50).write.saveAsTable(f"{database}.plain")
    spark.range(0).withColumn("p", F.lit(1)).write.partitionBy("p").saveAsTable(f"{database}.empty")
    plain = stored_profiles.key_scan_stored(spark, f"{database}.plain", shared_folder(spark, "a"), 4).collect()
    assert [(r.column_name, r.ndv) for r in plain] == [("id", 50)]
    assert stored_profiles.key_scan_stored(spark, f"{database}.empty", shared_folder(spark, "b"), 4).collect() == []
