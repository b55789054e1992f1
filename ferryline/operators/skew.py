"""Is a column a good distribution key, and how even is a distribution?"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.cells import quoted
from ferryline.functions.segments import segment_of

# Thresholds of the key verdict and of the skew grade.
NDV_PER_SEGMENT = 10
MAX_NULL_FRACTION = 0.05
GOOD_SKEW_PCT = 10
BAD_SKEW_PCT = 30

# Columns whose sketches one scan fills.
COLUMNS_PER_SCAN = 3

VERDICT_FEW = "unfit: too few distinct values for the segments"
VERDICT_NULL = "caution: NULLs gather on one segment"
VERDICT_TOP = "caution: the top value exceeds a fair share"
VERDICT_GOOD = "good"
VERDICT_TOP_UNKNOWN = "top value unknown"
VERDICT_NOT_ANALYZED = "not analysed"

GRADE_GOOD = "very good"
GRADE_FAIR = "acceptable"
GRADE_BAD = "look for another key"


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    """Union in pairs: every union is analysed again, so a long chain would be slow to build."""
    level = list(frames)
    while len(level) > 1:
        paired = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2 :]
    return level[0]


def _verdict(ndv: Column, nulls: Column, top: Column, segments: int) -> Column:
    return (
        F.when(ndv < NDV_PER_SEGMENT * segments, F.lit(VERDICT_FEW))
        .when(nulls > MAX_NULL_FRACTION, F.lit(VERDICT_NULL))
        .when(ndv.isNull(), F.lit(VERDICT_NOT_ANALYZED))
        .when(top.isNull(), F.lit(VERDICT_TOP_UNKNOWN))
        .when(top > 1.0 / segments, F.lit(VERDICT_TOP))
        .otherwise(F.lit(VERDICT_GOOD))
    )


def _column_profile(df: DataFrame, name: str) -> DataFrame:
    """Exact profile of one column: two aggregations, the first with partial counts per task."""
    counts = df.groupBy(quoted(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    given = F.col("v").isNotNull()
    return counts.agg(
        F.lit(name).alias("column_name"),
        F.count_if(given).alias("ndv"),
        F.coalesce(F.sum(F.when(~given, F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.max(F.when(given, F.col("n"))), F.lit(0)).alias("top"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def sketched(column: Column, dtype: T.DataType) -> Column:
    """A mergeable sketch of 2^14 buckets of the distinct values (about 0.8 % error).

    The sketch is one small binary per task. ``approx_count_distinct`` at this error
    keeps its buckets as buffer columns and is several times slower on many columns.
    """
    if not isinstance(dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        column = column.cast("string")
    return F.hll_sketch_agg(column, 14)


def _column_estimates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Estimated profiles with fixed-size sketches, a few columns per scan.

    A columnar scan of some columns reads only those, so together the scans read
    the table once, and the tasks stay short on wide tables.
    """
    groups = [names[i : i + COLUMNS_PER_SCAN] for i in range(0, len(names), COLUMNS_PER_SCAN)]
    return _union(_estimate_group(df, group) for group in groups)


def _estimate_group(df: DataFrame, names: Sequence[str]) -> DataFrame:
    profiles = []
    for name in names:
        column = quoted(name)
        spelled = "`" + name.replace("`", "``") + "`"
        top = F.get(F.expr(f"approx_top_k({spelled}, 1) FILTER (WHERE {spelled} IS NOT NULL)"), F.lit(0))
        profiles.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.hll_sketch_estimate(sketched(column, df.schema[name].dataType)).alias("ndv"),
                F.count_if(column.isNull()).alias("nulls"),
                # The sketch keeps no value whose share is below its resolution.
                F.coalesce(top["count"], F.lit(0)).alias("top"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    return df.agg(F.array(*profiles).alias("p")).select(F.inline("p"))


def key_scan(
    df: DataFrame, segments: int, exact: bool = True, columns: Sequence[str] | None = None
) -> DataFrame:
    """Judge every column as a distribution key, most distinct values first.

    Exact mode reads each column once, by itself, in its own type: a columnar scan
    costs the same as one scan of all columns, and no row is multiplied. Counting
    values starts inside the tasks, so a value with a third of the rows arrives as
    one partial count per task. Estimate mode shuffles no values, only one small
    sketch per task and column; use it first on very large tables.
    """
    names = list(columns or df.columns)
    if exact:
        profile = _union(_column_profile(df.select(quoted(n)), n) for n in names)
    else:
        profile = _column_estimates(df, names)
    return judged(profile, segments)


def analyze(spark: SparkSession, table: str) -> None:
    """Collect the catalog statistics that ``key_scan_statistics`` reads."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def key_scan_statistics(spark: SparkSession, table: str, segments: int) -> DataFrame:
    """The same verdict from catalog statistics; no row of the table is read.

    The statistics hold estimated distinct values and NULL counts. They name no most
    frequent value, so its share is NULL and no column is called good. A column that was
    never analysed has NULL figures and says so.
    """
    rows = []
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    total = re.search(r"(\d+) rows", details.get("Statistics", ""))
    for name in spark.table(table).columns:
        escaped = name.replace("`", "``")
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} `{escaped}`").collect()
        info = {r["info_name"]: r["info_value"] for r in described}
        known = total and info.get("distinct_count", "NULL") != "NULL"
        figures = (int(info["distinct_count"]), int(info["num_nulls"]), None, int(total[1])) if known else (None, None, None, None)
        rows.append((name, *figures))
    profile = spark.createDataFrame(rows, "column_name string, ndv bigint, nulls bigint, top bigint, rows bigint")
    return judged(profile, segments)


def _share(fraction: Column, known: Column) -> Column:
    """A rounded share: 0 for an empty table, NULL if it is not known."""
    return F.round(F.when(known.isNotNull(), F.coalesce(fraction, F.lit(0.0))), 4)


def judged(profile: DataFrame, segments: int) -> DataFrame:
    """Verdicts on ``column_name, ndv, nulls, top, rows``, most distinct values first."""
    rows = F.nullif(F.col("rows"), F.lit(0)).cast("double")
    null_fraction, top_fraction = F.col("nulls") / rows, F.col("top") / rows
    return profile.select(
        "column_name",
        "ndv",
        _share(null_fraction, F.col("nulls")).alias("null_frac"),
        _share(top_fraction, F.col("top")).alias("top_value_frac"),
        F.lit(segments).alias("segments"),
        _verdict(F.col("ndv"), null_fraction, top_fraction, segments).alias("verdict"),
    ).orderBy(F.desc("ndv"), "column_name")


def worst_skew(df: DataFrame, keys: Sequence[str], segments: int) -> DataFrame:
    """How far the most frequent key alone overfills its segment; NULL counts as a key."""
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    worst = F.max("n").cast("decimal(38,0)") * segments / F.sum("n")
    return counts.agg(
        F.count(F.lit(1)).alias("ndv"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_freq"),
        F.round(worst, 2).cast("decimal(18,2)").alias("worst_skew_ratio"),
    )


def segment_rows(
    df: DataFrame, keys: Sequence[str], segments: int, portable: bool = True
) -> DataFrame:
    """Rows per segment for a key, largest first. Segments without rows do not appear."""
    return (
        df.groupBy(segment_of([quoted(k) for k in keys], segments, portable).alias("segment"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "segment")
    )


def skew_grade(skew_pct: Column) -> Column:
    return (
        F.when(skew_pct <= GOOD_SKEW_PCT, F.lit(GRADE_GOOD))
        .when(skew_pct > BAD_SKEW_PCT, F.lit(GRADE_BAD))
        .when(skew_pct.isNotNull(), F.lit(GRADE_FAIR))
    )


def _evenness() -> list[Column]:
    """Figures over ``rows`` per segment, where a segment without rows has NULL."""
    rows, all_rows = F.col("rows"), F.coalesce("rows", F.lit(0))

    def spread(counts: Column) -> Column:
        return F.stddev_samp(counts) / F.nullif(F.avg(counts), F.lit(0.0)) * 100

    over = (F.max(rows) / F.nullif(F.avg(rows), F.lit(0.0)) - 1) * 100
    return [
        F.count(rows).alias("segments_with_data"),
        F.count_if(rows.isNull()).alias("empty_segments"),
        F.min(rows).alias("min_rows"),
        F.max(rows).alias("max_rows"),
        F.round(F.avg(rows), 1).alias("avg_rows"),
        F.round(spread(rows), 2).alias("skew_pct"),
        F.round(over, 2).alias("max_over_avg_pct"),
        F.round(spread(all_rows), 2).alias("skew_pct_all"),
    ]


def skew_summary(rows_per_segment: DataFrame, segments: int) -> DataFrame:
    """One row on the evenness of ``segment, rows``.

    The ``_all`` figures count segments without rows as zero; the others look only
    at segments that have rows, which hides an idle segment.
    """
    # Both sides have at most one row per segment.
    every = rows_per_segment.sparkSession.range(segments).select(F.col("id").cast("int").alias("segment"))
    joined = every.join(rows_per_segment, "segment", "left")
    return joined.agg(*_evenness()).withColumn("grade", skew_grade(F.col("skew_pct_all")))


def table_skew(
    tables: Sequence[tuple[str, DataFrame, Sequence[str]]],
    segments: int | Mapping[str, int],
    k: int = 20,
    portable: bool = True,
) -> DataFrame:
    """The ``k`` most unevenly spread of the given (name, table, keys).

    The tables are reduced to their rows per segment; everything after that handles
    ``segments`` small rows per table. ``segments`` may differ by table name.
    With ``stored_segments`` and ``portable=False`` bucketed tables are judged as they are stored.
    """
    number = {name: segments if isinstance(segments, int) else segments[name] for name, _, _ in tables}
    names = ["table_name", "distribution_key"]
    pairs = [(name, ",".join(keys)) for name, _, keys in tables]
    by_frame: dict[int, tuple[DataFrame, list[Column]]] = {}
    for (name, key), (_, df, keys) in zip(pairs, tables):
        place = F.struct(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("distribution_key"),
            segment_of([quoted(c) for c in keys], number[name], portable).alias("segment"),
        )
        by_frame.setdefault(id(df), (df, []))[1].append(place)
    # A table with several candidate keys is read once.
    placed = _union(df.select(F.inline(F.array(*places))) for df, places in by_frame.values())
    # One aggregation over the union: every task counts its rows before the only shuffle.
    counted = placed.groupBy(*names, "segment").agg(F.count(F.lit(1)).alias("rows"))
    every_segment = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("segment")
    listed = [(name, key, number[name]) for name, key in pairs]
    every = counted.sparkSession.createDataFrame(listed, "table_name string, distribution_key string, n int").select(
        *names, every_segment
    )
    return (
        every.join(counted, [*names, "segment"], "left")
        .groupBy(*names)
        .agg(*_evenness())
        .select(*names, F.col("skew_pct_all").alias("skew_coeff"))
        .orderBy(F.desc("skew_coeff"), *names)
        .limit(k)
    )


def partition_rows(df: DataFrame, by: str = "file") -> DataFrame:
    """Rows per file, partition folder or task of a table as it is stored now."""
    path = F.col("_metadata.file_path")
    place = {
        "file": path,
        "folder": F.regexp_replace(path, "/[^/]*$", ""),
        "task": F.spark_partition_id(),
    }[by]
    return (
        df.groupBy(place.alias(by)).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), by)
    )


def rows_to_move(
    sides: Sequence[tuple[str, DataFrame, Sequence[str], Sequence[str]]],
    segments: int,
    portable: bool = True,
) -> DataFrame:
    """Rows each side of a join must send elsewhere first.

    A side is (name, table, distribution key, join key). A row stays where it is if
    its own segment is also the segment of its join key, so no join is needed to
    count: one pass over two columns of each table.
    """
    counted = []
    for name, df, own, join in sides:
        here = segment_of([quoted(c) for c in own], segments, portable)
        there = segment_of([quoted(c) for c in join], segments, portable)
        counted.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.lit(",".join(own)).alias("distribution_key"),
                F.lit(",".join(join)).alias("join_key"),
                F.count(F.lit(1)).alias("total_rows"),
                F.count_if(here != there).alias("moved_rows"),
            )
        )
    share = F.round(F.col("moved_rows") / F.nullif(F.col("total_rows"), F.lit(0)), 4)
    return _union(counted).withColumn("moved_share", F.coalesce(share, F.lit(0.0)))


def approx_ndv(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values per column."""
    return _column_estimates(df, columns).select("column_name", "ndv")
