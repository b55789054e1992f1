"""Tables spread by a key, and joins that use it."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.cells import quoted
from ferryline.operators.publish import partition_location, partition_spec
from ferryline.operators.stored_profiles import partition_states
from ferryline.runtime import data_file_names, remove

#: A key with more rows than this on one side is joined in cells; one task handles so many rows easily.
HEAVY_ROWS = 1_000_000
#: Pieces into which each side of a heavy key is cut.
PIECES = 16
#: Decimal places that Spark keeps for sure where it multiplies decimals.
MOST_SCALE = 6


def write_distributed(
    df: DataFrame,
    table: str,
    buckets: int,
    keys: Sequence[str] | None = None,
    *,
    provider: str | None = None,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Save a table hashed into ``buckets`` by ``keys``, or evenly at random without keys.

    Rows are first brought together by key, so a task writes few buckets instead of
    all of them. The rebalance splits a key range that grew too large over several
    tasks; a bucket then simply has more than one file. With a ``path`` the table is external.
    """
    spread = df.hint("rebalance", buckets, *partition_by, *keys) if keys else df.repartition(buckets)
    writer = spread.write
    if provider:
        writer = writer.format(provider)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if keys:
        writer = writer.bucketBy(buckets, *keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def redistribute(
    spark: SparkSession,
    table: str,
    buckets: int,
    keys: Sequence[str] | None = None,
    location: str | None = None,
) -> None:
    """Change the distribution of an existing table; its rows, partitions, format and properties stay.

    The new table is complete before the old one steps aside, and the old one is dropped
    last. If the new name cannot be taken, the old table gets its name back. Partitions without rows
    are registered again, and those of a renamed table are pointed to where its files went, as not
    every catalog moves them along. Rows of partitions that lie elsewhere come into the table's own folder.

    The files of an external table are not the catalog's: its rows go to the new folder ``location``, the
    table points there from then on, and the old files stay where they are.
    """
    details = _table_details(spark, table)
    external = details.get("Type") == "EXTERNAL"
    if external and not location:
        raise ValueError(f"{table} is an external table; name a new folder for its rows")
    if location and not external:
        raise ValueError(f"{table} is not external; its catalog chooses the folder")
    if external and location.rstrip("/") == details["Location"].rstrip("/"):
        raise ValueError("the new folder is the table's present one")
    partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if clash := set(partition_by) & set(keys or ()):
        raise ValueError(f"a table is not distributed by its partition columns: {', '.join(sorted(clash))}")
    database, _, name = table.rpartition(".")
    run = uuid.uuid4().hex[:8]
    new, old = (f"{database}.{n}" if database else n for n in (f"{name}__new_{run}", f"{name}__old_{run}"))
    provider = details.get("Provider")
    write_distributed(spark.table(table), new, buckets, keys, provider=provider, partition_by=partition_by, path=location)
    if partition_by:
        filled = {r[0] for r in spark.sql(f"SHOW PARTITIONS {new}").collect()}
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            if row[0] not in filled:
                spark.sql(f"ALTER TABLE {new} ADD IF NOT EXISTS {partition_spec(row[0])}")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if properties:
        pairs = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ({pairs})")
    _rename(spark, table, old, partition_by)
    try:
        _rename(spark, new, table, partition_by)
    except Exception:
        _rename(spark, old, table, partition_by)
        raise
    spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)


def _rename(spark: SparkSession, table: str, name: str, partition_by: Sequence[str]) -> None:
    """Rename a table, and point its partitions to where its folder went.

    What a catalog makes of their places by itself is not relied on: some leave them, some spell special characters twice.
    """
    before = _table_details(spark, table)["Location"].rstrip("/")
    lay = {}
    if partition_by:
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        lay = {n: partition_location(spark, table, n) for n in names}
    spark.sql(f"ALTER TABLE {table} RENAME TO {name}")
    after = _table_details(spark, name)["Location"].rstrip("/")
    if before == after:
        return
    for partition, place in lay.items():
        if place.startswith(before + "/"):
            place = after + place[len(before) :]
        spark.sql(f"ALTER TABLE {name} {partition_spec(partition)} SET LOCATION {_sql_text(place)}")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table_details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def distribution_key(spark: SparkSession, table: str) -> list[str]:
    """Columns a table is hashed by; empty if it is spread at random."""
    text = _table_details(spark, table).get("Bucket Columns", "[]")
    return [name.strip("` ") for name in text.strip("[]").split(",") if name.strip()]


def distributed_tables(spark: SparkSession, database: str) -> list[tuple[str, DataFrame, list[str]]]:
    """(name, table, distribution key) of every hashed table of a database, from the catalog."""
    found = []
    for entry in spark.catalog.listTables(database):
        if not entry.isTemporary and entry.tableType != "VIEW":
            name = f"{database}.{entry.name}"
            keys = distribution_key(spark, name)
            if keys:
                found.append((entry.name, spark.table(name), keys))
    return sorted(found, key=lambda f: f[0])


def stored_segments(spark: SparkSession, database: str) -> dict[str, int]:
    """Number of buckets of every hashed table of a database, from the catalog."""
    names = [name for name, _, _ in distributed_tables(spark, database)]
    return {name: int(_table_details(spark, f"{database}.{name}")["Num Buckets"]) for name in names}


def heavy_keys(spark: SparkSession, table: str, keys: Sequence[str], rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows, NULLs apart; reads the key columns only.

    On a table bucketed by the keys each task counts its own buckets and nothing is shuffled.
    There are at most (rows of the table / ``rows``) such keys.
    """
    columns = [quoted(k) for k in keys]
    counts = spark.table(table).dropna(subset=list(keys)).groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > rows).select(*columns)


def _heavy_folder(spark: SparkSession, table: str, keys: Sequence[str], rows: int, store: str) -> str:
    """Folder of a store for the heavy keys of a table as its files are now; other files make another folder."""
    what = [table, list(keys), rows, sorted(partition_states(spark, table).items())]
    return f"{store.rstrip('/')}/{hashlib.sha256(json.dumps(what).encode()).hexdigest()}"


def store_heavy_keys(spark: SparkSession, table: str, keys: Sequence[str], store: str, rows: int = HEAVY_ROWS) -> DataFrame:
    """``heavy_keys`` from a store; the table is read only if its files changed since the keys were stored.

    Called after a write, it spares every later join the count. The files are listed before and
    after the count, and keys of a table that changed in between are not stored.
    """
    schema = spark.table(table).select(*[quoted(k) for k in keys]).schema
    path = _heavy_folder(spark, table, keys, rows, store)
    if not data_file_names(spark, path, "_SUCCESS"):
        found = heavy_keys(spark, table, keys, rows)
        found.coalesce(1).write.mode("overwrite").parquet(path)
        if _heavy_folder(spark, table, keys, rows, store) != path:
            remove(spark, path)
            raise RuntimeError(f"{table} changed while its keys were counted; call again")
    return spark.read.schema(schema).parquet(path)


def distributed_join(
    spark: SparkSession,
    left: str,
    right: str,
    on: Sequence[str],
    how: str = "inner",
    heavy_rows: int = HEAVY_ROWS,
    pieces: int = PIECES,
    store: str | None = None,
    by: Sequence[str] | None = None,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """Inner or left join of two tables bucketed by ``on``.

    Each task joins one bucket of both sides and nothing of them is shuffled, but for keys with
    more than ``heavy_rows`` rows on a side. Rows of those are cut at random into ``pieces`` on
    each side, and every pair of pieces is joined by itself, so no task holds such a key.
    The plan is the same at every size; the set of heavy keys may be empty. With a ``store`` the heavy
    keys of both tables come from it (``store_heavy_keys``), and unchanged tables are not counted again.

    The rows of the join may be as many as the square of a key's rows. With ``by``, columns of either table, they are
    counted instead of made: the result has ``n`` for each key and combination of ``by``, and totals of ``sums``
    (column: the type it is summed in; decimals with six places at most). Each side is summed by key and its own columns of ``by``,
    in its buckets, before it is joined, so no more rows meet than there are such combinations. These are totals of parts; sum them up.
    Values of rows without a partner must fit the type, too.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'; leave other joins to Spark")
    keys, a, b = list(on), spark.table(left), spark.table(right)
    own_a, own_b = a.columns, b.columns
    if by is not None:
        a, b = _totals(a, keys, by, sums or {}, "__rows_a"), _totals(b, keys, by, sums or {}, "__rows_b")
    rest_a, rest_b = ([c for c in t.columns if c not in keys] for t in (a, b))
    if clash := set(rest_a) & set(rest_b) or {"__a", "__b"} & {*rest_a, *rest_b}:
        raise ValueError(f"columns of both tables: {', '.join(sorted(clash))}")
    if by is not None and (lost := {*by, *(sums or {})} - {*own_a, *own_b} or {"n", *(sums or {})} & {*keys, *by}):
        raise ValueError(f"columns of no table, or of two meanings: {', '.join(sorted(lost))}")
    columns = [quoted(c) for c in (*keys, *rest_a, *rest_b)]
    padding = [F.lit(None).cast(b.schema[c].dataType).alias(c) for c in rest_b]
    if store:
        found = [store_heavy_keys(spark, table, keys, store, heavy_rows) for table in (left, right)]
    else:
        found = [heavy_keys(spark, table, keys, heavy_rows) for table in (left, right)]
    heavy = found[0].unionByName(found[1]).distinct()

    def hot(rows: DataFrame, piece: str, seed: int) -> DataFrame:
        # Drawn at the scan, whose rows come in a fixed order, so a task that runs again draws the same pieces. Totals come in any order.
        place = F.floor(F.rand(seed) * pieces) if by is None else F.pmod(F.xxhash64(F.lit(seed), *[quoted(c) for c in rows.columns if c in by]), F.lit(pieces))
        return rows.withColumn(piece, place.cast("int")).join(heavy, keys, "left_semi")

    cold = a.dropna(subset=keys).join(heavy, keys, "left_anti").join(b.join(heavy, keys, "left_anti"), keys, how)
    hot_a, hot_b = hot(a, "__a", 1), hot(b, "__b", 2)
    every = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    cells_a, cells_b = hot_a.withColumn("__b", every), hot_b.withColumn("__a", every)
    result = cold.select(*columns).unionByName(cells_a.join(cells_b, [*keys, "__a", "__b"]).select(*columns))
    if how == "left":
        alone = hot_a.join(hot_b.select(*[quoted(k) for k in keys]).distinct(), keys, "left_anti")
        for rows in (alone, a.where(F.array_contains(F.array(*[quoted(k).isNull() for k in keys]), True))):
            result = result.unionByName(rows.select(*[quoted(c) for c in (*keys, *rest_a)], *padding))
    if by is None:
        return result
    # Every row of one side meets every row of the other; one without a partner stands once.
    times = {c: F.coalesce("__rows_b", F.lit(1)) for c in rest_a} | {c: F.col("__rows_a") for c in rest_b}
    totals = [(quoted(c) * times[c]).alias(c) for c in sums or {}]
    return result.select(*[quoted(c) for c in dict.fromkeys((*keys, *by))], (F.col("__rows_a") * times["__rows_a"]).alias("n"), *totals)


def _totals(df: DataFrame, keys: Sequence[str], by: Sequence[str], sums: Mapping[str, str], rows: str) -> DataFrame:
    """Rows and sums of a table for each key and combination of those columns of ``by`` and ``sums`` that it has."""
    groups = [c for c in df.columns if c in keys or c in by]
    figures = []
    for name, kind in sums.items():
        if name in df.columns and name not in groups:
            kind = df.select(quoted(name).cast(kind).alias(name)).schema[0].dataType
            if isinstance(kind, T.DecimalType) and kind.scale > MOST_SCALE:
                raise ValueError(f"{name} would be rounded: sums of decimals have at most {MOST_SCALE} places")
            figures.append(F.sum(quoted(name).cast(kind)).alias(name))
    return df.groupBy(*[quoted(c) for c in groups]).agg(F.count(F.lit(1)).alias(rows), *figures)
