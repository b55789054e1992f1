"""Bounded looks at a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.functions.cells import cell_text, format_cells, quoted
from ferryline.operators.numbering import number_rows

# Fixed value: rows of a preview.
DEFAULT_ROWS = 100


def preview(df: DataFrame, max_rows: int = DEFAULT_ROWS) -> DataFrame:
    """The first rows and whether there are more, without counting the rest.

    One row more than asked is fetched; if it comes, ``truncated`` is true. The fetch
    starts with one task and adds more only while rows are missing, so a preview of a
    huge table reads a small part of it. ``0`` means everything: the frame comes back
    without a limit, is not fetched and stays distributed.
    """
    if max_rows < 0:
        raise ValueError("max_rows is at least 0")
    if max_rows == 0:
        return df.withColumn("truncated", F.lit(False))
    rows = df.take(max_rows + 1)  # bounded by the caller
    shown = df.sparkSession.createDataFrame(rows[:max_rows], df.schema)
    return shown.withColumn("truncated", F.lit(len(rows) > max_rows))


def preview_cells(df: DataFrame, max_rows: int = DEFAULT_ROWS, null_text: str = "NULL") -> DataFrame:
    shown = preview(df, max_rows)
    return format_cells(shown.drop("truncated"), null_text)


def vertical_rows(
    df: DataFrame, order_by: Sequence[str], max_rows: int = DEFAULT_ROWS, null_text: str = "NULL"
) -> DataFrame:
    """One row per cell: ``record_no, column_no, column_name, value``.

    ``order_by`` is a unique order of the records. Without a limit the records are
    numbered in parallel.
    """
    columns = df.columns
    if max_rows > 0:
        limited = df.orderBy(*[quoted(c) for c in order_by]).limit(max_rows)
        # At most max_rows rows are in this one-task window.
        numbered = limited.withColumn(
            "__record", F.row_number().over(Window.orderBy(*[quoted(c) for c in order_by]))
        )
    else:
        numbered = number_rows(df, order_by, "__record").withColumn("__record", F.col("__record") + 1)
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("column_no"),
                F.lit(name).alias("column_name"),
                cell_text(quoted(name), df.schema[name].dataType, null_text).alias("value"),
            )
            for i, name in enumerate(columns, 1)
        ]
    )
    return numbered.select(F.col("__record").cast("bigint").alias("record_no"), F.inline(cells))
