"""Writing delimited feeds from the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.cells import feed_text, quoted
from ferryline.runtime import data_file_names, remove
from ferryline.sources.feed_format import BYTE_ORDER_MARK, FeedFormat

# monotonically_increasing_id counts from 0 in the low 33 bits of every partition.
ROW_IN_PARTITION = (1 << 33) - 1


# All characters of numbers, dates, times and truth values; they need no escaping
# unless the feed uses one of them as its delimiter or escape character.
PLAIN_CHARACTERS = "0123456789+-.: einfaTruFls"


def row_in_partition() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION))


def _has_any(text: Column, characters: Sequence[str]) -> Column:
    found = F.lit(False)
    for character in characters:
        found = found | text.contains(character)
    return found


def _escaped(text: Column, fmt: FeedFormat) -> Column:
    if not fmt.escape:
        refused = F.raise_error(F.lit("a value needs escaping, but the feed has no escape character"))
        return F.when(_has_any(text, fmt.specials), refused).otherwise(text)
    if fmt.single_line:
        text = F.when(text.contains("\n"), F.raise_error(F.lit("a value holds an LF, but the feed is single_line"))).otherwise(text)
    for special in fmt.specials:
        text = F.replace(text, F.lit(special), F.lit(fmt.escape + special))
    return text


def _quoted_if_needed(text: Column, fmt: FeedFormat) -> Column:
    inner = F.replace(text, F.lit('"'), F.lit('""'))
    return F.when(
        _has_any(text, (fmt.delimiter, '"', "\r", "\n")), F.concat(F.lit('"'), inner, F.lit('"'))
    ).otherwise(text)


def feed_line(df: DataFrame, fmt: FeedFormat = FeedFormat()) -> Column:
    """One record of the feed, without its line end."""
    encode = _quoted_if_needed if fmt.quote else _escaped

    def cell(field: T.StructField) -> Column:
        text = feed_text(quoted(field.name), field.dataType)
        plain = not isinstance(field.dataType, T.StringType) and not any(
            c in PLAIN_CHARACTERS for c in fmt.specials
        )
        return F.coalesce(text if plain else encode(text, fmt), F.lit(fmt.written_null))

    cells = [cell(f) for f in df.schema]
    if len(cells) > 1:
        return F.concat_ws(fmt.delimiter, *cells)
    if fmt.quote:
        return F.when(cells[0] == "", F.lit('""')).otherwise(cells[0])
    refused = F.raise_error(F.lit("a record of one empty field needs quoting"))
    return F.when(cells[0] == "", refused).otherwise(cells[0])


def result_names(df: DataFrame) -> list[str]:
    """Column names without a table prefix."""
    return [name.split(".")[-1] for name in df.columns]


def strip_prefix(df: DataFrame) -> DataFrame:
    return df.toDF(*result_names(df))


def write_feed(
    df: DataFrame,
    path: str,
    fmt: FeedFormat = FeedFormat(),
    *,
    gzip: bool = False,
    files: int | None = None,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    keep_names: bool = False,
) -> int:
    """Write ``df`` as a feed directory and return the number of records.

    The count comes with the write itself; nothing is scanned twice. A header (or
    byte order mark) leads every file, an empty result still gets its header.

    ``files`` sets the number of files, which is the number of parallel readers of
    a gzip feed. With ``order_by`` the files hold consecutive key ranges, each in
    order. ``partition_by`` writes one directory per value; a value with very many
    rows is split over several files instead of being sent to one task. Such a
    directory tree is made for loads and has no header.

    The header drops a table prefix from the names unless ``keep_names``.
    """
    names = df.columns if keep_names else result_names(df)
    first_line = (BYTE_ORDER_MARK if fmt.bom else "") + (
        fmt.header_line(names) + fmt.line_sep if fmt.header else ""
    )
    if partition_by and first_line:
        raise ValueError("a feed with partition_by is written with header=False and bom=False")

    if partition_by:
        if order_by:
            raise ValueError("order_by and partition_by exclude each other")
        df = df.hint("rebalance", *([files] if files else []), *partition_by)
    elif order_by:
        keys = [quoted(c) for c in order_by]
        ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        df = ranged.sortWithinPartitions(*keys)
    elif files:
        df = df.repartition(files)

    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    line = feed_line(df.drop(*partition_by), fmt)
    if first_line:
        leads = F.when(row_in_partition() == 0, F.lit(first_line)).otherwise(F.lit(""))
        line = F.concat(leads, line)
    lines = df.select(line.alias("value"), *[quoted(c) for c in partition_by])

    def save(frame: DataFrame, save_mode: str) -> None:
        writer = frame.write.mode(save_mode).option("lineSep", fmt.line_sep)
        if first_line:
            # A task's file is never cut by the session's limit: its later pieces would have no header.
            writer = writer.option("maxRecordsPerFile", 0)
        if gzip:
            writer = writer.option("compression", "gzip")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.text(path)

    save(lines, mode)
    rows = counted.get.get("rows", 0)
    if rows == 0 and fmt.header:
        only_header = first_line.removesuffix(fmt.line_sep)
        save(df.sparkSession.createDataFrame([(only_header,)], "value string"), "append")
    elif first_line:
        _remove_file_without_lines(df.sparkSession, path)
    return rows


def _remove_file_without_lines(spark: SparkSession, path: str) -> None:
    """Spark writes a file for the first task of a write even if it has no rows; such a file would have no header."""
    for name in data_file_names(spark, path, "part-00000-*"):
        if spark.read.text(name).isEmpty():
            remove(spark, name)
