"""Records of a quoted feed whose files are read by many tasks each.

A value in quotes may hold line ends, so a line is not always a record, and whether a line starts inside quotes depends on
all that stands before it in its file. That is settled by the parity of quotes:

1. Each block of a file counts its lines with an odd number of quotes. There is one row for each block, and a running sum
   over the blocks of a file tells whether a block starts inside quotes.
2. A block without odd lines that starts outside has whole records only. Its lines pass on as they are.
3. The lines of other blocks meet in one task for each block, in order. A running sum finds the lines that start a record,
   and the lines of a record are put together again.
4. What a block has before its first record and after its last whole one is part of a record over several blocks. Blocks have
   at most two such pieces, which are joined in the order of the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.runtime import materialize

QUOTE = '"'


def quotes_in(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(QUOTE), F.lit("")))


def _together(line_sep: str, *order: str) -> Column:
    """The values of a group as one text, in the order of some columns."""
    rows = F.array_sort(F.collect_list(F.struct(*order, "value")))
    return F.array_join(F.transform(rows, lambda r: r["value"]), line_sep)


def block_states(lines: DataFrame) -> DataFrame:
    """One row for each block of a file: ``odd`` lines in it, ``inside`` if it starts within quotes, ``first`` line of the file."""
    blocks = lines.groupBy("file", "block").agg(F.sum(quotes_in(F.col("value")) % 2).alias("odd"), F.min("place").alias("place"))
    own = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("odd").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.select("file", "block", "odd", (before % 2).alias("inside"), F.first("place").over(own).alias("first"))


def quoted_records(lines: DataFrame, line_sep: str, header: bool) -> DataFrame:
    """``value``: the records of quoted feeds, without the first one of each file if there is a ``header``.

    ``lines`` are physical lines: ``file``, ``block`` (where the part of the file starts that one task reads), ``place`` (ascending
    in a block) and ``value``. A quote that is never closed takes in the rest of its file. Empty lines between records are no records.
    """
    states = materialize(block_states(lines), "blocks")
    known = lines.join(states, ["file", "block"])
    simple = (F.col("odd") == 0) & (F.col("inside") == 0)
    plain = known.where(simple).select("place", "first", "value")

    order = Window.partitionBy("file", "block").orderBy("place")
    inside = F.col("inside") + F.coalesce(F.sum(quotes_in(F.col("value")) % 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = known.where(~simple).withColumn("starts", (inside % 2 == 0).cast("int"))
    # Number 0 is what belongs to a record of an earlier block.
    marked = marked.withColumn("number", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = marked.groupBy("file", "block", "number").agg(
        _together(line_sep, "place").alias("value"), F.min("place").alias("place"), F.min("first").alias("first")
    )
    whole = (F.col("number") > 0) & (quotes_in(F.col("value")) % 2 == 0)
    along = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    edges = pieces.where(~whole).withColumn("record", F.sum((F.col("number") > 0).cast("int")).over(along))
    joined = edges.groupBy("file", "record").agg(
        _together(line_sep, "block", "number").alias("value"), F.min_by("place", F.struct("block", "number")).alias("place"), F.min("first").alias("first")
    )
    columns = ["place", "first", "value"]
    records = plain.unionByName(pieces.where(whole).select(*columns)).unionByName(joined.select(*columns))
    records = records.where(F.trim(F.col("value"), F.lit("\r\n")) != "")
    return (records.where("place != first") if header else records).select("value")
