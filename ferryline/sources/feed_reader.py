"""Reading delimited feeds into typed columns."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.cells import quoted
from ferryline.sources.feed_format import BYTE_ORDER_MARK, FeedFormat
from ferryline.sources.quoted_records import QUOTE, quoted_records

REJECT_REASON = "reject_reason"
REJECT_LINE = "reject_line"

_FIELDS = "__fields"
_LINE = "__line"


def _split_fields(line: Column, fmt: FeedFormat) -> Column:
    """Raw fields of a record, still escaped.

    A line without the escape character splits at the plain delimiter. Otherwise
    the possessive pattern walks over escaped pairs; it does not backtrack, so its
    cost and stack stay flat for fields of any length.
    """
    plain = F.split(line, re.escape(fmt.delimiter), -1)
    if not fmt.escape:
        return plain
    delimiter, escape = re.escape(fmt.delimiter), re.escape(fmt.escape)
    pattern = f"{delimiter}((?:[^{delimiter}{escape}]++|{escape}[\\s\\S])*+)"
    careful = F.regexp_extract_all(F.concat(F.lit(fmt.delimiter), line), F.lit(pattern), F.lit(1))
    return F.when(line.contains(fmt.escape), careful).otherwise(plain)


def _ends_within_escape(line: Column, fmt: FeedFormat) -> Column:
    """Whether a record ends with an escape character that escapes nothing."""
    if not fmt.escape:
        return F.lit(False)
    tail = F.substring(line, F.length(F.rtrim(line, F.lit(fmt.escape))) + 1, F.length(line))
    return line.endswith(fmt.escape) & (F.length(tail) % 2 == 1)


def _decoded_fields(line: Column, fmt: FeedFormat) -> Column:
    """Texts of a record's fields, NULL for the marker.

    The work per field sits in a lambda. Spelled out per column it would grow past
    the size the JVM compiles, which costs far more than the lambda.
    """
    pair = "[" + re.escape(fmt.escape) + r"]([\s\S])"

    def text(raw: Column) -> Column:
        return F.when(raw != fmt.written_null, raw)

    def unescaped(raw: Column) -> Column:
        return F.when(raw != fmt.written_null, F.regexp_replace(raw, pair, "$1"))

    fields = _split_fields(line, fmt)
    if not fmt.escape:
        return F.transform(fields, text)
    return F.when(line.contains(fmt.escape), F.transform(fields, unescaped)).otherwise(
        F.transform(fields, text)
    )


def _typed(
    records: DataFrame, schema: T.StructType, broken: Column, on_error: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Cast the fields (``__fields``) of records (``__line``) to the declared types."""
    if on_error not in ("fail", "flag"):
        raise ValueError("on_error is 'fail' or 'flag'")
    width = len(schema)
    is_text = [isinstance(f.dataType, T.StringType) for f in schema]
    if on_error == "fail":
        stop = F.raise_error(F.concat(F.lit(f"bad feed record, not {width} fields: "), F.col(_LINE)))
        sound = F.when(broken, stop).otherwise(F.col(_FIELDS))
        return records.select(sound.alias(_FIELDS), *keep).select(
            *[_strict_cast(_field(i), f, records.sparkSession).alias(f.name) for i, f in enumerate(schema)],
            *keep,
        )
    # In two steps each value is parsed once: the second looks for given texts that
    # came out as NULL.
    parsed = records.select(
        _FIELDS,
        _LINE,
        broken.alias("__broken"),
        *keep,
        *[(_field(i) if is_text[i] else _shaped(_field(i), f.dataType).try_cast(f.dataType)).alias(f"__{i}") for i, f in enumerate(schema)],
    )
    reasons = [F.when(F.col("__broken"), F.lit(f"not {width} fields"))]
    for i, f in enumerate(schema):
        if not is_text[i]:
            wrong = F.col(f"__{i}").isNull() & _field(i).isNotNull()
            reasons.append(F.when(wrong, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
    return parsed.select(
        *[F.col(f"__{i}").alias(f.name) for i, f in enumerate(schema)],
        *keep,
        F.coalesce(*reasons).alias(REJECT_REASON),
        _LINE,
    ).select(
        *[quoted(n) for n in schema.names],
        *keep,
        REJECT_REASON,
        F.when(F.col(REJECT_REASON).isNotNull(), F.col(_LINE)).alias(REJECT_LINE),
    )


# How dates, times and floating-point numbers are written; Spark's casts take more.
_DATE = r"\d{4}-\d{2}-\d{2}"
_TIME = _DATE + r"([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?"
_FLOAT = r"[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))"
_SHAPES = {
    T.DateType: _DATE,
    T.TimestampType: _TIME,
    T.TimestampNTZType: _TIME,
    T.FloatType: _FLOAT,
    T.DoubleType: _FLOAT,
}


def _shaped(text: Column, dtype: T.DataType) -> Column:
    """The text, or NULL if it is not written like a value of the type."""
    shape = _SHAPES.get(type(dtype))
    return F.when(text.rlike(rf"^\s*({shape})\s*$"), text) if shape else text


def _field(index: int) -> Column:
    return F.get(F.col(_FIELDS), F.lit(index))


def _strict_cast(text: Column, field: T.StructField, spark: SparkSession) -> Column:
    """A cast that stops on a bad value, also where the session's casts give NULL."""
    if isinstance(field.dataType, T.StringType):
        return text
    if type(field.dataType) not in _SHAPES and spark.conf.get("spark.sql.ansi.enabled") == "true":
        return text.cast(field.dataType)
    reason = F.concat(F.lit(f"bad feed record, {field.name} is not a {field.dataType.simpleString()}: "), text)
    wrong = F.when(text.isNotNull(), F.raise_error(reason).cast(field.dataType))
    return F.coalesce(_shaped(text, field.dataType).try_cast(field.dataType), wrong)


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    fmt: FeedFormat = FeedFormat(),
    on_error: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Turn records (column ``value``) of an unquoted feed into typed columns.

    ``on_error="fail"``: a record with the wrong number of fields, or a bad value in
    a column the query uses, stops the query; so does one that ends within an escape. ``on_error="flag"``: malformed records
    stay in and carry ``reject_reason`` and ``reject_line``.

    Works on batch and streaming frames; ``keep`` passes other columns through.
    """
    records = lines.select(
        F.col("value").alias(_LINE), _decoded_fields(F.col("value"), fmt).alias(_FIELDS), *keep
    )
    broken = (F.size(_FIELDS) != len(schema)) | _ends_within_escape(F.col(_LINE), fmt)
    return _typed(records, schema, broken, on_error, keep)


def _header_is_distinct(schema: T.StructType, fmt: FeedFormat) -> bool:
    """True if no valid record can spell the same line as the header.

    That holds as soon as the name of one number or date column is not itself such
    a value; no legal name of ours is, except odd ones like ``1``.
    """
    return any(
        isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        and re.fullmatch(r"[A-Za-z_]\w*", f.name)
        and f.name.lower() not in ("nan", "inf", "infinity")
        and f.name != fmt.null_marker
        for f in schema
    )


def drop_headers(lines: DataFrame, schema: T.StructType, fmt: FeedFormat) -> DataFrame:
    """Remove the one header line of every file.

    As a rule its text finds it: no record spells the same. If records of only text could do so, the header is found by its
    place, the first line of the part of a file that starts at byte 0, in the pass that reads it, streaming or not.
    """
    header = fmt.header_line(schema.names)
    # The line reader strips a byte order mark at the start of a file.
    if _header_is_distinct(schema, fmt):
        return lines.where(~F.col("value").isin(header, BYTE_ORDER_MARK + header)).select("value")
    placed = lines.select(
        (F.col("_metadata.file_block_start") == 0).alias("leads"), F.col("_metadata.file_path").alias("file"), "value"
    )
    return placed.mapInArrow(_without_first_lines, "value string")


def _without_first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of files read one after the other, without the first line of each part that leads its file."""
    before = None
    for batch in batches:
        if not len(batch):
            continue
        leads, files = batch.column("leads"), batch.column("file")
        same = pc.equal(files.slice(1), files.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
        same &= leads.slice(1).to_numpy(zero_copy_only=False) == leads.slice(0, len(batch) - 1).to_numpy(zero_copy_only=False)
        fresh = [(files[0].as_py(), leads[0].as_py()) != before, *~same]
        before = (files[-1].as_py(), leads[-1].as_py())
        kept = pc.invert(pc.and_(leads, pa.array(fresh, pa.bool_())))
        yield batch.select(["value"]).filter(kept)


def feed_lines(spark: SparkSession, path: str, fmt: FeedFormat, recursive: bool = True) -> DataFrame:
    """The records below a path as text; ``.gz`` files are unpacked by their name."""
    return (
        spark.read.schema("value string")
        .option("lineSep", fmt.line_sep)
        .option("recursiveFileLookup", str(recursive).lower())
        .text(path)
    )


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: FeedFormat = FeedFormat(),
    *,
    recursive: bool = True,
    on_error: str = "fail",
    partition_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read everything below ``path`` with a declared schema; nothing is inferred.

    ``partition_columns`` (name to type) are values of ``name=value`` directories,
    added as columns; a filter on them prunes directories.
    """
    if partition_columns:
        if fmt.quote or fmt.header:
            raise ValueError("partitioned feeds are unquoted and have no header")
        declared = ", ".join(["value string", *[f"`{n}` {t}" for n, t in partition_columns.items()]])
        lines = spark.read.schema(declared).option("lineSep", fmt.line_sep).text(path)
        return parse_lines(lines, schema, fmt, on_error, list(partition_columns))
    if fmt.quote:
        return _read_quoted(spark, path, schema, fmt, recursive, on_error)
    lines = feed_lines(spark, path, fmt, recursive)
    if fmt.header:
        lines = drop_headers(lines, schema, fmt)
    return parse_lines(lines, schema, fmt, on_error)


def _read_quoted(
    spark: SparkSession, path: str, schema: T.StructType, fmt: FeedFormat, recursive: bool, on_error: str
) -> DataFrame:
    lines = feed_lines(spark, path, fmt, recursive).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    raw = quoted_records(lines, fmt.line_sep, fmt.header).select(
        F.col("value").alias(_LINE), _quoted_fields(F.col("value"), fmt).alias("__raw")
    )
    # Without a quote all is split at delimiters. Otherwise what the pattern does not cover is malformed.
    covered = F.aggregate("__raw", F.lit(-1), lambda n, field: n + F.length(field) + 1)
    given = F.transform("__raw", lambda field: _unquoted(field, fmt))
    records = raw.select(_LINE, given.alias(_FIELDS), ((F.size("__raw") != len(schema)) | (covered != F.length(_LINE))).alias("__broken"))
    return _typed(records, schema, F.col("__broken"), on_error)


def _quoted_fields(line: Column, fmt: FeedFormat) -> Column:
    """Fields of a record as they stand there. The possessive pattern does not backtrack, so fields may have any length."""
    delimiter = re.escape(fmt.delimiter)
    pattern = f'{delimiter}("(?:[^"]++|"")*+"|[^{delimiter}"]*+)(?={delimiter}|\\z)'
    careful = F.regexp_extract_all(F.concat(F.lit(fmt.delimiter), line), F.lit(pattern), F.lit(1))
    return F.when(line.contains(QUOTE), careful).otherwise(F.split(line, delimiter, -1))


def _unquoted(field: Column, fmt: FeedFormat) -> Column:
    inner = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit(QUOTE * 2), F.lit(QUOTE))
    text = F.when(field.startswith(QUOTE), inner).otherwise(field)
    return F.when(text != fmt.null_marker, text)
