"""Expressions that read or print durations, sizes, locations and messages."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per duration unit. No unit means hours.
DURATION_UNITS = {"m": 60, "h": 3600, "d": 86400, "w": 604800}

# Bytes per size unit.
SIZE_UNITS = {"KB": 1024, "MB": 1024**2, "GB": 1024**3}

# Words of a refused multipart start.
MULTIPART_START = "CreateMultipartUpload"
DENIED_WORDS = ("AccessDenied", "Forbidden", "403", "NotImplemented", "MethodNotAllowed")

# Words of a rejected statement, lower case.
SYNTAX_WORDS = ("syntax", "parseexception", "analysisexception")

# Java parses "3d" and "3f" as numbers; a duration or size must not.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _number(text: Column) -> Column:
    text = _stripped(text)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def duration_seconds(text: Column) -> Column:
    """``90m``, ``24h``, ``7d``, ``2w``, ``12`` (hours) as seconds; NULL if malformed."""
    value = F.lower(_stripped(text))
    unit = F.right(value, F.lit(1))
    factor = F.create_map(*[F.lit(x) for pair in DURATION_UNITS.items() for x in pair])[unit]
    number = F.when(factor.isNull(), value).otherwise(
        F.substring(value, F.lit(1), F.length(value) - 1)
    )
    return _number(number) * F.coalesce(factor, F.lit(3600))


def size_bytes(text: Column) -> Column:
    """``512``, ``8KB``, ``8MiB``, ``1.5GB`` as whole bytes; NULL if malformed."""
    value = F.replace(F.upper(_stripped(text)), F.lit("IB"), F.lit("B"))
    unit = F.right(value, F.lit(2))
    factor = F.create_map(*[F.lit(x) for pair in SIZE_UNITS.items() for x in pair])[unit]
    number = (
        F.when(factor.isNotNull(), F.substring(value, F.lit(1), F.length(value) - 2))
        .when(value.endswith("B"), F.substring(value, F.lit(1), F.length(value) - 1))
        .otherwise(value)
    )
    return (_number(number) * F.coalesce(factor, F.lit(1))).try_cast("bigint")


def human_bytes(size: Column) -> Column:
    """Bytes with one decimal and the largest fitting unit up to GB."""
    size = size.cast("double")
    text = F.concat(F.format_number(size / 1024**3, 1), F.lit("GB"))
    for power, unit in ((2, "MB"), (1, "KB"), (0, "B")):
        scaled = size / float(1024**power)
        fits = F.abs(scaled) < 1024
        shown = F.concat(F.format_number(scaled, 1), F.lit(unit))
        text = F.when(fits, shown).otherwise(text)
    return text


def human_seconds(seconds: Column, units: tuple[str, str, str] = ("시간", "분", "초")) -> Column:
    """Seconds as ``9.5초``, ``1분 30초`` or ``1시간 2분 5초``; units can be replaced."""
    hour, minute, second = units
    whole = seconds.cast("bigint")
    hours = F.floor(whole / 3600).cast("string")
    minutes = F.floor(whole % 3600 / 60).cast("string")
    rest = (whole % 60).cast("string")
    short = F.concat(minutes, F.lit(f"{minute} "), rest, F.lit(second))
    return (
        F.when(seconds < 60, F.concat(F.format_number(seconds.cast("double"), 1), F.lit(second)))
        .when(whole >= 3600, F.concat(hours, F.lit(f"{hour} "), short))
        .otherwise(short)
    )


def uri_parts(uri: Column, scheme: str = "s3", default_bucket: str | None = None) -> Column:
    """``struct(bucket, key, valid)`` of a location.

    A value without the scheme is a bare key of ``default_bucket``; with no default
    it is invalid.
    """
    head = f"{scheme}://"
    full = uri.startswith(head)
    rest = F.substring(uri, F.lit(len(head) + 1), F.length(uri))
    slash = F.instr(rest, "/")
    bucket = F.when(slash > 0, F.substring(rest, F.lit(1), slash - 1)).otherwise(rest)
    key = F.when(slash > 0, F.substring(rest, slash + 1, F.length(rest))).otherwise(F.lit(""))
    bare_key = F.regexp_replace(uri, "^/+", "")
    valid = F.coalesce(
        F.when(full, bucket != "").otherwise(F.lit(bool(default_bucket)) & uri.isNotNull()),
        F.lit(False),
    )
    return F.struct(
        F.when(valid, F.when(full, bucket).otherwise(F.lit(default_bucket))).alias("bucket"),
        F.when(valid, F.when(full, key).otherwise(bare_key)).alias("key"),
        valid.alias("valid"),
    )


def as_directory(key: Column) -> Column:
    return F.when(key.endswith("/"), key).otherwise(F.concat(key, F.lit("/")))


def directory_prefix(key: str) -> str:
    """Driver-side form of :func:`as_directory` for arguments; '' stays ''."""
    return key if not key or key.endswith("/") else key + "/"


@cache
def wide_class() -> str:
    """Regex class of the code points that fill two columns (East Asian W and F).

    Large ranges come first, as the matcher tries them in order.
    """
    ranges: list[list[int]] = []
    for point in range(sys.maxunicode + 1):
        if unicodedata.east_asian_width(chr(point)) in "WF":
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    ranges.sort(key=lambda r: r[0] - r[1])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def display_width(text: Column) -> Column:
    """Terminal columns taken by a text: wide characters count twice."""
    # No character below U+1100 is wide; runs of them go first, at little cost.
    rest = F.regexp_replace(text, r"[^\x{1100}-\x{10FFFF}]++", "")
    return F.length(text) + F.regexp_count(rest, F.lit(wide_class()))


def pad_display(text: Column, width: int | Column) -> Column:
    """Fill with blanks on the right up to a display width; never cuts."""
    missing = F.greatest(F.lit(width) - display_width(text), F.lit(0))
    return F.concat(text, F.repeat(F.lit(" "), missing))


def compact_date(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def quote_literal(text: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def strip_newlines(text: Column) -> Column:
    """Each run of line breaks becomes one blank."""
    return F.regexp_replace(text, r"[\r\n]+", " ")


def _contains_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def multipart_start_denied(message: Column) -> Column:
    return message.contains(MULTIPART_START) & _contains_any(message, DENIED_WORDS)


def statement_hints(statement: Column, message: Column) -> Column:
    """``struct(syntax_error, ends_with_semicolon, inner_semicolon)`` for a failed statement."""
    syntax = _contains_any(F.lower(message), SYNTAX_WORDS)
    body = F.regexp_replace(statement, r"\s+$", "")
    inner = F.substring(body, F.lit(1), F.length(body) - 1).contains(";")
    return F.struct(
        syntax.alias("syntax_error"),
        (syntax & body.endswith(";")).alias("ends_with_semicolon"),
        (syntax & inner).alias("inner_semicolon"),
    )
