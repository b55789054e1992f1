"""Values as text: the spelling used in feeds and in previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _double_text(value: Column) -> Column:
    """A double in the spelling of the feed: ``0.1``, ``12345678.0``, ``1e+20``, ``nan``.

    Spark prints the same shortest digits but switches to ``1.0E7`` style earlier.
    Kept short, as a table may have many such columns in one compiled method.
    """
    text, size = value.cast("string"), F.abs(value)
    # 16 digits before and 22 after the point hold every double of this range.
    digits = F.regexp_replace(value.try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    for old, new in ((".0E", "E"), ("E-", "e-"), ("E", "e+"), ("Infinity", "inf"), ("NaN", "nan")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return (
        F.when((size >= 1e-3) & (size < 1e7), value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), digits)
        .otherwise(F.regexp_replace(text, r"e-(\d)$", "e-0$1"))
    )


def value_text(value: Column, dtype: T.DataType, true_false: tuple[str, str]) -> Column:
    """Text of a value; NULL stays NULL."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.when(value, F.lit(true_false[0])).when(~value, F.lit(true_false[1]))
    if isinstance(dtype, T.DoubleType):
        return _double_text(value)
    if isinstance(dtype, T.FloatType):
        return _double_text(value.cast("string").cast("double"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = value.cast("string")
        return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.DateType)):
        return value.cast("string")
    raise TypeError(f"no text form for {dtype.simpleString()}; cast the column first")


def feed_text(value: Column, dtype: T.DataType) -> Column:
    return value_text(value, dtype, ("True", "False"))


def cell_text(value: Column, dtype: T.DataType, null_text: str = "NULL") -> Column:
    return F.coalesce(value_text(value, dtype, ("true", "false")), F.lit(null_text))


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def format_cells(df: DataFrame, null_text: str = "NULL") -> DataFrame:
    """Every column as preview text."""
    return df.select(
        *[cell_text(quoted(f.name), f.dataType, null_text).alias(f.name) for f in df.schema]
    )
