"""Which segment a distribution key lands on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def segment_of(keys: Sequence[str | Column], segments: int, portable: bool = True) -> Column:
    """Segment number 0 .. segments-1 of a key.

    ``portable=True`` uses the first 32 bits of an md5 and gives the same answer in
    any SQL engine. ``portable=False`` uses the hash of Spark's own shuffles and
    buckets, so it shows the layout Spark will really produce; it is also cheaper.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    if not portable:
        return F.pmod(F.hash(*columns), F.lit(segments)).cast("int")
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    text = texts[0] if len(texts) == 1 else F.concat_ws("|", *texts)
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    segment = F.pmod(number, F.lit(segments)).cast("int")
    # Never NULL; said openly, a join on it needs no extra test that hashes every row again.
    return F.coalesce(segment, F.lit(0))
