"""Named SQL queries. Values are bound, never pasted into the text."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ferryline.operators.load import LoadResult, load
from ferryline.sources.feed_format import LOAD_FORMAT, FeedFormat
from ferryline.sources.feed_reader import read_feed

SQL_FOLDER = Path(__file__).parent / "sql"

# The order feed and table.
ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_dt", T.DateType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("status", T.StringType()),
    ]
)


@dataclass(frozen=True)
class NamedQuery:
    """SQL text, its required parameters and the defaults of the optional ones."""

    text: str
    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)

    def bind(self, given: Mapping[str, object]) -> dict[str, object]:
        missing = [name for name in self.required if name not in given]
        if missing:
            raise KeyError(f"missing parameter: {', '.join(missing)} (given: {', '.join(given) or 'none'})")
        known = {*self.required, *self.defaults}
        unused = [name for name in given if name not in known]
        if unused:
            warnings.warn(f"unused parameter: {', '.join(unused)}", stacklevel=3)
        return {**self.defaults, **{k: v for k, v in given.items() if k in known}}


def _shipped(name: str, required: tuple[str, ...], **defaults: object) -> NamedQuery:
    return NamedQuery((SQL_FOLDER / f"{name}.sql").read_text(encoding="utf-8"), required, defaults)


QUERIES: dict[str, NamedQuery] = {
    "daily_orders": _shipped("daily_orders", ("dt",), orders="sales.orders", status=None),
    "order_range": _shipped("order_range", ("from_dt", "to_dt"), orders="sales.orders"),
    "order_summary": _shipped("order_summary", ("dt",), schema="staging"),
}


def parse_parameters(items: Iterable[str]) -> dict[str, str]:
    """``name=value`` texts; the value may hold ``=`` and blanks, the last duplicate wins."""
    parameters: dict[str, str] = {}
    for item in items:
        name, separator, value = item.partition("=")
        if not separator or not name.strip():
            raise ValueError(f"not name=value: {item!r}")
        parameters[name.strip()] = value
    return parameters


def run_query(
    spark: SparkSession,
    name: str,
    parameters: Mapping[str, object] | None = None,
    queries: Mapping[str, NamedQuery] = QUERIES,
) -> DataFrame:
    """Run a named query; its plan is an ordinary Spark SQL plan."""
    try:
        query = queries[name]
    except KeyError:
        raise KeyError(f"no query {name!r}, one of {', '.join(sorted(queries))}") from None
    return spark.sql(query.text, args=query.bind(parameters or {}))


def load_orders(
    spark: SparkSession,
    dt: str,
    *,
    root: str,
    schema: str = "staging",
    fmt: FeedFormat = LOAD_FORMAT,
    reject_limit: int | None = None,
    dry_run: bool = False,
) -> LoadResult:
    """Append the order feed of one run directory ``root/orders/dt/`` to ``schema.orders``."""
    feed = read_feed(
        spark,
        f"{root.rstrip('/')}/orders/{dt}/",
        ORDERS_SCHEMA,
        fmt,
        on_error="fail" if reject_limit is None else "flag",
    )
    return load(feed, f"{schema}.orders", ORDERS_SCHEMA.names, reject_limit=reject_limit, dry_run=dry_run)
