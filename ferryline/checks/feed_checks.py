"""Feeds written from a table and read back must equal the table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.checks.registry import ORDERS, check, orders, table
from ferryline.runtime import materialize, shared_folder
from ferryline.sources.feed_format import LOAD_FORMAT, FeedFormat
from ferryline.sources.feed_reader import feed_lines, read_feed
from ferryline.sources.feed_writer import strip_prefix as without_prefix
from ferryline.sources.feed_writer import write_feed
from ferryline.sources.profiles import read_profile, write_profile

DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@check(DOCUMENTS)
def feed_roundtrip(spark, sf):
    data, path = _documents(spark, sf), shared_folder(spark, "feed")
    write_feed(data, path)
    return read_feed(spark, path, data.schema)


@check(DOCUMENTS)
def feed_quoted_roundtrip(spark, sf):
    data, path = _documents(spark, sf), shared_folder(spark, "feed")
    fmt = FeedFormat(quote=True)
    write_feed(data, path, fmt, files=8)
    return read_feed(spark, path, data.schema, fmt)


@check("SELECT doc_id, replace(text, chr(10), chr(13) || chr(10) || '\"`') AS text, lang, source, n_chars FROM documents")
def feed_quoted_split(spark, sf):
    # Two files, each read by many tasks; every line end of a text is one of the feed, with a quote and a delimiter behind it.
    data, path = _documents(spark, sf), shared_folder(spark, "feed")
    fmt, setting = FeedFormat(quote=True), "spark.sql.files.maxPartitionBytes"
    write_feed(data.withColumn("text", F.replace("text", F.lit("\n"), F.lit('\r\n"`'))), path, fmt, files=2)
    before = spark.conf.get(setting)
    spark.conf.set(setting, "256k")
    try:
        return materialize(read_feed(spark, path, data.schema, fmt), "split")
    finally:
        spark.conf.set(setting, before)


@check(
    """SELECT *, CAST(l_quantity AS VARCHAR) AS shown FROM (SELECT l_orderkey, l_partkey, l_suppkey,
  l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem)"""
)
def feed_typed_roundtrip(spark, sf):
    data = table(spark, sf, "lineitem").withColumn("shown", F.col("l_quantity").cast("string"))
    path = shared_folder(spark, "feed")
    write_feed(data, path)
    return read_feed(spark, path, data.schema)


@check("SELECT doc_id, replace(text, chr(10), chr(9) || chr(92)) AS text, lang, source, n_chars FROM documents")
def feed_lf_escaped(spark, sf):
    # Records end with LF; every line end of a text becomes a delimiter and an escape character.
    data, path = _documents(spark, sf), shared_folder(spark, "feed")
    fmt = FeedFormat(delimiter="\t", null_marker="\\N", header=False, line_sep="\n", single_line=True)
    write_feed(data.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\t\\"))), path, fmt)
    return read_feed(spark, path, data.schema, fmt)


@check(f"SELECT * FROM {ORDERS}")
def feed_prefix_gz(spark, sf):
    # One run directory per status below one prefix, gzip, as a load expects it.
    data, root = orders(spark, sf), shared_folder(spark, "feed")
    for name, part in (("old", F.col("status") == "F"), ("new", F.col("status") != "F")):
        write_feed(data.where(part), f"{root}/run/{name}", LOAD_FORMAT, gzip=True, files=4)
    return read_feed(spark, f"{root}/run/", data.schema, LOAD_FORMAT)


@check(DOCUMENTS)
def feed_bom(spark, sf):
    data, path = _documents(spark, sf), shared_folder(spark, "feed")
    fmt = FeedFormat(bom=True)
    write_feed(data, path, fmt, files=4)
    return read_feed(spark, path, data.schema, fmt)


@check(
    f"""SELECT true AS one_header_per_file, CAST(count(*) AS BIGINT) AS data_lines FROM {ORDERS}"""
)
def feed_header(spark, sf):
    data, path = orders(spark, sf), shared_folder(spark, "feed")
    fmt = FeedFormat()
    write_feed(data, path, fmt, files=6)
    header = F.col("value") == fmt.header_line(data.columns)
    per_file = (
        feed_lines(spark, path, fmt)
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.count_if(header).alias("headers"), F.count_if(~header).alias("lines"))
    )
    return per_file.agg(
        F.every(F.col("headers") == 1).alias("one_header_per_file"), F.sum("lines").alias("data_lines")
    )


# Records of text only, some equal to the header of the feed.
TEXT_ONLY = """(SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'status' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 10 = 0 THEN 'priority' ELSE o_orderpriority END AS priority FROM orders)"""


@check(f"SELECT status, priority, count(*) AS n FROM {TEXT_ONLY} GROUP BY ALL")
def feed_header_like_data(spark, sf):
    same = F.col("o_orderkey") % 10 == 0
    data = table(spark, sf, "orders").select(
        F.when(same, F.lit("status")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(same, F.lit("priority")).otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    path = shared_folder(spark, "feed")
    write_feed(data, path, files=5)
    back = read_feed(spark, path, data.schema)
    return back.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"))


@check(
    f"""SELECT order_id, CASE customer_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '\\N'
       ELSE status END AS note, nullif(customer_id % 7, 0) AS k FROM {ORDERS}"""
)
def feed_null_marker(spark, sf):
    case = F.col("customer_id") % 4
    note = F.when(case == 1, F.lit("")).when(case == 2, F.lit("\\N")).when(case == 3, F.col("status"))
    data = orders(spark, sf).select(
        "order_id", note.alias("note"), F.nullif(F.col("customer_id") % 7, F.lit(0)).alias("k")
    )
    path = shared_folder(spark, "feed")
    write_feed(data, path, LOAD_FORMAT)
    return read_feed(spark, path, data.schema, LOAD_FORMAT)


@check(f"SELECT order_id, status FROM {ORDERS}")
def strip_prefix(spark, sf):
    named = orders(spark, sf).select("order_id", "status").toDF("orders.order_id", "orders.status")
    return without_prefix(named)


@check(f"SELECT * FROM {ORDERS}")
def export_partitioned(spark, sf):
    # One directory per status; the value of the directory is a column again.
    data, path = orders(spark, sf), shared_folder(spark, "feed")
    write_feed(data, path, LOAD_FORMAT, gzip=True, partition_by=["status"])
    stored = T.StructType([f for f in data.schema if f.name != "status"])
    lines = read_feed(spark, path, stored, LOAD_FORMAT, partition_columns={"status": "string"})
    return lines.select(data.columns)


@check(f"SELECT * FROM {ORDERS}")
def profile_orc(spark, sf):
    path = shared_folder(spark, "orc")
    write_profile(orders(spark, sf), "orc", path)
    return read_profile(spark, "orc", path)


@check(f"SELECT * FROM {ORDERS}")
def profile_parquet(spark, sf):
    path = shared_folder(spark, "parquet")
    write_profile(orders(spark, sf), "parquet", path)
    return read_profile(spark, "parquet", path)


@check("SELECT vec_id || ',' || label AS value FROM embeddings")
def profile_text(spark, sf):
    path = shared_folder(spark, "text")
    lines = table(spark, sf, "embeddings").select(F.concat_ws(",", "vec_id", "label").alias("value"))
    write_profile(lines, "text", path)
    return read_profile(spark, "text", path)


@check(f"SELECT * FROM {ORDERS}")
def csv_header_roundtrip(spark, sf):
    data, path = orders(spark, sf), shared_folder(spark, "csv")
    write_profile(data, "csv", path, header="true")
    return read_profile(spark, "csv", path, data.schema, header=True)
