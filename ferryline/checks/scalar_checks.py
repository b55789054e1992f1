"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline.checks.registry import INVENTORY, ORDERS, check, inventory, orders, table
from ferryline.functions import text as fx
from ferryline.functions.text import wide_class

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# The n-th of these is put behind a number; the oracle has the same list.
DURATION_TAILS = ["m", "h", "d", " w", "", "H ", "x", "dd"]
SIZE_TAILS = ["", "B", "KB", "MB", " GB", "MiB", "kib", "TB", " mb "]


def _pick(tails: list[str]) -> F.Column:
    return F.element_at(
        F.array(*[F.lit(t) for t in tails]), (F.col("event_id") % len(tails) + 1).cast("int")
    )


def _pick_sql(tails: list[str]) -> str:
    return f"([{', '.join(repr(t) for t in tails)}])[event_id % {len(tails)} + 1]"


DURATIONS = f"""(SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
       || {_pick_sql(DURATION_TAILS)} AS duration FROM events)"""


@check(
    f"""WITH t AS (SELECT event_id, duration, lower(trim(duration)) AS v FROM {DURATIONS}),
u AS (SELECT *, CASE right(v, 1) WHEN 'm' THEN 60 WHEN 'h' THEN 3600 WHEN 'd' THEN 86400
                WHEN 'w' THEN 604800 END AS f FROM t),
w AS (SELECT *, trim(CASE WHEN f IS NULL THEN v ELSE v[:-2] END) AS num FROM u)
SELECT event_id, duration, CASE WHEN regexp_matches(num, '{NUMBER}')
       THEN TRY_CAST(num AS DOUBLE) * coalesce(f, 3600) END AS seconds FROM w"""
)
def parse_duration(spark, sf):
    text = F.concat(F.col("value").cast("decimal(18,2)").cast("string"), _pick(DURATION_TAILS))
    return (
        table(spark, sf, "events")
        .select("event_id", text.alias("duration"))
        .withColumn("seconds", fx.duration_seconds(F.col("duration")))
    )


@check(
    f"""WITH t AS (SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
       || {_pick_sql(SIZE_TAILS)} AS text FROM events),
u AS (SELECT *, replace(upper(trim(text)), 'IB', 'B') AS v FROM t),
w AS (SELECT *, CASE right(v, 2) WHEN 'KB' THEN 1024 WHEN 'MB' THEN 1048576
                WHEN 'GB' THEN 1073741824 END AS f FROM u),
x AS (SELECT *, trim(CASE WHEN f IS NOT NULL THEN v[:-3] WHEN v LIKE '%B' THEN v[:-2]
                     ELSE v END) AS num FROM w)
SELECT event_id, text, CASE WHEN regexp_matches(num, '{NUMBER}')
       THEN CAST(trunc(TRY_CAST(num AS DOUBLE) * coalesce(f, 1)) AS BIGINT) END AS bytes FROM x"""
)
def parse_size(spark, sf):
    text = F.concat(F.col("value").cast("decimal(18,2)").cast("string"), _pick(SIZE_TAILS))
    return (
        table(spark, sf, "events")
        .select("event_id", text.alias("text"))
        .withColumn("bytes", fx.size_bytes(F.col("text")))
    )


@check(
    f"""SELECT key, bytes, CASE WHEN bytes < 1024 THEN format('{{:,.1f}}', bytes::DOUBLE) || 'B'
  WHEN bytes < 1048576 THEN format('{{:,.1f}}', bytes::DOUBLE / 1024) || 'KB'
  WHEN bytes < 1073741824 THEN format('{{:,.1f}}', bytes::DOUBLE / 1048576) || 'MB'
  ELSE format('{{:,.1f}}', bytes::DOUBLE / 1073741824) || 'GB' END AS shown
FROM (SELECT key, size * CAST(pow(32, size % 6) AS BIGINT) AS bytes FROM {INVENTORY})"""
)
def human_bytes(spark, sf):
    size = F.col("size") * F.pow(F.lit(32), F.col("size") % 6).cast("bigint")
    return (
        inventory(spark, sf)
        .select("key", size.alias("bytes"))
        .withColumn("shown", fx.human_bytes(F.col("bytes")))
    )


@check(
    """SELECT event_id, CASE WHEN s < 60 THEN format('{:,.1f}', s) || '초'
  WHEN w >= 3600 THEN (w // 3600) || '시간 ' || (w % 3600 // 60) || '분 ' || (w % 60) || '초'
  ELSE (w // 60) || '분 ' || (w % 60) || '초' END AS shown
FROM (SELECT event_id, s, CAST(floor(s) AS BIGINT) AS w
      FROM (SELECT event_id, value * (event_id % 100) AS s FROM events))"""
)
def human_seconds(spark, sf):
    seconds = F.col("value") * (F.col("event_id") % 100)
    return table(spark, sf, "events").select("event_id", fx.human_seconds(seconds).alias("shown"))


@check(
    """WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN replace(url, 'http://', '')
    WHEN 1 THEN 'http://' WHEN 2 THEN '/' || page_id || '/x' ELSE url END AS uri FROM pages),
v AS (SELECT *, starts_with(uri, 'http://') AS is_full, uri[8:] AS rest FROM u),
w AS (SELECT *, CASE WHEN is_full THEN split_part(rest, '/', 1) ELSE 'stage' END AS b,
      CASE WHEN NOT is_full THEN ltrim(uri, '/')
           WHEN contains(rest, '/') THEN rest[instr(rest, '/') + 1:] ELSE '' END AS k FROM v)
SELECT page_id, uri, nullif(b, '') AS bucket, CASE WHEN b <> '' THEN k END AS key, b <> '' AS valid
FROM w"""
)
def uri_parts(spark, sf):
    case = F.col("page_id") % 5
    uri = (
        F.when(case == 0, F.replace("url", F.lit("http://"), F.lit("")))
        .when(case == 1, F.lit("http://"))
        .when(case == 2, F.concat(F.lit("/"), "page_id", F.lit("/x")))
        .otherwise(F.col("url"))
    )
    parts = fx.uri_parts(F.col("uri"), "http", default_bucket="stage")
    return (
        table(spark, sf, "pages")
        .select("page_id", uri.alias("uri"))
        .select("page_id", "uri", parts.alias("p"))
        .select("page_id", "uri", "p.*")
    )


@check(
    "SELECT doc_id, CAST(length(t) + length(regexp_replace(t, '"
    + wide_class().replace("[", "[^", 1)
    + "', '', 'g')) AS INTEGER) AS width"
    " FROM (SELECT doc_id, text || ' 한글 ＡＢ 漢字 ' || lang AS t FROM documents)"
)
def display_width(spark, sf):
    text = F.concat("text", F.lit(" 한글 ＡＢ 漢字 "), "lang")
    return table(spark, sf, "documents").select("doc_id", fx.display_width(text).alias("width"))


@check(
    f"""SELECT order_id, strftime(order_dt, '%Y%m%d') AS day,
       'ext_orders_' || replace(CAST(order_dt AS VARCHAR), '-', '') AS name FROM {ORDERS}"""
)
def compact_date(spark, sf):
    name = F.concat(F.lit("ext_orders_"), F.replace(F.col("order_dt").cast("string"), F.lit("-"), F.lit("")))
    return orders(spark, sf).select(
        "order_id", fx.compact_date(F.col("order_dt")).alias("day"), name.alias("name")
    )


@check("SELECT doc_id, '''' || replace(text, '''', '''''') || '''' AS literal FROM documents")
def quote_literal(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", fx.quote_literal(F.col("text")).alias("literal")
    )


@check(
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value,
  array_to_string([CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) FOR x IN embedding], ', ')
  AS joined FROM embeddings"""
)
def array_ops(spark, sf):
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("string"))
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.array_join(scaled, ", ").alias("joined"),
    )


@check("SELECT doc_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS line FROM documents")
def strip_newlines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fx.strip_newlines(F.col("text")).alias("line"))


MESSAGES = [
    "An error occurred (AccessDenied) when calling the CreateMultipartUpload operation: Forbidden",
    "An error occurred (NotImplemented) when calling the CreateMultipartUpload operation",
    "An error occurred (AccessDenied) when calling the PutObject operation",
    "An error occurred (NoSuchBucket) when calling the CreateMultipartUpload operation",
    "Syntax error in line 1",
    "AnalysisException: unknown table",
    "connection lost",
]
STATEMENTS = ["SELECT 1", "SELECT 1; ", "SELECT 1; SELECT 2", "SELECT 1; SELECT 2;"]


def _numbered(values: list[str], step: int) -> F.Column:
    index = F.floor(F.col("event_id") / step) % len(values) + 1
    return F.concat(F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int")))


def _numbered_sql(values: list[str], step: int) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[event_id // {step} % {len(values)} + 1]"


@check(
    f"""WITH l AS (SELECT event_id, {_numbered_sql(MESSAGES, 1)} || ' ' || props AS message,
    event_type || ' ' || {_numbered_sql(STATEMENTS, 3)} AS statement FROM events),
f AS (SELECT *, contains(lower(message), 'syntax') OR contains(lower(message), 'analysisexception')
      AS syn, rtrim(statement) AS body FROM l)
SELECT event_id, contains(message, 'CreateMultipartUpload') AND
  (contains(message, 'AccessDenied') OR contains(message, 'Forbidden') OR contains(message, '403') OR
   contains(message, 'NotImplemented') OR contains(message, 'MethodNotAllowed')) AS denied,
  syn AS syntax_error, syn AND ends_with(body, ';') AS ends_with_semicolon,
  syn AND contains(body[:-2], ';') AS inner_semicolon FROM f"""
)
def classify_errors(spark, sf):
    message = F.concat_ws(" ", _numbered(MESSAGES, 1), "props")
    statement = F.concat_ws(" ", "event_type", _numbered(STATEMENTS, 3))
    return (
        table(spark, sf, "events")
        .select("event_id", message.alias("message"), statement.alias("statement"))
        .select(
            "event_id",
            fx.multipart_start_denied(F.col("message")).alias("denied"),
            fx.statement_hints(F.col("statement"), F.col("message")).alias("h"),
        )
        .select("event_id", "denied", "h.*")
    )
