"""The delimited feed: exact bytes on writing, exact values on reading."""

import csv
import gzip
import io
import random
from datetime import date, datetime
from decimal import Decimal
from glob import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.cells import feed_text
from ferryline.sources import feed_reader
from ferryline.sources.feed_format import LOAD_FORMAT, FeedFormat
from ferryline.sources.feed_reader import REJECT_LINE, REJECT_REASON, read_feed
from ferryline.sources.feed_writer import strip_prefix, write_feed
from ferryline.sources.quoted_records import block_states
from ferryline.streaming.ingest import ingest_stream

SCHEMA = "order_id bigint, name string, amount string, order_dt date"
ROWS = [
    (1, "Åse Lund", "7.25", date(2026, 8, 1)),
    (2, "comma, inside", None, date(2026, 8, 2)),
    (3, 'quote" inside', "0", date(2026, 8, 3)),
]
HEADER = "order_id`name`amount`order_dt"


def files(path, pattern="part-*"):
    return sorted(f for f in glob(f"{path}/{pattern}") if not f.endswith(".crc"))


def raw(path, opener=open):
    return b"".join(opener(f, "rb").read() for f in files(path))


def export(spark, folder, rows=ROWS, fmt=FeedFormat(), schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    count = write_feed(df, folder, fmt, **options)
    assert count == len(rows)
    return raw(folder).decode().split("\r\n")[:-1]


def test_defaults(spark, folder):
    assert export(spark, folder) == [
        HEADER,
        "1`Åse Lund`7.25`2026-08-01",
        "2`comma, inside``2026-08-02",
        '3`quote" inside`0`2026-08-03',
    ]


def test_quoting_only_where_needed(spark, folder):
    lines = export(spark, folder, fmt=FeedFormat(quote=True))
    assert lines[2:] == ["2`comma, inside``2026-08-02", '3`"quote"" inside"`0`2026-08-03']


@pytest.mark.parametrize(
    "fmt, expected",
    [
        (FeedFormat(header=False), r"1`tick\`inside`1`2026-08-01"),
        (FeedFormat(header=False, quote=True), '1`"tick`inside"`1`2026-08-01'),
    ],
)
def test_delimiter_in_value(spark, folder, fmt, expected):
    rows = [(1, "tick`inside", "1", date(2026, 8, 1))]
    assert export(spark, folder, rows, fmt) == [expected]


def test_delimiter_in_value_without_escape_stops_and_publishes_nothing(spark, folder):
    with pytest.raises(PySparkException, match="needs escaping"):
        export(spark, folder, [(1, "a`b", "1", None)], FeedFormat(escape=""))
    assert files(folder) == []


@pytest.mark.parametrize(
    "fmt, shown",
    [
        (FeedFormat(null_marker="NULL"), "NULL"),
        (FeedFormat(null_marker="\\N"), "\\N"),
        (FeedFormat(null_marker="\\N", legacy_null_escape=True), "\\\\N"),
        (FeedFormat(null_marker="\\N", escape="", legacy_null_escape=True), "\\N"),
    ],
)
def test_null_marker(spark, folder, fmt, shown):
    assert export(spark, folder, fmt=fmt)[2] == f"2`comma, inside`{shown}`2026-08-02"
    schema = T.StructType.fromDDL(SCHEMA)
    back = read_feed(spark, folder, schema, fmt)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_tab_and_no_header(spark, folder):
    lines = export(spark, folder, fmt=FeedFormat(delimiter="\t", header=False))
    assert len(lines) == 3 and lines[1] == "2\tcomma, inside\t\t2026-08-02"


@pytest.mark.parametrize("header", [True, False])
def test_empty_result(spark, folder, header):
    fmt = FeedFormat(header=header)
    lines = export(spark, folder, [], fmt)
    assert lines == ([HEADER] if header else [])
    assert read_feed(spark, folder, T.StructType.fromDDL(SCHEMA), fmt).count() == 0


def test_header_escapes_names_and_drops_prefixes(spark, folder):
    df = spark.createDataFrame([(1, "x")], "`orders.order_id` bigint, `a``b` string")
    write_feed(df.coalesce(1), folder)
    assert raw(folder) == b"order_id`a\\`b\r\n1`x\r\n"
    assert strip_prefix(df).columns == ["order_id", "a`b"]
    write_feed(df.coalesce(1), folder + "-kept", keep_names=True)
    assert raw(folder + "-kept").startswith(b"orders.order_id`a\\`b\r\n")


def test_gzip_and_byte_order_mark(spark, folder):
    fmt = FeedFormat(bom=True)
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    write_feed(df, folder, fmt, gzip=True)
    data = raw(folder, gzip.open)
    assert data.startswith(b"\xef\xbb\xbforder_id`") and data.count(b"\xef\xbb\xbf") == 1
    back = read_feed(spark, folder, T.StructType.fromDDL(SCHEMA), fmt)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_byte_order_mark_without_header(spark, folder):
    fmt = FeedFormat(bom=True, header=False)
    write_feed(spark.createDataFrame(ROWS, SCHEMA), folder, fmt, files=2)
    assert all(open(f, "rb").read(3) == b"\xef\xbb\xbf" for f in files(folder))
    back = read_feed(spark, folder, T.StructType.fromDDL(SCHEMA), fmt)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_one_header_in_every_file(spark, folder):
    df = spark.range(1000).withColumn("name", F.lit("x"))
    write_feed(df, folder, files=7)
    assert len(files(folder)) == 7
    for f in files(folder):
        lines = open(f).read().split("\n")
        assert lines[0] == "id`name" and "id`name" not in lines[1:]


def test_ordered_export_keeps_the_order_over_files(spark, folder):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("v"))
    write_feed(df, folder, FeedFormat(header=False), files=4, order_by=["k"])
    keys = [int(line.split("`")[0]) for line in raw(folder).decode().split("\r\n")[:-1]]
    assert keys == sorted(keys) and len(keys) == 5000 and len(files(folder)) == 4


def special_texts(count, seed):
    rng = random.Random(seed)
    return [
        "".join(rng.choice('`\\\r\n",\tN한😀 aé') for _ in range(rng.randrange(12))) for _ in range(count)
    ]


@pytest.mark.parametrize("delimiter", ["`", "\t", "|", "^", "-", "]", "N", "."])
@pytest.mark.parametrize("quote", [False, True])
def test_same_bytes_as_python_csv_and_round_trip(spark, folder, delimiter, quote):
    texts = special_texts(600, 11)
    rows = [(i, a, None if i % 5 == 0 else b) for i, (a, b) in enumerate(zip(texts, reversed(texts)))]
    fmt = FeedFormat(delimiter=delimiter, quote=quote, header=False)
    schema = "id bigint, a string, b string"
    write_feed(spark.createDataFrame(rows, schema).coalesce(1), folder, fmt)

    expected = io.StringIO(newline="")
    options = (
        {"quoting": csv.QUOTE_MINIMAL}
        if quote
        else {"quoting": csv.QUOTE_NONE, "quotechar": None, "escapechar": "\\"}
    )
    csv.writer(expected, delimiter=delimiter, **options).writerows(rows)
    assert raw(folder).decode() == expected.getvalue()

    back = read_feed(spark, folder, T.StructType.fromDDL(schema), fmt)
    # The empty marker cannot tell '' from NULL.
    want = [(i, a or None, b or None) for i, a, b in rows]
    assert sorted(map(tuple, back.collect())) == want


@pytest.mark.parametrize("quote", [False, True])
def test_marker_keeps_empty_text_and_null_apart(spark, folder, quote):
    fmt = FeedFormat(null_marker="\\N", quote=quote)
    texts = special_texts(400, 5) + ["", "N", "\\", "`"]
    rows = [(i, None if i % 3 == 0 else t, t) for i, t in enumerate(texts)]
    schema = T.StructType.fromDDL("id bigint, a string, b string")
    write_feed(spark.createDataFrame(rows, schema), folder, fmt, files=3)
    assert sorted(map(tuple, read_feed(spark, folder, schema, fmt).collect())) == rows


def test_very_long_field(spark, folder):
    text = "x\\`\r\n" * 300_000
    schema = T.StructType.fromDDL("id bigint, a string")
    write_feed(spark.createDataFrame([(1, text)], schema), folder)
    assert read_feed(spark, folder, schema).first()["a"] == text


def test_single_column(spark, folder):
    df = spark.createDataFrame([("a",), ("",)], "v string").coalesce(1)
    with pytest.raises(PySparkException, match="one empty field"):
        write_feed(df, folder + "-plain")
    write_feed(df, folder, FeedFormat(quote=True, header=False))
    assert raw(folder) == b'a\r\n""\r\n'


def test_header_equal_to_data(spark, folder):
    rows = [("a", "b")] * 40 + [("x", "y")] * 7
    schema = T.StructType.fromDDL("a string, b string")
    write_feed(spark.createDataFrame(rows, schema), folder, files=5)
    assert sorted(map(tuple, read_feed(spark, folder, schema).collect())) == sorted(rows)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    for size in ("16", "10m"):  # parts of a file, and several files in a task
        spark.conf.set(setting, size)
        try:
            assert sorted(map(tuple, read_feed(spark, folder, schema).collect())) == sorted(rows)
        finally:
            spark.conf.set(setting, before)


def test_header_equal_to_data_in_a_stream(spark, folder):
    rows = [("a", "b")] * 40 + [("x", "y")] * 7
    schema = T.StructType.fromDDL("a string, b string")
    write_feed(spark.createDataFrame(rows, schema), f"{folder}/in", files=5)
    ingest_stream(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/state", FeedFormat()).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect())) == sorted(rows)


@pytest.mark.parametrize(
    "value",
    [0.0, -0.0, 0.1, 1.0, -2.5, 1e7, 12345678.9, 123456789012345.0, 9.999999999999998e15, 1e16, 1e20,
     1.5e300, 1e-3, 1.25e-4, 0.000123456789012345, 1e-5, -3.3e-7, 1e-300, 2.2e-308, float("inf"),
     float("-inf"), float("nan"), 2.0**53, 1 / 3, 1e15 / 7],
)
def test_double_spelling(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(feed_text(F.col("v"), T.DoubleType())).first()[0] == repr(value)


def test_other_spellings(spark):
    row = (True, Decimal("7.25"), datetime(2026, 8, 1, 1, 2, 3, 50), datetime(2026, 8, 1, 1, 2, 3))
    df = spark.createDataFrame([row], "b boolean, d decimal(18,2), t timestamp_ntz, s timestamp_ntz")
    shown = df.select(*[feed_text(F.col(f.name), f.dataType) for f in df.schema]).first()
    assert list(shown) == [str(v) for v in row]


def test_no_text_form_for_nested_values(spark, folder):
    with pytest.raises(TypeError, match="array"):
        write_feed(spark.createDataFrame([([1],)], "a array<int>"), folder)


BAD_LINES = ["1`a`2.5", "x`a`2.5", "2`b", "3`c`d`e", "4`d`", "5`e`much", "6`f\\`g`1"]
BAD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(8, 2)),
    ]
)


def bad_feed(spark, folder):
    spark.createDataFrame([(v,) for v in BAD_LINES], "value string").write.option("lineSep", "\r\n").text(folder)


def test_bad_records_are_flagged(spark, folder):
    bad_feed(spark, folder)
    fmt = FeedFormat(header=False)
    rows = read_feed(spark, folder, BAD_SCHEMA, fmt, on_error="flag").collect()
    assert {r[REJECT_LINE]: r[REJECT_REASON] for r in rows if r[REJECT_REASON]} == {
        "x`a`2.5": "id: not a bigint",
        "2`b": "not 3 fields",
        "3`c`d`e": "not 3 fields",
        "5`e`much": "amount: not a decimal(8,2)",
    }
    good = sorted((r["id"], r["name"], r["amount"]) for r in rows if not r[REJECT_REASON])
    assert good == [(1, "a", Decimal("2.50")), (4, "d", None), (6, "f`g", Decimal("1.00"))]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_record_stops_a_strict_read(spark, folder, ansi):
    bad_feed(spark, folder)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            read_feed(spark, folder, BAD_SCHEMA, FeedFormat(header=False)).collect()
        only_id = read_feed(spark, folder, BAD_SCHEMA, FeedFormat(header=False)).select("id")
        with pytest.raises(PySparkException):
            only_id.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_quoted_feed_flags_bad_records(spark, folder):
    text = '1`"a`b"`2.5\r\nx`a`2.5\r\n2`b\r\n3`"c\r\nd"`4\r\n'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(folder)
    fmt = FeedFormat(quote=True, header=False)
    rows = read_feed(spark, folder, BAD_SCHEMA, fmt, on_error="flag").collect()
    assert sorted((r["id"], r["name"]) for r in rows if not r[REJECT_REASON]) == [(1, "a`b"), (3, "c\r\nd")]
    assert sorted(r[REJECT_REASON] for r in rows if r[REJECT_REASON]) == ["id: not a bigint", "not 3 fields"]


@pytest.mark.parametrize("size", [40, 300, 5000])
@pytest.mark.parametrize("header", [True, False])
def test_quoted_files_are_read_in_parts(spark, folder, size, header):
    """Records over many blocks, blocks without a record's start, quotes and delimiters at line ends."""
    rng = random.Random(size)
    pieces = ["a", '"', "`", "\r\n", "\n", "\r", "é", "word " * 20, '\r\n"', '"\r\n', ""]
    rows = [(n, rng.choice([None, "".join(rng.choices(pieces, k=rng.randint(0, 30)))]), "x") for n in range(400)]
    schema = T.StructType.fromDDL("id bigint, text string, plain string")
    fmt = FeedFormat(quote=True, null_marker="\\N", header=header)
    write_feed(spark.createDataFrame(rows, schema), folder, fmt, files=3)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(size))
    try:
        back = read_feed(spark, folder, schema, fmt)
        assert sorted(map(tuple, back.collect())) == rows
    finally:
        spark.conf.set(setting, before)


def test_records_without_open_quotes_are_not_shuffled(spark, folder):
    df = spark.range(2000).select("id", F.lit('say "hi"').alias("v"))
    fmt = FeedFormat(quote=True)
    write_feed(df, folder, fmt, files=2)
    lines = feed_reader.feed_lines(spark, folder, fmt).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.lit(0).alias("place"), "value"
    )
    assert {(r.odd, r.inside) for r in block_states(lines).collect()} == {(0, 0)}
    assert read_feed(spark, folder, df.schema, fmt).exceptAll(df).isEmpty()


def test_a_quote_that_is_not_closed(spark, folder):
    text = '1`a`2.5\r\n2`"open`2.5\r\n3`c`4\r\n'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(folder)
    rows = read_feed(spark, folder, BAD_SCHEMA, FeedFormat(quote=True, header=False), on_error="flag").collect()
    assert [r["id"] for r in rows if not r[REJECT_REASON]] == [1] and len(rows) == 2


def test_every_file_has_its_header_though_the_first_task_is_empty(spark, folder):
    for gzip_it in (False, True):
        path = f"{folder}/{gzip_it}"
        df = spark.range(0, 4000, 1, 4).where("id >= 1000").select("id", F.lit("v").alias("text"))
        assert write_feed(df, path, FeedFormat(), gzip=gzip_it) == 3000
        names = files(path)
        assert len(names) == 3
        for name in names:
            assert (gzip.open if gzip_it else open)(name, "rb").read().startswith(b"id`text\r\n")


def test_partitioned_export_splits_a_hot_value(spark, folder):
    # Nine of ten rows share one value; it is written by several tasks, and all come back.
    df = spark.range(200_000, numPartitions=16).select(
        "id", F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.lit("cold")).alias("day")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100k")
    try:
        write_feed(df, folder, LOAD_FORMAT, partition_by=["day"])
    finally:
        spark.conf.set(setting, before)
    assert len(files(folder, "day=hot/part-*")) > 4
    stored = T.StructType.fromDDL("id bigint")
    back = read_feed(spark, folder, stored, LOAD_FORMAT, partition_columns={"day": "string"})
    assert back.exceptAll(df).isEmpty() and back.count() == 200_000


def test_partitioned_export_has_no_header(spark, folder):
    with pytest.raises(ValueError, match="header=False"):
        write_feed(spark.range(3).withColumn("day", F.lit("a")), folder, partition_by=["day"])


@pytest.mark.parametrize(
    "options",
    [
        {"delimiter": ""},
        {"delimiter": "ab"},
        {"delimiter": "\n"},
        {"escape": "`"},
        {"escape": "ab"},
        {"quote": True, "delimiter": '"'},
        {"line_sep": "\n"},
        {"null_marker": "a`b"},
    ],
)
def test_impossible_formats(options):
    with pytest.raises(ValueError):
        FeedFormat(**options)


def test_lf_records_without_escape(spark, folder):
    fmt = FeedFormat(escape="", line_sep="\n", header=False)
    write_feed(spark.createDataFrame([(1, "a\\b"), (2, "c")], "id int, v string").coalesce(1), folder, fmt)
    assert raw(folder) == b"1`a\\b\n2`c\n"
    schema = T.StructType.fromDDL("id int, v string")
    assert [tuple(r) for r in read_feed(spark, folder, schema, fmt).collect()] == [(1, "a\\b"), (2, "c")]


SINGLE = FeedFormat(delimiter="\t", null_marker="\\N", header=False, line_sep="\n", single_line=True)


def test_escaped_records_that_end_with_lf(spark, folder):
    rows = [(1, "a\tb\\"), (2, "c\rd"), (3, None), (4, "\\N"), (5, "")]
    write_feed(spark.createDataFrame(rows, "id int, v string").coalesce(1), folder, SINGLE)
    assert raw(folder) == b"1\ta\\\tb\\\\\n2\tc\\\rd\n3\t\\N\n4\t\\\\N\n5\t\n"
    schema = T.StructType.fromDDL("id int, v string")
    assert [tuple(r) for r in read_feed(spark, folder, schema, SINGLE).collect()] == rows


def test_lf_inside_a_value_of_an_lf_feed(spark, folder):
    with pytest.raises(PySparkException, match="single_line"):
        write_feed(spark.createDataFrame([(1, "a\nb")], "id int, v string"), f"{folder}/out", SINGLE)
    # Another writer's escaped LF: both halves are malformed, neither passes as a record.
    spark.createDataFrame([("1\ta\\",), ("b",), ("2\tc\\\\",)], "value string").coalesce(1).write.text(f"{folder}/in")
    schema = T.StructType.fromDDL("id int, v string")
    flagged = read_feed(spark, f"{folder}/in", schema, SINGLE, on_error="flag").collect()
    assert [r.reject_line for r in flagged] == ["1\ta\\", "b", None] and flagged[2].v == "c\\"
    with pytest.raises(PySparkException, match="bad feed record"):
        read_feed(spark, f"{folder}/in", schema, SINGLE).collect()
