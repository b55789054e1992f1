"""Durations, sizes, locations, widths and messages."""

import pytest
from pyspark.sql import functions as F

from ferryline.functions import text as fx


def values(spark, function, inputs, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_duration(spark):
    given = ["90m", "24h", "7d", "2w", "12", " 1.5H ", "", "어제", "3x", "h", "3dd", None]
    want = [5400, 86400, 604800, 1209600, 43200, 5400, None, None, None, None, None, None]
    assert values(spark, fx.duration_seconds, given) == want


def test_size(spark):
    given = ["512", "512B", "8KB", "64MB", "1.5GB", "8MiB", "8388608", "1.9", "아주 큰 파일", "1TB", "", None]
    want = [512, 512, 8192, 67108864, 1610612736, 8388608, 8388608, 1, None, None, None, None]
    assert values(spark, fx.size_bytes, given) == want


def test_bytes_text(spark):
    given = [0, 1023, 1536, 5 * 1024**3, 5000 * 1024**3, -1536, 2304]
    want = ["0.0B", "1,023.0B", "1.5KB", "5.0GB", "5,000.0GB", "-1.5KB", "2.2KB"]
    assert values(spark, fx.human_bytes, given, "bigint") == want


def test_seconds_text(spark):
    assert values(spark, fx.human_seconds, [9.5, 90.0, 3725.0, 59.94, 3600.9], "double") == [
        "9.5초", "1분 30초", "1시간 2분 5초", "59.9초", "1시간 0분 0초",
    ]
    assert values(spark, lambda c: fx.human_seconds(c, ("h", "m", "s")), [3725.0], "double") == ["1h 2m 5s"]


def test_display_width(spark):
    given = ["ab", "한글", "a한", "CSV 쓰기", "", "ＡＢ", "😀", "–é"]
    assert values(spark, fx.display_width, given) == [2, 4, 3, 8, 0, 4, 2, 2]


def test_padding_never_cuts(spark):
    assert values(spark, lambda c: fx.pad_display(c, 5), ["한글", "abcdef", ""]) == ["한글 ", "abcdef", "     "]


def test_uri(spark):
    given = ["s3://stage-bucket/impl/orders.csv", "s3://stage-bucket", "stage-bucket/key", "http://x/y", "s3://", "/tmp/a", None]
    want = [("stage-bucket", "impl/orders.csv"), ("stage-bucket", ""), None, None, None, None, None]
    got = values(spark, fx.uri_parts, given)
    assert [(r.bucket, r.key) if r.valid else None for r in got] == want


def test_bare_key_with_default_bucket(spark):
    got = values(spark, lambda c: fx.uri_parts(c, "s3", "b"), ["a/orders.csv", "/a/", "", "s3://c/d"])
    assert [(r.bucket, r.key) for r in got] == [("b", "a/orders.csv"), ("b", "a/"), ("b", ""), ("c", "d")]


def test_directory_form(spark):
    assert values(spark, fx.as_directory, ["a/b", "a/b/"]) == ["a/b/", "a/b/"]
    assert [fx.directory_prefix(k) for k in ("a", "a/", "")] == ["a/", "a/", ""]


def test_multipart_denied(spark):
    given = [
        "An error occurred (AccessDenied) when calling the CreateMultipartUpload operation: Forbidden",
        "An error occurred (NotImplemented) when calling the CreateMultipartUpload operation",
        "An error occurred (AccessDenied) when calling the PutObject operation",
        "An error occurred (NoSuchBucket) when calling the CreateMultipartUpload operation",
    ]
    assert values(spark, fx.multipart_start_denied, given) == [True, True, False, False]


@pytest.mark.parametrize(
    "statement, message, want",
    [
        ("SELECT 1", "connection lost", (False, False, False)),
        ("SELECT 1;", "connection lost", (False, False, False)),
        ("SELECT 1", "Syntax error in line 1", (True, False, False)),
        ("SELECT 1", "AnalysisException: x", (True, False, False)),
        ("SELECT 1 FROM t;\n", "Syntax error", (True, True, False)),
        ("SELECT 1; SELECT 2", "Syntax error", (True, False, True)),
        ("SELECT 1; SELECT 2;", "Syntax error", (True, True, True)),
    ],
)
def test_statement_hints(spark, statement, message, want):
    df = spark.createDataFrame([(statement, message)], "s string, m string")
    assert tuple(df.select(fx.statement_hints(F.col("s"), F.col("m")).alias("h")).first().h) == want


def test_small_texts(spark):
    assert values(spark, fx.quote_literal, ["a'b", ""]) == ["'a''b'", "''"]
    assert values(spark, fx.strip_newlines, ["a\r\n\nb\rc", "d"]) == ["a b c", "d"]
