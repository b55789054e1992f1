"""A content-addressed WARC archive.

``payloads`` holds the bytes of every different payload once, under their SHA-256 digest;
``records`` holds the exact header block of every record with the digest of its payload. The
full records come back through a join on the digest, which is verified on the bytes read.

Of the records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the smallest id
is a response and the others are revisits of it; a record of a revisit has no block, and the
payload is that of the response. Shorter payloads are responses always. Records with the same
smallest id are all responses; a NULL id is smaller than none, and only a group without any id
is all responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
_LINE = "\r\n"
# Fixed values of the WARC 1.1 format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(date: str) -> Column:
    """The header block of a record, up to and with its empty line."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    target = F.regexp_replace("url", r"[\x00-\x20]+", "%20")
    return F.concat_ws(
        _LINE,
        F.lit(_VERSION),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))),
        F.lit(_LINE),
    ).cast("binary")


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2000-01-01T00:00:00Z") -> None:
    """Write ``payloads`` and ``records`` below ``folder``. A NULL payload is empty; a NULL address is left out of the header."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first")).write.parquet(f"{folder}/payloads")
    firsts = spark.read.parquet(f"{folder}/payloads").select("digest", "first")
    light = rows.select("page_id", "url", "digest", F.length("payload").cast("long").alias("n_bytes"))
    known = light.join(firsts, "digest")
    alone = (F.col("n_bytes") < MIN_REVISIT) | F.col("page_id").eqNullSafe(F.col("first"))
    typed = known.withColumn("record_type", F.when(alone, "response").otherwise("revisit"))
    typed = typed.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("first")))
    typed.select("digest", _header(date).alias("header")).write.parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: parsed header fields, ``payload`` and ``record``, the bytes of the full record.

    A payload whose digest is not that of its header stops the read.
    """
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    text = F.decode("header", "UTF-8")
    value = lambda name, shape: F.nullif(F.regexp_extract(text, f"(?md)^{name}: {shape}\\r\n", 1), F.lit(""))
    rows = records.join(payloads, "digest").select(
        value("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        value("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        value("WARC-Type", "([^\r\n]*)").alias("record_type"),
        value("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("stated"),
        value("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        "header",
        "payload",
        F.sha2("payload", 256).alias("payload_digest"),
    )
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    verified = F.when(F.col("stated") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest: "), "stated"))
    )
    return rows.withColumn("payload_digest", verified).withColumn("record", F.concat("header", block, F.lit(b"\r\n\r\n"))).drop("stated", "header")
