"""A content-addressed archive of WARC records.

Two tables make an archive.  ``payloads`` holds the bytes of every distinct
payload once, under its SHA-256.  ``headers`` holds, for every record, the exact
bytes of its WARC and HTTP headers and the SHA-256 it refers to.  Records are put
together again by joining the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscle.session import fresh_path

# Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: 20 bits, five hex digits, make four characters."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*groups)), BASE32_HEX, BASE32)


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _one_line(value: Column) -> Column:
    """A header value that cannot end its line."""
    return F.replace(F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _head(date: str) -> Column:
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("record_type"),
        F.lit(f"{CRLF}WARC-Target-URI: "), _one_line(F.col("uri")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Record-ID: "), _urn(F.col("key")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit(f"{CRLF}WARC-Profile: {IDENTICAL}{CRLF}WARC-Refers-To: "), _urn(F.col("first_key")),
        )).otherwise(""),
        F.lit(f"{CRLF}Content-Length: "), block.cast("string"), F.lit(CRLF + CRLF), http,
    )


def write_archive(
    pages: DataFrame, path: str | None = None, key: str = "page_id", payload: str = "html", uri: str = "url",
    min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> str:
    """Archive one WARC record per row below ``path``; the path is returned.

    Of the records with one payload of at least ``min_bytes`` bytes, that with the
    smallest key is the response and the others revisit it; shorter payloads make
    responses only.  A null payload is an empty one.  Repeated rows of the smallest
    key are all responses.  A null key never is the smallest unless its payload has
    no other; rows with null keys then are responses, else revisits.  A null URI is
    written as an empty one, line ends in it are escaped.  An empty table gives an
    empty archive.  Other columns are not archived.

    Payload bytes move once, grouped by digest, of which each task keeps one copy
    before anything is shuffled; the join with the headers moves digests and keys.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{uri}`").alias("uri"),
        F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha256", F.sha2("payload", 256))
    kept = rows.groupBy("sha256").agg(F.min("key").alias("first_key"), F.first("payload").alias("payload"))
    kept.select(
        "sha256", "first_key", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"), "payload",
    ).write.parquet(f"{path}/payloads")

    facts = spark.read.parquet(f"{path}/payloads").drop("payload")
    known = rows.select("key", "uri", "sha256").join(facts, "sha256")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("key").eqNullSafe(F.col("first_key"))
    known.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).select(
        "sha256", F.encode(_head(date), "UTF-8").alias("head"),
    ).write.parquet(f"{path}/headers")
    return path


def _field(name: str) -> Column:
    return F.regexp_extract(F.decode("head", "UTF-8"), rf"(?m)^{name}: ([^\r]*)", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: key, uri, record_type, refers_to, payload_bytes, payload_digest, payload, head, record.

    Every payload is checked against its SHA-256 as it is read; a payload that was
    changed raises an error.  Its length and digests are taken once per distinct
    payload, before the join, so that a query without the bytes does not move them.
    ``record`` is the WARC record: headers, the payload of a response, two line ends.
    """
    stored = spark.read.parquet(f"{path}/payloads").select("sha256", "payload")
    sound = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("sha256"))).cast("binary")
    )
    payloads = stored.select("sha256", sound.alias("payload")).select(
        "sha256", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    number = lambda name: F.regexp_extract(_field(name), "^<urn:page:(.*)>$", 1)
    headers = spark.read.parquet(f"{path}/headers").select(
        "sha256", "head", number("WARC-Record-ID").try_cast("long").alias("key"),
        _field("WARC-Target-URI").alias("uri"), _field("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").try_cast("long").alias("refers_to"),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return headers.join(payloads, "sha256").select(
        "key", "uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "head",
        F.concat("head", body, F.lit(b"\r\n\r\n")).alias("record"),
    )
