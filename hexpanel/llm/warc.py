"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; exact record headers are a table of their own; a join on the digest
reconstructs the records. On reading, every payload's digest is computed again and must equal its address, and every
header's payload digest must equal that of the bytes it names.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexpanel.llm._util import cut, tidy

REVISIT_FROM = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
BROADCAST = 200_000
#: What some reader takes for the end of a line.
LINE_ENDS = "\r\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def _one_line(c: Column) -> Column:
    for end in LINE_ENDS:
        c = F.replace(c, F.lit(end), F.lit(quote(end)))
    return c


@tidy()
def write(df: DataFrame, path: str, key: str = "page_id", uri: str = "url", body: str = "html", date: str = "1970-01-01T00:00:00Z") -> str:
    """Writes an archive of one record per row of df under path (tables headers and payloads) and returns path.

    The payload is the body in UTF-8, null as empty. Of the rows with one payload of REVISIT_FROM bytes or more, the
    one with the largest key is a response and the others revisit it; smaller payloads are responses all. Rows that
    repeat the largest key are responses too. A null key is written as an empty id and never wins over another. All line
    separators of Unicode in an address or a key are percent-encoded, so that no reader can split a header there. Bodies
    are written whole whatever their length; an empty table makes an empty archive; other columns are not read.

    Payloads that no other row has are written where they are read; only those of digests that repeat are shuffled, as
    long as these digests are few enough to broadcast (BROADCAST rows of 64 bytes, counted first).
    """
    rows = df.select(df[key].alias("k"), F.coalesce(df[uri].cast("string"), F.lit("")).alias("u"), F.encode(F.coalesce(df[body].cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    small = rows.select("k", "u", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"))
    winners = small.groupBy("sha256").agg(F.max("k").alias("w"), F.count("*").alias("rows"))
    again = cut(winners.where("rows > 1").select("sha256"), "again")
    marked = F.broadcast(again) if again.count() <= BROADCAST else again
    once = rows.join(marked, "sha256", "left_anti").select("sha256", "payload")
    first = rows.join(marked, "sha256", "left_semi").groupBy("sha256").agg(F.first("payload").alias("payload"))
    for part, mode in ((once, "errorifexists"), (first, "append")):
        part.write.mode(mode).parquet(f"{path}/payloads", compression="zstd")
    named = small.join(winners, "sha256")
    revisit = (F.col("n") >= REVISIT_FROM) & ~F.col("k").eqNullSafe(F.col("w"))
    urn = lambda c: F.concat(F.lit(f"<{URN}"), _one_line(F.coalesce(c.cast("string"), F.lit(""))), F.lit(">\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("k")), F.lit(f"WARC-Date: {date}\r\nWARC-Target-URI: "), _one_line(F.col("u")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("w")), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string"), F.lit("\r\n\r\n"),
    )
    named.select(header.alias("header"), "sha256").write.parquet(f"{path}/headers", compression="zstd")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: record_id, uri, record_type, refers_to, payload_digest, payload_bytes, header, payload
    (the full payload, of revisits too). A payload that is not what its address or a header says fails the job. The
    digests are taken before the join, so a reader that asks for no payload shuffles none."""
    headers = spark.read.schema("header string, sha256 string").parquet(f"{path}/headers")
    payloads = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    measured = payloads.select(
        "sha256", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.sha1("payload")).otherwise(F.raise_error(F.lit("a stored payload differs from its digest"))).alias("sha1"),
    )
    field = lambda name: F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    named = headers.select("header", "sha256", field("WARC-Record-ID").alias("id"), field("WARC-Target-URI").alias("uri"), field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("refers"), F.substring(field("WARC-Payload-Digest"), 6, 40).alias("said"))
    key = lambda c: F.nullif(F.regexp_extract(c, rf"^<{URN}(.*)>$", 1), F.lit(""))
    return named.join(measured, "sha256").select(
        key("id").alias("record_id"), "uri", "record_type", key("refers").alias("refers_to"),
        F.when(F.col("said") == F.col("sha1"), F.col("sha1")).otherwise(F.raise_error(F.lit("a header names another payload"))).alias("payload_digest"),
        "payload_bytes", "header", "payload",
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds record, the bytes of each record as a WARC file holds them: header, block (none for revisits), two line ends."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n")))
