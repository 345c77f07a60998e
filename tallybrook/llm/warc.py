"""Content-addressed WARC archive (operator 2).

An archive is two tables: ``payloads`` holds the bytes of each distinct payload once, under
its SHA-256; ``records`` holds the exact header block of every record and the digest that
leads to its payload. Payloads of at least ``least`` bytes that repeat are written as one
response (the smallest page id) and revisits of it; shorter ones are all responses.

Equal digests are not taken on trust: while a payload's copies are combined, their bytes are
compared. A read puts each response together again, exact headers and payload, and takes size and
digest from that record: its block must be as long as Content-Length says and have the SHA-256 of
WARC-Payload-Digest. A revisit has no block; its digest leads to the stored payload, which is
hashed again. Any failing is an error. Payloads lie in buckets of their digest, so reading does not move them again.

Cases: a null payload is empty; a null url leaves out WARC-Target-URI, line breaks in an url are percent-encoded; a page
without an id is a response of its own and never referred to; a repeated row repeats its
record with the same type; extra columns are not stored; empty tables give empty archives.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import shuffle_width

PAYLOADS = "digest string, payload binary"
RECORDS = "digest string, headers binary"
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


@dataclass(frozen=True)
class Archive:
    """``table`` names the payloads in the catalog of the session that wrote them, which knows their buckets; others read the folder."""

    folder: str
    table: str | None = None

    def payloads(self, spark: SparkSession) -> DataFrame:
        if self.table and spark.catalog.tableExists(self.table):
            return spark.table(self.table)
        return spark.read.schema(PAYLOADS).parquet(f"{self.folder}/payloads")

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(RECORDS).parquet(f"{self.folder}/records")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def _headers(kind: Column, date: str) -> Column:
    """The header block; a field whose value is null is left out."""
    revisit = kind == "revisit"
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = F.col("page").cast("string")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        F.coalesce(_line("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), page, F.lit(">"))), F.lit(f"WARC-Record-ID: <{_ID}>\r\n")),
        _line("WARC-Date", date),
        F.coalesce(_line("WARC-Target-URI", uri), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Profile", PROFILE)).otherwise(""),
        F.when(revisit, _line("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("first_page").cast("string"), F.lit(">")))).otherwise(""),
        F.when(revisit, "").otherwise(_line("Content-Type", "text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Write both tables below ``folder``, which must be new and shared by all executors."""
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].cast("long").alias("page"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("page", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    # copies are combined within each task before they are shuffled; a set keeps one of those that are equal byte for byte
    stored = keyed.groupBy("digest").agg(F.collect_set("payload").alias("found"))
    checked = F.when(F.size("found") == 1, F.col("found")[0]).otherwise(F.raise_error(F.lit("different payloads share a digest")).cast("binary"))
    table = f"llm_{uuid.uuid4().hex}"
    writer = stored.select("digest", checked.alias("payload")).write.bucketBy(shuffle_width(pages.sparkSession), "digest")
    writer.option("compression", "zstd").option("path", f"{folder}/payloads").saveAsTable(table)

    narrow = keyed.select("page", "url", "digest", F.col("size").cast("long").alias("size"))
    firsts = narrow.filter(F.col("size") >= least).groupBy("digest").agg(F.min("page").alias("first_page"))
    kind = F.when(F.col("page") > F.col("first_page"), "revisit").otherwise("response")
    records = narrow.join(firsts, "digest", "left").select("digest", _headers(kind, date).cast("binary").alias("headers"))
    records.write.option("compression", "zstd").parquet(f"{folder}/records")
    return Archive(folder, table)


def _field(name: str) -> Column:
    """Value of a header field; an absent field is null."""
    return F.nullif(F.regexp_extract(F.col("headers").cast("string"), rf"\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def _digest() -> Column:
    return F.regexp_extract(_field("WARC-Payload-Digest"), "^sha256:(.*)$", 1)


def _page(name: str) -> Column:
    return F.regexp_extract(_field(name), rf"^<{_ID}(-?\d+)>$", 1).try_cast("long")


def _with_record(joined: DataFrame) -> DataFrame:
    """``record``: headers and payload as a WARC file holds them; the block of a revisit is empty."""
    body = F.when(_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.withColumn("record", F.concat(F.col("headers"), body, F.lit(b"\r\n\r\n")))


def _parsed(rows: DataFrame, size: Column, found: Column) -> DataFrame:
    verified = F.when(found == F.col("digest"), found).otherwise(F.raise_error(F.lit("a stored payload is missing or damaged")))
    return rows.select(
        _page("WARC-Record-ID").alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        _page("WARC-Refers-To").alias("refers_to"),
        size.cast("long").alias("payload_bytes"),
        verified.alias("payload_digest"),
    )


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """One row per record, read from its headers and its block, with the size and digest of the whole payload."""
    records = archive.records(spark).select(_digest().alias("digest"), "headers")
    is_revisit, length = _field("WARC-Type") == "revisit", _field("Content-Length").try_cast("int")
    responses, revisits = records.filter(~is_revisit), records.filter(is_revisit)
    # payloads below LEAST are responses however often they repeat: without buckets, Spark may split the records of a hot one
    by_path = Archive(archive.folder).payloads(spark)
    short = responses.filter(length < LEAST).join(by_path.filter(F.octet_length("payload") < LEAST), "digest", "left")
    long = responses.filter(F.coalesce(length, F.lit(LEAST)) >= LEAST).join(archive.payloads(spark), "digest", "left")
    begin, end = F.octet_length("headers") + 1, F.octet_length("headers") + length
    block = F.when(F.substring("record", end + 1, F.octet_length("record")) == F.lit(b"\r\n\r\n"), F.substring("record", begin, length))
    whole = _with_record(short.unionAll(long)).select("digest", "headers", block.alias("block"))
    stored = by_path.select("digest", F.octet_length("payload").alias("size"), F.sha2("payload", 256).alias("found"))
    # a hot digest is only wide on the revisits' side, which Spark may split
    looked_up = revisits.join(stored, "digest", "left")
    return _parsed(whole, F.octet_length("block"), F.sha2("block", 256)).unionAll(_parsed(looked_up, F.col("size"), F.col("found")))


def restore(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, headers, payload, record): the exact headers, the page's full payload, and the record as a WARC file holds it."""
    joined = archive.records(spark).join(archive.payloads(spark), "digest", "left")
    return _with_record(joined).select(_page("WARC-Record-ID").alias("page_id"), "headers", "payload", "record")
