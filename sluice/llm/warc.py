"""Content-addressed WARC archive: payload bytes once, exact record headers apart.

``write_archive`` writes two tables: ``payloads`` (strong digest, bytes; each content once) and
``headers`` (the exact header block of every record and the digest it refers to). A record is
header block + blank line + payload + two line ends; ``read_records`` joins the two tables back
into whole records. SHA-256 is the address; SHA-1 in base32 is the digest that WARC headers
carry. Readers recompute both from the stored bytes, and a mismatch fails the job.

Of equal payloads of at least ``min_bytes``, the smallest page_id is the response, the others
revisit it. NULL html is an empty payload. Rows that repeat a page_id and its html are the same
record twice and have the same type. A group whose page_ids are all NULL has only responses; a
NULL page_id beside others is a revisit. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import WorkFolder, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
# Records carry no capture time; a fixed one keeps reruns equal.
RECORD_DATE = "1970-01-01T00:00:00Z"


def base32_of_hex(digest: Column) -> Column:
    """RFC 4648 base32 of a hex digest whose bits are a multiple of 20 (SHA-1 has 160)."""
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )

    def letters(n: Column) -> Column:
        # An int column per group keeps the expression small: the four letters of 20 bits.
        return F.concat(
            *[F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        )

    return F.array_join(F.transform(groups, letters), "")


def records_of(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: digests, size, record type and the page a revisit refers to.

    The smallest page of each digest comes from an aggregate with partial results, and is
    joined back on the digest alone, without payload bytes.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        (F.col(url_col) if url_col in pages.columns else F.lit(None).cast("string")).alias("url"),
        F.sha2(payload, 256).alias("sha256"),
        base32_of_hex(F.sha1(payload)).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    first = rows.groupBy("sha256").agg(F.min("page_id").alias("_first"))
    is_first = F.col("_first").isNull() | F.col("page_id").eqNullSafe(F.col("_first")) | (F.col("payload_bytes") < min_bytes)
    return (
        rows.join(first, "sha256")
        .withColumn("record_type", F.when(is_first, "response").otherwise("revisit"))
        .withColumn("refers_to", F.when(~is_first, F.col("_first")))
        .drop("_first")
    )


def record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def header_block(version: str = "WARC/1.1") -> Column:
    """The header lines of a record, without the blank line that ends them."""
    revisit = F.col("record_type") == "revisit"
    # Line ends inside a URL would start a new header.
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", "")
    return F.concat_ws(
        CRLF,
        F.lit(version),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {RECORD_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    )


def write_archive(pages: DataFrame, folder: WorkFolder, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """Write the two tables and return them as read back: (headers, payloads).

    The one page that stands for a digest is found by page_id as well, so rows of a common
    payload are dealt by page and not by their digest. Pages without an id stand for their
    payload by the digest.
    """
    records = records_of(pages, min_bytes, id_col, url_col, html_col)
    headers = folder.write(
        records.select("page_id", "sha256", header_block().cast("binary").alias("header")), "headers"
    )
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    bytes_of = pages.select(F.col(id_col).alias("page_id"), F.sha2(payload, 256).alias("sha256"), payload.alias("payload"))
    first = bytes_of.groupBy("sha256").agg(F.min("page_id").alias("page_id"))
    named = bytes_of.join(first.filter("page_id IS NOT NULL"), ["sha256", "page_id"], "left_semi")
    unnamed = bytes_of.filter("page_id IS NULL").join(first.filter("page_id IS NULL").drop("page_id"), "sha256", "left_semi")
    # Repeated rows of one page: only equal (digest, page) pairs meet here.
    once = named.unionByName(unnamed).groupBy("sha256", "page_id").agg(F.first("payload").alias("payload")).drop("page_id")
    return headers, folder.write(once, "payloads")


def checked_payloads(payloads: DataFrame) -> DataFrame:
    """Digests and size of each stored payload, from its bytes; a damaged one fails the job."""
    actual = F.sha2("payload", 256)
    return payloads.select(
        F.when(actual == F.col("sha256"), F.col("sha256"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))))
        .alias("sha256"),
        base32_of_hex(F.sha1("payload")).alias("stored_digest"),
        F.octet_length("payload").cast("long").alias("stored_bytes"),
    )


def header_field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(found != "", found)


def read_index(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row per record from the archive's own bytes: header fields and checked digests."""
    page = F.regexp_extract(header_field("WARC-Refers-To"), "<urn:page:([^>]*)>", 1).cast(headers.schema["page_id"].dataType)
    said = headers.select(
        "page_id", "sha256",
        header_field("WARC-Type").alias("record_type"),
        F.regexp_extract(header_field("WARC-Payload-Digest"), "sha1:(.*)", 1).alias("payload_digest"),
        page.alias("refers_to"),
    )
    joined = said.join(checked_payloads(payloads), "sha256")
    digest = F.when(F.col("payload_digest") == F.col("stored_digest"), F.col("stored_digest")).otherwise(
        F.raise_error(F.concat(F.lit("digest of page differs: "), F.col("payload_digest")))
    )
    return joined.select("page_id", F.col("stored_bytes").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def read_records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Whole records: ``(page_id, record, content)``; content is the full payload, also of a revisit."""
    is_response = header_field("WARC-Type") == "response"
    ends = F.lit(CRLF + CRLF).cast("binary")
    body = F.when(is_response, F.col("payload")).otherwise(F.lit(b""))
    return headers.join(payloads, "sha256").select(
        "page_id", F.concat(F.col("header"), ends, body, ends).alias("record"), F.col("payload").alias("content")
    )


def export_warc(headers: DataFrame, payloads: DataFrame, path: str) -> None:
    """Write standard ``.warc`` text files: the sink's line separator is the record end."""
    trimmed = F.expr("substring(record, 1, octet_length(record) - 4)")
    read_records(headers, payloads).select(trimmed.cast("string").alias("value")).write.option(
        "lineSep", CRLF + CRLF
    ).text(path)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, payloads = write_archive(table(spark, sf_dir, "pages"), WorkFolder(spark, "warc"))
    return read_index(headers, payloads)
