"""WARC archives: writing, reading and transaction assembly.

``write_archives`` gives each page a request, a response (or revisit) and a
metadata record that name each other by WARC-Concurrent-To, and writes them
with Spark's text writer, whose line separator is the blank lines after a
record; archives hold about ``ARCHIVE_BYTES`` each.  ``read_archives`` takes
archives apart by Content-Length.  ``assemble`` joins the records of one
transaction through their concurrent-to identifiers into one nested row per
capture.

Of pages with equal payloads of ``min_bytes`` or more the one with the
largest page_id (then the largest url) is the response and the others
revisit it.

Defined results: a null html is an empty payload; a null url leaves out the
target URI, line breaks in a url are percent-encoded; a null page_id is
smaller than all others; repeated rows are archived once with their number
as ``copies``; an empty table gives archives without records; other columns
of the pages are not written.  Records without a transaction are kept by
``assemble`` as captures with a null response.  A very long page is one
record, held whole.  Bounds of foreign archives: one file is one task's
input and is held compressed, so a file must stay below 2 GB (Spark refuses
a larger one; archives of several members can be cut between members), and
the request and metadata records that name one identifier meet in one row,
so an archive in which one identifier has very many should be filtered by
the counts of ``concurrent_to`` first.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.common import discard, handover, need, small
from tablework.session import shared_scratch

ARCHIVE_BYTES = 32 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
DATE = "2000-01-01T00:00:00Z"
END = "\r\n"
# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = ("record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, "
          "warc_date string, payload_digest string, http_header string, payload binary, fields map<string,string>")


def base32(hexed: Column) -> Column:
    """Base32 of 40 hex digits (40 bits, eight characters, at a time)."""
    eights = [F.lpad(F.conv(F.substring(hexed, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.concat(*eights), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def with_digest(df: DataFrame, name: str, payload: Column) -> DataFrame:
    """df plus the bare upper-case base32 SHA-1 of payload.  The hash is a
    column of its own first: inside the digits it would be worked out again
    for each part, where the payload stands under a condition."""
    return df.withColumn("_sha1", F.sha1(payload.cast("binary"))).withColumn(name, base32(F.col("_sha1"))).drop("_sha1")


def record_id(h: Column) -> Column:
    """The identifier of a record from a hash of 32 hex digits; null: null."""
    return F.when(h.isNotNull(), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                  ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">")))


def record(kind: Column, own_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of one record without the blank lines after it; headers that are
    null are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), own_id),
             *[F.concat(F.lit(name + ": "), value) for name, value in headers],
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block)


def captures_of(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, url, html, bytes, digest, capture, copies, response): one
    row per distinct page, ``response`` the capture that a revisit names."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = with_digest(rows.withColumn("bytes", F.octet_length("html").cast("long")), "digest", F.col("html"))
    rows = rows.withColumn("capture", F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                                                        "digest", F.coalesce(F.concat(F.lit("="), "url"), F.lit("null")))))
    slim = handover(rows.groupBy("capture", "page_id", "url", "digest", "bytes").agg(F.count("*").alias("copies")),
                    "warc-captures")
    repeated = handover(slim.filter("copies > 1").select(F.col("capture").alias("_capture"), "copies"), "warc-repeated")
    counted = rows.join(small(repeated, 64), F.col("capture") == F.col("_capture"), "left").drop("_capture")
    single = counted.filter("copies IS NULL").withColumn("copies", F.lit(1).cast("long"))
    several = (counted.filter("copies IS NOT NULL").groupBy("capture")
               .agg(*[F.first(c).alias(c) for c in ("page_id", "url", "html", "bytes", "digest", "copies")]))
    leads = handover(slim.filter(F.col("bytes") >= min_bytes).groupBy("digest")
                     .agg(F.max(F.struct("page_id", "url", "capture"))["capture"].alias("response"),
                          F.count("*").alias("n"))
                     .filter("n > 1").select(F.col("digest").alias("_digest"), "response"), "warc-leads")
    return (single.unionByName(several)
            .join(small(leads, 128), F.col("digest") == F.col("_digest"), "left").drop("_digest"))


def records_of(captures: DataFrame, date: str = DATE) -> DataFrame:
    """(value): the text of three records per capture.  What several records
    name is worked out in columns before the texts are put together."""
    revisits = F.col("response").isNotNull() & (F.col("response") != F.col("capture"))
    uri = F.col("uri")
    named = captures.select(
        "html", "bytes", "digest", "copies", "page_id", revisits.alias("revisits"),
        F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("uri"),
        *[F.md5(F.concat(F.lit(kind + "|"), F.col("capture"))).alias(kind) for kind in ("request", "response", "metadata")],
        F.when(revisits, F.md5(F.concat(F.lit("response|"), F.col("response")))).alias("original"))
    named = named.withColumns({
        **{kind: record_id(F.col(kind)) for kind in ("request", "response", "metadata", "original")},
        "host": F.regexp_extract(F.coalesce(uri, F.lit("")), r"://([^/?#]*)", 1),
        "path": F.regexp_extract(F.coalesce(uri, F.lit("")), r"://[^/?#]*([^#]*)", 1)})
    revisits, path = F.col("revisits"), F.col("path")
    named = named.select(
        "html", "digest", "revisits", "uri", "request", "response", "metadata", "original",
        F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
                 F.col("bytes").cast("string"), F.lit(END + END), F.when(revisits, "").otherwise(F.col("html"))).alias("answer"),
        F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
                 F.lit(f" HTTP/1.1{END}Host: "), F.col("host"), F.lit(END + END)).alias("ask"),
        F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                 F.lit(f"{END}copies: "), F.col("copies").cast("string"), F.lit(END)).alias("about"))
    own = F.col("response")
    common = [("WARC-Target-URI", uri), ("WARC-Date", F.lit(date))]
    to_own = ("WARC-Concurrent-To", own)
    texts = F.array(
        record(F.lit("request"), F.col("request"),
               [*common, to_own, ("Content-Type", F.lit("application/http;msgtype=request"))], F.col("ask")),
        record(F.when(revisits, "revisit").otherwise("response"), own,
               [*common, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
                ("WARC-Refers-To", F.col("original")),
                ("WARC-Profile", F.when(revisits, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                ("Content-Type", F.lit("application/http;msgtype=response"))], F.col("answer")),
        record(F.lit("metadata"), F.col("metadata"),
               [*common, to_own, ("Content-Type", F.lit("application/warc-fields"))], F.col("about")))
    return named.select(F.explode(texts).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write gzipped archives of pages (page_id, url, html) under path."""
    need(pages, "page_id", "url", "html")
    total = pages.agg(F.sum(F.octet_length("html")).cast("long").alias("n")).first()["n"] or 0
    captures = captures_of(pages, min_bytes)
    dealt = captures.repartition(max(1, math.ceil(total / archive_bytes)), "capture")
    (records_of(dealt, date).write.option("lineSep", END + END).option("compression", "gzip").text(path))


# --------------------------------------------------------------- reading

def inflate(content: bytes) -> Iterator[bytes]:
    """Pieces of a plain or gzipped archive of one or more members."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = content
    while rest:
        member = zlib.decompressobj(31)
        while rest and not member.eof:
            yield member.decompress(rest, READ_BYTES)
            rest = member.unconsumed_tail or member.unused_data
        yield member.flush()


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; header names in lower case."""
    pieces, buffer = inflate(content), bytearray()

    def fill(enough) -> bool:
        while not enough():
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        while fill(lambda: len(buffer) >= 2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        if not buffer:
            return
        if not fill(lambda: buffer.find(b"\r\n\r\n") >= 0):
            raise ValueError("an archive ends inside a record's header")
        cut = buffer.find(b"\r\n\r\n")
        lines = buffer[:cut].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {a.strip().lower(): b.strip() for a, _, b in (line.partition(":") for line in lines[1:])}
        size = int(headers["content-length"])
        del buffer[:cut + 4]
        if not fill(lambda: len(buffer) >= size):
            raise ValueError("an archive ends inside a record's block")
        block = bytes(buffer[:size])
        del buffer[:size]
        yield headers, block


def row_of(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers.get("warc-type")
    header, payload, fields = None, block, None
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        header = head.decode("utf-8", "replace")
    elif headers.get("content-type", "") == "application/warc-fields":
        pairs = (line.partition(":") for line in block.decode("utf-8").split("\r\n") if line)
        fields, payload = [(a.strip(), b.strip()) for a, _, b in pairs], b""
    digest = headers.get("warc-payload-digest")
    return (headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
            headers.get("warc-target-uri"), headers.get("warc-date"),
            digest.partition(":")[2] if digest else None, header, payload, fields)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under path (columns of RECORD).
    An archive is one task's input and is inflated step by step."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.string()] * 8 + [pa.binary(), pa.map_(pa.string(), pa.string())]

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for headers, block in records_in(content.as_py()):
                    rows.append(row_of(headers, block))
                    size += len(block) + 512
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, response, requests, metadata): one nested row per
    capture.  Request and metadata records meet at the record that they name
    by concurrent-to, and join the response or revisit of that identifier."""
    whole = F.struct(*records.columns)
    kind = F.col("warc_type")
    answers = (records.filter(kind.isin("response", "revisit"))
               .select(F.col("record_id").alias("capture_id"), whole.alias("response")))
    others = (records.filter(kind.isin("request", "metadata"))
              .groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
              .agg(F.collect_list(F.when(kind == "request", whole)).alias("requests"),
                   F.collect_list(F.when(kind == "metadata", whole)).alias("metadata")))
    return answers.join(others, "capture_id", "full_outer")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """captures plus ``original``, the capture that a revisit refers to.
    One capture may be revisited by a third of all; the join is plain, so
    Spark may split it."""
    originals = captures.select(F.col("capture_id").alias("_original"),
                                F.struct("capture_id", "response", "metadata").alias("original"))
    revisits = captures.filter("response.refers_to IS NOT NULL")
    rest = captures.filter("response.refers_to IS NULL")
    found = revisits.join(originals, F.col("response.refers_to") == F.col("_original"), "left").drop("_original")
    return found.unionByName(rest, allowMissingColumns=True)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive pages, read the archives back without their payloads' bytes
    (``payload_bytes`` and the digest of what was read instead) and assemble
    the captures."""
    spark = pages.sparkSession
    path = shared_scratch(spark, "warc")
    write_archives(pages, path, min_bytes)
    read = read_archives(spark, path)
    answer = F.when(F.col("warc_type") == "response", F.col("payload"))
    slim = with_digest(read.withColumn("payload_bytes", F.octet_length("payload").cast("long")), "read_digest", answer)
    # written, as the two sides of the assembly would each take the archives apart
    slim = handover(slim.drop("payload", "http_header"), "warc-records")
    captures = handover(assemble(slim), "warc-assembled")
    discard(slim)
    return resolve_revisits(captures)
