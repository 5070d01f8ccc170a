"""WARC archives: writing pages as transactions and assembling them again.

``write_archive`` stores each page as a request, a response (or a revisit of an
equal payload) and a metadata record; request and metadata name the response in
WARC-Concurrent-To. The records are text with CRLF line ends, so Spark's text
writer stores them byte for byte, compressed, into the shared folder, with a
bounded number of records a file. ``read_archive`` parses the files by
Content-Length, and ``assemble`` joins request, response and metadata records
through the concurrent-to identifiers into one nested row per capture.

Payload texts are shuffled once, by digest and after a map-side reduction to
one row per digest; revisits are joined without their texts, in a join that
splits a payload that a large part of the pages share.

Edge cases: a null html counts as empty; a null url is an empty target; a null
id is written as an empty field and read back as null, and sorts after all
others as a response; repeated rows are captures of their own, of which one is
the response; an empty table gives an archive without records.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
RECORDS_PER_FILE = 3_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target string, "
    "date string, payload_digest string, payload_bytes long, block_bytes long, fields string, "
    "payload binary"
)


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of 40 hex digits (32 signs): 10 hex digits are 40 bits, 8
    signs. ``digest`` is read four times, so give a stored column, not its expression."""
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def record_id(kind: str, row: Column) -> Column:
    """A URN that depends on the row's key and the kind of record only."""
    h = F.md5(F.concat(F.lit(kind + "|"), row))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4),
        F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"),
    )


def _header(fields: list[tuple[str, Column]], block: Column) -> Column:
    """A whole record: version, named fields, block, two line ends."""
    lines = [F.lit(VERSION + CRLF)]
    for name, value in fields:
        lines += [F.lit(name + ": "), value, F.lit(CRLF)]
    lines += [
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF),
        block, F.lit(CRLF + CRLF),
    ]
    return F.concat(*lines)


def _clean(text: Column) -> Column:
    """A value that fits one header line: control signs are percent-encoded."""
    out = F.coalesce(text, F.lit(""))
    for c in "%\r\n":
        out = F.replace(out, F.lit(c), F.lit(quote(c)))
    return out


def _records(kind: Column, row: Column, url: Column, html: Column, digest: Column, n: Column,
             first_row: Column, page_id: Column, date: str) -> Column:
    """Request, response or revisit, and metadata record of a page as one text."""
    capture = record_id("capture", row)
    target = ("WARC-Target-URI", _clean(url))
    when = ("WARC-Date", F.lit(date))
    block_type = lambda s: ("Content-Type", F.lit(s))
    request = _header(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", record_id("request", row)),
         ("WARC-Concurrent-To", capture), target, when,
         block_type("application/http; msgtype=request")],
        F.concat(F.lit("GET "), _clean(url), F.lit(" HTTP/1.1" + CRLF + CRLF)),
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
              + "Content-Length: "), n.cast("string"), F.lit(CRLF + CRLF),
    )
    common = [("WARC-Record-ID", capture), target, when,
              ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
              block_type("application/http; msgtype=response")]
    answer = F.when(
        kind == "response",
        _header([("WARC-Type", F.lit("response")), *common], F.concat(http, html)),
    ).otherwise(
        _header([("WARC-Type", F.lit("revisit")),
                 ("WARC-Refers-To", record_id("capture", first_row)),
                 ("WARC-Profile", F.lit(REVISIT_PROFILE)), *common], http)
    )
    metadata = _header(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", record_id("metadata", row)),
         ("WARC-Concurrent-To", capture), target, when,
         block_type("application/warc-fields")],
        F.concat(F.lit("page_id: "), F.coalesce(page_id.cast("string"), F.lit("")),
                 F.lit(CRLF)),
    )
    return F.concat(request, answer, metadata)


def write_archive(pages: DataFrame, path: str, least: int = 0,
                  date: str = "2024-01-01T00:00:00Z") -> None:
    """Write every page's records below ``path``. Of equal payloads of at least
    ``least`` bytes the smallest page_id is the response, the others revisit it.
    ``pages`` must be a table or a checkpoint: rows are numbered while read."""
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumns({"n": F.octet_length("html"), "sha": F.sha1(F.encode("html", "UTF-8"))})
    # the first row of each payload, found on digests alone
    firsts = (
        rows.filter(F.col("n") >= least)
        .groupBy("sha", "n")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")).alias("f"))
        .select("sha", "n", F.col("f.row").alias("first_row"))
    )
    # the texts move once, to their digest; a payload with many copies is split by the join
    known = rows.join(firsts, ["sha", "n"], "left").withColumn(
        "first_row", F.coalesce("first_row", "row")
    )
    kind = F.when(F.col("row") == F.col("first_row"), "response").otherwise("revisit")
    text = _records(
        kind, F.col("row").cast("string"), F.col("url"), F.col("html"), base32(F.col("sha")),
        F.col("n"), F.col("first_row").cast("string"), F.col("page_id"), date,
    )
    # the writer ends each value with the line feed that ends its last record
    value = F.expr("substring(value, 1, length(value) - 1)")
    (
        known.select(text.alias("value"))
        .select(value.alias("value"))
        .write.option("lineSep", "\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE // 3)
        .text(path)
    )


def parse_records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of a WARC stream in order; lengths come from the headers, so a
    payload may hold anything, and one record is held at a time."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        for line in iter(stream.readline, b""):
            if not line.strip():
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields.get("content-length", 0))
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the last record is cut short")
        yield {"fields": fields, "block": block}


def _row(fields: dict, block: bytes, with_payload: bool) -> tuple:
    import base64
    import hashlib

    kind = fields.get("warc-type", "")
    payload, digest, n, text = None, None, None, None
    if kind in ("response", "revisit") and fields.get("content-type", "").startswith(
        "application/http"
    ):
        head, _, body = block.partition(b"\r\n\r\n")
        if kind == "response":
            payload, n = body, len(body)
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        else:
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            for line in head.split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    n = int(value)
    elif kind == "response":
        payload, n = block, len(block)
        digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    elif kind == "metadata":
        text = block.decode("utf-8", "replace")
    return (
        fields.get("warc-record-id"), kind, fields.get("warc-concurrent-to"),
        fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"),
        digest, n, len(block), text, payload if with_payload else None,
    )


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archive files below ``path``; a file is read by
    one task, which holds its compressed bytes and one record at a time. Digest
    and length of a response are those of its payload as read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    columns = [x.split()[0] for x in RECORD.split(", ")]

    def parse(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                raw = io.BytesIO(content)
                stream = gzip.open(raw) if content[:2] == b"\x1f\x8b" else raw
                out, held = [], 0
                for record in parse_records(stream):
                    out.append(_row(record["fields"], record["block"], with_payload))
                    held += len(record["block"]) if with_payload else 64
                    if held > 1 << 23 or len(out) >= 10_000:
                        yield _frame(out, columns)
                        out, held = [], 0
                if out:
                    yield _frame(out, columns)

    return files.select("content").mapInPandas(parse, RECORD)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    frame["payload_bytes"] = pd.array(frame["payload_bytes"], dtype="Int64")
    return frame


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, answer, requests, metadata).

    Requests and metadata are gathered by the record they are concurrent to; a
    capture has a few of them. Those whose capture is not in the archive are
    left out, a capture without them has empty lists.
    """
    answers = records.filter(F.col("type").isin("response", "revisit", "resource")).select(
        "record_id",
        F.struct("type", "refers_to", "target", "date", "payload_digest", "payload_bytes",
                 "payload").alias("answer"),
    )

    def beside(kind: str, *columns: str) -> DataFrame:
        return (
            records.filter(F.col("type") == kind)
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.sort_array(F.collect_list(F.struct("record_id", *columns))).alias(kind))
        )

    joined = answers.join(beside("request", "target", "date"), "record_id", "left").join(
        beside("metadata", "fields"), "record_id", "left"
    )
    empty = lambda c: F.coalesce(c, F.array().cast(joined.schema[c].dataType))
    return joined.select("record_id", "answer", empty("request").alias("request"),
                         empty("metadata").alias("metadata"))
