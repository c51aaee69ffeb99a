"""WARC archives: one transaction per page written, and transactions put together again.

Every page becomes three records: the request, the response (or, for a payload
that another record holds, a revisit) and a metadata record; request and
metadata name the response in ``WARC-Concurrent-To``. Reading parses the
records of any WARC files and joins them through these identifiers to one
nested row per capture.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.staging import dropped, shared_dir, written

#: Equal payloads of at least this many bytes are stored once.
REVISIT_BYTES = 1000
CRLF = "\r\n"
#: Ends a record; also the text sink's line separator, so that its files are WARC files.
RECORD_END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN = ("response", "revisit", "resource")
_PIECE = 1 << 20

RECORD_FIELDS = ("file string, place bigint, record_id string, type string, date string, target_uri string, concurrent_to array<string>, "
                 "refers_to string, http string, fields map<string,string>, payload_bytes bigint, payload_digest string, payload binary")


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, n_bytes, kept): ``kept`` is the (page_id, url) of the response that a row revisits, null for responses.

    Of rows with equal payloads of at least ``least_bytes`` bytes those with
    the largest page id are responses; a null id is smaller than all. The
    payload that a third of all pages share reaches the aggregate as one row a
    task, and the join back is one that Spark can split.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    kept = (p.where(F.col("n_bytes") >= least_bytes).groupBy("digest")
            .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"))
    p = p.join(kept, "digest", "left")
    return p.withColumn("kept", F.when(~F.col("kept.page_id").eqNullSafe(F.col("page_id")), F.col("kept")))


def _record(kind: str | Column, identifier: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text; headers whose value is null are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
             F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), identifier, F.lit(">"))]
    lines += [F.concat(F.lit(name + ": "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(RECORD_END), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = REVISIT_BYTES, date: str | None = None) -> None:
    """Gzipped WARC files below ``path``, a file per task, through Spark's own commit.

    A null payload is written as an empty one; line ends in a URL as %0D and
    %0A; a null URL or id leaves its header or field out. Payloads go out byte
    by byte. Record ids follow from the row, so rows that are alike in id, URL
    and payload give equal records. Other columns aren't read. Empty table: no
    records.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    salt = uuid.uuid4().hex
    p = with_roles(pages, id_col, url_col, html_col, least_bytes)

    def identifier(page: Column, url: Column, kind: str) -> Column:
        h = F.md5(F.concat_ws(" ", F.lit(f"{salt} {kind}"), F.col("digest"), F.coalesce(page.cast("string"), F.lit("-")), url))
        return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])

    page, address, revisit = F.col("page_id"), F.col("url"), F.col("kept").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    main = identifier(page, address, "response")
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", url)]
    beside = [*common, ("WARC-Concurrent-To", F.concat(F.lit("<urn:uuid:"), main, F.lit(">")))]
    host, rest = F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1), F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*([^#]*)", 1)
    asked = F.concat(F.lit("GET "), F.when(F.coalesce(rest, F.lit("")).startswith("/"), rest).otherwise(F.concat(F.lit("/"), F.coalesce(rest, F.lit("")))),
                     F.lit(f" HTTP/1.1{CRLF}Host: "), F.coalesce(host, F.lit("")), F.lit(RECORD_END))
    request = _record("request", identifier(page, address, "request"), [*beside, ("Content-Type", F.lit("application/http; msgtype=request"))], asked)
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(RECORD_END))
    held = [*common, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:uuid:"), identifier(F.col("kept.page_id"), F.col("kept.url"), "response"), F.lit(">")))),
            ("Content-Type", F.lit("application/http; msgtype=response"))]
    response = _record(F.when(revisit, "revisit").otherwise("response"), main, held, F.when(revisit, head).otherwise(F.concat(head, F.col("payload"))))
    about = F.concat_ws("", F.lit(f"software: tablesmith{CRLF}"), F.concat(F.lit("page-id: "), F.url_encode(F.col("page_id").cast("string")), F.lit(CRLF)))
    metadata = _record("metadata", identifier(page, address, "metadata"), [*beside, ("Content-Type", F.lit("application/warc-fields"))], about)
    (p.select(F.concat_ws(RECORD_END, request, response, metadata).alias("value"))
     .write.option("lineSep", RECORD_END).option("compression", "gzip").text(path))


class _Bytes:
    """A file's bytes, unpacked piece by piece; gzip files may have any number of members."""

    def __init__(self, data: bytes):
        self.data, self.at, self.have, self.start = memoryview(data), 0, bytearray(), 0
        self.member = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None
        self.zipped = self.member is not None

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = bytes(self.data[self.at: self.at + _PIECE])
        self.at += len(piece)
        if not self.zipped:
            self.have += piece
            return True
        while piece:
            if self.member.eof:
                piece = piece.lstrip(b"\0")
                if not piece:
                    break
                self.member = zlib.decompressobj(31)
            self.have += self.member.decompress(piece)
            piece = self.member.unused_data
        return True

    def until(self, mark: bytes) -> int:
        """Where ``mark`` next stands, -1 if nowhere."""
        seen = 0
        while (k := self.have.find(mark, seen)) < 0:
            seen = max(len(self.have) - len(mark) + 1, 0)
            if not self._more():
                return -1
        return k

    def take(self, n: int) -> bytes | None:
        while len(self.have) < n:
            if not self._more():
                return None
        out = bytes(memoryview(self.have)[:n])
        del self.have[:n]
        self.start += n
        return out

    def skip_line_ends(self) -> None:
        while True:
            n, size = 0, len(self.have)
            while n < size and self.have[n] in b"\r\n":
                n += 1
            del self.have[:n]
            self.start += n
            if self.have or not self._more():
                return


def _headers(text: str) -> list[tuple[str, str]]:
    """(lower-case name, value); a line that begins with a blank carries the one before on."""
    out: list[tuple[str, str]] = []
    for line in text.split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], out[-1][1] + " " + line.strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def parsed(file: str, data: bytes, payloads: bool = False) -> Iterator[dict]:
    """The records of one file. Where a record can't be read, one of type ``damaged`` ends the file."""
    source = _Bytes(data)
    while True:
        try:
            source.skip_line_ends()
            place = source.start
            end = source.until(b"\r\n\r\n") if source.have else -1
            if end < 0 and not source.have:
                return
            head = source.take(end + 4) if end >= 0 else None
            if head is None or not head.startswith(b"WARC/"):
                raise ValueError("no record head")
            lines = _headers(head.decode("utf-8", "replace").split("\r\n", 1)[1])
            named = dict(reversed(lines))
            block = source.take(int(named["content-length"]))
            if block is None:
                raise ValueError("the file ends within a record")
        except (ValueError, KeyError, zlib.error):
            yield {"file": file, "place": source.start, "type": "damaged"}
            return
        kind, media = named.get("warc-type", ""), named.get("content-type", "").replace(" ", "").lower()
        row = {"file": file, "place": place, "record_id": named.get("warc-record-id", "").strip("<>"), "type": kind,
               "date": named.get("warc-date"), "target_uri": named.get("warc-target-uri"),
               "concurrent_to": [v.strip("<>") for k, v in lines if k == "warc-concurrent-to"],
               "refers_to": named["warc-refers-to"].strip("<>") if "warc-refers-to" in named else None}
        payload = block
        if media.startswith("application/http"):
            top, _, payload = block.partition(b"\r\n\r\n")
            row["http"], _, rest = top.decode("utf-8", "replace").partition("\r\n")
            row["fields"] = dict(reversed(_headers(rest)))
        elif media.startswith("application/warc-fields"):
            row["fields"] = dict(reversed(_headers(block.decode("utf-8", "replace"))))
        if kind == "revisit":
            size = row.get("fields", {}).get("content-length", "")
            row["payload_bytes"] = int(size) if size.isdigit() else None
            row["payload_digest"] = named.get("warc-payload-digest", "").removeprefix("sha1:").lower() or None
        else:
            row["payload_bytes"], row["payload_digest"] = len(payload), hashlib.sha1(payload).hexdigest()
            row["payload"] = payload if payloads else None
        yield row


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the WARC files below ``path``, gzipped or plain.

    ``fields`` holds the HTTP headers, or a metadata record's fields;
    ``payload_bytes`` and ``payload_digest`` (SHA-1) are taken from the payload
    itself, for revisits from what their headers say. ``payload`` is null
    unless ``payloads``. A file is unpacked piece by piece, so a task holds its
    packed bytes and one record. A file that can't be read on gives a last row
    of type ``damaged``.
    """
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(RECORD_FIELDS)
    arrow = pa.schema([("file", pa.string()), ("place", pa.int64()), ("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()),
                       ("target_uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("http", pa.string()),
                       ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for row in parsed(file, data.as_py(), payloads):
                    row["fields"] = list(row["fields"].items()) if row.get("fields") is not None else None
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 500
                    if size >= _PIECE:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, schema)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: (response, requests, metadata), arrays by record id.

    A capture is a response, revisit or resource record and every request or
    metadata record tied to it by ``WARC-Concurrent-To``, in either direction
    and through other records (a metadata record may name the request). A
    record tied to several captures goes to the one of the smallest id. Records
    that reach no capture have a row each, with a null response. Records whose
    id repeats within a kind each stay. Records of other types, ``damaged`` ones
    among them, are left out; no records give no rows.
    """
    kinds = records.where(F.col("type").isin(*MAIN, "request", "metadata"))
    rest = kinds.where(~F.col("type").isin(*MAIN))
    main = kinds.where(F.col("type").isin(*MAIN))
    names = kinds.select("record_id", F.col("type").isin(*MAIN).alias("is_main"), "concurrent_to")
    links = names.select(F.col("record_id").alias("a"), "is_main", F.explode("concurrent_to").alias("b"))
    # straight to a capture, in either direction; this is all that most archives have
    heads = main.select(F.col("record_id").alias("b")).distinct()
    owned = (links.where("NOT is_main").join(heads, "b").select(F.col("a").alias("record_id"), F.col("b").alias("owner"))
             .unionByName(links.where("is_main").select(F.col("b").alias("record_id"), F.col("a").alias("owner"))))
    owned = written(owned.groupBy("record_id").agg(F.min("owner").alias("owner")), "warc-owners")
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    loose = written(rest.select("record_id").distinct().join(owned, "record_id", "left_anti"), "warc-loose")
    while loose.take(1):
        near = (edges.join(loose.withColumnRenamed("record_id", "a"), "a").join(owned.withColumnRenamed("record_id", "b"), "b")
                .groupBy("a").agg(F.min("owner").alias("owner")).withColumnRenamed("a", "record_id"))
        near = written(near, "warc-owners")
        if not near.take(1):
            break
        owned, before = written(owned.unionByName(near), "warc-owners"), loose
        loose = written(loose.join(near, "record_id", "left_anti"), "warc-loose")
        dropped(before)
    tied = rest.join(owned, "record_id", "left")
    beside = F.struct("record_id", "date", "target_uri", "http", "fields")
    gathered = (tied.withColumn("key", F.coalesce("owner", F.concat(F.lit("alone "), F.col("record_id"))))
                .groupBy("key").agg(F.sort_array(F.collect_list(F.when(F.col("type") == "request", beside.dropFields("fields")))).alias("requests"),
                                    F.collect_list(F.when(F.col("type") == "metadata", beside)).alias("metadata")))
    gathered = gathered.withColumn("metadata", F.array_sort("metadata", lambda x, y: F.when(x["record_id"] < y["record_id"], -1).when(x["record_id"] > y["record_id"], 1).otherwise(0)))
    response = F.struct(*[c for c in records.columns if c not in ("file", "place", "concurrent_to")])
    heads = main.select(F.col("record_id").alias("main_id"), response.alias("response"))
    out = heads.join(gathered, F.col("main_id") == F.col("key"), "full")
    empty = {c: F.coalesce(c, F.array().cast(gathered.schema[c].dataType.simpleString())) for c in ("requests", "metadata")}
    return out.select("response", *[v.alias(c) for c, v in empty.items()])


def report(pages: DataFrame) -> DataFrame:
    """The contract's columns: every page written to WARC files in the shared folder, read back and put together."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    records = written(read_records(spark, path), "warc-records")
    captures = transactions(records).where("response IS NOT NULL").select(
        F.expr("get(filter(transform(metadata, m -> m.fields['page-id']), x -> x IS NOT NULL), 0)").alias("page"), "response.*")
    captures = written(captures.select(F.expr("url_decode(page)").cast(pages.schema["page_id"].dataType).alias("page_id"), "record_id", "type",
                                       "refers_to", "payload_bytes", "payload_digest"), "warc-captures")
    held = captures.where(F.col("type") == "response").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("held_id")).distinct()
    return captures.join(held, "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("held_id").alias("refers_to"))


#: DuckDB; what an archive holds of each page follows from the payloads alone.
REPORT_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages),
kept AS (SELECT payload, max(page_id) AS kept_id FROM p WHERE n >= {REVISIT_BYTES} GROUP BY payload)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN kept_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept_id <> page_id THEN kept_id END AS refers_to
FROM p LEFT JOIN kept USING (payload)
"""
