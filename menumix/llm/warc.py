"""Operator 3: convert legacy ARC archives to WARC, and read both."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.session import scratch_path

# The header lines of both versions of the ARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = "X-Record-Key"
ARC_RECORD = "key long, url string, date string, mime string, kind string, record_id string, head binary, payload binary, payload_bytes long, digest string"
WARC_RECORD = "key long, kind string, record_id string, refers_to_id string, url string, date string, payload binary, payload_bytes long, digest string"
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}  # gzip files are never split, so a file is read in order


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_arc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "20010101000000") -> None:
    """One ARC file a task, of version 1 or 2 in turn: a version block, then a
    record for each row (an HTTP response whose header ``X-Record-Key`` holds the key).

    Null payloads are empty, a null url is ``unknown:``; bytes of a url that would
    break the header line are percent-encoded.
    """
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name, offset = 1 + part % 2, f"part-{part:05d}.arc", 0
        block = f"{version} 0 menumix\n{ARC_FIELDS[version]}\n"

        def header(url: str, mime: str, size: int) -> str:
            values = [url, "0.0.0.0", date, mime] + (["200", "-", "-", str(offset), name] if version == 2 else [])
            return " ".join([*values, str(size)])

        first = f"{header(f'filedesc://{name}', 'text/plain', len(block))}\n{block}"
        for batch in batches:
            out = []
            if first:
                out, offset, first = [first.encode()], len(first) + 1, ""
            keys, urls, payloads = (batch.column(i).to_pylist() for i in range(3))
            for key, url, payload in zip(keys, urls, payloads):
                payload = payload or b""
                url = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "unknown:")
                label = "" if key is None else f"{KEY_HEADER}: {key}\r\n"
                content = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{label}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                out.append(f"{header(url, 'text/html', len(content))}\n".encode() + content)
                offset += len(out[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    chosen = pages.select(F.col(key_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("string").cast("binary"))
    chosen.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.options(lineSep="\n", **GZIP).text(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of gzip files: the lines of a file in order, none of two files mixed."""
    return spark.read.option("lineSep", "\n").text(path).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))


class _Blocks:
    """Takes lines until a block of the declared length is whole; ``tail`` bytes of its last line belong to the separator."""

    def __init__(self, tail: int):
        self.tail, self.want, self.lines, self.size = tail, None, [], 0

    def begin(self, length: int) -> None:
        self.want, self.lines, self.size = length, [], -1

    def take(self, line: bytes) -> bytes | None:
        self.lines.append(line)
        self.size += len(line) + 1
        if self.size < self.want + self.tail:
            return None
        if self.size != self.want + self.tail:
            raise ValueError(f"a block of {self.want} bytes does not end where a line ends")
        content, self.want = b"\n".join(self.lines)[:self.want], None
        return content


def _key(head: bytes) -> int | None:
    for line in re.split(rb"\r?\n", head):
        name, _, value = line.partition(b":")
        if name.strip().lower() == KEY_HEADER.lower().encode() and value.strip().lstrip(b"-").isdigit():
            return int(value)
    return None


def split_capture(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload. Lines end in CR LF or, in many old files, in LF alone; a capture that
    does not begin as an HTTP response is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    blank = re.search(rb"\r?\n\r?\n", content)
    return (content[:blank.end()], content[blank.end():]) if blank else (content, b"")


def warc_date(stamp: str) -> str:
    """An ARC date of 14 digits, or of fewer whole parts down to the day, as a WARC date."""
    if not re.fullmatch(r"\d{8}(\d\d){0,3}", stamp):
        raise ValueError(f"not an ARC date: {stamp}")
    d = stamp.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files with what a WARC record needs: identifier, type and digest.

    Each file begins with its version block; its second line names the fields of all header lines
    that follow. Blocks are cut by their declared lengths, one record in memory at a time. The
    identifier derives from url, date, content and position. An HTTP capture becomes a
    response, the version block warcinfo, anything else a resource. A file
    that does not begin with a version block, a truncated block or an unknown
    version fails the job with its reason.
    """
    def run(batches):
        file, fields, held, place, blocks = None, None, None, 0, _Blocks(0)
        for batch in batches:
            out = []
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    if blocks.want is not None:
                        raise ValueError("an ARC file ends within a record")
                    file, fields, held, place = name, None, None, 0
                if blocks.want is None:
                    if not line:
                        continue
                    values = line.decode("utf-8", "surrogateescape").split(" ")
                    if fields is None:
                        if not values[0].startswith("filedesc:"):
                            raise ValueError("an ARC file must begin with its version block")
                        held = {"URL": values[0], "Archive-date": values[2], "Content-type": values[3]}
                    else:
                        if len(values) != len(fields):
                            raise ValueError(f"an ARC header line has {len(values)} fields, its version {len(fields)}")
                        held = dict(zip(fields, values))
                    blocks.begin(int(values[-1]))
                    continue
                content = blocks.take(line)
                if content is None:
                    continue
                if fields is None:
                    lines = content.decode().split("\n")
                    if lines[0].split(" ")[0] not in ("1", "2"):
                        raise ValueError(f"unknown ARC version: {lines[0]}")
                    fields = lines[1].split(" ")
                    kind, head, payload = "warcinfo", b"", content
                else:
                    head, payload = split_capture(content)
                    kind = "response" if head else "resource"
                place += 1
                digest, d = base32_sha1(payload), held["Archive-date"]
                identity = f"{held['URL']} {d} {hashlib.sha1(content).hexdigest()} {file} {place}"
                out.append((_key(head), held["URL"], warc_date(d), held["Content-type"], kind,
                            f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, identity)}>", head, payload, len(payload), digest))
            yield _batch(out, ARC_KINDS)
        if blocks.want is not None:
            raise ValueError("an ARC file ends within a record")

    return _lines(spark, path).mapInArrow(run, ARC_RECORD)


_S, _L, _B = pa.string(), pa.int64(), pa.binary()
ARC_KINDS = [("key", _L), ("url", _S), ("date", _S), ("mime", _S), ("kind", _S), ("record_id", _S), ("head", _B), ("payload", _B), ("payload_bytes", _L), ("digest", _S)]
WARC_KINDS = [("key", _L), ("kind", _S), ("record_id", _S), ("refers_to_id", _S), ("url", _S), ("date", _S), ("payload", _B), ("payload_bytes", _L), ("digest", _S)]


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Write the records of ARC files as WARC files.

    Of captures with equal payloads of at least ``least_bytes`` bytes the one
    with the smallest key (then identifier) is written in full, the others as
    revisits that refer to it. Only digests are grouped; payloads move only if
    some are repeated and their table is too large for Spark to broadcast.
    """
    records = read_arc(spark, arc_path)
    repeated = records.where((F.col("kind") == "response") & (F.col("payload_bytes") >= least_bytes)).groupBy("digest", "payload_bytes").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "record_id", "url", "date")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "payload_bytes", "first")
    full = records.join(repeated, ["digest", "payload_bytes"], "left")
    revisit = (F.col("kind") == "response") & F.col("first").isNotNull() & (F.col("first.record_id") != F.col("record_id"))
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))

    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("kind"))), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("url")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.coalesce(F.when(revisit, F.concat(
            line("WARC-Refers-To", F.col("first.record_id")), line("WARC-Refers-To-Target-URI", F.col("first.url")), line("WARC-Refers-To-Date", F.col("first.date")),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))), F.lit("")),
        line("Content-Type", F.when(F.col("kind") == "response", "application/http;msgtype=response").otherwise(F.col("mime"))),
        line("Content-Length", F.length(block)), F.lit("\r\n"))
    full.select(F.concat(header.cast("binary"), block).cast("string").alias("value")).write.options(lineSep="\r\n\r\n", **GZIP).text(warc_path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, blocks cut by Content-Length. The digest of a full
    payload is computed anew and must equal the header's; a revisit has its
    header's digest and no payload."""
    def run(batches):
        file, headers, blocks = None, None, _Blocks(1)
        for batch in batches:
            out = []
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    if blocks.want is not None or headers is not None:
                        raise ValueError("a WARC file ends within a record")
                    file = name
                if blocks.want is not None:
                    content = blocks.take(line)
                    if content is None:
                        continue
                    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    head, payload = b"", content
                    if kind in ("response", "revisit"):
                        head, payload = split_capture(content)
                    if kind != "revisit" and digest != base32_sha1(payload):
                        raise ValueError(f"digest of {headers['warc-record-id']} differs")
                    out.append((_key(head), kind, headers["warc-record-id"], headers.get("warc-refers-to"), headers.get("warc-target-uri"), headers.get("warc-date"),
                                None if kind == "revisit" else payload, None if kind == "revisit" else len(payload), digest))
                    headers = None
                elif headers is None:
                    if line.startswith(b"WARC/"):
                        headers = {}
                    elif line.strip():
                        raise ValueError("a WARC record must begin with its version")
                elif line == b"\r":
                    blocks.begin(int(headers["content-length"]))
                else:
                    label, _, value = line.decode("utf-8", "surrogateescape").rstrip("\r").partition(":")
                    headers[label.strip().lower()] = value.strip()
            yield _batch(out, WARC_KINDS)
        if blocks.want is not None or headers is not None:
            raise ValueError("a WARC file ends within a record")

    return _lines(spark, path).mapInArrow(run, WARC_RECORD)


def archive_pages(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Pages to ARC, to WARC, and back: (key, payload_bytes, payload_digest, record_type, refers_to) of every row.

    A revisit's length and key come from the response that it refers to. Rows
    without key are archived too and come back with a null key. Repeated rows are
    records of their own. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key_col, url_col, payload_col)
    convert(spark, arc, warc, least_bytes)
    found = read_warc(spark, warc).where("kind in ('response', 'revisit')").select("key", "kind", "record_id", "refers_to_id", "payload_bytes", "digest")
    responses = found.where("kind = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("key").alias("first_key"), F.col("payload_bytes").alias("first_bytes"))
    revisits = found.where("kind = 'revisit'").drop("payload_bytes").join(responses, "refers_to_id")
    return found.where("kind = 'response'").select("key", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select("key", "first_bytes", "digest", "kind", "first_key"))


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumnRenamed("key", "page_id")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t) AS payload_bytes, min(page_id) OVER (PARTITION BY t) AS first_id, sha1(t) AS hex FROM p),
b AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, 5 * i + 1, 5))::BIGINT) AS groups FROM h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(groups, lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', g // 32768 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', g // 1024 % 32 + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', g // 32 % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', g % 32 + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b"""
