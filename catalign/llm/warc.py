"""WARC archives: a writer with revisit records, and a reader that salvages what damage has left.

Writing: one gzip member per record, through Spark's own text sink, so any store that Spark writes works. The sink's line
separator is an empty gzip member, which every gzip reader passes over. Of records with equal payloads of `least_bytes` or more
the one with the largest id is the response; the others are revisits that refer to it and carry no payload.

Reading: members (or plain records) are checked one after the other: gzip checksum, version line, header form, content length,
end of record, block and payload digests. After a failed check the reader searches for the next valid member or version line,
goes on from there and logs the bytes between as a quarantined gap.

Defined results: null html is an empty payload; payloads below `least_bytes` are all responses; rows that repeat the largest id
and its payload are all responses; null ids are smallest, and rows without any id to refer to are responses; an empty table
gives no records; empty files give neither records nor gaps; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalign.llm import common

# An empty gzip member, the profile of revisits to equal payloads, the date all records carry.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
GZIP = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Records in one archive file: a task reads whole files, so this bounds its memory.
RECORDS_PER_FILE = 4000


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _number(text: str) -> str:
    """A URL as a header value: line breaks cannot start a header of their own."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_number(url or '')}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    data = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 1000) -> None:
    """Write every page as a record under `path`. Only pages whose payload may repeat leave their partition."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least_bytes, F.sha1("payload")))
    equal = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
    groups = common.saved(equal.filter("n > 1 AND first_id IS NOT NULL").select("digest", "first_id"), "payloads")
    suspects, single = common.routed(rows, F.col("digest"), common.marked(groups, "digest"))
    known = suspects.join(groups, "digest", "left")
    known = known.withColumn("revisit", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    plain = single.withColumn("first_id", F.lit(None).cast("long")).withColumn("revisit", F.lit(False))
    columns = ["page_id", "url", "payload", "first_id", "revisit"]

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([record(r["page_id"], r["url"], r["payload"], r["first_id"], r["revisit"]) for r in part], pa.binary())], names=["member"])

    members = plain.select(columns).unionByName(known.select(columns)).mapInArrow(pack, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("ISO-8859-1")).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


class Damage(Exception):
    """A check failed."""


def _parse(data: bytes, at: int, whole: bool) -> tuple[dict, int]:
    """The record at `at`, checked, and the offset after it. `whole`: nothing may follow it."""
    line = VERSION.match(data, at)
    if not line:
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", line.end() - 2)
    if end < 0:
        raise Damage("header without end")
    fields: dict[str, str] = {}
    for raw in data[line.end():end].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            raise Damage("header line without colon")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        raise Damage("no content length or type")
    start = end + 4
    stop = start + int(fields["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damage("content length")
    if whole and stop + 4 != len(data):
        raise Damage("bytes after the record")
    block = data[start:stop]
    if fields.get("warc-block-digest", "").startswith("sha1:") and fields["warc-block-digest"] != _sha1(block):
        raise Damage("block digest")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0:
            raise Damage("http header")
        payload = block[cut + 4:]
    if fields["warc-type"] != "revisit" and fields.get("warc-payload-digest", "").startswith("sha1:") and fields["warc-payload-digest"] != _sha1(payload):
        raise Damage("payload digest")
    return fields | {"payload": payload}, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    opened = zlib.decompressobj(31)
    try:
        body = opened.decompress(memoryview(data)[at:])
    except zlib.error as err:
        raise Damage("gzip member") from err
    if not opened.eof:
        raise Damage("cut gzip member")
    return body, len(data) - len(opened.unused_data)


def _window(data: bytes, at: int, size: int) -> tuple[bytes, int]:
    """`_member` over a slice: without it every member would copy the rest of the file as unused data."""
    while True:
        piece = data[at:at + size]
        try:
            body, used = _member(piece, 0)
            return body, at + used
        except Damage as err:
            if str(err) != "cut gzip member" or at + size >= len(data):
                raise
            size *= 4


def salvage(data: bytes):
    """Yield ("record", start, end, fields) and ("gap", start, end, reason) that together cover the file."""
    at, size, gap, reason = 0, len(data), None, ""
    while at < size:
        try:
            if data.startswith(GZIP, at):
                body, end = _window(data, at, 1 << 16)
                found = _parse(body, 0, True)[0] if body else None
            else:
                found, end = _parse(data, at, False)
        except Damage as err:
            if gap is None:
                gap, reason = at, str(err)
            member, line = data.find(GZIP, at + 1), VERSION.search(data, at + 1)
            nexts = [x for x in (member, line.start() if line else -1) if x >= 0]
            at = min(nexts, default=size)
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        if found:
            yield "record", at, end, found
        at = end
    if gap is not None:
        yield "gap", gap, size, reason


READ = "file string, kind string, start long, end long, reason string, type string, record_id string, uri string, payload_digest string, " \
       "refers_to string, payload_length long, payload binary"


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of every archive under `path`.

    kind 'record': checked records, with payload_digest in hex. kind 'gap': quarantined bytes from start to end, with the first failed
    check as reason. A task holds one archive at a time. payload_length is of the full payload, for revisits as their record states it.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def row(file: str, item: tuple) -> dict:
        kind, start, end, what = item
        base = {"file": file, "kind": kind, "start": start, "end": end}
        if kind == "gap":
            return base | {"reason": what}
        digest = what.get("warc-payload-digest", "").removeprefix("sha1:")
        own = len(what["payload"])
        return base | {
            "type": what["warc-type"], "record_id": what.get("warc-record-id"), "uri": what.get("warc-target-uri"),
            "payload_digest": base64.b32decode(digest).hex() if re.fullmatch("[A-Z2-7]{32}", digest) else None, "refers_to": what.get("warc-refers-to"),
            "payload_length": int(what["x-payload-length"]) if what.get("x-payload-length", "").isdigit() else own,
            "payload": what["payload"] if with_payload else None}

    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in READ.split(", "))])

    def parse(batches):
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1), strict=True):
                held, kept = [], 0
                for item in salvage(data.as_py()):
                    held.append(row(file.as_py(), item))
                    kept += 500 + len(held[-1].get("payload") or b"")
                    if kept > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, kept = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(parse, READ)


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record that was read back."""
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long").alias(c)
    found = records.filter("kind = 'record'")
    return found.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                        F.col("type").alias("record_type"), number("refers_to"))
