"""WARC archives: a writer with revisit records and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import materialize

# fixed values: record versions, profile and date of the WARC standard
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# end of fixed values

DATE = "2024-01-01T00:00:00Z"  # pages carry no capture time
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000002ff03000000000000000000")
_MAGIC = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def _uri(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, response_id=None, revisit: bool = False) -> bytes:
    """One record. A revisit keeps the HTTP header, which tells the payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\r\n\x00]", lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
        "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(), f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(response_id)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
               least_revisit_bytes: int = 0, records_per_file: int = 5000) -> None:
    """Write one record per row, each a gzip member of its own, into files of at most `records_per_file` records.

    Of the rows with equal payload (of at least `least_revisit_bytes` bytes) the largest id is written as response, the
    others as revisits of it. Who is the response is found from digests alone, counted per task first; pages meet it in
    a join that adaptive execution can split. Null html is an empty payload. Null ids are never the largest where
    another id exists; rows that repeat the winning id are all responses. An empty table makes archives without records.
    Other columns are not read.

    Spark's own writer makes the files, so a lost executor leaves no half-written one. Its separator between rows is an
    empty gzip member, which readers skip.
    """
    body = text_or_empty(F.col(html))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("html"),
                        F.unhex(F.sha1(body)).alias("digest"), F.octet_length(body).alias("n"))
    last = rows.groupBy("digest", "n").agg(F.max("page_id").alias("response_id"))
    # written once: the join then has an exchange of its own on both sides
    last = materialize(last, "warc-responses")
    joined = rows.join(last, ["digest", "n"]).select(
        "page_id", "url", "html", "digest", "response_id",
        (~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("n") >= least_revisit_bytes)).alias("revisit"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    digest = base64.b32encode(r["digest"]).decode()
                    out.append(_gzip(record_bytes(r["page_id"], r["url"], r["html"].encode(), digest, r["response_id"], r["revisit"])))
                yield pa.RecordBatch.from_pydict({"member": pa.array(out, pa.binary())})

    files = joined.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    (files.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at `at`, and where it ends; ValueError if a check fails."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("header has no end")
    head = {}
    for row in data[line.end():end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = head.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise ValueError("no content length")
    block = data[end + 4:end + 4 + int(length)]
    stop = end + 4 + int(length)
    if len(block) < int(length) or data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("block is cut short")
    for name, body in (("warc-block-digest", block), ("warc-payload-digest", None)):
        want = head.get(name, "")
        if body is None and head.get("warc-type") != "response":
            continue
        if body is None:
            body = block.partition(b"\r\n\r\n")[2]
        if want.lower().startswith("sha1:") and base64.b32encode(hashlib.sha1(body).digest()).decode() != want[5:].upper():
            raise ValueError(f"{name} differs")
    return {"head": head, "block": block}, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The gzip member that starts at `at`, unpacked as far as it goes, where it ends, and what broke it, if anything."""
    unpack, out, view = zlib.decompressobj(31), [], memoryview(data)
    stop, step = at, 65536
    while not unpack.eof and stop < len(data):
        before = unpack.copy() if step > 1 else None
        try:
            out.append(unpack.decompress(view[stop:stop + step]))
        except zlib.error as exc:
            if before is None:
                return b"".join(out), stop, f"gzip: {exc}"
            unpack, step = before, 1  # byte by byte up to the error
            continue
        stop += min(step, len(data) - stop)
    if not unpack.eof:
        return b"".join(out), stop, "gzip: member is cut short"
    return b"".join(out), stop - len(unpack.unused_data), ""


def _inside(plain: bytes) -> Iterator[tuple[str, int, int, object]]:
    """Like `salvage`, in unpacked bytes, where only version lines are searched."""
    at, bad, reason = 0, None, ""
    while at < len(plain):
        try:
            record, stop = _parse(plain, at)
        except ValueError as exc:
            if bad is None:
                bad, reason = at, str(exc)
            line = _VERSION_LINE.search(plain, at + 1)
            at = line.start() if line else len(plain)
            continue
        if bad is not None:
            yield "gap", bad, at, reason
            bad = None
        yield "record", at, stop, record
        at = stop
    if bad is not None:
        yield "gap", bad, len(plain), reason


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """('record', start, end, record) for each good record and ('gap', start, end, reason) for each quarantined byte range.

    After a failed check the search goes on at the next gzip magic or version line behind the failed start, whichever
    comes first and holds a good record; everything skipped until there is one gap. A member that holds a good record is
    searched for version lines in its unpacked bytes, as far as it can be unpacked; its records and gaps have the range
    of the member, and a gap's reason tells the place in the unpacked bytes.
    """
    view, at, bad, reason = data, 0, None, ""
    while at < len(view):
        broken = ""
        try:
            if view.startswith(_MAGIC, at):
                plain, stop, broken = _member(view, at)
                found = list(_inside(plain))
                if not any(kind == "record" for kind, *_ in found) and (found or broken):
                    raise ValueError(broken or found[0][3])
            else:
                record, stop = _parse(view, at)
                found = [("record", at, stop, record)]
        except ValueError as exc:
            if bad is None:
                bad, reason = at, str(exc)
            member, line = view.find(_MAGIC, at + 1), _VERSION_LINE.search(view, at + 1)
            ahead = [x for x in (member, line.start() if line else -1) if x >= 0]
            at = min(ahead) if ahead else len(view)
            continue
        if bad is not None and found:
            yield "gap", bad, at, reason
            bad = None
        if broken:  # where the member would have ended is unknown: it reaches to where the search goes on
            low = found.pop()[1] if found[-1][0] == "gap" else len(plain)
            found.append(("gap", low, len(plain), broken))
            member, line = view.find(_MAGIC, at + 1), _VERSION_LINE.search(view, at + 1)
            stop = min([x for x in (member, line.start() if line else -1) if x >= 0], default=len(view))
        for kind, low, high, what in found:
            yield kind, at, stop, what if kind == "record" else f"{what} (unpacked bytes {low} to {high})"
        at = stop
    if bad is not None:
        yield "gap", bad, len(view), reason


RECORD_SCHEMA = (
    "kind string, file string, start_byte long, end_byte long, reason string, page_id long, url string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary")


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records (kind `record`) and quarantined byte ranges (kind `gap`) of the archives below a path.

    Files are read whole, one at a time: their size is bounded by whoever writes them (`records_per_file`). An empty
    folder gives no rows. Ids that are not of this writer's form are null.
    """
    def number(uri: str | None):
        found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", uri or "")
        return int(found[1]) if found else None

    def row(file, kind, start, end, what) -> dict:
        base = dict.fromkeys(x.split()[0] for x in RECORD_SCHEMA.split(", ")) | {"kind": kind, "file": file, "start_byte": start, "end_byte": end}
        if kind == "gap":
            return base | {"reason": what}
        head, block = what["head"], what["block"]
        http, _, payload = block.partition(b"\r\n\r\n")
        size = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", b"\r\n" + http)
        type_, digest = head.get("warc-type"), head.get("warc-payload-digest", "")
        full = type_ != "revisit"
        return base | {
            "page_id": number(head.get("warc-record-id")), "url": head.get("warc-target-uri"), "record_type": type_,
            "refers_to": number(head.get("warc-refers-to")),
            "payload_bytes": len(payload) if full else int(size[1]) if size else None,
            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else digest.partition(":")[2].upper(),
            "payload": payload if full and with_payload else None}

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RECORD_SCHEMA.split(", ")])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, held, size = batch.column(0)[i].as_py(), [], 0
                for found in salvage(batch.column(1)[i].as_py()):
                    held.append(row(file, *found))
                    size += len(held[-1]["payload"] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(records, RECORD_SCHEMA)
