"""WARC archives of pages: a writer that stores equal payloads once, and a reader that
salvages what it can.

Every record is a gzip member of its own. The reader checks each member and each block
digest; after a failed check it searches for the next member, or in plain files the next
version line, that reads as a whole record, goes on from there and logs the bytes between
as quarantined.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import staged
from tillwright.session import shared_folder

ARCHIVE_BYTES = 32 << 20
SMALLEST_REVISIT = 1000
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
MISSING = "none"

ENTRIES = (
    "file string, offset long, size long, kind string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to long, reason string"
)


class Broken(ValueError):
    """What lies at an offset is no whole record."""


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{MISSING if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP header of its page without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url or f"urn:page:{page_id}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {_base32(digest)}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
    ]
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that begins at ``at`` and where it ends; :class:`Broken` if it is not whole."""
    if not VERSION.match(raw, at):
        raise Broken("no version line")
    stop = raw.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Broken("header without an end")
    head = {}
    for line in raw[at:stop].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise Broken("header line without a colon")
        head[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        raise Broken("no length")
    begin = stop + 4
    end = begin + int(head["content-length"])
    block = raw[begin:end]
    if len(block) < end - begin or raw[end : end + 4] != b"\r\n\r\n":
        raise Broken("block cut short")
    if "warc-block-digest" in head and head["warc-block-digest"] != _base32(hashlib.sha1(block).digest()):
        raise Broken("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    kind = head.get("warc-type")
    try:
        digest = base64.b32decode(head.get("warc-payload-digest", "").removeprefix("sha1:"))
    except ValueError as wrong:
        raise Broken("unreadable payload digest") from wrong
    if kind == "response" and hashlib.sha1(payload).digest() != digest:
        raise Broken("payload digest differs")
    entry = {
        "kind": kind,
        "page_id": _page(head.get("warc-record-id")),
        "payload_bytes": len(payload) if kind == "response" else int(size[1]) if size else None,
        "payload_digest": digest.hex(),
        "refers_to": _page(head.get("warc-refers-to")),
    }
    return entry, end + 4


def _member(raw: memoryview, at: int) -> tuple[dict, int]:
    unzip = zlib.decompressobj(31)
    try:
        plain = unzip.decompress(raw[at:])
    except zlib.error as wrong:
        raise Broken(f"gzip: {wrong}") from wrong
    if not unzip.eof:
        raise Broken("member cut short")
    entry, end = parse(plain)
    if end != len(plain):
        raise Broken("member holds more than a record")
    return entry, len(raw) - len(unzip.unused_data)


def entries(raw: bytes) -> Iterator[tuple[int, int, dict]]:
    """``offset, end`` and record or quarantined gap, over all bytes of an archive."""
    view, at = memoryview(raw), 0
    zipped = raw[:3] == MEMBER or (not VERSION.match(raw) and MEMBER in raw)

    def read(here: int) -> tuple[dict, int]:
        if not zipped:
            return parse(raw, here)
        if raw[here : here + 3] != MEMBER:
            raise Broken("no member")
        entry, end = _member(view[here : here + (64 << 10)], 0) if len(raw) - here <= 64 << 10 else _windowed(here)
        return entry, here + end

    def _windowed(here: int) -> tuple[dict, int]:
        # Only as much as the member needs: a window that grows until it holds its end.
        width = 64 << 10
        while True:
            window = view[here : here + width]
            try:
                return _member(window, 0)
            except Broken as wrong:
                if str(wrong) != "member cut short" or here + width >= len(raw):
                    raise
                width *= 4

    while at < len(raw):
        try:
            entry, end = read(at)
        except Broken as wrong:
            end, reason = len(raw), str(wrong)
            search = at + 1
            while search < len(raw):
                if zipped:
                    search = raw.find(MEMBER, search)
                else:
                    found = VERSION.search(raw, search)
                    search = found.start() if found else -1
                if search < 0:
                    break
                try:
                    read(search)
                except Broken:
                    search += 1
                    continue
                end = search
                break
            yield at, end, {"kind": "gap", "reason": reason}
        else:
            yield at, end, entry
        at = end


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)``; return the manifest
    ``file`` of the archives that count.

    Of rows with equal payloads of at least 1000 bytes the one with the largest page_id is
    a response and the others are revisits of it; a null html is an empty payload. A row
    without page_id is always a response. Repeated rows of the largest page_id are responses
    too. Large payloads are sought by digest among repeated digests only; a very frequent
    payload is a hot join key, of which only one row is on the other side.

    Archives are written under names of their own by each attempt and listed by the attempt
    that Spark takes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        files, out, written = [], None, 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for page_id, url, html, size, digest, refers_to in zip(*columns, strict=True):
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, written = store.open_output_stream(f"{place}/{files[-1]}", compression=None), 0
                raw = record(page_id, url, (html or "").encode(), size, bytes.fromhex(digest), refers_to)
                zipper = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = zipper.compress(raw) + zipper.flush()
                out.write(member)
                written += len(member)
                if written >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=["file"])

    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html",
        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"),
    )
    repeated = (
        rows.where(F.col("size") >= SMALLEST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "largest")
    )
    refers_to = F.when(F.col("page_id") != F.col("largest"), F.col("largest"))
    judged = rows.join(repeated, "digest", "left").select(
        "page_id", "url", F.when(refers_to.isNull(), F.col("html")).alias("html"), "size", "digest",
        refers_to.alias("refers_to"),
    )
    return staged(judged.mapInArrow(run, "file string"), "warc-manifest")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Every record and every quarantined gap of the archives ``files(file)`` in ``folder``.

    ``kind`` is the record's type or ``gap``; offsets and sizes are bytes of the archive,
    and ``reason`` says which check failed at the start of a gap. Empty archives have no
    entries. A task holds one archive at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        names = [part.split()[0] for part in ENTRIES.split(", ")]
        kinds = [pa.string() if part.split()[1] == "string" else pa.int64() for part in ENTRIES.split(", ")]
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with store.open_input_file(f"{place}/{file}") as source:
                    raw = source.read()
                rows = [{"file": file, "offset": a, "size": b - a} | entry for a, b, entry in entries(raw)]
                columns = [pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # A number of its own for each archive's task: by their few bytes all would be one task.
    return files.select("file").repartition(max(1, files.count()), "file").mapInArrow(run, ENTRIES)


def archive_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and describe what is read back."""
    folder = shared_folder(spark, "warc")
    found = read_archives(write_archives(pages, folder), folder)
    return found.where("kind <> 'gap'").select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"
    )
