"""Operator 7: WARC archives, written by tasks and read back by a reader that salvages damaged files.

Every record is a gzip member of its own. The reader checks each one: member trailer, version line, header block, length, payload
digest. After a failed check it looks for the next byte at which a valid member, or in plain archives a version line, begins, goes
on from there, and logs the bytes between as a quarantined gap with the reason. Tasks write to new names in a shared folder and
hand the names on through a staged table, so a repeated task leaves files that nobody reads, never half a file.

Payloads of at least ``min_bytes`` that equal each other are stored once, with the largest id; the others become revisit records.

Cases: a null payload is an empty one; a null id or address is kept as null; of repeated rows with the largest id each is a
response; an empty table gives no archives and no rows; records of any size are read in pieces, one at a time.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from linecross.llm.common import delete_path, discard, local_path, map_batches, shared_folder, stage

#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 48 << 20
_PIECE = 1 << 20
_GZIP = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_VERSION_LINE = re.compile(rb"WARC/1\.\d\r\n")
#: A header block longer than this is damage.
_MOST_HEADER = 64 << 10
RECORDS = "kind string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, " \
          "archive string, at bigint, gap_bytes bigint, reason string"


def _number(value: int | None) -> str:
    return "" if value is None else str(value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record as WARC 1.1 text."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"X-Page-ID: {_number(page_id)}",
            f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~')}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {_number(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Damage(Exception):
    """A check that failed; the text is the reason."""


class Source:
    """Random access to a file in any store, in pieces."""

    def __init__(self, uri: str):
        path = local_path(uri)
        if path is not None:
            self.file = pa.OSFile(path)
        else:
            store, path = fs.FileSystem.from_uri(uri)
            self.file = store.open_input_file(path)
        self.size = self.file.size()
        self.start, self.piece = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes; fewer only at the end of the file."""
        if at < self.start or at + n > self.start + len(self.piece):
            self.file.seek(at)
            self.start, self.piece = at, self.file.read(max(n, _PIECE))
        return self.piece[at - self.start:at - self.start + n]

    def find(self, needle: bytes, at: int) -> int:
        """First place of ``needle`` at or after ``at``, or -1."""
        while at < self.size:
            piece = self.read(at, _PIECE)
            if (found := piece.find(needle)) >= 0:
                return at + found
            if at + len(piece) >= self.size:
                return -1
            at += len(piece) - len(needle) + 1
        return -1


class Member:
    """The bytes of one record, from a gzip member or a plain archive, read forward in pieces."""

    def __init__(self, source: Source, at: int):
        self.source, self.at = source, at
        self.gzip = source.read(at, 3) == _GZIP
        self.codec = zlib.decompressobj(31) if self.gzip else None
        self.ready = bytearray()

    def _more(self) -> bool:
        if self.codec is not None and self.codec.eof or self.at >= self.source.size:
            return False
        piece = self.source.read(self.at, _PIECE if self.codec is None else 64 << 10)
        if self.codec is None:
            self.ready += piece
            self.at += len(piece)
        else:
            try:
                self.ready += self.codec.decompress(piece)
            except zlib.error:
                raise Damage("gzip") from None
            self.at += len(piece) - len(self.codec.unused_data)
        return True

    def until(self, end: bytes, most: int) -> bytes | None:
        """Bytes before ``end``, which are taken with it; None if it does not come."""
        start = 0
        while (found := self.ready.find(end, start)) < 0:
            if len(self.ready) > most or not self._more():
                return None
            start = max(0, len(self.ready) - _PIECE - len(end)) if self.codec is None else 0
        out = bytes(self.ready[:found])
        del self.ready[:found + len(end)]
        return out

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes, at least one unless the data ends."""
        while not self.ready and self._more():
            pass
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def finish(self) -> int:
        """Where the next record starts; the member must end well."""
        if self.codec is None:
            return self.at - len(self.ready)
        while not self.codec.eof:
            if not self._more():
                raise Damage("truncated")
            self.ready.clear()
        return self.at


def read_record(source: Source, at: int) -> tuple[dict, int]:
    """The record that starts at a place and the place after it; ``Damage`` if any check fails."""
    member = Member(source, at)
    head = member.until(b"\r\n\r\n", _MOST_HEADER)
    if head is None or not head.startswith(_VERSION):
        raise Damage("version line")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise Damage("length")
    left, digest, full, http, size = int(fields["content-length"]), hashlib.sha1(), hashlib.sha1(), bytearray(), 0
    seeking = True
    while left:
        piece = member.take(min(left, _PIECE))
        if not piece:
            raise Damage("truncated")
        left -= len(piece)
        full.update(piece)
        if seeking:
            http += piece
            if (end := http.find(b"\r\n\r\n")) < 0:
                continue
            piece, seeking = bytes(http[end + 4:]), False
        digest.update(piece)
        size += len(piece)
    tail = b""
    while len(tail) < 4 and (more := member.take(4 - len(tail))):
        tail += more
    if tail != b"\r\n\r\n":
        raise Damage("record end")
    if fields.get("warc-block-digest", "sha1:" + full.hexdigest()).lower() != "sha1:" + full.hexdigest():
        raise Damage("block digest")
    kind, stated = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if kind == "response":
        if stated and stated != digest.hexdigest():
            raise Damage("payload digest")
        stated = digest.hexdigest()
    elif fields.get("x-payload-length", "").isdigit():
        size = int(fields["x-payload-length"])
    number = {name: int(fields[name]) if fields.get(name, "").lstrip("-").isdigit() else None for name in ("x-page-id", "x-refers-to-page-id")}
    url = fields.get("warc-target-uri")
    return {"kind": "record", "page_id": number["x-page-id"], "url": None if url is None else unquote(url), "payload_bytes": size,
            "payload_digest": stated, "record_type": kind, "refers_to": number["x-refers-to-page-id"], "at": at}, member.finish()


def _next_start(source: Source, at: int) -> int:
    """Next place from ``at`` on where a member that opens with a version line, or a plain version line, begins; else the file's end.

    Damage may have eaten the line break before a version line, so a whole one counts anywhere; a false one fails its own checks.
    """
    zipped, plain = source.find(_GZIP, at), source.find(_VERSION, at)
    while zipped >= 0 or plain >= 0:
        if plain >= 0 and (zipped < 0 or plain < zipped):
            if _VERSION_LINE.match(source.read(plain, 10)):
                return plain
            plain = source.find(_VERSION, plain + 1)
            continue
        try:
            if zlib.decompressobj(31).decompress(source.read(zipped, 4096), 64).startswith(_VERSION):
                return zipped
        except zlib.error:
            pass
        zipped = source.find(_GZIP, zipped + 1)
    return source.size


def salvage(uri: str) -> Iterator[dict]:
    """Records of an archive and the gaps between them, in the file's order."""
    source, at = Source(uri), 0
    while at < source.size:
        try:
            found, at = read_record(source, at)
            yield found | {"archive": uri}
        except Damage as damage:
            after = _next_start(source, at + 1)
            yield {"kind": "gap", "archive": uri, "at": at, "gap_bytes": after - at, "reason": str(damage)}
            at = after


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, date: str = "2020-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write a record per row of (page_id, url, html) into archives below ``folder``; returns the staged list of archives.

    Copies are found by digest. The join that brings the largest id of a digest is an equi-join, whose hot keys adaptive execution
    can split; only digests seen more than once take part.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("bigint")})
    copies = rows.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(copies.where("n > 1").select("digest", "first"), "digest", "left")
    revisit = F.expr(f"coalesce(size >= {min_bytes} AND first IS NOT NULL AND NOT (page_id <=> first), false)")
    rows = rows.withColumn("revisit", revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, done = None, "", []
        for batch in batches:
            for page_id, url, page, digest, first, again in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "digest", "first", "revisit"))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, written = store.open_output_stream(f"{root}/{name}", compression=None), 0
                zipped = zlib.compressobj(level, zlib.DEFLATED, 31)
                text = record(page_id, url, page.encode("utf-8", "surrogatepass"), digest, first if again else None, again, date)
                data = zipped.compress(text) + zipped.flush()
                out.write(data)
                written += len(data)
                if written >= ARCHIVE_BYTES:
                    out.close()
                    done.append(name)
                    out = None
        if out is not None:
            out.close()
            done.append(name)
        yield pa.RecordBatch.from_pydict({"archive": pa.array([f"{folder}/{n}" for n in done], pa.string())})

    return stage(rows.select("page_id", "url", "html", "digest", "first", "revisit").mapInArrow(run, "archive string"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps (``kind``) of the archives named in column ``archive``, one task per few archives."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        rows = [row for uri in batch.column(0).to_pylist() for row in salvage(uri)]
        return pa.Table.from_pylist(rows, schema=_ARROW)

    return map_batches(archives.select("archive").repartition(F.col("archive")), run, RECORDS)


_ARROW = pa.schema([(part.split()[0], pa.int64() if part.split()[1] == "bigint" else pa.string()) for part in RECORDS.split(", ")])


def warc_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Write archives and read them back: staged records, and staged gaps. The archives are deleted once both are written."""
    folder = shared_folder(spark, "warc")
    archives = write_archives(pages, folder, min_bytes)
    found = stage(read_archives(archives), "records")
    discard(archives)
    delete_path(spark, folder)
    return found.where("kind = 'record'").drop("kind", "gap_bytes", "reason"), found.where("kind = 'gap'").select(
        "archive", "at", "gap_bytes", "reason")
