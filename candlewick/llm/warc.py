"""WARC archives: a deduplicating writer and a salvage reader.

Writer: one gzip member per record, archives rolled by size, written by the
tasks straight to a shared folder under names that no other attempt uses. A
manifest table lists the archives of the attempts that finished; leftovers of
lost tasks are in no manifest and are never read.

Reader: every record must pass its checks (gzip checksum, version line, header
block, content length, closing line ends, payload digest). After a failure it
searches for the next valid member or version line, goes on there, and logs the
bytes between as a quarantined gap. Archives are read through a sliding buffer;
memory is bounded by the largest record, not by the archive.

Null payloads are empty, null keys and urls are kept as such; rows with equal
keys are separate records; an empty table writes no archive. The shared folder
may be of any kind that pyarrow.fs opens from its URI (file, s3, gs, hdfs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.config import scratch_path
from candlewick.llm.common import materialise, open_store, table

ROLL_BYTES = 16 << 20
MIN_REVISIT_BYTES = 1000
DATE = "2024-01-31T00:00:00Z"
BLOCK = 1 << 20
STEP = 16 << 10

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
LINE_END = b"\r\n"


def _escape(value: str) -> str:
    """No blank or control character may stand in a header's value."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, key, url: str | None, payload: bytes, length: int, digest: str, refers_to=None) -> bytes:
    """One record. A revisit's block is the HTTP head alone, whose
    Content-Length is that of the payload it stands for."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _escape(url)))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
               ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = [VERSION, *(f"{n}: {v}".encode() for n, v in fields), b"", b""]
    return LINE_END.join(lines) + block + LINE_END * 2


def write(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
          roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write one record per row; returns the manifest (archive, records, bytes).

    Of rows with equal payloads of MIN_REVISIT_BYTES or more, that of the
    largest key holds the payload, the others revisit it (rows that share the
    largest key all hold it)."""
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload")).select(
        "*", F.octet_length("payload").alias("length"), F.sha1("payload").alias("digest"))
    # Narrow partial aggregation first: only repeated payloads go on.
    held = (rows.where(F.col("length") >= MIN_REVISIT_BYTES).groupBy("digest", "length")
            .agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    held = materialise(held, "repeated")
    rows = rows.join(held, ["digest", "length"], "left").select(
        "key", "url", "length", "digest",
        F.when(F.col("key") < F.col("holder"), F.col("holder")).alias("refers_to"),
        F.when(F.coalesce(F.col("key") < F.col("holder"), F.lit(False)), F.lit(None)).otherwise(F.col("payload")).alias("payload"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        out, name, count, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [count], "bytes": [size]})

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, count, size = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                kind = "response" if r["refers_to"] is None else "revisit"
                raw = gzip.compress(record(kind, r["key"], r["url"], r["payload"] or b"", r["length"], r["digest"],
                                           r["refers_to"]), 5, mtime=0)
                out.write(raw)
                count, size = count + 1, size + len(raw)
                if size >= roll_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return materialise(rows.mapInArrow(save, "archive string, records long, bytes long"), "manifest")


class Damaged(Exception):
    """A record that fails a check."""


class Source:
    """Bytes of a random-access file through one sliding buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.buffer = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if at < self.at or at + n > self.at + len(self.buffer):
            self.file.seek(at)
            self.buffer, self.at = self.file.read(max(n, BLOCK)), at
        return self.buffer[at - self.at:at - self.at + n]

    def search(self, at: int) -> int:
        """The next place that may start a record, or the end."""
        while at < self.size:
            part = self.get(at, BLOCK)
            if m := START.search(part):
                return at + m.start()
            at += max(1, len(part) - 9)  # a mark may lie across two blocks
        return self.size


def _member(s: Source, at: int) -> tuple[bytes, int]:
    """The contents of the gzip member at ``at`` and its end."""
    z, out = zlib.decompressobj(31), []
    while not z.eof:
        part = s.get(at, STEP)
        if not part:
            raise Damaged("gzip member is cut off")
        try:
            out.append(z.decompress(part))
        except zlib.error as e:
            raise Damaged("gzip member is damaged") from e
        at += len(part)
        if len(out) == 1 and out[0] and not out[0].startswith(b"WARC/1."[:len(out[0])]):
            raise Damaged("no version line")
    return b"".join(out), at - len(z.unused_data)


def _fields(raw: bytes) -> dict[str, str]:
    lines = raw.split(LINE_END)
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise Damaged("no version line")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        out[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"[0-9]{1,15}", out.get("content-length", "")):
        raise Damaged("no content length")
    return out


def _checked(fields: dict[str, str], block: bytes) -> dict:
    """The record as a row; its digests must agree."""
    def sha1(data: bytes) -> str:
        return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()

    if (want := fields.get("warc-block-digest", "")).startswith("sha1:") and want != sha1(block):
        raise Damaged("block digest differs")
    payload, http_length = block, None
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, payload = block.partition(LINE_END * 2)
        if not mark:
            raise Damaged("HTTP head is cut off")
        if m := re.search(rb"(?im)^content-length:\s*([0-9]{1,15})\s*$", head):
            http_length = int(m[1])
    kind = fields.get("warc-type")
    want = fields.get("warc-payload-digest", "")
    if kind == "revisit":
        digest, length = want, http_length
    else:
        digest, length = sha1(payload), len(payload)
        if want.startswith("sha1:") and want != digest:
            raise Damaged("payload digest differs")
    try:
        digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
    except ValueError as e:
        raise Damaged("unreadable digest") from e
    return {"type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": length, "payload": payload}


def _record(s: Source, at: int) -> tuple[dict, int]:
    """The record at ``at`` and its end."""
    if s.get(at, 3) == GZIP_MAGIC:
        raw, end = _member(s, at)
        head, mark, rest = raw.partition(LINE_END * 2)
        if not mark:
            raise Damaged("header is cut off")
        fields = _fields(head)
        n = int(fields["content-length"])
        if len(rest) != n + 4 or rest[n:] != LINE_END * 2:
            raise Damaged("content length differs")
        return _checked(fields, rest[:n]), end
    if not s.get(at, 7).startswith(b"WARC/1."):
        raise Damaged("no version line")
    head, size = b"", 4096
    while LINE_END * 2 not in head:
        if len(head) == min(size >> 1, s.size - at) and size > 4096 or size > 1 << 24:
            raise Damaged("header is cut off")
        head, size = s.get(at, size), size << 1
    head = head[:head.index(LINE_END * 2)]
    fields = _fields(head)
    first = at + len(head) + 4
    end = first + int(fields["content-length"])
    if s.get(end, 4) != LINE_END * 2:
        raise Damaged("content length differs")
    return _checked(fields, s.get(first, end - first)), end + 4


def salvage(s: Source) -> Iterator[dict]:
    """Records and gaps in order: each has offset and end, a gap has a reason."""
    at, gap, reason = 0, None, ""
    while at < s.size:
        try:
            row, end = _record(s, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = s.search(at + 1)
            continue
        if gap is not None:
            yield {"offset": gap, "end": at, "gap": reason}
            gap = None
        yield row | {"offset": at, "end": end, "gap": None}
        at = end
    if gap is not None:
        yield {"offset": gap, "end": s.size, "gap": reason}


READ = ("archive string, offset long, end long, gap string, type string, record_id string, target_uri string, "
        "refers_to string, payload_digest string, payload_bytes long")


def read(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps (``gap`` says why, and is null for records) of the
    archives in a manifest (column ``archive``)."""
    names = [f.split()[0] for f in READ.split(", ")] + ["payload"] * with_payload
    schema = pa.schema([(n, pa.int64() if n in ("offset", "end", "payload_bytes") else
                         pa.binary() if n == "payload" else pa.string()) for n in names])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{root}/{name}") as f:
                    for row in salvage(Source(f, f.size())):
                        row["archive"] = name
                        held += len(row.get("payload") or b"") if with_payload else 0
                        if not with_payload:
                            row.pop("payload", None)
                        rows.append(row)
                        if len(rows) >= 1000 or held > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # Whole archives are dealt out, so that a task reads several at most.
    tasks = max(1, min(manifest.count(), 100_000))
    return (manifest.select("archive").repartition(tasks, "archive")
            .mapInArrow(load, READ + (", payload binary" if with_payload else "")))


def records(rows: DataFrame) -> DataFrame:
    return rows.where("gap IS NULL").drop("gap")


def gaps(rows: DataFrame) -> DataFrame:
    """The quarantine log: archive, offset, end, reason."""
    return rows.where("gap IS NOT NULL").select("archive", "offset", "end", F.col("gap").alias("reason"))


def op5_warc_salvage(spark, sf_dir) -> DataFrame:
    """All pages written to archives and read back."""
    folder = scratch_path(spark, "warc")
    manifest = write(table(spark, sf_dir, "pages"), folder)
    r = records(read(manifest, folder, with_payload=False))
    number = r"^<urn:page:(-?[0-9]+)>$"
    return r.select(
        F.regexp_extract("record_id", number, 1).try_cast("long").alias("page_id"),
        "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        F.regexp_extract("refers_to", number, 1).try_cast("long").alias("refers_to"))


SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS holder FROM p WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id < holder THEN holder END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
