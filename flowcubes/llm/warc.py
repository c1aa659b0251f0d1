"""WARC archives of pages: a writer, and a reader that salvages damaged files.

The writer stores each record as a gzip member of its own. Each task writes
its files under names of its own attempt, moves them to their final names when
they are whole, and returns their names; only files that are so returned are
read, so a lost and repeated task leaves no record twice.

The reader checks each record: the member's checksum, the version line, the
lengths and the digests. When one fails, it searches for the nearest place at
which a member or a version line begins that passes them, whatever the file has
held before, goes on there, and reports the bytes between as a quarantined gap.
All records of a member are read, with gaps of their own within it; of a member
that is cut short, those that another record follows. Archives go out in batches
of bounded payload, and a task reads one.

Defined results: a null html is an empty payload; a null id is written and
read back as null and counts as the smallest; among records of equal payload
every row with the largest id is a response; an empty table gives none; extra
columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowcubes.llm.common import cut
from flowcubes.session import ensure_checkpoint_dir

#: Payloads from this size on are stored once.
MIN_REVISIT = 1000
#: A file is closed when it has so many bytes; the reader holds one file.
ROLL_BYTES = 32 << 20
#: The reader hands on what it has read when it holds so many bytes of payload.
BATCH_BYTES = 32 << 20
#: Bytes of a member that are unpacked at a time.
PIECE = 16 << 10
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/\d\.\d\r\n")
#: Where a member or a plain record may begin.
BEGINNING = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The bytes of one record. A revisit keeps the HTTP head, with the length
    and digest of the full payload, but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", "", url)))
    if revisit:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", _digest(payload)), ("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Found:
    """A record, or a gap (``reason`` says what failed), at a place of a file; in
    a member, that of the member, and ``inner`` is the place in its plain bytes."""

    start: int
    end: int
    fields: dict[str, str] | None = None
    block: bytes = b""
    reason: str = ""
    inner: int | None = None


class Damaged(ValueError):
    """What failed, and the records that were whole before it."""

    def __init__(self, reason: str, before: list[Found] | None = None):
        super().__init__(reason)
        self.before = before or []


def _parse(raw: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at a place of plain bytes, and where it ends."""
    if not VERSION_LINE.match(raw, at):
        raise Damaged("no version line")
    end = raw.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header cut short")
    fields = {}
    for line in raw[at:end].split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        fields[k.decode("utf-8", "replace").lower()] = v.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit():
        raise Damaged("no content length")
    stop = end + 4 + int(size)
    if raw[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("content length does not fit")
    block = raw[end + 4:stop]
    if fields.get("warc-block-digest", _digest(block)) != _digest(block):
        raise Damaged("block digest differs")
    if fields.get("warc-type") == "response" and "warc-payload-digest" in fields and fields["warc-payload-digest"] != _digest(block.partition(b"\r\n\r\n")[2]):
        raise Damaged("payload digest differs")
    return fields, block, stop + 4


def _plain(raw: bytes, at: int) -> tuple[list[Found], int]:
    fields, block, end = _parse(raw, at)
    return [Found(at, end, fields, block)], end


def _member(raw: bytes, at: int) -> tuple[list[Found], int]:
    """The records and gaps of the gzip member at a place, and where it ends."""
    opened, parts, end = zlib.decompressobj(31), [], at
    try:
        while not opened.eof and end < len(raw):  # in pieces, as what follows the member is copied
            piece = memoryview(raw)[end:end + PIECE]
            parts.append(opened.decompress(piece))
            end += len(piece)
    except zlib.error as e:
        raise Damaged(f"bad member: {e}") from e
    plain = b"".join(parts)
    found = list(_walk(plain, _plain, VERSION_LINE))
    if not opened.eof:
        followed = [f for f in found if f.fields and VERSION_LINE.match(plain, f.end)]
        raise Damaged("member cut short", [Found(at, at, f.fields, f.block, inner=f.start) for f in followed])
    if not any(f.fields for f in found):
        raise Damaged(found[0].reason if found else "empty member")
    end -= len(opened.unused_data)
    return [Found(at, end, f.fields, f.block, f.reason, f.start) for f in found], end


def _either(raw: bytes, at: int) -> tuple[list[Found], int]:
    return (_member if raw.startswith(GZIP, at) else _plain)(raw, at)


def _walk(raw: bytes, read: Callable[[bytes, int], tuple[list[Found], int]], beginning: re.Pattern) -> Iterator[Found]:
    """What ``read`` finds at each place; after a failure, from the nearest
    beginning at which it finds something."""
    at = 0
    while at < len(raw):
        try:
            found, end = read(raw, at)
            yield from found
            at = end
            continue
        except Damaged as e:
            reason = str(e)
            yield from e.before
        probe = at + 1
        while m := beginning.search(raw, probe):
            try:
                read(raw, m.start())
                break
            except Damaged as e:
                if e.before:
                    break
                probe = m.start() + 1
        end = m.start() if m else len(raw)
        yield Found(at, end, reason=reason)
        at = end


def salvage(raw: bytes) -> Iterator[Found]:
    """Records of an archive, compressed, plain or both, and gaps in file order."""
    return _walk(raw, _either, BEGINNING)


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and for revisits the page they refer to.

    Only digests that occur twice or more take part in the join; their largest
    ids are pre-aggregated."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.when(F.octet_length("html") >= MIN_REVISIT, F.sha1(F.col("html").cast("binary"))))
    repeated = p.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1 and largest is not null")
    p = p.join(repeated.select("digest", "largest"), "digest", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return p.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("largest")).alias("refers_to"))


def write(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, level: int = 3) -> DataFrame:
    """Archives of the marked pages in a shared folder (a path or URI that
    pyarrow.fs opens); returns the (path, records) that were written whole."""

    folder = _shared(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        task = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, n, files = io.BytesIO(), 0, []

        def close() -> None:
            path = f"{base}/{task}-{len(files):04d}.warc.gz"
            with store.open_output_stream(path + ".open", compression=None) as f:
                f.write(out.getbuffer())
            store.move(path + ".open", path)
            files.append((path, n))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit"))):
                page_id, url, html, refers_to, revisit = row
                out.write(gzip.compress(record(page_id, url, html.encode("utf-8"), refers_to, revisit), level, mtime=0))
                n += 1
                if out.tell() >= roll:
                    close()
                    out, n = io.BytesIO(), 0
        if n:
            close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files]), pa.array([f[1] for f in files], pa.int64())], schema=arrow)

    kind = T.StructType.fromDDL("path string, records long")
    arrow = to_arrow_schema(kind)
    return cut(pages.mapInArrow(run, kind))


def _shared(spark: SparkSession, folder: str) -> str:
    """The folder as Spark understands it: without a scheme, on its default file system."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", folder) or default.startswith("file:"):
        return folder
    return f"{default.rstrip('/')}/{folder.lstrip('/')}"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub("^s3[an]:", "s3:", path)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _row(path: str, found: Found) -> tuple:
    fields = found.fields or {}
    head, _, body = found.block.partition(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)
    digest = fields.get("warc-payload-digest", "")
    return (path, found.start, found.end, found.inner, found.reason or None, fields.get("warc-type"), _page(fields.get("warc-record-id")), fields.get("warc-target-uri"), _page(fields.get("warc-refers-to")),
            int(size[1]) if size else len(body), base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None, body)


def read(files: DataFrame, folder: str, whole: bool = False, most: int = BATCH_BYTES) -> DataFrame:
    """Every record and every gap of the archives named by ``path``, each archive
    in a task of its own. With ``whole`` an archive that has a gap, or other than
    the number of ``records`` that were written to it, ends the run. A batch is
    handed on when it holds ``most`` bytes."""
    kind = T.StructType.fromDDL("path string, start long, end long, inner long, gap string, record_type string, page_id long, url string, refers_to long, payload_bytes long, payload_digest string, payload binary")
    arrow = to_arrow_schema(kind)
    folder = _shared(files.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                with store.open_input_stream(path, compression=None) as f:
                    raw = f.read()
                rows, held, n = [], 0, 0
                for found in salvage(raw):
                    if whole and found.reason:
                        raise RuntimeError(f"{path}: {records} records written, a gap at {found.start}: {found.reason}")
                    rows.append(_row(path, found))
                    held += len(found.block)
                    n += 1
                    if held >= most:
                        yield batch_of(rows)
                        rows, held = [], 0
                if whole and n != records:
                    raise RuntimeError(f"{path}: {records} records written, {n} read")
                if rows:
                    yield batch_of(rows)

    if "records" not in files.columns:
        files = files.withColumn("records", F.lit(None).cast("long"))
    # by number, which is kept: file names are a few bytes, and would be folded into one task
    return files.select("path", "records").repartitionByRange(max(1, files.count()), "path").mapInArrow(run, kind)


def archive(pages: DataFrame, folder: str | None = None, whole: bool = False) -> DataFrame:
    """Writes the pages as archives and reads these back: records and gaps."""
    folder = folder or f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read(write(marked(pages), folder), folder, whole)


def round_trip(pages: DataFrame) -> DataFrame:
    """One row per page, from what the salvage reader finds; it fails if that is
    not every record written."""
    return archive(pages, whole=True).where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TWIN = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages),
     largest AS (SELECT digest, max(page_id) AS page FROM p WHERE size >= {MIN_REVISIT} GROUP BY digest)
SELECT p.page_id, p.size AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN p.page_id IS DISTINCT FROM l.page AND l.page IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM l.page THEN l.page END AS refers_to
FROM p LEFT JOIN largest l ON p.size >= {MIN_REVISIT} AND p.digest = l.digest
"""
