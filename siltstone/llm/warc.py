"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Archives are gzip files with one member per record. The reader cuts files into byte
ranges, one task each: it looks for the gzip magic from the range's first byte,
validates each candidate by decoding a WARC header from it, and from there reads member
after member. A task owns the records that start inside its range and reads the last
one beyond the range's end. Nothing needs an index.

Files are written under names of their own to the given folder; the list of files comes
from the tasks that committed, so what a lost or repeated task left is never read.
Folders can be in any store that pyarrow.fs knows by its URI (file, hdfs, s3, gs).

Defined results: a null payload is stored as an empty one; a null url as an empty one,
read back as null; pages without an id are null again on reading, and visit the page of
their payload that has one; rows that repeat the id of the response are responses too;
no pages give no files and an empty result; other columns are not archived.
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

from siltstone.llm.shared import written

#: Payloads of fewer bytes are stored each time.
MIN_BYTES = 0
FILE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 16
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY = re.compile(r"<urn:page:(-?\d+)>")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI."""
    return fs.FileSystem.from_uri(arrow_uri(uri))


def arrow_uri(uri: str) -> str:
    """A URI as pyarrow knows it: Hadoop writes file:/a for file:///a, and s3a: or s3n: for s3:."""
    return re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the session's default file system, if it has none."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


# ---------------------------------------------------------------- writing


def with_revisits(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is the page whose record holds the payload, for revisits.

    Payloads that occur more than once are counted by digest first, with partial sums,
    and only they are joined: a table of known size, broadcast by Spark while small.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.filter(F.length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
        .filter("n > 1 AND head IS NOT NULL")
        .select(F.col("digest").alias("of"), "head")
    )
    heads = written(repeated, "heads")
    return rows.join(heads, F.col("digest") == F.col("of"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")), F.col("head")).alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    name = "none" if page_id is None else page_id
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {re.sub('[\r\n]', '', url or '')}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: {digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http + payload if refers_to is None else http
    head.append(f"Content-Length: {len(block)}")
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packed.compress(raw) + packed.flush()


def write_archive(pages: DataFrame, folder: str, *, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the rows of `with_revisits`; returns (path, bytes, records), a row per file."""
    folder = qualified(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        out = path = None
        records = 0

        def closed() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{path}"], "bytes": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())}
            )

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    store.create_dir(root, recursive=True)
                    path, records = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                row = [batch.column(name)[i].as_py() for name in ("page_id", "url", "payload", "digest", "refers_to")]
                out.write(record(*row, date))
                records += 1
                if out.tell() >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(pages.mapInArrow(run, "path string, bytes bigint, records bigint"), "files")


# ---------------------------------------------------------------- reading


class _Window:
    """Bytes of a file from a moving start, read as needed."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        new = self.file.read(max(_READ, len(self.data)))
        self.data += new
        return bool(new)

    def skip(self, n: int) -> None:
        self.start, self.data = self.start + n, self.data[n:]


def _header(window: _Window) -> tuple[dict[str, str], bytes, zlib._Decompress, int] | None:
    """Decodes a member's WARC header, however long; None if no member with such a header starts here.

    Returns the fields, what was decoded beyond them, the open decoder and the bytes it has read."""
    unpack, text, used = zlib.decompressobj(31), bytearray(), 0
    while True:
        if used == len(window.data) and not window.more():
            return None
        looked = max(0, len(text) - 3)
        try:
            text += unpack.decompress(window.data[used:])
        except zlib.error:
            return None
        used = len(window.data)
        ends = text.find(b"\r\n\r\n", looked)
        if text[: len(b"WARC/1.")] != b"WARC/1."[: len(text)] or unpack.eof and ends < 0:
            return None
        if ends >= 0:
            rest = bytes(text[ends + 4 :])
            lines = text[:ends].decode("utf-8", "surrogatepass").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            return (fields, rest, unpack, used) if fields.get("content-length", "").isdigit() else None


def records_of(store: fs.FileSystem, path: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record that starts in [start, end)."""
    with store.open_input_file(path) as file:
        window = _Window(file, start)
        while window.start < end:
            at = window.data.find(MAGIC)
            if at < 0:
                window.skip(max(0, len(window.data) - len(MAGIC) + 1))
                if not window.more():
                    return
                continue
            window.skip(at)
            if window.start >= end:
                return
            found = _header(window)
            if found is None:
                window.skip(1)
                continue
            fields, first, unpack, used = found
            offset, block = window.start, [first]
            while not unpack.eof:
                window.skip(used)
                used = 0
                if not window.data and not window.more():
                    raise ValueError(f"{path}: the record at {offset} is cut off")
                block.append(unpack.decompress(window.data))
                used = len(window.data)
            window.skip(used - len(unpack.unused_data))
            yield offset, fields, b"".join(block)[: int(fields["content-length"])]


_SCHEMA = (
    "path string, offset bigint, record_id string, record_type string, url string, page_id bigint, refers_to string, "
    "refers_to_page bigint, digest string, payload_bytes bigint, digest_holds boolean"
)


def _key(record_id: str | None) -> int | None:
    found = _KEY.fullmatch(record_id or "")
    return int(found[1]) if found else None


def read_archive(files: DataFrame, *, payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row per record of the files (path, bytes): header fields, digest (of the payload; a revisit's is
    the stored one), payload_bytes (null for revisits), whether the stored digest holds, and the payload."""
    total = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    splits = files.select(
        "path", F.explode(F.sequence(F.lit(0), F.floor((F.col("bytes") - 1) / split_bytes))).alias("k"), "bytes"
    ).select("path", (F.col("k") * split_bytes).alias("start"), F.least((F.col("k") + 1) * split_bytes, F.col("bytes")).alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                store, path = opened(split["path"])
                rows: list[dict] = []
                held = 0
                for offset, fields, block in records_of(store, path, split["start"], split["end"]):
                    body = block.partition(b"\r\n\r\n")[2]
                    stored = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    response = fields.get("warc-type") == "response"
                    own = base64.b32encode(hashlib.sha1(body).digest()).decode() if response else stored
                    row = {
                        "path": split["path"], "offset": offset, "record_id": fields.get("warc-record-id"),
                        "record_type": fields.get("warc-type"), "url": fields.get("warc-target-uri") or None,
                        "page_id": _key(fields.get("warc-record-id")), "refers_to": fields.get("warc-refers-to"),
                        "refers_to_page": _key(fields.get("warc-refers-to")), "digest": own,
                        "payload_bytes": len(body) if response else None, "digest_holds": own == stored,
                    }
                    rows.append(row | ({"payload": body if response else None} if payload else {}))
                    held += len(body)
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = _SCHEMA + (", payload binary" if payload else "")
    arrow = pa.schema([(n, kinds[k]) for n, k in (field.split() for field in schema.split(", "))])
    return splits.repartition(int(min(total, 100_000))).mapInArrow(run, schema)


def whole(records: DataFrame, files: DataFrame) -> DataFrame:
    """The records read, if they are as many as the files (path, bytes, records) were written with."""
    read, stored = records.count(), files.agg(F.sum("records")).first()[0] or 0
    if read != stored:
        raise ValueError(f"{read} records read of {stored} written")
    return records


def resolved(records: DataFrame) -> DataFrame:
    """Gives revisits the payload_bytes of the response they refer to.

    Responses are grouped by id first; many revisits of one response are a hot key of the
    left side, which adaptive execution splits."""
    held = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("of"))
        .agg(F.max("payload_bytes").alias("held_bytes"))
    )
    return (
        records.join(held, (F.col("refers_to") == F.col("of")) & (F.col("record_type") == "revisit"), "left")
        .withColumn("payload_bytes", F.coalesce("payload_bytes", "held_bytes"))
        .drop("of", "held_bytes")
    )
