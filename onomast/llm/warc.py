"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a skippable frame at the end holds the seek table (the seekable
format of the Zstandard project: sizes of each frame, then a fixed footer), so any frame can be read alone. An index maps
each record identifier to its bundle, frame and offset within the frame. Of records with equal payloads one is written in
full, the others as ``revisit`` records that refer to it.

Bundles are written under a name of their own attempt and moved into place; the index holds those of finished tasks only,
so a task that is run again leaves at most an orphan file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onomast.llm.common import join_by_hot_key, parallelism, scratch_path, stored

FRAME_BYTES = 1 << 19
BUNDLE_BYTES = 64 << 20
#: Frames that one unit of reading takes from a bundle.
FRAMES_AT_ONCE = 32
#: Payloads that several records share; up to so many digests (about 60 bytes each) are broadcast, more are joined by shuffle.
BROADCAST_DIGESTS = 200_000
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id bigint, bundle string, frame int, offset bigint, length bigint"
RECORD = "record_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def _name(record_id: int | None) -> str:
    return f"<urn:page:{'none' if record_id is None else record_id}>"


def _number(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name)
    return int(found[1]) if found else None


def encode_record(record_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head only, whose Content-Length is that of the full payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(record_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-￿\U00010000-\U0010ffff]", lambda m: quote(m[0], errors="replace"), url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_records(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC headers by lower-case name, block) of each record in a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record here")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        n = int(head["content-length"])
        yield head, frame[end + 4 : end + 4 + n]
        at = end + 4 + n + 4


class BundleWriter:
    """Writes frames and, on close, the seek table."""

    def __init__(self, sink, level: int = 3):
        self.sink, self.packer = sink, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.sizes: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.held_bytes = self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.held and self.held_bytes + len(record) > FRAME_BYTES:
            self.flush()
        at = (len(self.sizes), self.held_bytes)
        self.held.append(record)
        self.held_bytes += len(record)
        self.total += len(record)
        return at

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.sink.write(packed)
            self.sizes.append((len(packed), self.held_bytes))
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        body = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.sink.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(position, packed size, size) of each frame, from the end of an open bundle."""
    end = source.size()
    frames, descriptor, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    body, at, out = source.read_at(frames * width, end - 9 - frames * width), 0, []
    for i in range(frames):
        packed, size = struct.unpack_from("<II", body, i * width)
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(source, where: tuple[int, int, int]) -> bytes:
    at, packed, size = where
    return zstandard.ZstdDecompressor().decompress(source.read_at(packed, at), max_output_size=size)


def _roles(pages: DataFrame) -> DataFrame:
    """record_id, url, payload, digest (hex), revisit, refers_to."""
    each = pages.withColumn("digest", F.sha1("payload"))
    shared = stored(each.groupBy("digest").agg(F.max("record_id").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1"), "digests")
    if shared.count() <= BROADCAST_DIGESTS:
        each = each.join(F.broadcast(shared.drop("n")), "digest", "left")
    else:
        each = join_by_hot_key(each, shared, "digest", "n", each.count())
    revisit = F.col("kept").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("kept"))
    return each.select("record_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("kept")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row into bundles under ``folder`` (shared by all executors); gives the index.

    The payload is the text in UTF-8, empty for null. Of equal payloads the record with the largest id is written in full
    (all of them where the same row is repeated, and where none has an id); the others revisit it, those without an id
    too. Other columns are not archived. The index (record_id, bundle, frame, offset, length) is stored before this
    returns. An empty table gives an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        writer, name, rows = None, "", []

        def close() -> pa.RecordBatch:
            writer.close()
            store.move(f"{root}/{name}.tmp", f"{root}/{name}")
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array([f"{folder}/{name}"] * len(rows)), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["record_id", "bundle", "frame", "offset", "length"])

        for b in batches:
            for i in range(b.num_rows):
                record_id, url, payload, digest, revisit, refers_to = (c[i].as_py() for c in b.columns)
                if writer is None:
                    name, rows = f"part-{uuid.uuid4().hex}.warc.zst", []
                    store.create_dir(root)
                    writer = BundleWriter(store.open_output_stream(f"{root}/{name}.tmp"))
                record = encode_record(record_id, url, payload, len(payload), base64.b32encode(bytes.fromhex(digest)).decode(), refers_to, revisit, date)
                rows.append((record_id, *writer.add(record), len(record)))
                if writer.total >= BUNDLE_BYTES:
                    yield close()
                    writer = None
        if writer is not None:
            yield close()

    ids = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    return stored(_roles(ids).mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles in an index. The digest of each full payload is worked out anew and must agree.

    Frames stand by themselves, so a bundle is read by as many tasks as it has units of frames. An index entry repeated
    reads nothing twice; an empty index gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bundle, unit in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, path = pafs.FileSystem.from_uri(bundle)
                with store.open_input_file(path) as source:
                    for where in seek_table(source)[unit * FRAMES_AT_ONCE : (unit + 1) * FRAMES_AT_ONCE]:
                        yield _frame_rows(read_frame(source, where), payloads)

    units = index.select("bundle", F.floor(F.col("frame") / FRAMES_AT_ONCE).cast("int").alias("unit")).distinct()
    # a number of its own, as a few bytes for each unit would else be put together into one task
    tasks = max(1, min(units.count(), 64 * parallelism(index.sparkSession)))
    return units.repartition(tasks).mapInArrow(run, RECORD)


def _frame_rows(frame: bytes, payloads: bool) -> pa.RecordBatch:
    rows = []
    for head, block in decode_records(frame):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = head["warc-payload-digest"].removeprefix("sha1:")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        revisit = head["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != said):
            raise ValueError(f"damaged record {head['warc-record-id']}")
        rows.append((_number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], size, said, _number(head["warc-refers-to"]) if revisit else None, payload if payloads and not revisit else None))
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])


def find_record(index: DataFrame, record_id: int) -> bytes | None:
    """The record with this id as it stands in its bundle, None without one: one frame is read and unpacked, no other.

    Of several records with the id, the one whose bundle's name, frame and offset are least.
    """
    at = index.where(F.col("record_id") == record_id).select("bundle", "frame", "offset", "length").orderBy("bundle", "frame", "offset").first()
    if at is None:
        return None
    store, path = pafs.FileSystem.from_uri(at.bundle)
    with store.open_input_file(path) as source:
        return read_frame(source, seek_table(source)[at.frame])[at.offset : at.offset + at.length]


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared folder and read them back: record_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write_archives(pages, scratch_path(pages.sparkSession, "warc"))
    return read_archives(index, payloads=False).drop("payload", "url")
