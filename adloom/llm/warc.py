"""Web archives as seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends in a skippable frame holding
the seek table (compressed and plain size of every frame), so any frame is reached without
reading the others. The index maps a record id to its bundle, frame and place in the frame.

Of records whose payloads are equal and at least ``MIN_REVISIT_BYTES`` long, the one with
the smallest page_id is a response and the others revisit it. A null html is an empty
payload; a null url leaves the target header out. A row without page_id revisits like any
other, and is a response where its whole group has none. Rows that repeat the smallest
page_id are all responses. An empty table makes no bundle; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import shuffle_partitions, staged
from adloom.llm.files import attempt_name, folder, open_input, open_output

MIN_REVISIT_BYTES = 100
FRAME_BYTES = 256 * 1024  # plain bytes after which a frame is closed
BUNDLE_BYTES = 1024**3  # compressed bytes after which a new bundle is begun
LEVEL = 3
RECORD_DATE = "2020-01-01T00:00:00Z"

# Fixed values of the archive format and of the seekable Zstandard format.
PROFILE = "http://netpreserve.org/fileformat/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")

FRAMES = (
    "bundle string, frame int, frame_offset bigint, frame_bytes bigint, plain_bytes bigint, "
    "record_ids array<string>, starts array<bigint>, lengths array<bigint>"
)


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def make_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One record; a revisit carries its payload's digest and size but not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Page-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"Page-Refers-To: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (empty for a revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not an archive record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return headers, block.partition(b"\r\n\r\n")[2]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, plain) sizes of all frames and the footer."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    content = entries + FOOTER.pack(len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(content)) + content


def read_seek_table(source) -> list[tuple[int, int]]:
    """Sizes of all frames, from the end of an open bundle."""
    end = source.size()
    source.seek(end - FOOTER.size)
    count, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    source.seek(end - FOOTER.size - count * width)
    data = source.read(count * width)
    return [struct.unpack_from("<II", data, i * width) for i in range(count)]


def read_frame(source, offset: int, size: int, plain: int) -> bytes:
    source.seek(offset)
    return zstandard.ZstdDecompressor().decompress(source.read(size), max_output_size=plain)


class _Bundle:
    """A bundle being written: one frame is held in memory at a time."""

    def __init__(self, root: str, frame_bytes: int):
        self.uri = f"{root}/{attempt_name('bundle', '.warc.zst')}"
        self.out = open_output(self.uri)
        self.frame_bytes = frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.offset = 0
        self._begin()

    def _begin(self) -> None:
        self.ids: list[str] = []
        self.lengths: list[int] = []
        self.plain = bytearray()

    def add(self, name: str, record: bytes) -> dict | None:
        self.ids.append(name)
        self.lengths.append(len(record))
        self.plain += record
        return self.flush() if len(self.plain) >= self.frame_bytes else None

    def flush(self) -> dict | None:
        """Close the frame and describe it."""
        if not self.ids:
            return None
        data = self.zstd.compress(bytes(self.plain))
        self.out.write(data)
        starts = [0]
        for n in self.lengths[:-1]:
            starts.append(starts[-1] + n)
        row = {
            "bundle": self.uri,
            "frame": len(self.sizes),
            "frame_offset": self.offset,
            "frame_bytes": len(data),
            "plain_bytes": len(self.plain),
            "record_ids": self.ids,
            "starts": starts,
            "lengths": self.lengths,
        }
        self.sizes.append((len(data), len(self.plain)))
        self.offset += len(data)
        self._begin()
        return row

    def close(self) -> None:
        self.out.write(seek_table(self.sizes))
        self.out.close()


_FRAME_SCHEMA = pa.schema(
    [
        ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()),
        ("frame_bytes", pa.int64()), ("plain_bytes", pa.int64()),
        ("record_ids", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)


def with_revisits(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest and the page they repeat (null for a response)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    # counted before anything is joined: a payload on a third of all pages is one row
    repeated = staged(
        rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and first_page is not null")
        .drop("_n"),
        "repeated-payloads",
    )
    return rows.join(repeated, "digest", "left").withColumn(
        "refers_to",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_page")), F.col("first_page")),
    )


def write_archive(pages: DataFrame, root: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write all pages as bundles under ``root``; one row per frame, with its records'
    ids, starts and lengths. Each task streams its rows into its own bundles."""
    folder(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            done = []
            columns = (batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to"))
            for values in zip(*columns):
                page_id, url, payload, digest, refers_to = (v.as_py() for v in values)
                if bundle is None:
                    bundle = _Bundle(root, frame_bytes)
                record = make_record(
                    page_id, url, payload, digest, refers_to, refers_to is not None
                )
                if row := bundle.add(record_id(page_id), record):
                    done.append(row)
                    if bundle.offset >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
            if done:
                yield pa.RecordBatch.from_pylist(done, _FRAME_SCHEMA)
        if bundle is not None:
            last = bundle.flush()
            bundle.close()
            if last:
                yield pa.RecordBatch.from_pylist([last], _FRAME_SCHEMA)

    rows = with_revisits(pages).select("page_id", "url", "payload", "digest", "refers_to")
    return staged(rows.mapInArrow(write, FRAMES), "archive-frames")


def record_index(frames: DataFrame) -> DataFrame:
    """One row per record: where it is."""
    places = F.arrays_zip("record_ids", "starts", "lengths")
    return frames.select(
        "bundle", "frame", "frame_offset", "frame_bytes", "plain_bytes", F.explode(places).alias("_r")
    ).select(
        F.col("_r.record_ids").alias("record_id"),
        "bundle", "frame", "frame_offset", "frame_bytes", "plain_bytes",
        F.col("_r.starts").alias("start"), F.col("_r.lengths").alias("length"),
    )


def read_archive(frames: DataFrame, page_type: str = "bigint") -> DataFrame:
    """All records of the frames given, read back from the bundles: each frame is fetched
    by its offset and each record by its place in the frame. Digest and size of a response
    are computed from the payload read and must equal what its headers say."""
    schema = (
        f"record_id string, page_id {page_type}, payload_bytes bigint, payload_digest string, "
        f"record_type string, refers_to {page_type}, url string, payload binary"
    )
    number = str if page_type == "string" else int

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in batch.to_pylist():
                with open_input(frame["bundle"]) as source:
                    plain = read_frame(
                        source, frame["frame_offset"], frame["frame_bytes"], frame["plain_bytes"]
                    )
                rows = []
                for name, start, n in zip(frame["record_ids"], frame["starts"], frame["lengths"]):
                    headers, payload = parse_record(plain[start : start + n])
                    revisit = headers["WARC-Type"] == "revisit"
                    size = int(headers["Page-Payload-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    found = (len(payload), hashlib.sha256(payload).hexdigest())
                    if headers["WARC-Record-ID"] != name or not revisit and found != (size, digest):
                        raise ValueError(f"record {name} is not what the index says")
                    page, first = headers.get("Page-ID"), headers.get("Page-Refers-To")
                    rows.append(
                        {
                            "record_id": name,
                            "page_id": None if page is None else number(page),
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": headers["WARC-Type"],
                            "refers_to": None if first is None else number(first),
                            "url": headers.get("WARC-Target-URI"),
                            "payload": None if revisit else payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, arrow_schema)

    id_type = {"string": pa.string(), "int": pa.int32()}.get(page_type, pa.int64())
    arrow_schema = pa.schema(
        [
            ("record_id", pa.string()), ("page_id", id_type), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", id_type),
            ("url", pa.string()), ("payload", pa.binary()),
        ]
    )
    spread = frames.repartition(shuffle_partitions(frames.sparkSession), "bundle", "frame")
    return spread.mapInArrow(read, schema)


def read_records(frames: DataFrame, ids: DataFrame, page_type: str = "bigint") -> DataFrame:
    """Only the records whose ``record_id`` is asked for: the index finds their places, and
    only their frames are opened."""
    wanted = record_index(frames).join(ids.select("record_id").distinct(), "record_id")
    keys = ["bundle", "frame", "frame_offset", "frame_bytes", "plain_bytes"]
    # a frame holds a bounded number of records, so these lists are bounded too
    lists = wanted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "record_id"))).alias("_r")
    )
    chosen = lists.select(
        *keys,
        F.col("_r.record_id").alias("record_ids"),
        F.col("_r.start").alias("starts"),
        F.col("_r.length").alias("lengths"),
    )
    return read_archive(chosen, page_type)
