"""Web archives in seekable Zstandard bundles.

A bundle is one file: WARC records grouped into independent Zstandard frames, then the seek table, a skippable frame
that lists the compressed and plain size of every frame. An index maps record ids to a frame and the offset inside it,
so that one record costs the decompression of one frame. Bundles are written and read by Spark itself, so they can lie
in any store that Spark reaches, and a task that is run again replaces its files.
"""

from __future__ import annotations

import hashlib
import struct
from base64 import b32encode
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import materialize

#: Plain bytes after which a frame and a bundle are closed; a longer record has a frame of its own.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
#: Fixed values of the seekable format: the skippable frame that holds the table, and the magic number at its end.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: The pages carry no time; one for all keeps reruns alike.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_END = b"\r\n\r\n"
_URN = "urn:page:"


def _base32(digest: bytes) -> str:
    return b32encode(digest).decode()


def _record(page: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, revisit: bool) -> bytes:
    name = f"{_URN}{'null' if page is None else page}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else name}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + _END + (b"" if revisit else payload)
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + _END + block + _END


class _Bundle:
    """Frames of one file, up to its seek table."""

    def __init__(self):
        self.frames, self.sizes, self.open, self.plain = [], [], [], 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> None:
        self.open.append(record)
        self.plain += len(record)
        if sum(map(len, self.open[-1:])) >= FRAME_BYTES or sum(map(len, self.open)) >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            plain = b"".join(self.open)
            packed = self.packer.compress(plain)
            self.frames.append(packed)
            self.sizes.append((len(packed), len(plain)))
            self.open = []

    def done(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, from the end of the file."""
    count, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("not a seekable bundle without checksums")
    sizes = struct.unpack(f"<{2 * count}I", content[-9 - 8 * count : -9])
    starts = np.cumsum([0, *sizes[::2]]).tolist()
    return list(zip(starts, sizes[::2], sizes[1::2]))


def read_frame(content: bytes, frame: tuple[int, int, int]) -> bytes:
    start, packed, plain = frame
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=plain)


def _parsed(plain: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and length of the record at a frame's offset."""
    head_end = plain.index(_END, at)
    lines = plain[at:head_end].decode().split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    block_end = head_end + 4 + int(headers["Content-Length"])
    block = plain[head_end + 4 : block_end]
    return headers, block[block.index(_END) + 4 :], block_end + 4 - at


def _page(urn: str | None) -> int | None:
    number = urn.strip("<>").removeprefix(_URN) if urn else "null"
    return None if number == "null" else int(number)


def write_bundles(
    pages: DataFrame, path: str, page: str = "page_id", url: str = "url", payload: str = "html", dedupe_from: int = 0
) -> None:
    """Write one record per row of `pages` into bundle files under `path`, which must not exist.

    A null payload is empty. Of records with equal payloads of at least `dedupe_from` bytes the one with the largest
    id is a response and the others are revisits that refer to it; all smaller ones are responses. Rows that repeat an
    id and a payload are alike; a null id is a revisit if any other row has its payload, else a response. Empty
    tables make no bundle. Payloads are compared by SHA-1; only ids and digests are shuffled to find equal ones.
    """
    rows = pages.select(
        F.col(page).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    seen = materialize(rows.select("page_id", "digest").distinct())
    last = materialize(seen.groupBy("digest").agg(F.max("page_id").alias("last")))
    roles = seen.join(last, "digest").select(F.col("page_id").alias("id"), F.col("digest").alias("d"), "last")
    joined = rows.join(roles.hint("merge"), F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")))
    dealt = joined.select("page_id", "url", "payload", "digest", "last")

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = _Bundle()
        for batch in batches:
            text = batch.column(2).cast(pa.binary())
            for i in range(len(batch)):
                body = text[i].as_py()
                number, last_id = batch.column(0)[i].as_py(), batch.column(4)[i].as_py()
                revisit = len(body) >= dedupe_from and last_id is not None and number != last_id
                digest = bytes.fromhex(batch.column(3)[i].as_py())
                bundle.add(_record(number, batch.column(1)[i].as_py(), body, digest, last_id, revisit))
                if bundle.plain >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.done()], pa.binary())], ["content"])
                    bundle = _Bundle()
        if bundle.plain:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.done()], pa.binary())], ["content"])

    # One row is one file. The writer ends every row with a separator, which here is the last byte of the magic number.
    content = dealt.mapInArrow(bundles, "content binary").select(
        F.substring("content", F.lit(1), F.length("content") - 1).cast("string").alias("value")
    )
    separator = SEEKABLE.to_bytes(4, "little")[-1:].decode("latin-1")
    content.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", separator).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def index_bundles(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, bundle, frame, at, length, record_type, payload_bytes, payload_digest, refers_to) of every record.

    Read from the bundles; `at` is the record's offset inside its plain frame. For a revisit, payload_bytes is null
    here, as its payload lies elsewhere. The digest of a response is computed from what was read.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = []
                for k, frame in enumerate(seek_table(content)):
                    plain, at = read_frame(content, frame), 0
                    while at < len(plain):
                        headers, body, length = _parsed(plain, at)
                        revisit = headers["WARC-Type"] == "revisit"
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        rows.append({
                            "page_id": _page(headers["WARC-Record-ID"]), "bundle": name, "frame": k, "at": at,
                            "length": length, "record_type": headers["WARC-Type"],
                            "payload_bytes": None if revisit else len(body),
                            "payload_digest": digest if revisit else _base32(hashlib.sha1(body).digest()),
                            "refers_to": _page(headers.get("WARC-Refers-To")),
                        })
                        at += length
                yield pa.RecordBatch.from_pylist(rows, _INDEX)

    return _files(spark, path).select("path", "content").mapInArrow(
        records,
        "page_id long, bundle string, frame int, at int, length int, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long",
    )


_INDEX = pa.schema([
    ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("at", pa.int32()), ("length", pa.int32()),
    ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
])


def full_records(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record; a revisit has its response's size."""
    sizes = index.filter("record_type = 'response'").groupBy(F.col("page_id").alias("to"), F.col("payload_digest").alias("d"))
    sizes = materialize(sizes.agg(F.max("payload_bytes").alias("to_bytes")))
    joined = index.join(sizes, (F.col("refers_to") == F.col("to")) & (F.col("payload_digest") == F.col("d")), "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def fetch(spark: SparkSession, path: str, index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(page_id, payload) of the responses and, through what they refer to, the revisits with the ids asked for.

    Only the bundles that hold them are read, and only the frames that hold them are decompressed.
    """
    asked = index.join(page_ids.select(F.col("page_id").cast("long")).distinct(), "page_id", "left_semi")
    asked = asked.select("page_id", F.coalesce("refers_to", "page_id").alias("held_by"), "payload_digest")
    held = index.filter("record_type = 'response'").select(F.col("page_id").alias("held_by"), "bundle", "frame", "at", "payload_digest")
    places = asked.join(held, ["held_by", "payload_digest"]).groupBy("bundle").agg(
        F.collect_list(F.struct("frame", "at", "page_id")).alias("places")
    )
    files = _files(spark, path).join(places, F.col("path") == F.col("bundle")).select("content", "places")

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, wanted in zip(batch.column(0), batch.column(1)):
                content, frames, open_frame = content.as_py(), seek_table(content.as_py()), (-1, b"")
                for place in sorted(wanted.as_py(), key=lambda x: (x["frame"], x["at"])):
                    if place["frame"] != open_frame[0]:
                        open_frame = (place["frame"], read_frame(content, frames[place["frame"]]))
                    body = _parsed(open_frame[1], place["at"])[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([place["page_id"]], pa.int64()), pa.array([body.decode()])], ["page_id", "payload"]
                    )

    return files.mapInArrow(payloads, "page_id long, payload string")
