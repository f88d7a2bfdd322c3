"""Seekable Zstandard bundles of WARC records.

A bundle ``bundle-NNNNN.warc.zst`` is a run of independent Zstandard frames,
each holding some whole WARC/1.1 records, and ends in a seek table: a skippable
frame in the public Zstandard seekable format (compressed and plain size of each
frame, the frame count, a descriptor byte and a magic number). Any Zstandard
reader can unpack a bundle from front to back; with the index of
:func:`write`, one record costs the seek table and one frame.

Equal payloads are stored once: the record of the largest page id is a
``response``; the others are ``revisit`` records (profile
identical-payload-digest) that keep the HTTP headers only.

Nulls: a null html is an empty payload, a null url leaves WARC-Target-URI out. A
null page id never becomes the response of others unless all ids of the payload
are null. Repeated rows of the largest page id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import dealt_by_bytes, frames, staged, text_batches, work_dir
from .files import AtomicFile, store

FRAME_BYTES = 1 << 20
READ_BYTES = 32 << 20  # of records that one task reads back
LEVEL = 3
CAPTURED = "1970-01-01T00:00:00Z"
# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
TABLE_FOOT = "<IBI"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int | None, repeat: int = 0) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}" + (f":{repeat}" if repeat else "")


def page_of(urn: str) -> int | None:
    number = urn.split(":")[2]
    return int(number) if number else None


def _uri(url: str) -> str:
    """The url on one header line: control characters percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def pack_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                is_revisit: bool, repeat: int = 0, date: str = CAPTURED) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [("WARC-Type", "revisit" if is_revisit else "response"),
            ("WARC-Record-ID", f"<{record_id(page_id, repeat)}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _uri(url)))
    head.append(("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)))
    if is_revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join((b"WARC/1.1\r\n", "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace"),
                     b"\r\n", block, b"\r\n\r\n"))


def unpack_record(raw: bytes) -> dict:
    """Fields of one record: headers as a dict, http headers and payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    assert first.startswith("WARC/"), "not a WARC record"
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in http.decode("ascii").split("\r\n")[1:])
    return {"headers": headers, "http": http, "payload": payload}


class Bundle(AtomicFile):
    """A bundle being written; ``add`` returns (frame, offset in its frame)."""

    def __init__(self, folder: str, name: str, frame_bytes: int = FRAME_BYTES):
        import zstandard
        super().__init__(folder, name)
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.frame_bytes, self.held, self.size, self.table = frame_bytes, [], 0, []

    def add(self, record: bytes) -> tuple[int, int]:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        place = (len(self.table), self.size)
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        packed = self.pack(b"".join(self.held))
        self.write(packed)
        self.table.append((len(packed), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.table) \
            + struct.pack(TABLE_FOOT, len(self.table), 0, SEEKABLE)
        self.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        super().close()


class BundleReader:
    """Random access to the frames of one bundle."""

    def __init__(self, folder: str, name: str):
        fs, root = store(folder)
        self.file = fs.open_input_file(f"{root}/{name}")
        size, foot = self.file.size(), struct.calcsize(TABLE_FOOT)
        n, _, magic = struct.unpack(TABLE_FOOT, self.file.read_at(foot, size - foot))
        assert magic == SEEKABLE, "no seek table"
        entries = struct.iter_unpack("<II", self.file.read_at(8 * n, size - foot - 8 * n))
        self.places, at = [], 0
        for packed, plain in entries:
            self.places.append((at, packed, plain))
            at += packed
        self.last = (-1, b"")

    def frame(self, k: int) -> bytes:
        import zstandard
        if self.last[0] != k:
            at, packed, plain = self.places[k]
            self.last = (k, zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain))
        return self.last[1]

    def close(self) -> None:
        self.file.close()


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows (page_id, url, html, refers_to, is_revisit).

    Only digests and ids are grouped; the pages then meet the one row of their
    digest, so a payload that fills a third of the table is a skewed join side
    that adaptive execution splits.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    last = rows.where(F.octet_length("html") >= min_bytes).groupBy(digest.alias("digest")) \
        .agg(F.max("page_id").alias("response_id"))
    joined = rows.withColumn("digest", digest).join(last, "digest", "left")
    revisit = (F.octet_length("html") >= min_bytes) & F.col("response_id").isNotNull() \
        & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("response_id")).alias("refers_to"),
                         revisit.alias("is_revisit"))


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
          frame_bytes: int = FRAME_BYTES) -> tuple[DataFrame, str]:
    """Write bundles; returns their index (record_id, page_id, bundle, frame,
    place, size) and the folder. An empty table writes no bundle. Each try of a task
    writes a bundle of its own name, as its rows may come in another order; the index
    names the bundles of the tries that Spark has committed, others are not read."""
    spark = pages.sparkSession
    text_batches(spark)
    folder = folder or work_dir(spark, "warc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"bundle-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.zst"
        bundle, seen = None, {}
        for b in batches:
            bundle = bundle or Bundle(folder, name, frame_bytes)
            rows = []
            for page, url, html, refers, revisit in zip(b["page_id"].astype(object), b["url"], b["html"],
                                                        b["refers_to"].astype(object), b["is_revisit"]):
                page = None if pd.isna(page) else int(page)
                repeat = seen[page] = seen.get(page, -1) + 1
                record = pack_record(page, url, html.encode("utf-8", "replace"),
                                     None if pd.isna(refers) else int(refers), bool(revisit), repeat)
                rows.append((record_id(page, repeat), page, name, *bundle.add(record), len(record)))
            out = pd.DataFrame(rows, columns=["record_id", "page_id", "bundle", "frame", "place", "size"])
            yield out.astype({"page_id": "Int64"})
        if bundle:
            bundle.close()

    index = with_responses(pages, min_bytes).mapInPandas(
        run, "record_id string, page_id long, bundle string, frame int, place long, size long")
    return staged(index, "warc-index"), folder


def read(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Read the indexed records back: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url (and payload, empty for revisits). The digest of
    a response is computed from its payload and must equal its header."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, reader = None, None
        for b in batches:
            rows = []
            for bundle, frame, place, size in zip(b["bundle"], b["frame"], b["place"], b["size"]):
                if bundle != name:
                    if reader:
                        reader.close()
                    name, reader = bundle, BundleReader(folder, bundle)
                got = unpack_record(reader.frame(int(frame))[int(place): int(place) + int(size)])
                head, payload = got["headers"], got["payload"]
                kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                assert kind == "revisit" or base32_sha1(payload) == digest, "payload differs from its digest"
                refers = head.get("WARC-Refers-To")
                rows.append((page_of(head["WARC-Record-ID"].strip("<>")), int(got["http"]["Content-Length"]), digest,
                             kind, page_of(refers.strip("<>")) if refers else None, head.get("WARC-Target-URI"),
                             payload if with_payload else b""))
            out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type",
                                              "refers_to", "url", "payload"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
        if reader:
            reader.close()

    dealt = dealt_by_bytes(index.select("bundle", "frame", "place", "size"), "size", READ_BYTES, "bundle", "frame")
    rows = dealt.sortWithinPartitions("bundle", "frame", "place").mapInPandas(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "url string, payload binary")
    return rows if with_payload else rows.drop("payload")
