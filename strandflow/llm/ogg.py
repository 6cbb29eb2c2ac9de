"""Ogg containers: writing, page checks, packets, logical streams and timestamps.

A page is a 27-byte head (capture pattern, version, flags, granule position, stream serial number, page number, CRC,
number of segments), its lacing values and its body.  A packet's length is the sum of its lacing values up to the first
below 255; a packet may go on over pages.  The CRC is the non-reflected one with polynomial 0x04C11DB7, start 0; here it
comes from the reflected CRC of ``zlib`` over bit-reversed bytes, so no byte loop runs in Python.

The reader verifies every page's checksum and number, reassembles packets, sorts them by logical stream and derives each
packet's time from the granule position of the page on which it ends.

``media_features`` stores each text's payload (UTF-8, then bytes 255 up to a positive multiple of ``BLOCK``) as 8-bit
samples in two interleaved logical streams, one block a packet, reads the stored bytes back and returns digests and
figures of what was read.  Everything depends on the text alone.

Defined results: null text is empty (one block of bytes 255); equal texts get equal values; rows that repeat get equal rows;
ids keep their type, nulls included; damaged files raise ``OggError`` from the reader.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import common as C

BLOCK = 576
RATE = 48_000
#: Packets on a page at most: 3 lacing values a packet of 576 bytes, 255 a page.
PER_PAGE = 85
SERIALS = (0x5F10, 0x5F11)
MAGIC = b"rawbytes"
_HEAD = struct.Struct("<4sBBqIIIB")
_FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4


class OggError(ValueError):
    """The bytes are not a sound Ogg file."""


def page_crc(page: bytes) -> int:
    reflected = zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(reflected.to_bytes(4, "little").translate(_FLIP), "big")


def lacing(length: int) -> bytes:
    return b"\xff" * (length // 255) + bytes([length % 255])


def make_page(flags: int, granule: int, serial: int, number: int, segments: bytes, body: bytes) -> bytes:
    blank = _HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(segments)) + segments + body
    return b"".join((blank[:22], struct.pack("<I", page_crc(blank)), blank[26:]))


def write_stream(packets: list[bytes], serial: int, samples: int = BLOCK, per_page: int = PER_PAGE) -> list[bytes]:
    """Pages of one logical stream: a head packet on a page of its own, then the packets, ``samples`` granules each.

    Packets of any length are laced; one that does not fit goes on on the next page, and a page on which no packet ends
    has granule position -1.
    """
    pages = [make_page(FIRST, 0, serial, 0, lacing(len(MAGIC) + 8), MAGIC + struct.pack("<II", RATE, samples))]
    number, granule, at = 1, 0, 0
    segments, body, begun, ended = bytearray(), [], False, False
    for k, packet in enumerate(packets):
        values, used = lacing(len(packet)), 0
        while used < len(values):
            take = min(255 - len(segments), len(values) - used)
            piece = values[used : used + take]
            size = sum(piece)
            segments += piece
            body.append(packet[at : at + size])
            used, at = used + take, at + size
            if used == len(values):
                granule, at, ended = granule + samples, 0, True
            last = k == len(packets) - 1 and used == len(values)
            if last or len(segments) == 255 or (used == len(values) and len(segments) + len(values) > 255 and len(body) >= per_page):
                flags = (CONTINUED if begun else 0) | (LAST if last else 0)
                pages.append(make_page(flags, granule if ended else -1, serial, number, bytes(segments), b"".join(body)))
                number, begun = number + 1, used < len(values)
                segments, body, ended = bytearray(), [], False
    if not packets:
        pages.append(make_page(LAST, 0, serial, 1, b"", b""))
    return pages


def interleave(streams: list[list[bytes]]) -> bytes:
    """All first pages, then the streams' pages by turns."""
    out = [s[0] for s in streams]
    for k in range(1, max(map(len, streams))):
        out += [s[k] for s in streams if k < len(s)]
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    rate: int = 0
    packets: list[bytes] = field(default_factory=list)
    #: Seconds at which each packet ends.
    times: list[float] = field(default_factory=list)
    pages: int = 0
    granule: int = 0
    ended: bool = False


def read(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number, in order of appearance."""
    streams: dict[int, Stream] = {}
    open_: dict[int, list[bytes]] = {}
    at, view = 0, memoryview(data)
    while at < len(data):
        if len(data) - at < 27:
            raise OggError(f"a page is cut off at byte {at}")
        magic, version, flags, granule, serial, number, crc, n = _HEAD.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise OggError(f"no page at byte {at}")
        begin = at + 27 + n
        segments = data[at + 27 : begin]
        end = begin + sum(segments)
        if len(segments) < n or end > len(data):
            raise OggError(f"a page is cut off at byte {at}")
        if page_crc(b"".join((view[at : at + 22], b"\0\0\0\0", view[at + 26 : end]))) != crc:
            raise OggError(f"the page at byte {at} has a wrong checksum")
        s = streams.setdefault(serial, Stream(serial))
        if number != s.pages or bool(flags & FIRST) != (number == 0) or s.ended:
            raise OggError(f"page {number} of stream {serial} is out of order")
        if bool(flags & CONTINUED) != (serial in open_):
            raise OggError(f"page {number} of stream {serial} does not go on where the last one ended")
        s.pages += 1
        s.ended = bool(flags & LAST)
        done, start, pos = [], begin, begin
        for value in segments:
            pos += value
            if value < 255:
                piece = data[start:pos]
                done.append(b"".join([*open_.pop(serial), piece]) if serial in open_ else piece)
                start = pos
        if start < pos:
            open_.setdefault(serial, []).append(data[start:pos])
        if number == 0:
            if len(done) != 1 or not done[0].startswith(MAGIC) or len(done[0]) != len(MAGIC) + 8:
                raise OggError(f"stream {serial} has an unknown head")
            s.rate, each = struct.unpack("<II", done[0][len(MAGIC) :])
            s.samples = each
        else:
            if done and granule < 0:
                raise OggError(f"page {number} of stream {serial} has no granule position")
            s.packets += done
            # the page's granule position is the end of its last packet
            s.times += [(granule - s.samples * k) / s.rate for k in range(len(done) - 1, -1, -1)]
            s.granule = max(s.granule, granule)
        at = end
    if any(not s.ended for s in streams.values()) or open_:
        raise OggError("a stream has no end")
    return streams


def store(payload: bytes) -> bytes:
    blocks = [payload[i : i + BLOCK] for i in range(0, len(payload), BLOCK)]
    return interleave([write_stream(blocks[k::2], serial) for k, serial in enumerate(SERIALS)])


def load(data: bytes) -> tuple[bytes, dict[int, Stream]]:
    """The payload and the streams it came from."""
    streams = read(data)
    a, b = (streams[s].packets for s in SERIALS)
    out: list[bytes] = [b""] * (len(a) + len(b))
    out[0::2], out[1::2] = a, b
    return b"".join(out), streams


def _features(texts: list[str | None]) -> list:
    rows = []
    for text in C.utf8(texts):
        pad = BLOCK - len(text) if not text else -len(text) % BLOCK
        media = store(text + b"\xff" * pad)
        payload, streams = load(media)
        packets, pages = sum(len(s.packets) for s in streams.values()), sum(s.pages for s in streams.values())
        seconds = max(s.granule / s.rate for s in streams.values())
        feature = f"ogg;streams={len(streams)};pages={pages};packets={packets};granule={'/'.join(str(s.granule) for s in streams.values())};seconds={seconds:.6f}"
        rows.append((len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(streams), pages, packets, seconds))
    return list(zip(*rows, strict=True))


RESULT = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_streams long, n_pages long, n_packets long, seconds double"


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and RESULT; one row per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return C.per_text(src, RESULT, lambda: _features)


def demux(files: DataFrame, id_col: str = "id", data_col: str = "data") -> DataFrame:
    """Packets of stored Ogg files: id, serial, packet, seconds, data."""

    src = files.select(F.col(id_col).alias("id"), F.col(data_col).alias("data"))
    schema = StructType([src.schema["id"], *StructType.fromDDL("serial long, packet long, seconds double, data binary").fields])
    kinds = [f.type for f in to_arrow_schema(schema)][1:]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.batches(source):
            for k in range(b.num_rows):  # a file at a time
                data = b.column("data")[k].as_py()
                if data is None:
                    continue
                got = [(s.serial, n, t, p) for s in read(data).values() for n, (t, p) in enumerate(zip(s.times, s.packets, strict=True))]
                ids = b.column("id").take(pa.array([k] * len(got), pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(zip(*got, strict=True) if got else [[]] * 4, kinds, strict=True)]], names=schema.names)

    return src.mapInArrow(run, schema)
