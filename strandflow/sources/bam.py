"""BAM files: splittable reading, regions by index, and writing.

A BAM file is a row of BGZF blocks (gzip members of at most 64 kB that carry their own size).  A split of the file begins
at its first block whose successor is a block too, and in it at the first place from which record follows record.  A
record belongs to the split in which the block that holds its first byte begins, so every record is read once.  With an
index beside the file (``.bai``) a region reads only the index's chunks for it.
"""

from __future__ import annotations

import bisect
import functools
import io
import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .sequences import ALIGNED, SplitReader, listed, opened, split_clips

_HEAD = struct.Struct("<iiiBBHHHiiii")
_BASES, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
_NUMBERS = {ord(k): struct.Struct(v) for k, v in {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}.items()}
_TEXTS = frozenset(b"ZH")
_LB, _MD, _X0, _X1, _AS, _XS, _PP = b"LB", b"MD", b"X0", b"X1", b"AS", b"XS", b"PP"
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
_MOST = 1 << 16
#: The block without data that ends every file.
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
ROWS = 4096


def block_size(data: bytes, at: int = 0) -> int | None:
    """Size of the BGZF block that begins at ``at``, or None."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or len(data) < at + 18:
        return None
    (extra,) = struct.unpack_from("<H", data, at + 10)
    field, end = at + 12, min(at + 12 + extra, len(data))
    while field + 6 <= end:
        (n,) = struct.unpack_from("<H", data, field + 2)
        if data[field : field + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", data, field + 4)[0] + 1
        field += 4 + n
    return None


def first_block(f, start: int, size: int) -> int:
    """Where the first block at or after ``start`` begins (``size`` if there is none)."""
    f.seek(start)
    data = f.read(3 * _MOST)
    at = data.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        n = block_size(data, at)
        if n and (start + at + n == size or block_size(data, at + n)):
            return start + at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return size


class Stream:
    """The uncompressed bytes of a file from a block on; ``origin(at)`` is the block that holds byte ``at``."""

    def __init__(self, f, start: int):
        self.f, self.next, self.data, self.marks = f, start, b"", []

    def need(self, n: int) -> bool:
        """Make ``n`` bytes available; False if the file has no more."""
        parts, have = [self.data], len(self.data)
        while have < n:
            self.f.seek(self.next)
            head = self.f.read(_MOST)
            size = block_size(head) if head else None
            if size is None:
                break
            data = zlib.decompress(head[18 : size - 8] if head[10:12] == b"\x06\x00" else head[12 + struct.unpack_from("<H", head, 10)[0] : size - 8], -15)
            self.marks.append((have, self.next))
            parts.append(data)
            have, self.next = have + len(data), self.next + size
        self.data = b"".join(parts) if len(parts) > 1 else self.data
        return have >= n

    def place(self, at: int) -> tuple[int, int, int]:
        """The block that holds byte ``at``, and where it begins and ends here."""
        k = bisect.bisect_right(self.marks, at, key=lambda m: m[0]) - 1
        begin, block = self.marks[k]
        return block, begin, self.marks[k + 1][0] if k + 1 < len(self.marks) else len(self.data)

    def origin(self, at: int) -> int:
        return next(c for begin, c in reversed(self.marks) if begin <= at)

    def drop(self, n: int) -> None:
        """Forget the first ``n`` bytes."""
        self.data = self.data[n:]
        keep = max((k for k, (begin, _) in enumerate(self.marks) if begin <= n), default=0)
        self.marks = [(begin - n, c) for begin, c in self.marks[keep:]]


@dataclass
class Header:
    """The head of a file: its bytes, the names of the references, and the block and place in it at which records begin."""

    data: bytes
    names: list[str]
    block: int
    skip: int


def header(f, known: Header | None = None) -> Header:
    """The head of a file; ``known``: another file's, whose names are taken over if the bytes are the same."""
    s = Stream(f, 0)
    if not s.need(8) or s.data[:4] != b"BAM\x01":
        raise ValueError("not a BAM file")
    if known and s.need(len(known.data)) and s.data.startswith(known.data):
        at, names = len(known.data), known.names
    else:
        (n,) = struct.unpack_from("<i", s.data, 4)
        s.need(12 + n)
        (count,) = struct.unpack_from("<i", s.data, 8 + n)
        at, names = 12 + n, []
        for _ in range(count):
            s.need(at + 4)
            (size,) = struct.unpack_from("<i", s.data, at)
            s.need(at + 8 + size)
            names.append(s.data[at + 4 : at + 3 + size].decode())
            at += 8 + size
    data = s.data[:at]
    if not s.need(at + 1):
        return Header(data, names, s.next, 0)
    block = s.origin(at)
    return Header(data, names, block, at - next(b for b, c in s.marks if c == block))


#: The last head that this process read, and the file's path, size and time.
_last: list = [None, None]


def head_of(f, path: str, info) -> Header:
    """The head of a file, kept for the next splits of the file and for files with the same head."""
    key = (path, info.size, info.mtime_ns)
    if _last[0] != key:
        _last[:] = key, header(f, _last[1])
    return _last[1]


def plausible(data: bytes, at: int, refs: int) -> int | None:
    """Where the next record would begin if one began here, or None if none can."""
    if at + 36 > len(data):
        return None
    size, ref, pos, name, _, _, cigar, _, seq, mate, mate_pos, _ = _HEAD.unpack_from(data, at)
    if not (32 <= size < 1 << 28 and -1 <= ref < refs and -1 <= mate < refs and pos >= -1 and mate_pos >= -1 and name > 0 and seq >= 0):
        return None
    if 32 + name + 4 * cigar + (seq + 1) // 2 + seq > size:
        return None
    text = data[at + 36 : at + 36 + name]
    if len(text) == name and (text[-1] or not all(33 <= c <= 126 for c in text[:-1])):
        return None
    return at + 4 + size


def first_record(s: Stream, refs: int) -> int | None:
    """Where records begin in a stream that begins at some block."""
    s.need(4 * _MOST)
    for at in range(len(s.data)):
        place, n = at, 0
        while n < 8 and (following := plausible(s.data, place, refs)) is not None:
            place, n = following, n + 1
            if place >= len(s.data) - 36:
                break
        if n == 8 or (n and place >= len(s.data) - 36):
            return at
    return None


class _Digits(dict):
    """Bases as hexadecimal digits; what is no base becomes no digit."""

    def __missing__(self, key: int) -> str:
        return "?"


_LETTERS = str.maketrans("0123456789abcdef", _BASES)
_HEX = _Digits(str.maketrans(_BASES, "0123456789abcdef"))


@functools.lru_cache(maxsize=1 << 14)
def _cigar(data: bytes) -> str:
    return "".join(f"{c >> 4}{_OPS[c & 15]}" for c in struct.unpack(f"<{len(data) // 4}I", data))


def decode(data: bytes, names: list[str], lib: str) -> tuple | None:
    """The columns of ALIGNED from a record without its size, or None for an unmapped read."""
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, *_ = struct.unpack_from("<iiBBHHHi", data)
    if ref < 0:
        return None
    at = 32 + n_name
    name = data[32 : at - 1].decode()
    cigar = _cigar(data[at : at + 4 * n_cigar])
    at += 4 * n_cigar
    packed = data[at : at + (n_seq + 1) // 2]
    seq = packed.hex().translate(_LETTERS)[:n_seq]
    at += (n_seq + 1) // 2 + n_seq
    tags: dict[bytes, object] = {}
    while at + 3 <= len(data):
        key, kind = data[at : at + 2], data[at + 2]
        at += 3
        if kind in _NUMBERS:
            (tags[key],) = _NUMBERS[kind].unpack_from(data, at)
            at += _NUMBERS[kind].size
        elif kind in _TEXTS:
            end = data.index(0, at)
            tags[key], at = data[at:end].decode(), end + 1
        elif kind == ord("A"):
            tags[key], at = chr(data[at]), at + 1
        elif kind == ord("B"):
            (n,) = struct.unpack_from("<i", data, at + 1)
            at += 5 + n * _NUMBERS[data[at]].size
        else:
            raise ValueError(f"tag {key.decode('latin-1')} of read {name} has the unknown type {chr(kind)}")
    num = lambda k, to: to(tags[k]) if k in tags else None
    return (tags.get(_LB, lib), names[ref], pos, cigar or "*", bool(flag & 16), name, split_clips(cigar, seq) if "S" in cigar else seq, tags.get(_MD), mapq, num(_X0, int), num(_X1, int), num(_AS, int), num(_XS, int), num(_PP, float))


def bins_of(start: int, end: int) -> list[int]:
    """Numbers of the index's bins that can hold alignments over a region: six levels, each 8 times as fine as the last."""
    out, first = [], 0
    for level in range(6):
        shift = 29 - 3 * level
        out += range(first + (start >> shift), first + ((end - 1) >> shift) + 1)
        first += 8**level
    return out


#: Chunks with fewer bytes of the file between them are read as one.
NEAR = 1 << 16
_ZEROS = re.compile(rb"\0*")


def index_chunks(data: bytes, wanted: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Virtual offsets (begin, end) of the index's chunks for all regions (by reference, start and end) at once; chunks that
    overlap or lie near each other are one, so no record is in two."""
    if data[:4] != b"BAI\x01":
        raise ValueError("not a BAM index")
    (refs,) = struct.unpack_from("<i", data, 4)
    at, found, r = 8, [], 0
    while r < refs:
        # a reference without alignments is eight zero bytes
        none = min((_ZEROS.match(data, at).end() - at) // 8, refs - r)
        if none:
            at, r = at + 8 * none, r + none
            continue
        regions, r = wanted.get(r, []), r + 1
        bins = {number for s, e in regions for number in bins_of(s, e)}
        (n,) = struct.unpack_from("<i", data, at)
        at, mine = at + 4, []
        for _ in range(n):
            number, count = struct.unpack_from("<Ii", data, at)
            if number in bins:
                mine += struct.iter_unpack("<QQ", data[at + 8 : at + 8 + 16 * count])
            at += 8 + 16 * count
        (n,) = struct.unpack_from("<i", data, at)
        # alignments that reach the first region begin at or after the linear index's offset
        floor = struct.unpack_from("<Q", data, at + 4 + 8 * min(min(s for s, _ in regions) >> 14, n - 1))[0] if regions and n else 0
        at += 4 + 8 * n
        found += [(max(b, floor), e) for b, e in mine if e > floor]
    out: list[tuple[int, int]] = []
    for b, e in sorted(found):
        if out and (b <= out[-1][1] or (b >> 16) - (out[-1][1] >> 16) < NEAR):
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


class Regions:
    """Regions by chromosome, merged and sorted."""

    def __init__(self, regions: list[tuple[str, int, int]]):
        self.by: dict[str, list[tuple[int, int]]] = {}
        for chrom, s, e in sorted(regions):
            mine = self.by.setdefault(chrom, [])
            if mine and s <= mine[-1][1]:
                mine[-1] = (mine[-1][0], max(e, mine[-1][1]))
            elif s < e:
                mine.append((s, e))

    def reached(self, chrom: str, pos: int, end: int) -> bool:
        mine = self.by.get(chrom, [])
        # the last region that begins before the alignment ends
        k = bisect.bisect_left(mine, (end, -1))
        return k > 0 and mine[k - 1][1] > pos


def parse_region(text: str) -> tuple[str, int, int]:
    """``chrom`` or ``chrom:first-last`` (from 1, both included) to chrom, start, end (from 0, half-open)."""
    m = re.fullmatch(r"(.+):([\d,]+)(?:-([\d,]+))?", text)
    if not m:
        return text, 0, 1 << 29
    return m[1], int(m[2].replace(",", "")) - 1, int(m[3].replace(",", "")) if m[3] else 1 << 29


class _Split(InputPartition):
    """Blocks from ``start`` to ``end``; or virtual offsets from ``start`` and ``skip`` to ``last``.  The head, which may
    list very many references, is read by the task."""

    def __init__(self, path: str, start: int, end: int, skip: int | None = None, last: int | None = None):
        self.path, self.start, self.end, self.skip, self.last = path, start, end, skip, last


class BamReader(SplitReader):
    """Options ``region`` (one) or ``regions`` (several, separated by ``;``): a read is returned once, however many it
    reaches.  With an index all regions of a file are planned at once."""

    def __init__(self, options: dict):
        super().__init__(options)
        texts = [t for t in (options.get("region"), *options.get("regions", "").split(";")) if t]
        self.regions = [parse_region(t) for t in texts] if texts or "regions" in options else None

    def takes_chrom(self) -> bool:
        return super().takes_chrom() and self.regions is None

    def wanted(self) -> Regions | None:
        if self.regions is not None:
            return Regions(self.regions)
        return Regions([(self.chrom, 0, 1 << 29)]) if self.chrom is not None else None

    def partitions(self):
        from pyarrow import fs

        out, regions, head = [], self.wanted(), None
        for path, size in listed(self.path):
            if path.endswith(".bai"):
                continue
            if regions:
                store, at = opened(path)
                with store.open_input_file(at) as f:
                    head = header(f, head)
                asked = {r: regions.by[c] for r, c in enumerate(head.names) if c in regions.by}
                if not asked:
                    continue
                if store.get_file_info(f"{at}.bai").type == fs.FileType.File:
                    with store.open_input_file(f"{at}.bai") as f:
                        chunks = index_chunks(f.read(), asked)
                    out += [_Split(path, b >> 16, size, b & 0xFFFF, e) for b, e in chunks]
                    continue
            out += [_Split(path, s, min(s + self.split, size)) for s in range(0, size, self.split)]
        return out

    def rows(self, part: _Split) -> Iterator[tuple]:
        store, path = opened(part.path)
        info = store.get_file_info(path)
        regions = self.wanted()
        with store.open_input_file(path) as f:
            head = head_of(f, part.path, info)
            start, skip = part.start, part.skip
            if skip is None:
                # a split may end or begin inside the head
                if part.end <= head.block:
                    return
                start, skip = (head.block, head.skip) if start <= head.block else (first_block(f, start, info.size), None)
            if start >= part.end:
                return
            s = Stream(f, start)
            at = skip if skip is not None else first_record(s, len(head.names))
            until = 0
            while at is not None and s.need(at + 4):
                if at >= until:
                    block, begin, until = s.place(at)
                    if block >= part.end:
                        return
                if part.last is not None and (block << 16 | at - begin) >= part.last:
                    return
                (n,) = struct.unpack_from("<i", s.data, at)
                if not s.need(at + 4 + n):
                    raise ValueError(f"{part.path} ends inside a record")
                row = decode(s.data[at + 4 : at + 4 + n], head.names, self.lib)
                at += 4 + n
                if at > 1 << 20:
                    s.drop(at)
                    at = until = 0
                if row and (not regions or regions.reached(row[1], row[2], row[2] + reference_length(row[3]))):
                    yield row

    def read(self, part):
        if part is None:  # a reader without partitions is called once
            return
        rows: list[tuple] = []
        for row in self.rows(part):
            rows.append(row)
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


@functools.lru_cache(maxsize=1 << 14)
def reference_length(cigar: str) -> int:
    return max(1, sum(int(n) for n, op in re.findall(r"(\d+)([MDN=X])", cigar)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=[f.name for f in ALIGNED.fields])


class BamSource(DataSource):
    """``spark.read.format("bam").load(path)``; options lib, region (``chrom:first-last``), regions, splitBytes.  Written
    by ``write_bam``."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> StructType:
        return ALIGNED

    def reader(self, schema: StructType) -> DataSourceReader:
        return BamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return BamWriter(self.options, overwrite)


# ---------------------------------------------------------------------------------------------------------------------
# writing
# ---------------------------------------------------------------------------------------------------------------------
#: Bytes of a block before they are packed: packed, with their frame, they must stay under 64 kB.
BLOCK = 60_000


def _block(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return struct.pack("<4sIBBH2sHH", b"\x1f\x8b\x08\x04", 0, 0, 255, 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


@functools.lru_cache(maxsize=1 << 14)
def _packed_cigar(cigar: str) -> bytes:
    ops = [int(n) << 4 | _OPS.index(op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    return struct.pack(f"<{len(ops)}I", *ops)


def encode(row: dict, ref: int) -> bytes:
    """A record of an alignment (columns of ALIGNED; the query has its soft-clipped ends)."""
    name, cigar, query, pos = row["qname"].encode() + b"\0", _packed_cigar(row["cigar"]), row["query"], row["pos"]
    seq = bytes.fromhex(query.translate(_HEX) + "0" * (len(query) % 2))
    tags = b"".join(k + str(row[c]).encode() + b"\0" for k, c in ((b"MDZ", "md"), (b"LBZ", "lib")) if row.get(c) is not None)
    tags += b"".join(k + struct.pack("<i", row[c]) for k, c in ((b"X0i", "x0"), (b"X1i", "x1"), (b"ASi", "as_"), (b"XSi", "xs")) if row.get(c) is not None)
    tags += b"PPf" + struct.pack("<f", row["pp"]) if row.get("pp") is not None else b""
    number = bin_of(pos, pos + reference_length(row["cigar"]))
    fixed = _HEAD.pack(32 + len(name) + len(cigar) + len(seq) + len(query) + len(tags), ref, pos, len(name), row["mapq"] or 0, number, len(cigar) // 4, 16 * bool(row["is_reverse"]), len(query), -1, -1, 0)
    return b"".join((fixed, name, cigar, seq, b"\xff" * len(query), tags))


def bin_of(start: int, end: int) -> int:
    """The finest of the index's bins that holds an alignment."""
    for level in range(5, 0, -1):
        shift = 29 - 3 * level
        if start >> shift == (end - 1) >> shift:
            return (8**level - 1) // 7 + (start >> shift)
    return 0


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class BamWriter(DataSourceArrowWriter):
    """A BAM file and its index for each partition, whose rows come in order.

    Tasks write to a folder beside the files, under names of their own; the commit moves what finished tasks report, so
    neither a failed job nor a task's second attempt leaves anything that is read.  Option ``refs``: names and lengths.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.refs, self.overwrite = options["path"].rstrip("/"), json.loads(options["refs"]), overwrite
        self.staged = f"{self.path}/_staged-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        rows = (dict(zip(b.schema.names, r, strict=True)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        first = next(rows, None)
        if first is None:
            return _Written([])
        store, folder = opened(self.staged)
        store.create_dir(folder, recursive=True)
        name = f"part-{uuid.uuid4().hex}.bam"
        with store.open_output_stream(f"{folder}/{name}") as f:
            index = write(f, itertools.chain([first], rows), [tuple(r) for r in self.refs])
        with store.open_output_stream(f"{folder}/{name}.bai") as f:
            f.write(index)
        return _Written([name, f"{name}.bai"])

    def commit(self, messages: list[_Written | None]) -> None:
        from pyarrow import fs

        store, folder = opened(self.path)
        store.create_dir(folder, recursive=True)
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(folder)):
                if f.type == fs.FileType.File:
                    store.delete_file(f.path)
        for m in messages:
            for name in m.files if m else []:
                store.move(f"{opened(self.staged)[1]}/{name}", f"{folder}/{name}")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        from pyarrow import fs

        store, folder = opened(self.staged)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def write_bam(rows: DataFrame, path: str, refs: list[tuple[str, int]] | None = None, files: int | None = None) -> None:
    """Alignments (columns of ALIGNED) as a folder of BAM files with indexes, each a range of places; ``files`` of them.

    ``refs``: names and lengths of the references in order, which every BAM file's header lists; else those that occur.
    """
    rows = rows.select(*ALIGNED.names)
    if refs is None:
        length = F.expr("aggregate(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), 0L, (s, x) -> s + CAST(x AS BIGINT))")
        refs = [(r["chrom"], int(r["n"])) for r in rows.groupBy("chrom").agg(F.max(F.col("pos") + length).alias("n")).orderBy("chrom").collect()]
    # one row a reference; a literal list of them would be searched from its start for every read
    place = F.broadcast(rows.sparkSession.createDataFrame([(n, i) for i, (n, _) in enumerate(refs)], "_name string, _place int"))
    order = [F.col("_place"), F.col("pos"), F.col("qname")]
    numbered = rows.join(place, F.col("chrom") == F.col("_name"), "left")
    dealt = numbered.repartitionByRange(files, *order) if files else numbered.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).select(*ALIGNED.names).write.format("bam").option("refs", json.dumps(refs)).mode("overwrite").save(path)


def write(f: io.BufferedIOBase, rows: Iterable[dict], refs: list[tuple[str, int]], block: int = BLOCK) -> bytes:
    """Write sorted alignments as a BAM file; returns its index."""
    text = ("@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in refs)).encode()
    head = b"".join((b"BAM\x01", struct.pack("<i", len(text)), text, struct.pack("<i", len(refs)), *(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in refs)))
    number = {n: i for i, (n, _) in enumerate(refs)}
    # of references that occur: chunks by bin, and the first offset of each window
    bins: dict[int, dict[int, list[tuple[int, int]]]] = {}
    linear: dict[int, dict[int, int]] = {}
    # the head takes as many blocks as it needs
    written, pending = sum(f.write(_block(head[k : k + block])) for k in range(0, len(head), block)), bytearray()

    def here() -> int:
        return written << 16 | len(pending)

    for row in rows:
        ref = number[row["chrom"]]
        data = encode(row, ref)
        at = here()
        pending += data
        while len(pending) >= block:
            written += f.write(_block(bytes(pending[:block])))
            del pending[:block]
        (bin_,) = struct.unpack_from("<H", data, 4 + 10)
        chunks = bins.setdefault(ref, {}).setdefault(bin_, [])
        # records of a bin that follow each other are one chunk
        if chunks and chunks[-1][1] == at:
            chunks[-1] = (chunks[-1][0], here())
        else:
            chunks.append((at, here()))
        windows = linear.setdefault(ref, {})
        for w in range(row["pos"] >> 14, (row["pos"] + reference_length(row["cigar"]) - 1 >> 14) + 1):
            windows.setdefault(w, at)
    if pending:
        f.write(_block(bytes(pending)))
    f.write(END_BLOCK)
    index = [b"BAI\x01" + struct.pack("<i", len(refs))]
    for ref in range(len(refs)):
        own, starts = bins.get(ref, {}), linear.get(ref, {})
        index.append(struct.pack("<i", len(own)))
        for k, chunks in sorted(own.items()):
            index.append(struct.pack("<Ii", k, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
        n = max(starts, default=-1) + 1
        offsets, last = [], 0
        for w in range(n):
            last = starts.get(w, last)
            offsets.append(last)
        index.append(struct.pack(f"<i{n}Q", n, *offsets))
    return b"".join(index)
