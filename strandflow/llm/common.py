"""Helpers shared by the training-data operators: shared-folder tables, batching and vectorised text hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..scratch import Scratch, remove, shared_dir  # noqa: F401 - used through this module

#: Text bytes that one vectorised hashing step takes (a longer document is a step of its own).
CHUNK_BYTES = 600_000
#: Text bytes that are taken out of an Arrow batch at a time (a longer document is a slice of its own).
SLICE_BYTES = 1_500_000


# ---------------------------------------------------------------------------------------------------------------------
# tables
# ---------------------------------------------------------------------------------------------------------------------
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``, is 0."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def sized(items: Iterable[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose total size is about ``limit``."""
    start = total = n = 0
    for n, item in enumerate(items, 1):
        total += len(item)
        if total >= limit:
            yield start, n
            start, total = n, 0
    if start < n:
        yield start, n


def utf8(texts) -> list[bytes]:
    """UTF-8 of each text; null is empty.  Lone surrogates cannot occur in Spark strings."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


try:
    _malloc_trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not glibc
    _malloc_trim = None


def batches(source: Iterator) -> Iterator:
    """The batches as they come; memory that one has freed goes back to the system before the next, since workers are reused."""
    for b in source:
        yield b
        if _malloc_trim:
            _malloc_trim(0)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive parts of about ``limit`` text bytes, without copying."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    step = (np.cumsum(size, dtype=np.int64) - size) // limit
    cuts = np.flatnonzero(np.diff(step)) + 1 if len(step) else np.zeros(0, int)
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        if e > s:
            yield batch.slice(s, e - s)


def per_text(src: DataFrame, fields: str, make, limit: int = SLICE_BYTES) -> DataFrame:
    """``src`` without its column ``text`` and with ``fields`` computed from it, one row per row.

    ``make()`` is called once a task; what it returns gets the texts of a slice (None for null) and gives a column of
    values for each field.  The other columns stay Arrow data from end to end, so ids keep type, value and null.
    """
    rest = [c for c in src.columns if c != "text"]
    added = StructType.fromDDL(fields)
    kinds = [f.type for f in to_arrow_schema(added)]
    schema = StructType([src.schema[c] for c in rest] + added.fields)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for b in batches(source):
            for part in slices(b, limit=limit):
                made = judge(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *[pa.array(v, k) for v, k in zip(made, kinds, strict=True)]], names=schema.names)

    return src.select(*rest, "text").mapInArrow(run, schema)


def filter_rows(docs: DataFrame, text_col: str, make) -> DataFrame:
    """Rows for which the function that ``make()`` returns (texts as UTF-8 -> flags) holds, every column as it is."""

    def run(source):
        decide = make()
        for b in batches(source):
            keep = [np.asarray(decide(utf8(p.column(text_col).to_pylist())), bool) for p in slices(b, text_col)]
            yield b.filter(pa.array(np.concatenate(keep))) if keep else b

    return docs.mapInArrow(run, docs.schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores after it until no column of ``df`` is called so in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


# ---------------------------------------------------------------------------------------------------------------------
# hashing
# ---------------------------------------------------------------------------------------------------------------------
def _random_u64(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64)


BYTE_CODE = _random_u64(256, 11) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BYTE_CODE_LOWER = BYTE_CODE[_LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n; kept between calls up to the length of a hashing step, so that one very long text
    leaves nothing behind."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    out = []
    for b in (BASE, BASE_INV):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    if n <= 2 * CHUNK_BYTES:
        _powers[:] = out
    return out[0], out[1]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """P with P[0] = 0 and P[i+1] = P[i] + codes[i] * BASE**i; see span_hash."""
    out = np.empty(len(codes) + 1, np.uint64)
    out[0] = 0
    np.cumsum(codes * powers(len(codes) + 1)[0][: len(codes)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end], whatever its place."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def byte_class(members: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Words of benchmark matching: digits, letters and every non-ASCII character.
ALNUM_WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)])
#: Words of near-duplicate matching: whatever lies between ASCII white space.
SPACE_WORD = ~byte_class([0x20, *range(0x09, 0x0E)])


def hash_words(texts: list[bytes], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes (never 0) of the lower-cased words of all texts, and the offsets of each text's words among them."""
    joined = b" ".join(texts) + b" "
    buf = np.frombuffer(joined, np.uint8)
    edge = np.diff(word[buf].view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = prefix_hash(BYTE_CODE_LOWER[buf])
    hashes = mix(span_hash(prefix, starts, ends) + (ends - starts).astype(np.uint64)) | np.uint64(1)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, bounds)
