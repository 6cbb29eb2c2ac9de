"""Sequence files with an index: regions become byte ranges, so that only the bases asked for are read.

The index of a FASTA file, or of a folder of them, is a table with a row a record: file, file_bytes, chrom, length, offset
(of the first base), width and line_bytes (bases and bytes of a full line).  It is built by tasks over byte ranges and
kept beside the files as ``<path>.index``.  Several species over a chromosome are one file, named by the chromosome, with
a record a species.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.intervals import numbered
from ..scratch import settle
from .sequences import listed, opened

#: Bytes of a file that one row of the scan covers.
SPLIT = 64 << 20
#: Ranges of a file that lie this close are read at once, up to BLOCK bytes.
GAP, BLOCK = 4 << 10, 8 << 20

_PIECE = "file string, split long, at long, chrom string, first long, width long, line_bytes long, bases long, last long, n_lines long, even boolean"


def splits(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(file, file_bytes, split, stop): the byte ranges of the files of a path."""
    files = spark.createDataFrame([(p, n) for p, n in listed(path) if n and not p.rpartition("/")[2].startswith(("_", "."))], "file string, file_bytes long")
    ranges = files.withColumn("split", F.explode(F.expr(f"sequence(0L, file_bytes - 1, {split}L)")))
    ranges = ranges.withColumn("stop", F.least(F.col("split") + split, "file_bytes"))
    # a task for some ranges, whatever the number of files
    return ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "split")


class _Piece:
    """The lines of one record inside one byte range."""

    def __init__(self, at: int, chrom: str | None):
        self.at, self.chrom, self.first, self.width, self.line_bytes = at, chrom, None, 0, 0
        self.bases = self.last = self.n_lines = 0
        self.even = True

    def add(self, at: int, line: bytes) -> None:
        bases = len(line.rstrip())
        if self.first is None:
            self.first, self.width, self.line_bytes = at, bases, len(line)
        else:
            self.even &= self.last == self.width
        self.bases, self.last, self.n_lines = self.bases + bases, bases, self.n_lines + 1


def _pieces(f: io.BufferedReader, start: int, stop: int) -> Iterator[_Piece]:
    f.seek(max(start - 1, 0))
    if start:
        f.readline()
    piece = _Piece(start, None)
    while (at := f.tell()) < stop:
        line = f.readline()
        if line.startswith(b">"):
            yield piece
            name = line[1:].split()
            piece = _Piece(at, name[0].decode() if name else "")
        elif line.strip():
            piece.add(at, line)
        else:
            # a blank line may only end a record
            piece.last = -1
    yield piece


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for file, start, stop in zip(pdf["file"], pdf["split"].tolist(), pdf["stop"].tolist(), strict=True):
            store, path = opened(file)
            with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as f:
                out = [(file, start, p.at, p.chrom, p.first, p.width, p.line_bytes, p.bases, p.last, p.n_lines, p.even) for p in _pieces(f, start, stop) if p.chrom is not None or p.n_lines]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PIECE.split(", ")]).astype({"first": "Int64"})


def index_fasta(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The index of a FASTA file or a folder of them.  The name of a record is the first word of its header; a record without
    bases has no row.  Fails where a record's lines differ in length, the last one aside: it has no byte ranges."""
    ranges = splits(spark, path, split)
    pieces = settle(ranges.select("file", "split", "stop").mapInPandas(_scan, _PIECE), "pieces")
    # lines before a range's first header belong to the last header of the ranges before it: a row a range
    heads = pieces.where("chrom IS NOT NULL").groupBy("file", "split").agg(F.max("at").alias("head"))
    by_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    held = ranges.select("file", "split", "file_bytes").join(heads, ["file", "split"], "left").withColumn("before", F.last("head", True).over(by_file))
    owned = pieces.join(held.select("file", "split", "file_bytes", "before"), ["file", "split"]).withColumn("record", F.when(F.col("chrom").isNotNull(), F.col("at")).otherwise(F.col("before")))
    # a record has a piece a range that it lies in
    rows = F.array_sort(F.collect_list(F.when(F.col("n_lines") > 0, F.struct("first", "width", "line_bytes", "last", "n_lines", "even"))))
    recs = owned.where("record IS NOT NULL").groupBy("file", "file_bytes", "record").agg(F.max("chrom").alias("chrom"), F.sum("bases").alias("length"), rows.alias("p")).where("length > 0")
    recs = recs.select("*", F.col("p")[0]["width"].alias("width"), F.col("p")[0]["line_bytes"].alias("line_bytes"), F.element_at("p", -1).alias("end"))
    full = F.forall(F.slice("p", 1, F.size("p") - 1), lambda x: x["even"] & (x["width"] == F.col("width")) & (x["last"] == F.col("width")) & (x["line_bytes"] == F.col("line_bytes")))
    tail = F.col("end.even") & (F.col("end.last") <= F.col("width")) & ((F.col("end.width") == F.col("width")) | (F.col("end.n_lines") == 1))
    bad = F.raise_error(F.concat(F.lit("lines of different lengths in record "), F.col("chrom"), F.lit(" of "), F.col("file"))).cast("long")
    return recs.select("file", "file_bytes", "chrom", F.when(full & tail, F.col("length")).otherwise(bad).alias("length"), F.col("p")[0]["first"].alias("offset"), "width", "line_bytes")


def indexed(spark: SparkSession, path: str) -> DataFrame:
    """The index beside a path; built and written if there is none, or if the files' sizes are not those it was made of."""
    side = f"{path.rstrip('/')}.index"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(side + "/_SUCCESS")
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        index = spark.read.parquet(side)
        sizes = spark.createDataFrame(listed(path), "file string, _now long")
        if index.select("file", "file_bytes").distinct().join(sizes, "file", "left").where("_now IS NULL OR _now <> file_bytes").isEmpty():
            return index
    index_fasta(spark, path).write.mode("overwrite").parquet(side)
    return spark.read.parquet(side)


def stitched(index: DataFrame) -> DataFrame:
    """The index of aligned species: chrom from the file's name, up to its first dot; species from the record's name, up to
    ``.chr``."""
    name = F.regexp_extract("file", r"([^/.]+)[^/]*$", 1)
    return index.withColumn("species", F.regexp_replace("chrom", r"\.chr.*$", "")).withColumn("chrom", name)


def _blocks(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(rows, end): how many of the next sorted ranges are read at once, and the end of what is read."""
    i = 0
    while i < len(ranges):
        start, end = ranges[i]
        j = i + 1
        while j < len(ranges) and ranges[j][0] <= end + GAP and max(end, ranges[j][1]) - start <= BLOCK:
            end, j = max(end, ranges[j][1]), j + 1
        yield j - i, end
        i = j


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for file, rows in pdf.groupby("file", sort=False):
            store, path = opened(file)
            spans = list(zip(rows["lo"].tolist(), rows["hi"].tolist(), strict=True))
            with store.open_input_file(path) as f:
                i = 0
                for n, end in _blocks(spans):
                    start = spans[i][0]
                    data = f.read_at(end - start, start)
                    cut = [data[a - start : b - start].decode().replace("\n", "").replace("\r", "") for a, b in spans[i : i + n]]
                    part = rows.iloc[i : i + n]
                    yield pd.DataFrame({"_r": part["_r"], "_k": part["_k"], "_seq": cut, "_bytes": [len(data)] + [0] * (n - 1)})
                    i += n


def _ranges(regions: DataFrame, index: DataFrame, extra: list[str]) -> DataFrame:
    """Regions (with _r) and their records' byte ranges lo to hi; the range is empty where nothing of the record is asked."""
    hit = regions.join(index.select("chrom", *extra, "file", "length", "offset", "width", "line_bytes"), "chrom", "left")
    first, last = F.greatest(F.col("start"), F.lit(0)), F.least(F.col("end"), "length") - 1
    at = lambda p: F.col("offset") + F.floor(p / F.col("width")) * F.col("line_bytes") + p % F.col("width")
    inside = F.coalesce(last >= first, F.lit(False))
    return hit.withColumns({"lo": F.when(inside, at(first)), "hi": F.when(inside, at(last) + 1), "_k": F.xxhash64("file", "offset")})


def read_ranges(ranges: DataFrame) -> DataFrame:
    """(_r, _k, _seq, _bytes) of byte ranges (_r, _k, file, lo, hi): bases, and bytes read.  Ranges are dealt by place, so a
    task reads a stretch of a file in order, whatever the share of one chromosome."""
    dealt = ranges.where("lo IS NOT NULL").select("_r", "_k", "file", "lo", "hi").repartitionByRange("file", "lo", "_r").sortWithinPartitions("file", "lo", "hi")
    return dealt.mapInPandas(_read, "_r long, _k long, _seq string, _bytes long")


def indexed_slices(regions: DataFrame, index: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Adds seq to regions (chrom, start, end): their bases, N outside the sequence or where it is unknown.

    ``extra``: further columns of ``index`` (species); a region then has a row for each record of its chromosome.
    """
    extra = extra or []
    ranges = settle(_ranges(numbered(regions, "_r"), index, extra), "ranges")
    got = read_ranges(ranges).select("_r", "_k", "_seq")
    out = ranges.join(got, ["_r", "_k"], "left")
    n = F.greatest(F.col("end") - F.col("start"), F.lit(0)).cast("int")
    left = F.repeat(F.lit("N"), F.least(F.greatest(-F.col("start"), F.lit(0)), n).cast("int"))
    return out.select(*regions.columns, *extra, F.rpad(F.concat(left, F.coalesce("_seq", F.lit(""))), n, "N").alias("seq"))


def indexed_alignment(regions: DataFrame, index: DataFrame, species: list[str] | None = None, offset: int = 0) -> DataFrame:
    """Regions with species and seq of all (chosen) species, from the index of stitched files; gaps read as N.

    Bases are those at start + offset to end + offset; N only, if the offset moves a region below 0.
    """
    index = index.where(F.col("species").isin(species)) if species else index
    moved = regions.withColumns({"start": F.col("start") + offset, "end": F.col("end") + offset})
    out = indexed_slices(moved, index, ["species"])
    below = F.least("start", "end") < 0
    seq = F.when(below & (F.col("start") >= offset), F.repeat(F.lit("N"), F.length("seq"))).otherwise(F.translate("seq", "-", "N"))
    return out.withColumn("seq", seq).withColumns({"start": F.col("start") - offset, "end": F.col("end") - offset})
