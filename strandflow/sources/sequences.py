"""Readers of sequences, alignments, wiggle and statistics blocks."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition
from pyspark.sql.types import StructType

from ..operators.reads import fastq_records
from ..schemas import ALIGNMENT
from ..scratch import settle
from .flat import numbered_lines


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """record, name, seq, qual; blank lines do not count."""
    return fastq_records(numbered_lines(spark, path))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id and seq; # lines are skipped, a header without data gives nothing."""
    text = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    text = text.select(F.regexp_replace("value", r"^>", "").alias("v"))
    head = F.substring_index("v", "\n", 1)
    body = F.expr("substring(v, length(substring_index(v, '\n', 1)) + 2)")
    seq = F.regexp_replace(F.regexp_replace(body, r"(?m)^#.*$", ""), r"\s", "")
    return text.select(F.trim(head).alias("id"), seq.alias("seq")).where((F.col("seq") != "") & ~F.col("id").startswith("#"))


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """value and its place: file, split (byte where the file's split begins) and line_no, which rises inside a split."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line_no"))


def ordinals(lines: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows of split_lines, or some of them, numbered from 0 in the order of their files (written parts by their number)
    without gaps.  Rows are counted inside their splits; what earlier splits hold is carried over a table of one row each."""
    lines = settle(lines, "lines")
    part = F.regexp_extract("file", r"part-(\d+)", 1).try_cast("long")
    held = lines.groupBy("file", "split").agg(F.count("*").alias("_n"))
    before = Window.orderBy(part, "file", "split").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col("file").alias("_f"), F.col("split").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("file", "split").orderBy("line_no")) - 1
    out = lines.withColumn("_own", own).join(held, (F.col("file") == F.col("_f")) & (F.col("split") == F.col("_s")))
    return out.select(*lines.columns, (F.col("_own") + F.col("_before")).alias(name))


def data_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of data (not blank, no # lines) of a file or folder: value and ordinal."""
    lines = split_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return ordinals(lines).select("value", "ordinal")


def by_place(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Lines of two files that stand at the same place, counting lines of data only: ordinal, left, right.  Lines beyond the
    shorter file's end have no partner and get null."""
    a, b = data_lines(spark, left), data_lines(spark, right)
    return a.withColumnRenamed("value", "left").join(b.withColumnRenamed("value", "right"), "ordinal", "full").select("ordinal", "left", "right")


def blocks(lines: DataFrame, is_head) -> DataFrame:
    """Body lines with block (their head line's place) and head (the block's head line); lines before any head go.

    The head of a line is the last one before it in its split of the file, else the last one of the splits before: a
    table of one row a split.
    """
    heads = lines.withColumn("_h", F.when(is_head(F.col("value")), F.struct(F.col("split").alias("split"), F.col("line_no").alias("line_no"), F.col("value").alias("head"))))
    last = heads.groupBy("file", "split").agg(F.max("_h").alias("_v"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(F.col("file").alias("_f"), F.col("split").alias("_s"), F.last("_v", ignorenulls=True).over(before).alias("_carry"))
    w = Window.partitionBy("file", "split").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    out = heads.withColumn("_own", F.last("_h", ignorenulls=True).over(w)).join(carry, (F.col("file") == F.col("_f")) & (F.col("split") == F.col("_s")))
    out = out.withColumn("_b", F.coalesce("_own", "_carry")).where(F.col("_h").isNull() & F.col("_b").isNotNull())
    return out.select("value", "file", "split", "line_no", F.struct(F.col("file"), F.col("_b.split").alias("split"), F.col("_b.line_no").alias("line_no")).alias("block"), F.col("_b.head").alias("head"))


def read_wiggle(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-step wiggle as positions: chrom, pos (0-based), score; a score is repeated ``step`` times."""
    lines = split_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("track"))
    body = settle(blocks(lines, lambda c: c.startswith("fixedStep")), "wiggle")
    field = lambda k, d: F.coalesce(F.regexp_extract("head", rf"\b{k}=(\S+)", 1).try_cast("long"), F.lit(d))
    # a block's lines are numbered inside their split; earlier splits' shares of the block come before
    part = Window.partitionBy("block", "split").orderBy("line_no")
    held = body.groupBy(F.col("block").alias("_b"), F.col("split").alias("_s")).agg(F.count("*").alias("_n"))
    held = held.select("_b", "_s", F.coalesce(F.sum("_n").over(Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    body = body.withColumn("_i", F.row_number().over(part) - 1).join(held, (F.col("block") == F.col("_b")) & (F.col("split") == F.col("_s")))
    step = field("step", 1)
    rows = body.select(F.regexp_extract("head", r"\bchrom=(\S+)", 1).alias("chrom"), (field("start", 1) - 1 + (F.col("_i") + F.col("_before")) * step).alias("first"), step.alias("step"), F.col("value").try_cast("double").alias("score"))
    return rows.select("chrom", F.explode(F.expr("sequence(first, first + step - 1)")).alias("pos"), "score")


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Statistics blocks as a long table: title, key, label, value, options."""
    lines = split_lines(spark, path).where(F.trim("value") != "")
    body = settle(blocks(lines, lambda c: c.startswith(">")), "statistics")
    last = lambda cond, x: F.max(F.when(cond, x))
    heads = body.groupBy("block").agg(last(F.col("value").startswith("#") & ~F.col("value").startswith("##"), F.col("value")).alias("labels"), last(F.col("value").startswith("##"), F.col("value")).alias("options"))
    rows = body.where(~F.col("value").startswith("#")).join(heads, "block")
    labels = F.split(F.substring("labels", 2, 1 << 20), "\t")
    cells = F.split("value", "\t")
    rows = rows.select(F.trim(F.substring("head", 2, 1 << 20)).alias("title"), F.get(cells, 0).alias("key"), labels.alias("l"), F.trim(F.regexp_replace(F.coalesce("options", F.lit("")), "^##", "")).alias("options"), F.posexplode(F.slice(cells, 2, 1 << 20)).alias("i", "v"))
    return rows.select("title", "key", F.trim(F.try_element_at("l", F.col("i") + 2)).alias("label"), F.col("v").try_cast("double").alias("value"), "options")


# ---------------------------------------------------------------------------------------------------------------------
# alignments
# ---------------------------------------------------------------------------------------------------------------------
def split_clips(cigar: str, query: str) -> str:
    """The query without soft-clipped ends."""
    lead, trail = re.match(r"(?:\d+H)?(\d+)S", cigar), re.search(r"(\d+)S(?:\d+H)?$", cigar)
    end = len(query) - (int(trail[1]) if trail else 0)
    return query[int(lead[1]) if lead else 0 : end]


def parse_sam_line(line: str, lib: str) -> tuple | None:
    """The columns of ALIGNED, or None for an unmapped read."""
    f = line.rstrip("\n").split("\t")
    if len(f) < 11 or f[2] == "*":
        return None
    tags = {t[:2]: t[5:] for t in f[11:] if len(t) > 5}
    num = lambda k, kind: kind(tags[k]) if k in tags else None
    return (tags.get("LB", lib), f[2], int(f[3]) - 1, f[5], bool(int(f[1]) & 16), f[0], split_clips(f[5], f[9]), tags.get("MD"), int(f[4]), num("X0", int), num("X1", int), num("AS", int), num("XS", int), num("PP", float))


#: Alignments as readers give them: without tid, which a part of a file cannot know (see with_tids).
ALIGNED = StructType([f for f in ALIGNMENT.fields if f.name != "tid"])


class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class SplitReader(DataSourceReader):
    """Splits each file by byte ranges; a chromosome given as a filter or option is applied while reading.

    Files are opened through pyarrow's file systems: local paths, and URIs of the stores that these know.
    """

    def __init__(self, options: dict):
        self.path, self.lib = options["path"], options.get("lib", "lib")
        self.split, self.chrom = int(options.get("splitBytes", 64 << 20)), options.get("chrom")

    def pushFilters(self, filters):
        for f in filters:
            # a second condition on the chromosome is left to Spark
            if isinstance(f, EqualTo) and f.attribute == ("chrom",) and self.takes_chrom():
                self.chrom = f.value
            else:
                yield f

    def takes_chrom(self) -> bool:
        return self.chrom is None

    def partitions(self):
        return [_Part(p, s, min(s + self.split, n)) for p, n in listed(self.path) for s in range(0, max(n, 1), self.split)]


def opened(path: str):
    """The file system and path of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int]]:
    """Files (and their sizes) of a path, a folder or a pattern over the names of one folder."""
    from fnmatch import fnmatch

    from pyarrow import fs

    store, at = opened(path)
    head = path[: len(path) - len(at)] if path.endswith(at) else ""
    folder, _, name = at.rpartition("/")
    if any(c in name for c in "*?["):
        found = [f for f in store.get_file_info(fs.FileSelector(folder)) if fnmatch(f.base_name, name)]
    else:
        info = store.get_file_info(at)
        found = store.get_file_info(fs.FileSelector(at)) if info.type == fs.FileType.Directory else [info]
    return sorted((head + f.path, f.size) for f in found if f.type == fs.FileType.File)


class SamReader(SplitReader):
    def read(self, part):
        if part is None:  # a reader without partitions is called once
            return
        store, path = opened(part.path)
        with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as f:
            f.seek(max(part.start - 1, 0))
            if part.start:
                f.readline()
            while f.tell() < part.end:
                line = f.readline()
                if not line:
                    break
                if line.startswith(b"@"):
                    continue
                row = parse_sam_line(line.decode(), self.lib)
                if row and (self.chrom is None or row[1] == self.chrom):
                    yield row


class SamSource(DataSource):
    """``spark.read.format("sam").option("lib", ...).load(path)`` over SAM text."""

    @classmethod
    def name(cls) -> str:
        return "sam"

    def schema(self) -> StructType:
        return ALIGNED

    def reader(self, schema: StructType) -> DataSourceReader:
        return SamReader(self.options)


def register(spark: SparkSession) -> None:
    from .bam import BamSource

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SamSource)
    spark.dataSource.register(BamSource)


def with_tids(rows: DataFrame, chroms: list[str] | None = None) -> DataFrame:
    """Adds tid: the place of the chromosome in ``chroms``, else among the sorted names that occur."""
    if chroms:
        tid = F.array_position(F.array(*[F.lit(c) for c in chroms]), F.col("chrom")).cast("int") - 1
        return rows.withColumn("tid", tid).select(*[c.name for c in ALIGNMENT])
    names = rows.select("chrom").distinct()
    # one row a chromosome
    ids = names.select(F.col("chrom").alias("_c"), (F.row_number().over(Window.orderBy("chrom")) - 1).alias("tid"))
    return rows.join(F.broadcast(ids), F.col("chrom") == F.col("_c")).select(*[c.name for c in ALIGNMENT])


def alignments(spark: SparkSession, path: str, lib: str = "lib", chroms: list[str] | None = None) -> DataFrame:
    """SAM text through Spark's own reader: works on every store; ``chroms`` gives the order of chromosomes (else by name)."""
    # lines are chosen by their text: a filter of the cells would cut each line again
    chrom = F.substring_index(F.substring_index("value", "\t", 3), "\t", -1)
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.substring_index("value", "\t", 10) != F.col("value")) & (chrom != "*"))
    rows = rows.select(chrom.alias("chrom"), F.split("value", "\t").alias("f")).select("*", F.slice("f", 12, 1 << 20).alias("t"))
    rows = rows.select("*", F.transform("t", lambda t: F.substring(t, 1, 3)).alias("k"))
    tag = lambda k: F.substring(F.get("t", F.array_position("k", f"{k}:").cast("int") - 1), 6, 1 << 20)
    f = lambda i: F.get("f", i)
    clip = lambda pattern: F.when(f(5).contains("S"), F.coalesce(F.regexp_extract(f(5), pattern, 1).try_cast("int"), F.lit(0))).otherwise(0)
    lead, trail = clip(r"^(?:\d+H)?(\d+)S"), clip(r"(\d+)S(?:\d+H)?$")
    query = F.substring(f(9), lead + 1, F.length(f(9)) - lead - trail)
    out = rows.select(F.coalesce(tag("LB"), F.lit(lib)).alias("lib"), "chrom", (f(3).cast("long") - 1).alias("pos"), f(5).alias("cigar"), (f(1).cast("int").bitwiseAND(16) != 0).alias("is_reverse"), f(0).alias("qname"), query.alias("query"), tag("MD").alias("md"), f(4).cast("int").alias("mapq"), tag("X0").cast("int").alias("x0"), tag("X1").cast("int").alias("x1"), tag("AS").cast("int").alias("as_"), tag("XS").cast("int").alias("xs"), tag("PP").cast("double").alias("pp"))
    return with_tids(out, chroms)


def records(lines: Iterator[str]) -> Iterator[tuple[str, str]]:
    """FASTA records of an iterator of lines, for small inputs on the driver."""
    name, seq = None, []
    for line in lines:
        line = line.strip()
        if line.startswith("#"):
            continue
        if line.startswith(">"):
            if name is not None and seq:
                yield name, "".join(seq)
            name, seq = line[1:].strip(), []
        elif line:
            seq.append(line)
    if name is not None and seq:
        yield name, "".join(seq)
