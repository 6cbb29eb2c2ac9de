"""Flat-file readers: typed headers, name headers, lists in cells, keyed tables, GFF, gene tables, sizes, pair counts."""

from __future__ import annotations

import itertools
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import attributes, make_list
from ..schemas import GFF, UCSC_GENE

#: Cell kinds of typed headers and the Spark types that they become.
KINDS = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean", "intlist": "array<bigint>", "floatlist": "array<double>", "strlist": "array<string>"}
_LISTS = {"intlist": "bigint", "floatlist": "double", "strlist": "string"}


def parse_description(text: str) -> list[tuple[str, str]] | None:
    """``## name:kind\\tname:kind`` to pairs; None if it is malformed."""
    cells = [c.strip() for c in text.lstrip("#").strip().split("\t") if c.strip()]
    out = []
    for c in cells:
        name, _, kind = c.partition(":")
        if kind not in KINDS:
            return None
        out.append((name, kind))
    return out or None


def clean_name(name: str) -> str:
    """A column name from a header cell."""
    name = re.sub(r"[()\[\].]", "", name.strip())
    return re.sub(r"[ /\-]", "_", name).replace("+", "plus").replace("%", "percent")


def cast(cell: Column, kind: str) -> Column:
    if kind in _LISTS:
        return make_list(cell, _LISTS[kind])
    if kind == "bool":
        return cell == "True"
    if kind == "str":
        return F.trim(cell)
    return F.trim(cell).try_cast(KINDS[kind])


def _failed(value: Column, kind: str) -> Column:
    """Whether a cell, or one of a list's, could not be cast."""
    return value.isNull() | F.coalesce(F.exists(value, lambda x: x.isNull()), F.lit(False)) if kind in _LISTS else value.isNull()


def _files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(URI, path, bytes) of the files that the text reader reads, in order: written parts by their number.  Contents are not read."""
    rows = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("uri"), "path", "length").collect()
    part = lambda r: int((re.search(r"part-(\d+)", r["path"].rpartition("/")[2]) or [0, -1])[1])
    return [tuple(r) for r in sorted(rows, key=lambda r: (part(r), r["path"]))]


def _bytes(text: str) -> int:
    """A size as settings give it: ``134217728b``, ``64MB``, ``4096``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


#: Rows of a task that a line number has room for (as monotonically_increasing_id).
_TASK_ROWS = 1 << 33


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value and line_no (rising in file order; not without gaps).

    The reader deals splits of files to its tasks by their size, so a task's number says nothing about the place of its
    lines: a split's place comes from its file's and from the byte at which it begins.
    """
    # no split is shorter, but for a file's last one
    unit = max(1, min(_bytes(spark.conf.get(f"spark.sql.files.{k}")) for k in ("maxPartitionBytes", "openCostInBytes")))
    firsts, at = [], 0
    for uri, _, size in _files(spark, path):
        firsts.append((uri, at))
        at += size // unit + 1
    # one row a file
    places = F.broadcast(spark.createDataFrame(firsts, "_uri string, _first long"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_uri"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_i"))
    place = F.col("_first") + F.floor(F.col("_at") / unit)
    return lines.join(places, "_uri").select("value", (place * _TASK_ROWS + F.col("_i") % _TASK_ROWS).alias("line_no"))


def header_of(spark: SparkSession, path: str, lines: int = 1000) -> list[str]:
    """The # lines before the first line of data of a file or folder; only the beginning is read."""
    out: list[str] = []
    for _, file, _ in _files(spark, path):
        while True:
            first = [r["value"] for r in spark.read.text(file).limit(lines).collect()]
            head = list(itertools.takewhile(lambda x: x.startswith("#") or not x.strip(), first))
            if len(head) < len(first) or len(first) < lines:
                break
            lines *= 10
        out += [x for x in head if x.strip()]
        if len(head) < len(first):
            break
    return out


def read_flat(spark: SparkSession, path: str, description: str | None = None, hints: dict[str, str] | None = None, renames: dict[str, str] | None = None, default: str = "str", skip: list[int] | None = None, sep: str = "\t", skip_broken: bool = True, keep_line: bool = False, broken_value: bool = False, counts: Observation | None = None) -> DataFrame:
    """A flat file as a typed table.

    The schema comes from ``description`` or the first ``## name:kind`` line; else from the first ``#name`` line with
    kinds from ``hints``; else from the first data line (``guess``).  Blank and # lines are skipped, ``skip`` drops cells
    by index, rows with too few or too many cells or failed casts are dropped, or (broken_value) get -1 and empty lists;
    keep_line adds the whole line.  ``counts``: filled by the action that computes the table, in the same pass: lines,
    broken (rows with a wrong number of cells or a failed cast), first_broken and last_broken (line_no and line).
    """
    heads = header_of(spark, path)
    pairs = parse_description(description) if description else None
    for h in heads:
        pairs = pairs or (parse_description(h) if h.startswith("##") else None)
    if not pairs:
        names = next((h for h in heads if not h.startswith("##")), None)
        hints = hints or {}
        if names:
            cols = [clean_name(c) for c in names[1:].rstrip("\n").split(sep)]
            cols = [(renames or {}).get(c, c) for c in cols]
            pairs = [(c, hints.get(c, default)) for c in cols]
    body = numbered_lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumnRenamed("value", "_line")
    cells = F.split("_line", re.escape(sep), -1)
    for i in sorted(skip or [], reverse=True):
        cells = F.concat(F.slice(cells, 1, i), F.slice(cells, i + 2, 1 << 20))
    if not pairs:
        first = body.orderBy("line_no").limit(1).select(cells.alias("c")).first()
        pairs = [(f"c{i}", guess(x)) for i, x in enumerate(first["c"])] if first else []
    body = body.select("line_no", "_line", cells.alias("_c"))
    if counts is not None:
        failed = [_failed(cast(F.get("_c", i), k), k) for i, (_, k) in enumerate(pairs)]
        line = F.when(reduce(Column.__or__, failed, F.size("_c") != len(pairs)), F.struct("line_no", F.col("_line").alias("line")))
        body = body.observe(counts, F.count(F.lit(1)).alias("lines"), F.count(line).alias("broken"), F.min(line).alias("first_broken"), F.max(line).alias("last_broken"))
    typed = body.where(F.size("_c") == len(pairs))
    out = typed.select("line_no", "_line", "_c", *[cast(F.get("_c", i), k).alias(n) for i, (n, k) in enumerate(pairs)])
    for i, (n, k) in enumerate(pairs):
        bad = _failed(F.col(n), k)
        if broken_value:
            empty = F.array().cast(KINDS[k]) if k in _LISTS else F.lit("" if k == "str" else False if k == "bool" else -1).cast(KINDS[k])
            out = out.withColumn(n, F.when(bad, empty).otherwise(F.col(n)))
        elif skip_broken:
            out = out.where(~bad)
    return out.select(*[n for n, _ in pairs], *([F.col("_line").alias("line")] if keep_line else []), "line_no")


def guess(cell: str) -> str:
    """The first of int, float, intlist, floatlist that the cell parses as; else str."""
    def ok(f, x) -> bool:
        try:
            f(x)
        except ValueError:
            return False
        return True

    parts = [p for p in cell.replace(";", ",").rstrip(",").split(",")]
    for kind, f, xs in (("int", int, [cell]), ("float", float, [cell]), ("intlist", int, parts), ("floatlist", float, parts)):
        if all(ok(f, x) for x in xs):
            return kind
    return "str"


def keyed(df: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    """One row per key, the last one."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def read_gff(spark: SparkSession, path: str, fix_chr: bool = True) -> DataFrame:
    """GFF rows and line_no; start stays 1-based."""
    kinds = {"LongType()": "int"}
    text = "## " + "\t".join(f"{f.name}:{kinds.get(str(f.dataType), 'str')}" for f in GFF.fields)
    out = read_flat(spark, path, text)
    return out.withColumn("chrom", F.when(F.col("chrom").startswith("chr"), F.col("chrom")).otherwise(F.concat(F.lit("chr"), "chrom"))) if fix_chr else out


def gff_loci(gff: DataFrame, prefix: str = "transcript/noncoding") -> DataFrame:
    """Loci of GFF rows; the name is the attribute Name, ID, name or transcript_id, else the attributes as they are."""
    a = attributes(F.col("attr_str"))
    name = F.coalesce(*[F.try_element_at(a, F.lit(k)) for k in ("Name", "ID", "name", "transcript_id")], F.col("attr_str"))
    return gff.select("chrom", "sense", (F.col("start") - 1).alias("start"), "end", F.concat_ws("/", F.lit(prefix), "type").alias("path"), name.alias("name"))


def gff_prefix(file_name: str) -> str:
    """A file name's dots as slashes, without the last two parts."""
    return "/".join(file_name.split(".")[:-2])


_GENE_HINTS = {"txStart": "int", "txEnd": "int", "cdsStart": "int", "cdsEnd": "int", "exonCount": "int", "exonStarts": "intlist", "exonEnds": "intlist", "exonFrames": "intlist", "bin": "int"}
_GENE_COLUMNS = ["strand" if f.name == "sense" else f.name for f in UCSC_GENE.fields]


def read_genes(spark: SparkSession, path: str, fix_chr: bool = True) -> DataFrame:
    """A gene table; its # header names the columns, else the usual sixteen; strand becomes sense."""
    names = next((h for h in header_of(spark, path) if not h.startswith("##")), None)
    cols = names[1:].split("\t") if names else _GENE_COLUMNS
    out = read_flat(spark, path, "## " + "\t".join(f"{c}:{_GENE_HINTS.get(c, 'str')}" for c in map(clean_name, cols)))
    out = out.withColumnRenamed("strand", "sense").withColumnRenamed("proteinID", "id")
    for c in ("id", "name2"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.withColumn("chrom", F.when(F.col("chrom").startswith("chr"), F.col("chrom")).otherwise(F.concat(F.lit("chr"), "chrom"))) if fix_chr else out


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    return read_flat(spark, path, "## chrom:str\tsize:int").select("chrom", "size")


def read_pair_counts(spark: SparkSession, path: str) -> list[list[float]]:
    """The 16 counts of a pair table, in file order, as a 4 x 4 matrix."""
    rows = read_flat(spark, path, "## kmer:str\tcount:float\tfraction:float").orderBy("line_no").limit(16).collect()
    if len(rows) != 16:
        raise ValueError(f"{path} has {len(rows)} of 16 pairs")
    return [[r["count"] for r in rows[i : i + 4]] for i in range(0, 16, 4)]
