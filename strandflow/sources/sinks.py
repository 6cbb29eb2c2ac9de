"""Text forms of results, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import channel
from ..operators.ordered import global_rank
from ..schemas import SCORES
from .tracks import SAVE_BIN


def _text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def gff_lines(df: DataFrame, chrom: str = "chrom", source: str | Column = "source", type_: str | Column = "type", start: str | Column = "start", end: str | Column = "end", score: str | Column = "score", sense: str = "sense", frame: str | Column = "frame", attrs: str | Column = "attr_str") -> DataFrame:
    """Nine tab-joined columns as they are."""
    return df.select(F.concat_ws("\t", *[_text(c) for c in (chrom, source, type_, start, end, score, sense, frame, attrs)]).alias("value"))


def cluster_gff(clusters: DataFrame, source: str = "strandflow", type_: str = "cluster") -> DataFrame:
    """Clusters as GFF: 1-based start, score in column 6, entropy score in column 8, 1-based peak as ccr."""
    attrs = F.format_string('name="%s"; n_reads="%s"; n_uniq="%s"; ccr="%d";', F.col("cid"), F.col("n_reads").cast("string"), F.col("uniq_reads").cast("string"), F.col("peak") + 1)
    return gff_lines(clusters, "chrom", F.lit(source), F.lit(type_), F.col("start") + 1, "end", "score", "strand", "entropy_score", attrs)


def peak_gff(clusters: DataFrame, flank: int, source: str = "strandflow") -> DataFrame:
    """Regions of ``flank`` bases around each peak (not cut at the chromosome's ends)."""
    return gff_lines(clusters, "chrom", F.lit(source), F.lit("ccr"), F.col("peak") + 1 - flank, F.col("peak") + 1 + flank, "score", "strand", F.lit("."), F.format_string('name="%s";', F.col("cid")))


def stats_lines(clusters: DataFrame) -> tuple[str, DataFrame]:
    """Header and lines of cluster statistics."""
    cells = [_text("cid"), F.when(F.col("decoy"), "True").otherwise("False"), *[_text(c) for c in SCORES[:-1]], F.array_join(F.transform("edits", lambda x: x.cast("string")), ",")]
    return "#" + "\t".join(["cid", "decoy", *SCORES]), clusters.select(F.concat_ws("\t", *cells).alias("value"))


def with_header(header: str, lines: DataFrame) -> DataFrame:
    """A header line before the others, which keep their order; sorted in parallel, so the first of the files that are
    written begins with it."""
    rest = lines.select(F.monotonically_increasing_id().alias("_i"), "value")
    first = lines.sparkSession.createDataFrame([(-1, header)], "_i long, value string")
    return first.unionByName(rest).orderBy("_i").select("value")


def bed_lines(clusters: DataFrame) -> DataFrame:
    """BED6: chrom, start, end, name, score, strand."""
    return clusters.select(F.concat_ws("\t", *[_text(c) for c in ("chrom", "start", "end", "cid", "score", "strand")]).alias("value"))


def run_lines(runs: DataFrame) -> tuple[str, DataFrame]:
    """Run-length track lines; an empty track has none."""
    return "## start:int\tend:int\tscore:float", runs.select(F.concat_ws("\t", *[_text(c) for c in ("start", "end", "score")]).alias("value"))


def fasta_lines(seqs: DataFrame, id_col: str = "id", seq_col: str = "seq", width: int = 80) -> DataFrame:
    """Records with folded sequences, one value a record."""
    folded = F.regexp_replace(F.regexp_replace(seq_col, rf"(.{{{width}}})", "$1\n"), "\n$", "")
    return seqs.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), folded).alias("value"))


def fastq_lines(reads: DataFrame) -> DataFrame:
    return reads.select(F.concat_ws("\n", "name", "seq", F.lit("+"), "qual").alias("value"))


def stat_block(title: str, table: DataFrame, label: str, columns: list[str], order: str | None = None, options: str = "") -> DataFrame:
    """A statistics block: title, labels, options, then ``key\\tvalues`` lines in order."""
    head = [f">{title}", "#" + "\t".join([label, *columns])] + ([f"## {options}"] if options else [])
    rows = table.select((F.col(order) if order else F.col(table.columns[0])).alias("_o"), F.concat_ws("\t", *[_text(c) for c in [table.columns[0] if not order else label_column(table, order, columns), *columns]]).alias("value"))
    first = table.sparkSession.createDataFrame([(i, h) for i, h in enumerate(head)], "_i int, value string")
    both = first.withColumn("_o", F.lit(None).cast(rows.schema["_o"].dataType)).select("_i", "_o", "value").unionByName(rows.select(F.lit(len(head)).alias("_i"), "_o", "value"))
    return both.orderBy("_i", "_o").select("value")


def label_column(table: DataFrame, order: str, columns: list[str]) -> str:
    return next(c for c in table.columns if c != order and c not in columns)


def transcript_lines(tx: DataFrame) -> DataFrame:
    """Gene table lines; frames are all -1, and a transcript without coding region has cds = end."""
    end = F.element_at("exon_ends", -1)
    lists = lambda c: F.concat(F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ","), F.lit(","))
    frames = F.concat(F.array_join(F.transform("exon_starts", lambda x: F.lit("-1")), ","), F.lit(","))
    cells = [F.lit("0"), _text("name"), _text("chrom"), _text("sense"), _text(F.element_at("exon_starts", 1)), _text(end), _text(F.coalesce("cds_start", end)), _text(F.coalesce("cds_end", end)), _text(F.size("exon_starts")), lists("exon_starts"), lists("exon_ends"), F.lit("0"), _text("gene_id"), F.lit("unk"), F.lit("unk"), frames]
    return tx.select(F.concat_ws("\t", *cells).alias("value"))


def typed_lines(df: DataFrame) -> tuple[str, DataFrame]:
    """A typed header and tab-separated lines of any flat table."""
    kinds = {"bigint": "int", "int": "int", "double": "float", "float": "float", "boolean": "bool", "string": "str", "array<bigint>": "intlist", "array<double>": "floatlist", "array<string>": "strlist"}
    head = "## " + "\t".join(f"{c}:{kinds.get(t, 'str')}" for c, t in df.dtypes)
    cell = lambda c, t: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") if t.startswith("array") else F.when(F.col(c), "True").otherwise("False") if t == "boolean" else _text(c)
    return head, df.select(F.concat_ws("\t", *[cell(c, t) for c, t in df.dtypes]).alias("value"))


def write_lines(lines: DataFrame, path: str, header: str | None = None, single: bool = False) -> None:
    """Text files in order, the first with the header; ``single``: one file, which one task writes."""
    out = with_header(header, lines) if header else lines
    (out.coalesce(1) if single else out).write.mode("overwrite").text(path)


def write_verdicts(clusters: DataFrame, path: str, method: str) -> None:
    """Kept rows and the others, both marked with the method, as two partitions of one directory."""
    out = clusters.withColumn("stream", F.when(F.col("verdict") == "kept", "out").otherwise("err")).withColumn("filtered_by", F.lit(method))
    out.write.mode("overwrite").partitionBy("stream").parquet(path)


def dictionary(seg: DataFrame) -> DataFrame:
    """(id, combination): the distinct combinations of a compiled annotation, numbered from 1 in their order by a parallel
    sort; 0 is the empty one."""
    return global_rank(seg.select("combination").where("combination <> ''").distinct(), [F.col("combination")], "id").select((F.col("id") + 1).cast("long").alias("id"), "combination")


def write_coded(seg: DataFrame, path: str) -> None:
    """A compiled annotation with combinations as ids: ``segments`` by chromosome and strand, and ``combinations``."""
    dictionary(seg).write.mode("overwrite").parquet(f"{path}/combinations")
    words = seg.sparkSession.read.parquet(f"{path}/combinations")
    write_annotation(seg.join(words, "combination", "left").withColumn("id", F.coalesce("id", F.lit(0))).drop("combination"), f"{path}/segments")


def load_coded(spark: SparkSession, path: str, process=channel, chrom: str | None = None, sense: str | None = None) -> DataFrame:
    """Segments of a coded annotation with ``process`` of their combinations as column channel; each combination is parsed
    once, in the dictionary, not once a segment.  Chromosome and strand become partition filters."""
    seg = spark.read.parquet(f"{path}/segments")
    for c, v in (("chrom", chrom), ("sense", sense)):
        seg = seg.where(F.col(c) == v) if v is not None else seg
    words = spark.read.parquet(f"{path}/combinations")
    empty = spark.createDataFrame([(0, "")], words.schema)
    return seg.join(words.unionByName(empty).select("id", process(F.col("combination")).alias("channel")), "id")


def write_annotation(seg: DataFrame, path: str) -> None:
    """A compiled annotation: segments by chromosome and strand; Parquet keeps the dictionary of combinations."""
    seg.repartition("chrom", "sense", F.floor(F.col("start") / SAVE_BIN)).sortWithinPartitions("start").write.mode("overwrite").partitionBy("chrom", "sense").parquet(path)
