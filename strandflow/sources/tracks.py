"""Genome tracks: tables of runs or positions and of sequence chunks, addressed by region.

A track is a table (chrom, strand, start, end, value) of runs; where nothing is stored the default counts.  Sequences
are tables (chrom, chunk, seq) of ``CHUNK`` bases; several species make an alignment table (chrom, species, chunk, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import complement
from ..operators.clusters import is_unique
from ..operators.edits import multiplicity
from ..operators.intervals import coverage, numbered, overlap_count, range_join, read_starts, run_length, score_track
from ..scratch import settle

CHUNK = 1 << 12
#: Bases of a chromosome and strand that one task writes.
SAVE_BIN = 1 << 24


def chunk_sequences(seqs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Sequences (id, seq) to (chrom, chunk, seq)."""
    n = F.expr(f"sequence(0L, CAST((length(seq) - 1) DIV {size} AS BIGINT))")
    return seqs.where("length(seq) > 0").select(F.col("id").alias("chrom"), "seq", F.explode(n).alias("chunk")).select("chrom", "chunk", F.expr(f"substring(seq, CAST(chunk * {size} + 1 AS INT), {size})").alias("seq"))


def slices(regions: DataFrame, bases: DataFrame, size: int = CHUNK, extra: list[str] | None = None) -> DataFrame:
    """Adds seq to regions (chrom, start, end): their bases, N where the sequence ends or is unknown.

    Only the chunks that a region touches are joined.  ``extra``: further keys of ``bases`` (species).
    """
    extra = extra or []
    r = numbered(regions, "_r")
    keys = r.select("_r", "chrom", "start", "end", F.explode(F.expr(f"sequence(CAST(floor(greatest(start, 0L) / {size}) AS BIGINT), CAST(floor((greatest(end, start + 1, 1L) - 1) / {size}) AS BIGINT))")).alias("chunk"))
    hit = keys.join(bases, ["chrom", "chunk"])
    lo, hi = F.greatest(F.col("start"), F.col("chunk") * size), F.least(F.col("end"), F.col("chunk") * size + F.length("seq"))
    piece = F.substring("seq", (lo - F.col("chunk") * size + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))
    got = hit.groupBy("_r", *extra).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", piece.alias("p")))), lambda x: x["p"]), "").alias("_seq"))
    out = r.join(got, "_r", "left")
    left = F.repeat(F.lit("N"), F.least(F.greatest(-F.col("start"), F.lit(0)), F.col("end") - F.col("start")).cast("int"))
    seq = F.rpad(F.concat(left, F.coalesce("_seq", F.lit(""))), (F.col("end") - F.col("start")).cast("int"), "N")
    return out.withColumn("seq", seq).drop("_r", "_seq")


def on_strand(seq: Column, strand: Column) -> Column:
    """Complemented, not reversed, on -."""
    return F.when(strand == "-", complement(seq)).otherwise(seq)


def oriented(seq: Column, strand: Column) -> Column:
    """As read on its strand: reverse complement on -."""
    return F.when(strand == "-", F.reverse(complement(seq))).otherwise(seq)


def alignment_slices(regions: DataFrame, bases: DataFrame, species: list[str] | None = None, offset: int = 0, size: int = CHUNK) -> DataFrame:
    """Regions with the sequences of all (chosen) species in order of names: columns species and seq; gaps read as N.

    A region's bases are those at start + offset to end + offset; N only, if the offset moves its start below 0.
    """
    if species:
        bases = bases.where(F.col("species").isin(species))
    moved = regions.withColumns({"start": F.col("start") + offset, "end": F.col("end") + offset})
    out = slices(moved, bases, size, ["species"])
    seq = F.when((F.col("start") < 0) & (F.col("start") >= offset), F.repeat(F.lit("N"), F.length("seq"))).otherwise(F.translate("seq", "-", "N"))
    return out.withColumn("seq", seq).withColumns({"start": F.col("start") - offset, "end": F.col("end") - offset})


def values(regions: DataFrame, track: DataFrame, default: float = 0.0, stranded: bool = True) -> DataFrame:
    """One row per base of each region: region columns, pos, value (the default where the track has nothing)."""
    r = numbered(regions, "_r")
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    right = track.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("value").alias("_v"))
    hit = range_join(r.select("_r", *keys, "start", "end"), right, keys)
    cells = hit.select("_r", F.explode(F.expr("sequence(greatest(start, r_start), least(end, r_end) - 1)")).alias("pos"), "_v")
    every = r.withColumn("pos", F.explode(F.expr("sequence(start, end - 1)")))
    return every.join(cells, ["_r", "pos"], "left").withColumn("value", F.coalesce("_v", F.lit(default))).drop("_r", "_v")


def region_sum(regions: DataFrame, track: DataFrame, stranded: bool = True) -> DataFrame:
    """Sum over each region, without expanding runs."""
    r = numbered(regions, "_r")
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    right = track.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("value").alias("_v"))
    hit = range_join(r.select("_r", *keys, "start", "end"), right, keys)
    s = hit.groupBy("_r").agg(F.sum(F.col("_v") * (F.least("end", "r_end") - F.greatest("start", "r_start"))).alias("_s"))
    return r.join(s, "_r", "left").withColumn("sum", F.coalesce("_s", F.lit(0.0))).drop("_r", "_s")


def oriented_profile(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per region the values in reading order: an array, reversed on -."""
    by = cells.groupBy(*keys, "strand").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("v"))
    return by.select(*keys, F.when(F.col("strand") == "-", F.reverse("v")).otherwise(F.col("v")).alias("profile"))


def read_sparse(spark: SparkSession, path: str, chrom: str, strand: str = "+") -> DataFrame:
    """``pos\\tvalue`` lines as runs of one base."""
    from .flat import read_flat

    rows = read_flat(spark, path, "## pos:int\tvalue:int")
    return rows.select(F.lit(chrom).alias("chrom"), F.lit(strand).alias("strand"), F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.col("value").cast("double").alias("value"))


def read_runs(spark: SparkSession, path: str, chrom: str, strand: str = "+") -> DataFrame:
    """``## start:int end:int score:float`` files."""
    from .flat import read_flat

    return read_flat(spark, path, "## start:int\tend:int\tscore:float").select(F.lit(chrom).alias("chrom"), F.lit(strand).alias("strand"), "start", "end", F.col("score").alias("value"))


def bam_reads(spark: SparkSession, path: str, regions: list[str] | None = None, unique: bool = True, mult: bool = True) -> DataFrame:
    """chrom, strand, pos, pend and mult of the reads of a BAM file, or a folder of them; of the regions' reads only, found
    by the index.  ``unique``: uniquely mapped reads only; ``mult``: a read weighs what its name's ``_x<n>`` says."""
    from .sequences import register

    register(spark)
    source = spark.read.format("bam")
    rows = (source if regions is None else source.option("regions", ";".join(regions))).load(path)
    if unique:
        rows = rows.where(is_unique(F.col("x0"), F.col("as_"), F.col("xs")))
    length = F.expr("aggregate(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), 0L, (s, x) -> s + CAST(x AS BIGINT))")
    weight = F.coalesce(multiplicity(F.col("qname")), F.lit(1)).cast("long") if mult else F.lit(1).cast("long")
    return rows.select("chrom", F.when(F.col("is_reverse"), "-").otherwise("+").alias("strand"), "pos", (F.col("pos") + length).alias("pend"), weight.alias("mult"))


def region_text(chrom: str, start: int, end: int) -> str:
    """A region as readers take it (from 1, both ends included)."""
    return f"{chrom}:{start + 1}-{end}"


def read_bam(spark: SparkSession, path: str, chrom: str | None = None, strand: str | None = None, regions: list[str] | None = None, unique: bool = True, mult: bool = True, only_starts: bool = False) -> DataFrame:
    """Depth of a BAM file's reads, or their 5' ends (``only_starts``), as a track; reads that reach a region count over
    their whole length.  Without a strand, reads of both count together, under strand ``*``."""
    reads = bam_reads(spark, path, regions if regions is not None else [chrom] if chrom else None, unique, mult)
    reads = reads.where(F.col("chrom") == chrom) if chrom else reads
    reads = reads.where(F.col("strand") == strand) if strand in ("+", "-") else reads
    if only_starts:
        cells = read_starts(reads, ["chrom"])
        runs = cells.select("chrom", F.col("pos5").alias("start"), (F.col("pos5") + 1).alias("end"), "value")
    else:
        runs = coverage(reads, ["chrom"])
    return runs.select("chrom", F.lit(strand if strand in ("+", "-") else "*").alias("strand"), "start", "end", F.col("value").cast("double").alias("value"))


def bam_counts(spark: SparkSession, path: str, regions: DataFrame, planned: list[str] | None = None, unique: bool = True, mult: bool = True, stranded: bool = False) -> DataFrame:
    """Adds ``reads`` to regions (chrom, strand, start, end): the weight of the reads that reach each one; 0 if none does.

    ``planned``: the regions, or wider ones, as texts, if they are few enough to be planned by the index; else the files
    are read whole and joined.  The join looks at the reads twice, so the files are decoded once and the reads written.
    """
    reads = settle(bam_reads(spark, path, planned, unique, mult), "bam")
    return overlap_count(regions, reads, ["chrom", "strand"] if stranded else ["chrom"])


#: Kinds of tracks that load_track knows; more can be registered.
READERS = {"runs": read_runs, "sparse": read_sparse, "bam": read_bam}


def register_reader(kind: str, reader) -> None:
    READERS[kind] = reader


def save_track(track: DataFrame, path: str) -> None:
    """Parquet by chromosome and strand, so that a region reads its own files only; a long chromosome is written by many
    tasks."""
    track.repartition("chrom", "strand", F.floor(F.col("start") / SAVE_BIN)).write.partitionBy("chrom", "strand").mode("overwrite").parquet(path)


def load_track(spark: SparkSession, path: str, kind: str | None = None, chrom: str | None = None, strand: str | None = None) -> DataFrame:
    """A saved track, or a file of another kind; chromosome and strand become partition filters.  A BAM file needs no kind:
    its track is the depth of its reads, on both strands together if none is given."""
    if kind == "bam" or (kind is None and path.endswith(".bam")):
        return READERS["bam"](spark, path, chrom, strand)
    if kind:
        return READERS[kind](spark, path, chrom, strand or "+")
    out = spark.read.parquet(path)
    for c, v in (("chrom", chrom), ("strand", strand)):
        out = out.where(F.col(c) == v) if v is not None else out
    return out


# ---------------------------------------------------------------------------------------------------------------------
# builders
# ---------------------------------------------------------------------------------------------------------------------
def wiggle_track(spark: SparkSession, source: str, path: str, strand: str = "+") -> DataFrame:
    """A saved track of a fixed-step wiggle file."""
    from .sequences import read_wiggle

    runs = run_length(read_wiggle(spark, source).withColumn("strand", F.lit(strand)), ["chrom", "strand"], value="score")
    save_track(runs.withColumnRenamed("score", "value"), path)
    return load_track(spark, path)


def coverage_track(alignments: DataFrame, path: str, weight: str = "mult") -> DataFrame:
    """A saved track of the depth of alignments (chrom, strand, pos, pend and a weight)."""
    save_track(coverage(alignments, ["chrom", "strand"], weight=weight), path)
    return load_track(alignments.sparkSession, path)


def feature_track(features: DataFrame, path: str, score: str = "score") -> DataFrame:
    """A saved track of scored features (chrom, strand, start, end, line_no); of several over a position the last line counts."""
    cells = score_track(features, ["chrom", "strand"], score=score)
    save_track(run_length(cells, ["chrom", "strand"]).withColumnRenamed("score", "value"), path)
    return load_track(features.sparkSession, path)
