"""Queries that write a table in a file format, read it back through that format's reader and return what was read.

The files lie in the shared folder; the SQL takes the same figures from the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from ..functions import text as X
from ..operators import annotate as A
from ..operators import fdr as D
from ..operators import filters as P
from ..operators import genemodel as G
from ..operators import intervals as I
from ..scratch import settle, shared_dir
from ..sources import bam, flat, genome, sequences, sinks, tracks
from .edit_queries import RAW, aligned
from .queries import _DNA, _TX, ALN, CLUSTER_SQL, CODE_SQL, ISLAND_SQL, LOCUS, TIES, _dna, _kept, _table, aln, locus, transcripts
from .registry import SQL, query


def stored(spark: SparkSession, lines: DataFrame, header: str | None = None) -> str:
    """Write lines (column value; a value may hold several lines) and give the folder's path."""
    path = f"{shared_dir(spark)}/strandflow/files-{uuid.uuid4().hex}"
    sinks.write_lines(lines, path, header)
    return path


# ---- typed tables ---------------------------------------------------------------------------------------------------
_ORDERS = "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_custkey % 2 = 0 AS even FROM orders"


def _orders(spark, d):
    return _table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 2 == 0).alias("even"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, o_custkey % 2 = 0 AS even, concat(o_custkey, ',', o_orderkey % 3) AS keys FROM orders")
def s1_typed_table(spark, d):
    """A table with a typed header, lists in cells."""
    keys = F.array("o_custkey", F.col("o_orderkey") % 3).cast("array<bigint>")
    header, lines = sinks.typed_lines(_table(spark, d, "orders").select("o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("id"), keys.alias("keys")).join(_orders(spark, d), "id"))
    got = flat.read_flat(spark, stored(spark, lines, header))
    return got.select("id", "status", "price", "even", F.array_join(F.transform("keys", lambda x: x.cast("string")), ",").alias("keys"))


def _broken(spark, d):
    """Orders as lines with a named header; every seventh key is no number, every eleventh line has a cell too few."""
    key = F.when(F.col("id") % 7 == 0, "x").otherwise(F.col("id").cast("string"))
    cells = F.when(F.col("id") % 11 == 0, F.concat_ws("\t", key, "status")).otherwise(F.concat_ws("\t", key, "status", F.col("price").cast("string")))
    return stored(spark, _orders(spark, d).select(cells.alias("value")), "#order id\tstatus\tprice (total)")


@query("SELECT o_orderkey AS order_id, o_orderstatus AS state, o_totalprice AS price_total FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0")
def s5_named_table(spark, d):
    """Kinds by name, cleaned and renamed columns, broken lines dropped."""
    return flat.read_flat(spark, _broken(spark, d), hints={"order_id": "int", "price_total": "float"}, renames={"status": "state"}).drop("line_no")


@query("SELECT CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_orderkey END AS order_id, o_orderstatus AS status, o_totalprice AS price_total FROM orders WHERE o_orderkey % 11 <> 0")
def s4_broken_values(spark, d):
    """Broken cells become -1."""
    return flat.read_flat(spark, _broken(spark, d), hints={"order_id": "int", "price_total": "float"}, broken_value=True).drop("line_no")


@query("SELECT count(*) AS lines, count_if(o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) AS broken, count_if(o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0) AS kept, true AS shown FROM orders")
def p17_broken_lines(spark, d):
    """Broken lines counted, and the first and last of them kept, by the pass that writes the others."""
    counts = Observation()
    got = settle(flat.read_flat(spark, _broken(spark, d), hints={"order_id": "int", "price_total": "float"}, counts=counts))
    n, first, last = counts.get["broken"], counts.get["first_broken"], counts.get["last_broken"]
    shown = n == 0 or (first["line"].count("\t") < 2 or first["line"].startswith("x")) and (last["line"].count("\t") < 2 or last["line"].startswith("x"))
    return got.agg(F.lit(counts.get["lines"]).alias("lines"), F.lit(n).alias("broken"), F.count("*").alias("kept"), F.lit(shown).alias("shown"))


@query("SELECT o_orderkey AS c0, o_totalprice AS c1, o_orderstatus AS c2, concat(o_custkey, ',', 1) AS c3 FROM orders")
def s5_guessed_table(spark, d):
    """Kinds from the first line of data."""
    o = _table(spark, d, "orders")
    got = flat.read_flat(spark, stored(spark, o.select(F.concat_ws("\t", "o_orderkey", F.col("o_totalprice").cast("string"), "o_orderstatus", F.concat(F.col("o_custkey"), F.lit(";1,"))).alias("value"))))
    return got.select("c0", "c1", "c2", F.array_join(F.transform("c3", lambda x: x.cast("string")), ",").alias("c3"))


@query("SELECT o_custkey AS cust, max(o_orderkey) AS id FROM orders GROUP BY o_custkey")
def s3_keyed(spark, d):
    """S3: of the lines with one key the last one counts."""
    o = _table(spark, d, "orders").orderBy("o_orderkey").select(F.concat_ws("\t", "o_custkey", "o_orderkey").alias("value"))
    return flat.keyed(flat.read_flat(spark, stored(spark, o), "## cust:int\tid:int"), "cust").select("cust", "id")


@query("SELECT concat('chr', c_custkey) AS chrom, 1000 + c_nationkey AS size FROM customer")
def s28_sizes(spark, d):
    c = _table(spark, d, "customer").select(F.concat_ws("\t", F.concat(F.lit("chr"), F.col("c_custkey")), F.lit(1000) + F.col("c_nationkey")).alias("value"))
    return flat.read_sizes(spark, stored(spark, c))


# ---- GFF and gene tables --------------------------------------------------------------------------------------------
@query(f"WITH l AS ({LOCUS}) SELECT chrom, sense, start, \"end\", 'genes/' || CASE WHEN start % 2 = 0 THEN 'exon' ELSE 'intron' END AS path, name FROM l")
def s7_gff_loci(spark, d):
    """Features written as GFF and read as loci."""
    rows = locus(spark, d).select(F.regexp_replace("chrom", "^chr", "").alias("chrom"), F.lit("src").alias("source"), F.when(F.col("start") % 2 == 0, "exon").otherwise("intron").alias("type"), (F.col("start") + 1).alias("start"), "end", F.lit(".").alias("score"), "sense", F.lit(".").alias("frame"), F.format_string('gene_id "g"; ID "%s";', "name").alias("attr_str"))
    got = flat.read_gff(spark, stored(spark, sinks.gff_lines(rows), "##gff-version 2"))
    return flat.gff_loci(got, "genes")


@query(f"WITH t AS ({_TX}) SELECT name, gene_id, chrom, sense, CAST(n AS INT) AS exons, s AS start, s + 3 * w * (n - 1) + w AS \"end\", s + 10 AS cds_start, s + 3 * w * (n - 1) + w - 15 AS cds_end FROM t")
def s15_gene_table(spark, d):
    """Transcripts written as a gene table and read back."""
    got = G.transcripts(flat.read_genes(spark, stored(spark, sinks.transcript_lines(transcripts(spark, d)))))
    return G.with_lengths(got).select("name", "gene_id", "chrom", "sense", F.size("exon_starts").alias("exons"), "start", "end", "cds_start", "cds_end")


@query(f"WITH t AS ({_TX}) SELECT name, gene_id, chrom, sense, array_to_string(list_transform(range(0, n), lambda i: s + 3 * w * i), ',') AS starts, array_to_string(list_transform(range(0, n), lambda i: s + 3 * w * i + w), ',') AS ends FROM t")
def s16_transcripts_from_gtf(spark, d):
    """Transcripts put together from exon rows."""
    ex = G.exons(transcripts(spark, d)).select("chrom", F.lit("src").alias("source"), F.lit("exon").alias("type"), (F.col("e_start") + 1).alias("start"), F.col("e_end").alias("end"), F.lit(".").alias("score"), "sense", F.lit(".").alias("frame"), F.format_string('gene_id "%s"; transcript_id "%s";', "gene_id", "name").alias("attr_str"))
    got = flat.read_gff(spark, stored(spark, sinks.gff_lines(ex)))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return G.transcripts_from_gtf(got, X.attributes(F.col("attr_str"))).select("name", "gene_id", "chrom", "sense", text("exon_starts").alias("starts"), text("exon_ends").alias("ends"))


# ---- reads, sequences, alignments -----------------------------------------------------------------------------------
@query(f"SELECT qname AS name, query AS seq, repeat('I', length(query)) AS qual, count(*) AS n FROM ({RAW}) t GROUP BY ALL")
def s10_fastq(spark, d):
    """Reads written as FASTQ and read back."""
    r = aligned(spark, d).select(F.concat(F.lit("@"), "qname").alias("name"), F.col("query").alias("seq"), F.expr("repeat('I', length(query))").alias("qual"))
    got = sequences.read_fastq(spark, stored(spark, sinks.fastq_lines(r)))
    return got.groupBy("name", "seq", "qual").agg(F.count("*").alias("n"))


@query(f"WITH {_DNA} SELECT 'd' || doc_id AS id, length(seq) AS length, md5(seq) AS seq_md5 FROM dna WHERE seq <> ''")
def s11_fasta(spark, d):
    """Whole sequences written with folded lines and read back."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    got = sequences.read_fasta(spark, stored(spark, sinks.fasta_lines(seqs)))
    return got.select("id", F.length("seq").cast("long").alias("length"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query(f"SELECT lib, chrom, pos, strand = '-' AS is_reverse, qname, cigar, query, md, mapq, x0, x1, CAST(dense_rank() OVER (ORDER BY chrom) - 1 AS INT) AS tid FROM ({RAW}) t")
def s9_sam(spark, d):
    """Alignments written as SAM text (every fourth with clipped ends) and read back."""
    clip = F.when(F.col("pos") % 4 == 0, F.concat(F.lit("2S"), "cigar", F.lit("1S"))).otherwise(F.col("cigar"))
    seq = F.when(F.col("pos") % 4 == 0, F.concat(F.lit("NN"), "query", F.lit("N"))).otherwise(F.col("query"))
    line = F.concat_ws("\t", "qname", F.when(F.col("is_reverse"), "16").otherwise("0"), "chrom", F.col("pos") + 1, "mapq", clip, F.lit("*"), F.lit("0"), F.lit("0"), seq, F.lit("*"), F.concat(F.lit("MD:Z:"), "md"), F.concat(F.lit("X0:i:"), "x0"), F.concat(F.lit("X1:i:"), "x1"), F.concat(F.lit("LB:Z:"), "lib"))
    got = sequences.alignments(spark, stored(spark, aligned(spark, d).select(line.alias("value")), "@HD\tVN:1.6"))
    return got.select("lib", "chrom", "pos", "is_reverse", "qname", F.regexp_replace("cigar", r"^2S|1S$", "").alias("cigar"), "query", "md", "mapq", "x0", "x1", "tid")


#: Regions of 40 bases that the queries through BAM files ask for: of every 1000 bases of each chromosome, those from 500.
_PEAKS = "(SELECT DISTINCT chrom, CAST(pos // 1000 * 1000 + 500 AS BIGINT) AS start, CAST(pos // 1000 * 1000 + 540 AS BIGINT) AS \"end\" FROM ({RAW}) t0)".replace("{RAW}", RAW)


def _bam(spark, d):
    """All alignments as BAM files with indexes, and the folder."""
    path = f"{shared_dir(spark)}/strandflow/bam-{uuid.uuid4().hex}"
    sequences.register(spark)
    bam.write_bam(aligned(spark, d), path, files=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return path


def _peaks(spark, d):
    at = (F.floor(F.col("pos") / 1000) * 1000 + 500).cast("long")
    return aligned(spark, d).select("chrom", at.alias("start"), (at + 40).alias("end")).distinct()


@query(f"SELECT lib, chrom, pos, strand = '-' AS is_reverse, qname, cigar, query, md, mapq, x0, x1 FROM ({RAW}) t")
def s9_bam(spark, d):
    """Alignments written as BAM by many tasks and read back in small splits."""
    got = spark.read.format("bam").option("splitBytes", str(1 << 16)).load(_bam(spark, d))
    return got.select("lib", "chrom", "pos", "is_reverse", "qname", "cigar", "query", "md", "mapq", "x0", "x1")


@query(f"""SELECT p.chrom, p.start, p."end", CAST(coalesce(sum(t.mult), 0) AS BIGINT) AS reads FROM {_PEAKS} p
LEFT JOIN (SELECT * FROM ({RAW}) t1 WHERE x0 < 2) t ON t.chrom = p.chrom AND t.pos < p."end" AND t.aend > p.start GROUP BY ALL""")
def s25_bam_counts(spark, d):
    """Weights of the uniquely mapped reads over regions, straight from indexed BAM files; all regions are planned at once."""
    peaks = _peaks(spark, d)
    texts = [tracks.region_text(r["chrom"], r["start"], r["end"]) for r in peaks.collect()]
    return tracks.bam_counts(spark, _bam(spark, d), peaks, texts)


@query(f"""WITH r AS (SELECT chrom, pos, aend, mult FROM ({RAW}) t WHERE x0 < 2), e AS (
  SELECT chrom, pos AS p, mult AS v FROM r UNION ALL SELECT chrom, aend, -mult FROM r
), s AS (SELECT chrom, p, sum(v) AS v FROM e GROUP BY ALL HAVING sum(v) <> 0
), c AS (SELECT chrom, p AS start, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS "end", sum(v) OVER (PARTITION BY chrom ORDER BY p) AS value FROM s)
SELECT chrom, '*' AS strand, start, "end", CAST(value AS DOUBLE) AS value FROM c WHERE value > 0""")
def s27_bam_track(spark, d):
    """The depth of BAM files as a track."""
    return tracks.load_track(spark, _bam(spark, d), "bam")


@query("SELECT concat('chr', p_partkey) AS chrom, p_size * 10 + i * 2 + j AS pos, CAST(p_size + i AS DOUBLE) AS score FROM part, range(0, 6) a(i), range(0, 2) b(j)")
def s13_wiggle(spark, d):
    """One fixed-step block a part, written and read back as positions."""
    p = _table(spark, d, "part")
    head = F.concat(F.lit("fixedStep chrom=chr"), "p_partkey", F.lit(" start="), F.col("p_size") * 10 + 1, F.lit(" step=2"))
    body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: (F.col("p_size") + i).cast("string")), "\n")
    return sequences.read_wiggle(spark, stored(spark, p.select(F.concat_ws("\n", head, body).alias("value")), "track type=wiggle_0"))


@query("SELECT concat('part ', p_partkey) AS title, k.k AS key, l.l AS label, CAST(p_size * CASE WHEN k.k = 'a' THEN 1 ELSE 2 END + CASE WHEN l.l = 'total' THEN 0 ELSE 1 END AS DOUBLE) AS value, concat('--n=', p_size) AS options FROM part, (VALUES ('a'), ('b')) k(k), (VALUES ('total'), ('decoy')) l(l)")
def s14_statistics(spark, d):
    """Statistics blocks, written and read back."""
    size = F.col("p_size")
    block = F.concat_ws("\n", F.concat(F.lit(">part "), "p_partkey"), F.lit("#what\ttotal\tdecoy"), F.concat(F.lit("## --n="), size), F.concat_ws("\t", F.lit("a"), size, size + 1), F.concat_ws("\t", F.lit("b"), size * 2, size * 2 + 1))
    return sequences.read_statistics(spark, stored(spark, _table(spark, d, "part").select(block.alias("value"))))


# ---- tracks ---------------------------------------------------------------------------------------------------------
def _regions(spark, d, n=2000):
    """Regions of 30 bases over sequences d<doc_id>; some begin before, some end beyond them."""
    o = _table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("chrom"), (F.col("doc_id") % 400 * 5 - 10).cast("long").alias("start"))
    return o.withColumn("end", F.col("start") + 30)


_REGION = "rg AS (SELECT doc_id, doc_id % 400 * 5 - 10 AS a FROM documents)"


@query(f"WITH {_DNA}, {_REGION} SELECT 'd' || doc_id AS chrom, a AS start, rpad(CASE WHEN a < 0 THEN repeat('N', CAST(-a AS BIGINT)) || substr(coalesce(seq, ''), 1, CAST(30 + a AS BIGINT)) ELSE substr(coalesce(seq, ''), CAST(a + 1 AS BIGINT), 30) END, 30, 'N') AS seq FROM rg LEFT JOIN dna USING (doc_id)")
def s20_sequence_slices(spark, d):
    """Bases of regions from a chunked sequence table, padded with N."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    return tracks.slices(_regions(spark, d), tracks.chunk_sequences(seqs)).select("chrom", "start", "seq")


@query(f"WITH {_DNA}, {_REGION}, sp AS (SELECT doc_id, s, CASE WHEN s = 'one' THEN seq ELSE replace(seq, 'A', '-') END AS seq FROM dna, (VALUES ('one'), ('two')) v(s) WHERE seq <> '') SELECT 'd' || doc_id AS chrom, s AS species, rpad(CASE WHEN a < 0 THEN repeat('N', CAST(-a AS BIGINT)) || substr(replace(seq, '-', 'N'), 1, CAST(30 + a AS BIGINT)) ELSE substr(replace(seq, '-', 'N'), CAST(a + 1 AS BIGINT), 30) END, 30, 'N') AS seq FROM rg JOIN sp USING (doc_id) WHERE CASE WHEN a < 0 THEN 0 ELSE a END // 4096 <= (length(seq) - 1) // 4096")
def s21_alignment_slices(spark, d):
    """Two species over each region; gaps read as N."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    one = tracks.chunk_sequences(seqs).withColumn("species", F.lit("one"))
    bases = one.unionByName(one.withColumns({"species": F.lit("two"), "seq": F.translate("seq", "A", "-")}))
    return tracks.alignment_slices(_regions(spark, d), bases, ["one", "two"]).where("species IS NOT NULL").select("chrom", "species", "seq")


@query(f"""WITH {_DNA}, {_REGION}, b AS (SELECT 'd' || doc_id AS chrom, a AS start, doc_id % 2 = 0 AS rev, rpad(CASE WHEN a < 0 THEN repeat('N', CAST(-a AS BIGINT)) || substr(coalesce(seq, ''), 1, CAST(30 + a AS BIGINT)) ELSE substr(coalesce(seq, ''), CAST(a + 1 AS BIGINT), 30) END, 30, 'N') AS seq FROM rg LEFT JOIN dna USING (doc_id))
SELECT chrom, start, CASE WHEN rev THEN reverse(translate(seq, 'ACGTN', 'TGCAN')) ELSE seq END AS seq FROM b""")
def s18_indexed_slices(spark, d):
    """Bases of regions, as read on their strands, by byte ranges of indexed FASTA files."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    index = genome.indexed(spark, stored(spark, sinks.fasta_lines(seqs)))
    regions = _regions(spark, d).withColumn("strand", F.when(F.substring("chrom", 2, 20).cast("long") % 2 == 0, "-").otherwise("+"))
    return genome.indexed_slices(regions, index).select("chrom", "start", tracks.oriented(F.col("seq"), F.col("strand")).alias("seq"))


_RUNS = "SELECT chrom, sense AS strand, min(start) AS start, min(start) + 5 AS \"end\", CAST(count(*) AS DOUBLE) AS value FROM ({LOCUS}) l GROUP BY chrom, sense"


def _runs(spark, d):
    by = locus(spark, d).groupBy("chrom", F.col("sense").alias("strand")).agg(F.min("start").alias("start"), F.count("*").cast("double").alias("value"))
    return by.withColumn("end", F.col("start") + 5).select("chrom", "strand", "start", "end", "value")


@query(f"WITH rn AS ({_RUNS.replace('{LOCUS}', LOCUS)}) SELECT chrom, strand, pos, CASE WHEN pos BETWEEN start AND start + 4 THEN value ELSE 0.0 END AS value FROM (SELECT *, unnest(range(start - 3, start + 8)) AS pos FROM rn)")
def s22_track_values(spark, d):
    """A track saved, loaded and read base by base, with its default outside."""
    path = f"{shared_dir(spark)}/strandflow/track-{uuid.uuid4().hex}"
    runs = _runs(spark, d)
    tracks.save_track(runs, path)
    regions = runs.select("chrom", "strand", (F.col("start") - 3).alias("start"), (F.col("start") + 8).alias("end"))
    return tracks.values(regions, tracks.load_track(spark, path)).select("chrom", "strand", "pos", "value")


@query(f"WITH rn AS ({_RUNS.replace('{LOCUS}', LOCUS)}) SELECT chrom, strand, 3 * value AS sum, CASE WHEN strand = '-' THEN concat('0,', CAST(value AS INT), ',', CAST(value AS INT), ',', CAST(value AS INT)) ELSE concat(CAST(value AS INT), ',', CAST(value AS INT), ',', CAST(value AS INT), ',0') END AS profile FROM rn")
def g10_track_methods(spark, d):
    """Sums over regions and profiles in reading order."""
    runs = _runs(spark, d)
    regions = runs.select("chrom", "strand", (F.col("start") + 2).alias("start"), (F.col("start") + 6).alias("end"))
    sums = tracks.region_sum(regions, runs).select("chrom", "strand", "sum")
    profile = tracks.oriented_profile(tracks.values(regions, runs).withColumn("key", F.concat("chrom", "strand")), ["chrom", "key"])
    out = sums.withColumn("key", F.concat("chrom", "strand")).join(profile, ["chrom", "key"])
    return out.select("chrom", "strand", "sum", F.array_join(F.transform("profile", lambda x: x.cast("int").cast("string")), ",").alias("profile"))


@query(f"WITH l AS ({LOCUS}) SELECT start AS pos, max(CAST(\"end\" AS DOUBLE)) AS value FROM l GROUP BY start")
def s24_sparse_track(spark, d):
    """``pos value`` lines."""
    own = locus(spark, d).groupBy("start").agg(F.max("end").alias("end")).select(F.concat_ws("\t", "start", "end").alias("value"))
    return tracks.load_track(spark, stored(spark, own), "sparse", "all", "+").select(F.col("start").alias("pos"), "value")


@query(f"WITH l AS ({LOCUS}) SELECT chrom, sense, pos, CAST(arg_max(\"end\", name) AS DOUBLE) AS value FROM (SELECT *, unnest(range(start, least(start + 5, \"end\"))) AS pos FROM l) GROUP BY chrom, sense, pos")
def a13_score_track(spark, d):
    """Positions take the score of the last line over them."""
    rows = locus(spark, d).select("chrom", "sense", "start", F.least(F.col("start") + 5, "end").alias("end"), F.col("end").cast("double").alias("score"), F.col("name").alias("line_no"))
    return I.score_track(rows, ["chrom", "sense"])


@query("""SELECT chrom, strand, start, "end", value FROM (WITH """ + f"aln AS ({ALN})" + """, ev AS (SELECT 'all' AS chrom, '+' AS strand, pos AS p, mult AS d FROM aln UNION ALL SELECT 'all', '+', pend, -mult FROM aln), dl AS (SELECT chrom, strand, p, sum(d) AS d FROM ev GROUP BY 1, 2, 3 HAVING sum(d) <> 0),
cv AS (SELECT chrom, strand, p AS start, lead(p) OVER w AS "end", CAST(sum(d) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value FROM dl WINDOW w AS (PARTITION BY chrom, strand ORDER BY p)) SELECT * FROM cv WHERE value > 0 AND "end" IS NOT NULL)""")
def s23_run_lines(spark, d):
    """Coverage over all alignments, as if of one chromosome, as run lines, written and read back."""
    runs = I.coverage(aln(spark, d).withColumns({"chrom": F.lit("all"), "strand": F.lit("+")}), ["chrom", "strand"], width=512)
    header, lines = sinks.run_lines(runs.withColumnRenamed("value", "score"))
    return tracks.load_track(spark, stored(spark, lines, header), "runs", "all", "+").select("chrom", "strand", "start", "end", "value")


# ---- functions and gene models --------------------------------------------------------------------------------------
@query(f"WITH {_DNA}, c AS (SELECT doc_id, f, array_to_string(list_transform(range(f, length(seq) - f - 4, 3), lambda i: coalesce({CODE_SQL}[substr(seq, i + 1, 3)], '*')), '') AS p FROM dna, range(0, 3) t(f)) SELECT doc_id, f AS frame, md5(regexp_extract(p, '(M[^*]*)', 1)) AS protein_md5 FROM c")
def f8_translate(spark, d):
    """Proteins of whole sequences in three frames."""
    frames = [F.struct(F.lit(f).cast("long").alias("frame"), F.md5(S.translate(F.col("seq"), f).cast("binary")).alias("protein_md5")) for f in range(3)]
    return _dna(spark, d).where("seq IS NOT NULL").select("doc_id", F.inline(F.array(*frames)))


@query(f"""WITH l AS ({LOCUS}) SELECT name, replace(replace(path || 'processing/exon', 'transcript/', ''), 'x', 'y') AS compact, lower(name) <> 'tx0' AS flag, string_split(rtrim(path, '/'), '/')[-1] AS tail FROM l""")
def f12_cells(spark, d):
    """Compact names, truth of cells, ends of paths."""
    l = locus(spark, d)
    cell = F.when(F.col("name") == "TX0", F.lit("False")).otherwise(F.col("name"))
    compact = F.regexp_replace(X.compact_features(F.concat("path", F.lit("processing/exon"))), "x", "y")
    return l.select("name", compact.alias("compact"), X.to_bool(cell).alias("flag"), X.path_tail(F.regexp_replace("path", "/+$", "")).alias("tail"))


@query(f"WITH l AS ({LOCUS}) SELECT name, 'transcript/coding,transcript/' || lower(substr(name, 3, 1)) AS categories, 'transcript/' || name || ',transcript/a' AS features FROM l")
def f13_channel(spark, d):
    """Categories and features of a stored combination."""
    combo = F.concat(F.lit("transcript/coding/a$transcript/"), F.substring("name", 3, 1), F.lit("/"), F.col("name"), F.lit("$transcript/coding/a"))
    c = X.channel(combo)
    return locus(spark, d).select("name", F.array_join(F.array_sort(F.transform(c["categories"], lambda x: F.lower(x))), ",").alias("_c"), F.array_join(c["features"], ",").alias("features")).select("name", F.concat(F.lit("transcript/coding,transcript/"), F.regexp_replace(F.regexp_replace("_c", "transcript/coding", ""), "^,?transcript/|,$", "")).alias("categories"), "features")


@query(SQL["f13_channel"])
def s26_combination_ids(spark, d):
    """Combinations as ids of a dictionary, each parsed once and joined back."""
    path = f"{shared_dir(spark)}/strandflow/coded-{uuid.uuid4().hex}"
    combo = F.concat(F.lit("transcript/coding/a$transcript/"), F.substring("name", 3, 1), F.lit("/"), F.col("name"), F.lit("$transcript/coding/a"))
    sinks.write_coded(locus(spark, d).select("chrom", "sense", "start", "end", "name", combo.alias("combination")), path)
    got = sinks.load_coded(spark, path)
    return got.select("name", F.array_join(F.reverse(F.array_sort("channel.categories")), ",").alias("_c"), F.array_join("channel.features", ",").alias("features")).select("name", F.concat(F.lit("transcript/coding,transcript/"), F.lower(F.substring("name", 3, 1))).alias("categories"), "features")


@query(f"WITH {CLUSTER_SQL} SELECT CAST(row_number() OVER (ORDER BY encode(tid || ':' || strand || ':' || island)) - 1 AS BIGINT) AS ordinal, tid || ':' || strand || ':' || island AS name, chrom, start + 1 AS start, \"end\", uniq_reads FROM kept")
def j6_by_place(spark, d):
    """Clusters written as GFF and their statistics as another file, joined line by line."""
    rows = _kept(spark, d).orderBy("cid")
    gff = sinks.gff_lines(rows, "chrom", F.lit("x"), F.lit("cluster"), F.col("start") + 1, "end", F.lit("."), "strand", F.lit("."), F.lit("."))
    left = stored(spark, gff, "##gff-version 2")
    both = sequences.by_place(spark, left, stored(spark, rows.select(F.concat_ws("\t", "cid", "uniq_reads").alias("value")), "#cid\tuniq_reads"))
    l, r = F.split("left", "\t"), F.split("right", "\t")
    return both.select("ordinal", F.get(r, 0).alias("name"), F.get(l, 0).alias("chrom"), F.get(l, 3).cast("long").alias("start"), F.get(l, 4).cast("long").alias("end"), F.get(r, 1).cast("long").alias("uniq_reads"))


@query("SELECT l_orderkey AS k, l_linenumber AS line, l_suppkey % 3 AS id FROM lineitem QUALIFY l_suppkey % 3 IS DISTINCT FROM lag(l_suppkey % 3) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AND l_suppkey % 3 IS DISTINCT FROM lead(l_suppkey % 3) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)")
def p14_consecutive_ids(spark, d):
    """Lines whose id neither neighbour in the file has."""
    rows = _table(spark, d, "lineitem").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    lines = sequences.data_lines(spark, stored(spark, rows.select(F.concat_ws("\t", "l_orderkey", "l_linenumber", F.col("l_suppkey") % 3).alias("value")), "#k\tline\tid"))
    c = F.split("value", "\t")
    return P.filter_consecutive(lines.select("ordinal", *[F.get(c, i).cast("long").alias(n) for i, n in enumerate(("k", "line", "id"))]), "id").drop("ordinal")


@query(f"""WITH t AS ({_TX}), b AS (SELECT *, s + 3 * w * (n - 1) + w AS e FROM t), p AS (
SELECT name, 'exon' AS kind, s + 3 * w * i AS a, s + 3 * w * i + w AS b FROM b, range(0, 4) r(i) WHERE i < n UNION ALL
SELECT name, 'intron', s + 3 * w * i + w, s + 3 * w * (i + 1) FROM b, range(0, 4) r(i) WHERE i < n - 1 UNION ALL
SELECT name, 'CDS', greatest(s + 3 * w * i, s + 10), least(s + 3 * w * i + w, e - 15) FROM b, range(0, 4) r(i) WHERE i < n UNION ALL
SELECT name, CASE WHEN sense = '-' THEN '3UTR' ELSE '5UTR' END, s, s + 10 FROM b UNION ALL SELECT name, CASE WHEN sense = '-' THEN '5UTR' ELSE '3UTR' END, e - 15, e FROM b)
SELECT kind, count(*) AS n, CAST(sum(a) AS BIGINT) AS starts, CAST(sum(b) AS BIGINT) AS ends FROM p GROUP BY kind""")
def g7_segments(spark, d):
    """Pieces of UTRs, coding regions, exons and introns."""
    return G.gene_segments(transcripts(spark, d)).groupBy("kind").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


@query(f"""WITH t AS ({_TX}), b AS (SELECT *, s + 3 * w * (n - 1) + w AS e, sense = '+' AS f FROM t), p AS (
SELECT 'TSS' AS kind, CASE WHEN f THEN s ELSE e - 1 END AS a FROM b UNION ALL SELECT 'PAS', CASE WHEN f THEN e ELSE s - 1 END FROM b UNION ALL
SELECT 'CDSstart', CASE WHEN f THEN s + 10 ELSE e - 16 END FROM b UNION ALL SELECT 'CDSend', CASE WHEN f THEN e - 15 ELSE s + 9 END FROM b UNION ALL
SELECT '5''SS', CASE WHEN f THEN s + 3 * w * i + w ELSE s + 3 * w * (i + 1) - 1 END FROM b, range(0, 4) r(i) WHERE i < n - 1 UNION ALL
SELECT '3''SS', CASE WHEN f THEN s + 3 * w * (i + 1) - 1 ELSE s + 3 * w * i + w END FROM b, range(0, 4) r(i) WHERE i < n - 1)
SELECT kind, count(*) AS n, CAST(sum(a) AS BIGINT) AS starts FROM p GROUP BY kind""")
def g7_features(spark, d):
    """One-base features of transcripts."""
    return G.gene_features(transcripts(spark, d)).groupBy("kind").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


@query(f"WITH t AS ({_TX}) SELECT name, p AS pos, (p - s) % (3 * w) < w AND p >= s AND p < s + 3 * w * (n - 1) + w AS inside FROM t, LATERAL (SELECT unnest([s - 1, s, s + w, s + 3 * w + 1, s + 3 * w * n]) AS p)")
def g5_contains(spark, d):
    t = transcripts(spark, d)
    s = F.element_at("exon_starts", 1)
    w = F.element_at("exon_ends", 1) - s
    t = t.withColumn("pos", F.explode(F.array(s - 1, s, s + w, s + 3 * w + 1, s + 3 * w * F.size("exon_starts"))))
    return t.select("name", "pos", G.contains(F.col("pos")).alias("inside"))


def _chains(spark, d):
    """Three exons of 9, 12 and 15 bases in every document's sequence of 100 letters or more, coding from the fourth base."""
    t = _dna(spark, d).where("length(seq) >= 100").select(F.concat(F.lit("d"), F.col("doc_id")).alias("chrom"), F.concat(F.lit("t"), F.col("doc_id")).alias("name"), F.lit("g").alias("gene_id"), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("sense"))
    ints = lambda *x: F.array(*[F.lit(i).cast("long") for i in x])
    return t.withColumns({"exon_starts": ints(10, 30, 60), "exon_ends": ints(19, 42, 75), "cds_start": F.lit(13).cast("long"), "cds_end": F.lit(70).cast("long")})


_COMPLEMENT = "translate({x}, 'ACGTN', 'TGCAN')"


@query(f"WITH {_DNA}, x AS (SELECT doc_id, substr(seq, 11, 9) || substr(seq, 31, 12) || substr(seq, 61, 15) AS s FROM dna WHERE length(seq) >= 100) SELECT 't' || doc_id AS name, CASE WHEN doc_id % 2 = 0 THEN s ELSE reverse({_COMPLEMENT.format(x='s')}) END AS seq FROM x")
def g3_splice(spark, d):
    """Spliced sequences, as read on their strand."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    return G.splice_sequence(_chains(spark, d), tracks.chunk_sequences(seqs))


@query(f"WITH {_DNA}, x AS (SELECT doc_id, substr(seq, 14, 6) || substr(seq, 31, 12) || substr(seq, 61, 10) AS s FROM dna WHERE length(seq) >= 100), y AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN s ELSE reverse({_COMPLEMENT.format(x='s')}) END AS s FROM x) SELECT 't' || doc_id AS name, regexp_extract(array_to_string(list_transform(range(0, length(s) - 4, 3), lambda i: coalesce({CODE_SQL}[substr(s, i + 1, 3)], '*')), ''), '(M[^*]*)', 1) AS orf FROM y")
def g8_orf(spark, d):
    """Proteins of spliced coding regions."""
    seqs = _dna(spark, d).where("seq <> ''").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "seq")
    return G.orf(_chains(spark, d), tracks.chunk_sequences(seqs))


# ---- merging, verdicts, statistics ----------------------------------------------------------------------------------
@query(f"WITH {ISLAND_SQL} SELECT chrom, strand, island, count(DISTINCT lib) AS libs, count(*) AS n FROM isl GROUP BY tid, chrom, strand, island")
def j1_merged_sources(spark, d):
    """Islands over three sources and an empty one."""
    a = aln(spark, d).select("tid", "chrom", "strand", "lib", "pos", "pend")
    parts = [a.where(F.col("lib") == f"lib{k}") for k in range(4)]
    r = I.islands(I.merge_sources(*parts), ["tid", "chrom", "strand"], ties=["lib"], width=4096)
    return r.groupBy("tid", "chrom", "strand", "island").agg(F.count_distinct("lib").alias("libs"), F.count("*").alias("n")).drop("tid")


@query(f"WITH {CLUSTER_SQL} SELECT CASE WHEN NOT decoy AND conversion_score >= 4 AND n_reads >= 9 THEN 'out' ELSE 'err' END AS stream, CASE WHEN decoy THEN 'decoy' WHEN conversion_score >= 4 AND n_reads >= 9 THEN 'kept' ELSE 'low_score' END AS verdict, 'signature,n_reads' AS filtered_by, count(*) AS n FROM kept GROUP BY ALL")
def k11_verdict_files(spark, d):
    """Kept and other clusters as two streams of files."""
    path = f"{shared_dir(spark)}/strandflow/verdicts-{uuid.uuid4().hex}"
    sinks.write_verdicts(D.verdicts(_kept(spark, d), ["signature", "n_reads"], [4.0, 9.0]), path, "signature,n_reads")
    return spark.read.parquet(path).groupBy("stream", "verdict", "filtered_by").agg(F.count("*").alias("n"))


@query(f"WITH l AS ({LOCUS}), g AS (SELECT chrom, CASE WHEN start % 2 = 0 THEN '+' ELSE '-' END AS sense, start, start + 10 AS \"end\", name FROM l), w AS (SELECT name, chrom, sense, CASE WHEN sense = '+' THEN start - 1 ELSE \"end\" - 2 END AS s FROM g) SELECT w.name, coalesce(string_agg(DISTINCT 'transcript/' || l.name, ',' ORDER BY 'transcript/' || l.name), '') AS lefts FROM w LEFT JOIN l ON l.chrom = w.chrom AND l.start < w.s + 3 AND w.s < l.\"end\" AND l.sense = w.sense GROUP BY w.name")
def j5_annotated_bounds(spark, d):
    """The features over the left bounds, from the annotated attribute strings."""
    g = locus(spark, d).select("chrom", F.when(F.col("start") % 2 == 0, "+").otherwise("-").alias("sense"), (F.col("start") + 1).alias("start"), (F.col("start") + 10).alias("end"), F.col("name").alias("attr_str"))
    out = A.annotate_gff(g, locus(spark, d), "left", width=256)
    found = F.substring_index(F.substring_index("attr_str", 'LEFT_SENSE="', -1), '"', 1)
    return out.select(F.substring_index("attr_str", " ", 1).alias("name"), F.when(found == "", "").otherwise(F.concat(F.lit("transcript/"), F.replace(found, F.lit(","), F.lit(",transcript/")))).alias("lefts"))
