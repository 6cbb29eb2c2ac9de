"""Gene models: exon chains, transcripts and the loci that they emit.

A transcript is a row with name, chrom, sense, exon_starts, exon_ends (sorted arrays), cds_start, cds_end and gene_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAIRS = "arrays_zip(exon_starts, exon_ends)"


def transcripts(genes: DataFrame, gene_names: DataFrame | None = None) -> DataFrame:
    """Transcripts from a gene table; the gene id is gene_names' (name, gene), else name2, else id, else name."""
    out = genes
    if gene_names is not None:
        out = out.join(gene_names.select(F.col("name"), F.col("gene").alias("_gene")), "name", "left")
    else:
        out = out.withColumn("_gene", F.lit(None).cast("string"))
    full = lambda c: F.when(F.col(c) != "", F.col(c))
    out = out.withColumn("gene_id", F.coalesce(full("_gene"), full("name2"), full("id"), F.col("name")))
    coding = F.col("cdsStart") < F.col("cdsEnd")
    return out.select("name", "gene_id", "chrom", "sense", F.col("exonStarts").alias("exon_starts"), F.col("exonEnds").alias("exon_ends"), F.when(coding, F.col("cdsStart")).alias("cds_start"), F.when(coding, F.col("cdsEnd")).alias("cds_end"))


def transcripts_from_gtf(gff: DataFrame, attrs: Column) -> DataFrame:
    """Transcripts from exon rows grouped by transcript_id; without coding regions."""
    # the attributes are parsed once a row
    ex = gff.where(F.col("type") == "exon").withColumn("_a", attrs).select(F.col("_a")["transcript_id"].alias("name"), F.col("_a")["gene_id"].alias("gene_id"), "chrom", "sense", F.struct((F.col("start") - 1).alias("s"), F.col("end").alias("e")).alias("x"))
    by = ex.groupBy("name", "chrom", "sense").agg(F.min("gene_id").alias("gene_id"), F.array_sort(F.collect_set("x")).alias("xs"))
    null = F.lit(None).cast("long")
    return by.select("name", "gene_id", "chrom", "sense", F.col("xs.s").alias("exon_starts"), F.col("xs.e").alias("exon_ends"), null.alias("cds_start"), null.alias("cds_end"))


def with_lengths(tx: DataFrame) -> DataFrame:
    """Adds start, end, unspliced and spliced length, exon lengths and cumulative exon offsets."""
    out = tx.withColumns({"start": F.expr("exon_starts[0]"), "end": F.expr("element_at(exon_ends, -1)"), "exon_lengths": F.expr(f"transform({_PAIRS}, x -> x.exon_ends - x.exon_starts)")})
    out = out.withColumns({"unspliced": F.col("end") - F.col("start"), "spliced": F.expr("aggregate(exon_lengths, 0L, (s, x) -> s + x)")})
    return out.withColumn("offsets", F.expr("aggregate(exon_lengths, array(0L), (s, x) -> concat(s, array(element_at(s, -1) + x)))"))


def exons(tx: DataFrame) -> DataFrame:
    """One row per exon, numbered from the 5' end."""
    n = F.size("exon_starts")
    rows = tx.select("*", F.posexplode(F.expr(_PAIRS)).alias("_i", "_x"))
    return rows.select(*tx.columns, F.when(F.col("sense") == "-", n - F.col("_i")).otherwise(F.col("_i") + 1).alias("number"), F.col("_x.exon_starts").alias("e_start"), F.col("_x.exon_ends").alias("e_end"))


def introns(tx: DataFrame) -> DataFrame:
    """One row per intron, numbered from the 5' end."""
    n = F.size("exon_starts") - 1
    zipped = F.zip_with(F.expr("slice(exon_ends, 1, size(exon_ends) - 1)"), F.expr("slice(exon_starts, 2, size(exon_starts) - 1)"), lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    rows = tx.where(F.size("exon_starts") > 1).select("*", F.posexplode(zipped).alias("_i", "_x"))
    return rows.select(*tx.columns, F.when(F.col("sense") == "-", n - F.col("_i")).otherwise(F.col("_i") + 1).alias("number"), F.col("_x.s").alias("i_start"), F.col("_x.e").alias("i_end"))


def splice_sites(tx: DataFrame) -> DataFrame:
    """One-base 5' and 3' splice sites of every intron."""
    minus = F.col("sense") == "-"
    rows = introns(tx)
    left, right = F.struct(F.col("i_start").alias("start"), (F.col("i_start") + 1).alias("end")), F.struct((F.col("i_end") - 1).alias("start"), F.col("i_end").alias("end"))
    return rows.select(*tx.columns, "number", F.when(minus, right).otherwise(left).alias("ss5"), F.when(minus, left).otherwise(right).alias("ss3"))


def to_spliced(pos: Column) -> Column:
    """Offset from the 5' end in the spliced transcript, or null outside exons; needs exon arrays and sense."""
    inside = F.exists(F.expr(_PAIRS), lambda x: (x["exon_starts"] <= pos) & (pos < x["exon_ends"]))
    left = F.aggregate(F.expr(_PAIRS), F.lit(0).cast("long"), lambda s, x: s + F.greatest(F.lit(0), F.least(pos, x["exon_ends"]) - x["exon_starts"]))
    total = F.aggregate(F.expr(_PAIRS), F.lit(0).cast("long"), lambda s, x: s + x["exon_ends"] - x["exon_starts"])
    return F.when(inside, F.when(F.col("sense") == "-", total - left - 1).otherwise(left))


def from_spliced(offset: Column) -> Column:
    """The genomic position of a spliced offset (from the 5' end), or null beyond the transcript."""
    total = F.aggregate(F.expr(_PAIRS), F.lit(0).cast("long"), lambda s, x: s + x["exon_ends"] - x["exon_starts"])
    at = F.when(F.col("sense") == "-", total - offset - 1).otherwise(offset)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    step = lambda s, x: F.struct((s["done"] + x["exon_ends"] - x["exon_starts"]).alias("done"), F.when(s["pos"].isNull() & (at >= s["done"]) & (at < s["done"] + x["exon_ends"] - x["exon_starts"]), x["exon_starts"] + at - s["done"]).otherwise(s["pos"]).alias("pos"))
    return F.aggregate(F.expr(_PAIRS), F.struct(zero.alias("done"), none.alias("pos")), step, lambda s: s["pos"])


def contains(pos: Column) -> Column:
    return F.exists(F.expr(_PAIRS), lambda x: (x["exon_starts"] <= pos) & (pos < x["exon_ends"]))


def clip_chain(start: Column, end: Column, keep_empty: bool = False) -> Column:
    """Exons cut to [start, end), as array<struct<s, e>>."""
    cut = F.transform(F.expr(_PAIRS), lambda x: F.struct(F.greatest(x["exon_starts"], start).alias("s"), F.least(x["exon_ends"], end).alias("e")))
    return F.filter(cut, lambda x: x["s"] <= x["e"] if keep_empty else x["s"] < x["e"])


def parts(tx: DataFrame) -> DataFrame:
    """Adds utr5, cds and utr3 (arrays of exon pieces, in genomic order) of coding transcripts.

    A side part whose boundary lies at an exon's start also holds the empty piece at that boundary, so its span reaches over
    the intron.
    """
    lo, hi = F.col("cds_start"), F.col("cds_end")
    left = F.filter(F.transform(F.expr(_PAIRS), lambda x: F.struct(x["exon_starts"].alias("s"), F.least(x["exon_ends"], lo).alias("e"))), lambda x: x["s"] <= lo)
    right = F.filter(F.transform(F.expr(_PAIRS), lambda x: F.struct(F.greatest(x["exon_starts"], hi).alias("s"), x["exon_ends"].alias("e"))), lambda x: x["e"] >= hi)
    minus, coding = F.col("sense") == "-", lo.isNotNull()
    return tx.withColumns({"cds": F.when(coding, clip_chain(lo, hi)), "utr5": F.when(coding, F.when(minus, right).otherwise(left)), "utr3": F.when(coding, F.when(minus, left).otherwise(right))})


def spliced_length(chain: Column) -> Column:
    return F.aggregate(chain, F.lit(0).cast("long"), lambda s, x: s + x["e"] - x["s"])


def gene_segments(tx: DataFrame) -> DataFrame:
    """(name, kind, number, start, end): pieces of 5UTR, CDS, 3UTR, exons and introns."""
    p = parts(tx)
    out = None
    for kind, c in (("5UTR", "utr5"), ("CDS", "cds"), ("3UTR", "utr3")):
        rows = p.where(F.col(c).isNotNull()).select("name", F.lit(kind).alias("kind"), F.posexplode(c).alias("i", "x")).select("name", "kind", (F.col("i") + 1).alias("number"), F.col("x.s").alias("start"), F.col("x.e").alias("end")).where("start < end")
        out = rows if out is None else out.unionByName(rows)
    out = out.unionByName(exons(tx).select("name", F.lit("exon").alias("kind"), "number", F.col("e_start").alias("start"), F.col("e_end").alias("end")))
    return out.unionByName(introns(tx).select("name", F.lit("intron").alias("kind"), "number", F.col("i_start").alias("start"), F.col("i_end").alias("end")))


def gene_features(tx: DataFrame) -> DataFrame:
    """(name, kind, start, end): one-base TSS, PAS, CDSstart, CDSend, 5'SS and 3'SS."""
    t = with_lengths(tx)
    minus = F.col("sense") == "-"
    one = lambda kind, plus, neg: F.struct(F.lit(kind).alias("kind"), F.when(minus, neg).otherwise(plus).alias("start"))
    items = F.array(one("TSS", F.col("start"), F.col("end") - 1), one("PAS", F.col("end"), F.col("start") - 1), one("CDSstart", F.col("cds_start"), F.col("cds_end") - 1), one("CDSend", F.col("cds_end"), F.col("cds_start") - 1))
    a = t.select("name", F.explode(items).alias("x")).select("name", "x.kind", "x.start", (F.col("x.start") + 1).alias("end")).where("start IS NOT NULL")
    s = splice_sites(tx)
    for kind, c in (("5'SS", "ss5"), ("3'SS", "ss3")):
        a = a.unionByName(s.select("name", F.lit(kind).alias("kind"), F.col(f"{c}.start").alias("start"), F.col(f"{c}.end").alias("end")))
    return a


def loci(tx: DataFrame, tx_class: str = "coding", sizes: DataFrame | None = None) -> DataFrame:
    """All loci of transcripts (chrom, sense, start, end, path, name); one explode, no join.

    With chromosome sizes loci are cut to the chromosome, and those of unknown chromosomes dropped; else starts are cut at 0.
    """
    t = parts(with_lengths(tx))
    minus = F.col("sense") == "-"
    start, end = F.col("start"), F.col("end")

    def locus(path: str, s: Column, e: Column, name: Column = F.col("name")) -> Column:
        return F.struct(s.alias("start"), e.alias("end"), F.lit(path).alias("path"), name.alias("name"))

    pick = lambda plus, neg: F.when(minus, neg).otherwise(plus)
    items = []
    for n in (500, 1000):
        items.append(locus(f"regulation/promoter_{n}/", pick(start - n, end), pick(start, end + n)))
        items.append(locus(f"transcript/downstream_{n}/", pick(end, start - n), pick(end + n, start)))
    items.append(locus(f"transcript/{tx_class}/", start, end))
    items.append(locus("transcript/processing/TSS/", pick(start, end - 1), pick(start + 1, end)))
    items.append(locus("transcript/processing/polyA_site/", pick(end, start - 1), pick(end + 1, start)))
    items.append(locus("gene/", start, end, F.col("gene_id")))
    number = lambda kind, i, n: F.concat(F.col("name"), F.lit(f".{kind}"), F.lpad((pick(i + 1, n - i)).cast("string"), 2, "0"))
    exon_rows = F.transform(F.expr(_PAIRS), lambda x, i: locus("transcript/processing/exon/", x["exon_starts"], x["exon_ends"], number("exon", i, F.size("exon_starts"))))
    gaps = F.zip_with(F.expr("slice(exon_ends, 1, size(exon_ends) - 1)"), F.expr("slice(exon_starts, 2, size(exon_starts) - 1)"), lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    intron_name = lambda i: number("intron", i, F.size("exon_starts") - 1)
    intron_rows = F.transform(gaps, lambda x, i: locus("transcript/processing/intron/", x["s"], x["e"], intron_name(i)))
    ss5 = F.transform(gaps, lambda x, i: locus("transcript/processing/SS5/", pick(x["s"], x["e"] - 1), pick(x["s"] + 1, x["e"]), intron_name(i)))
    ss3 = F.transform(gaps, lambda x, i: locus("transcript/processing/SS3/", pick(x["e"] - 1, x["s"]), pick(x["e"], x["s"] + 1), intron_name(i)))
    lo, hi = F.col("cds_start"), F.col("cds_end")
    span = lambda c: (F.array_min(F.col(f"{c}.s")), F.array_max(F.col(f"{c}.e")))
    coding = [locus("transcript/translation/CDS/", *span("cds")), locus("transcript/translation/start/", pick(lo, hi - 1), pick(lo + 1, hi)), locus("transcript/translation/stop/", pick(hi, lo - 1), pick(hi + 1, lo))]
    utrs = [F.when(spliced_length(F.col(c)) > 0, locus(f"transcript/translation/{n}/", *span(c))) for c, n in (("utr5", "UTR5"), ("utr3", "UTR3"))]
    has_cds = F.col("cds").isNotNull() & (F.size("cds") > 0)
    every = F.concat(F.array(*items), exon_rows, intron_rows, ss5, ss3, F.when(has_cds, F.array(*coding, *utrs)).otherwise(F.expr("array()").cast("array<struct<start:bigint,end:bigint,path:string,name:string>>")))
    out = t.select("chrom", "sense", F.explode(F.array_compact(every)).alias("x")).select("chrom", "sense", "x.start", "x.end", "x.path", "x.name")
    if sizes is not None:
        out = out.join(sizes, "chrom").withColumn("end", F.least("end", "size")).drop("size")
    return out.withColumn("start", F.greatest("start", F.lit(0))).where("start < end").select("chrom", "sense", "start", "end", "path", "name")


def splice_sequence(tx: DataFrame, bases: DataFrame, id_col: str = "name") -> DataFrame:
    """Spliced sequences: exon pieces of a chunked sequence table, put together in order, reverse-complemented on -."""
    return _spliced(exons(tx).select(id_col, "sense", "chrom", F.col("e_start").alias("start"), F.col("e_end").alias("end")), bases, id_col)


def _spliced(pieces: DataFrame, bases: DataFrame, id_col: str) -> DataFrame:
    from ..functions.sequence import rev_comp
    from ..sources.tracks import slices

    got = slices(pieces, bases)
    by = got.groupBy(id_col, "sense").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "seq"))), lambda x: x["seq"]), "").alias("seq"))
    return by.select(id_col, F.when(F.col("sense") == "-", rev_comp(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def orf(tx: DataFrame, bases: DataFrame, id_col: str = "name") -> DataFrame:
    """(id, orf): the protein of each transcript's spliced coding region; empty without one."""
    from ..functions.sequence import translate

    rows = parts(tx).select(id_col, "sense", "chrom", F.explode_outer("cds").alias("x")).where("x IS NOT NULL")
    seqs = _spliced(rows.select(id_col, "sense", "chrom", F.col("x.s").alias("start"), F.col("x.e").alias("end")), bases, id_col)
    return tx.select(id_col).join(seqs, id_col, "left").select(id_col, F.coalesce(translate(F.col("seq")), F.lit("")).alias("orf"))
