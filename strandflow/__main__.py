"""Command line: ``python -m strandflow COMMAND ...``; each command is one life cycle or filter."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import filters as P
from .operators import genemodel as G
from .operators import reads as R
from .plans.pipelines import ClusterOptions, annotate_file, build_annotation, filter_clusters, find_clusters
from .session import session, ship
from .sources import flat, sequences, sinks, tracks


def _alignments(spark: SparkSession, path: str, lib: str) -> DataFrame:
    """SAM text, or BAM by its name."""
    if path.endswith(".bam"):
        sequences.register(spark)
        return sequences.with_tids(spark.read.format("bam").option("lib", lib).load(path))
    return sequences.alignments(spark, path, lib)


def clusters(spark: SparkSession, a: argparse.Namespace) -> None:
    groups = a.groups.split(",") if a.groups else []
    region = P.parse_masks([a.region])[0] if a.region else None
    options = ClusterOptions(a.decoy, a.mode.split(","), groups, a.min_reads, a.conv, a.min_uniq, a.min_support, a.require_conversions, a.read_count, not a.unstranded, a.mask or [], region)
    discard = flat.gff_loci(flat.read_gff(spark, a.discard)).withColumnRenamed("sense", "strand") if a.discard else None
    out = find_clusters([_alignments(spark, p, f"lib{i}") for i, p in enumerate(a.sam)], options, discard)
    kept = out["kept"].cache()
    if a.logfile:
        logging.basicConfig(level=logging.INFO, filename=a.logfile, format="%(asctime)s %(levelname)-8s %(message)s")
        for key, n in sorted(out["counters"].collect()):
            logging.info("%s %d", key, n)
    sinks.write_lines(sinks.cluster_gff(kept), f"{a.out}/clusters")
    head, lines = sinks.stats_lines(kept)
    sinks.write_lines(lines, a.cluster_stats or f"{a.out}/cluster_stats", head)
    if a.ccr:
        sinks.write_lines(sinks.peak_gff(kept, a.ccr), f"{a.out}/peaks")
    if a.track:
        tracks.coverage_track(P.not_ribosomal(out["reads"]), f"{a.out}/coverage", "w")
    sinks.write_lines(sinks.stat_block("conversion statistics", out["statistics"].drop("_"), "read alignments and edits", ["total", "reference", "decoy"], "rank"), a.stats or f"{a.out}/statistics", single=True)
    out["counters"].coalesce(1).write.mode("overwrite").csv(f"{a.out}/counters", sep="\t")


def fdr(spark: SparkSession, a: argparse.Namespace) -> None:
    kinds = {c: "float" for c in sinks.SCORES} | {"cid": "str", "decoy": "bool", "edits": "floatlist"}
    table = flat.read_flat(spark, a.stats, hints=kinds).drop("line_no")
    out, method = filter_clusters(table, a.cutoff, a.scale)
    sinks.write_verdicts(out, a.out, method)
    print(method)


def _features(spark: SparkSession, paths: list[str], fix_chr: bool = True, gene_names: str | None = None) -> DataFrame:
    """Loci of GFF files and gene tables; ``gene_names``: a file of transcript and gene names."""
    names = flat.read_flat(spark, gene_names, "## name:str\tgene:str").select("name", "gene") if gene_names else None
    out = None
    for p in paths:
        if p.endswith((".gff", ".gff3", ".gtf")):
            part = flat.gff_loci(flat.read_gff(spark, p, fix_chr), flat.gff_prefix(p.rsplit("/", 1)[-1]) or "transcript/noncoding")
        else:
            part = G.loci(G.transcripts(flat.read_genes(spark, p, fix_chr), names))
        out = part if out is None else out.unionByName(part)
    return out


def annotate(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = annotate_file(flat.read_gff(spark, a.gff), _features(spark, a.features), a.bounds)
    sinks.write_lines(sinks.gff_lines(rows), a.out)


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    sizes = flat.read_sizes(spark, a.sizes) if a.sizes else None
    sinks.write_annotation(build_annotation(_features(spark, a.features, not a.dont_fix_chr, a.gene_names), sizes), a.out)


def markov(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = R.markov(spark, flat.read_pair_counts(spark, a.pairs), a.length, a.seed)
    lines = chunks.orderBy("chunk").select(F.explode(F.expr("regexp_extract_all(seq, '(.{1,80})', 1)")).alias("value"))
    sinks.write_lines(lines, a.out, a.header or None)


def collapse(spark: SparkSession, a: argparse.Namespace) -> None:
    reads = sequences.read_fastq(spark, a.fastq).withColumn("line_no", F.col("record"))
    sinks.write_lines(sinks.fastq_lines(R.collapse(reads, a.lib).orderBy("rank")), a.out)


def threshold(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_lines(P.score_threshold(spark.read.text(a.table), [int(c) for c in a.columns.split(",")], [float(t) for t in a.thresholds.split(",")]), a.out)


def total(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_lines(P.column_sum(spark.read.text(a.table), [int(c) for c in a.columns.split(",")], a.name), a.out)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandflow", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *positional: str, **many: bool) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for x in positional:
            p.add_argument(x, nargs="+" if many.get(x) else None)
        p.add_argument("--out", required=True)
        p.set_defaults(run=run)
        return p

    p = command("clusters", clusters, "sam", sam=True)
    p.add_argument("--decoy", default="markov")
    p.add_argument("--mode", default="TC")
    p.add_argument("--groups", default="")
    p.add_argument("--min-reads", type=int, default=2)
    p.add_argument("--min-uniq", type=float, default=1)
    p.add_argument("--min-support", type=int, default=1)
    p.add_argument("--conv", type=float, default=1)
    p.add_argument("--require-conversions", action="store_true")
    p.add_argument("--unstranded", action="store_true")
    p.add_argument("--read-count", choices=["uniq", "lin", "arcsinh", "log"], default="uniq")
    p.add_argument("--mask", action="append")
    p.add_argument("--region")
    p.add_argument("--discard")
    p.add_argument("--ccr", type=int, default=0)
    p.add_argument("--track", action="store_true")
    p.add_argument("--stats", help="where the statistics go, else OUT/statistics")
    p.add_argument("--cluster-stats", help="where the cluster scores go, else OUT/cluster_stats")
    p.add_argument("--logfile")
    p = command("fdr", fdr, "stats")
    p.add_argument("--cutoff", type=float, default=0.05)
    p.add_argument("--scale", type=float, default=0.5)
    p = command("annotate", annotate, "gff", "features", features=True)
    p.add_argument("--bounds", choices=["off", "left", "right", "both"], default="off")
    p = command("build-annotation", build, "features", features=True)
    p.add_argument("--sizes")
    p.add_argument("--gene-names")
    p.add_argument("--dont-fix-chr", action="store_true")
    p = command("markov", markov, "pairs")
    p.add_argument("--length", type=int, default=1000)
    p.add_argument("--seed", type=int)
    p.add_argument("--header", default=">chrmarkov")
    command("collapse", collapse, "fastq", "lib")
    command("threshold", threshold, "table", "columns", "thresholds")
    p = command("sum", total, "table", "columns")
    p.add_argument("--name", default="sum")
    return top


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    spark = spark or session()
    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
