"""The three life cycles: alignments to clusters, clusters to filtered clusters, features to annotation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clusters as M
from ..operators import edits as E
from ..operators import fdr as D
from ..operators import filters as P
from ..operators import intervals as I
from ..operators.annotate import annotate_gff


@dataclass
class ClusterOptions:
    """Settings of find_clusters, with their usual defaults."""

    decoy_flag: str = "markov"
    modes: list[str] = field(default_factory=lambda: ["TC"])
    groups: list[str] = field(default_factory=list)
    min_reads: int = 2
    min_conv: float = 1
    min_uniq: float = 1
    min_support: int = 1
    require_conversions: bool = False
    count: str = "uniq"
    stranded: bool = True
    masks: list[str] = field(default_factory=list)
    region: tuple[str, int, int] | None = None


def find_clusters(sources: list[DataFrame], options: ClusterOptions | None = None, discard: DataFrame | None = None) -> dict[str, DataFrame]:
    """Alignment tables (schemas.ALIGNMENT) to clusters (all, with reason, decoy and cid), kept, counters and statistics."""
    o = options or ClusterOptions()
    libs = o.groups or [f"lib{i}" for i in range(len(sources))]
    named = [s.withColumn("lib", F.lit(g)) if o.groups else s for s, g in zip(sources, libs, strict=True)]
    aln = I.merge_sources(*named)
    reads = E.with_edits(aln)
    if o.region:
        reads = P.region(reads, *o.region)
    strand = F.when(F.col("is_reverse"), "-").otherwise("+") if o.stranded else F.lit("*")
    reads = reads.withColumns({"strand": strand, "w": E.weight(F.col("qname"), o.count)})
    ties = ["lib", "qname"]
    reads = I.islands(reads, ["tid", "chrom", "strand"], ties=ties)
    keys = ["tid", "chrom", "strand", "island"]
    modes = E.library_modes(libs, o.modes)
    table = M.score_clusters(reads, keys, modes, ["pos", *ties])
    cids = I.number_clusters(reads, ties=ties)
    table = P.not_ribosomal(table.join(cids, ["tid", "strand", "island"])).withColumn("decoy", P.is_decoy(F.col("chrom"), o.decoy_flag))
    marks: dict[str, str] = {}
    if discard is not None:
        free = P.not_under(table, discard, ["chrom", "strand"]).select("cid", F.lit(False).alias("tracked"))
        table = table.join(free, "cid", "left").withColumn("tracked", F.coalesce("tracked", F.lit(True)))
        marks["tracked_col"] = "tracked"
    if o.masks:
        masks = table.sparkSession.createDataFrame(P.parse_masks(o.masks), "chrom string, start long, end long")
        free = P.masked(table, masks).select("cid", F.lit(False).alias("under_mask"))
        table = table.join(free, "cid", "left").withColumn("under_mask", F.coalesce("under_mask", F.lit(True)))
        marks["masked_col"] = "under_mask"
    table = table.withColumn("reason", P.discard_reason(o.min_reads, o.min_conv, o.min_uniq, o.min_support, o.require_conversions, **marks))
    stats = M.edit_statistics(reads, E.edit_rows(reads, keys), keys).join(table.select(*keys, "decoy"), keys)
    return {"clusters": table, "kept": table.where("reason IS NULL"), "counters": P.stage_counters(table), "statistics": P.global_statistics(stats), "reads": reads}


def filter_clusters(clusters: DataFrame, max_fdr: float = 0.05, scale: float = 0.5, pairs_with: tuple[str, ...] = ("n_reads", "signature")) -> tuple[DataFrame, str]:
    """Clusters with verdict, and the method.  If the whole set is within the limit nothing is filtered; else the best
    single or paired cutoff is; without any, every reference row is a low score."""
    first = D.unfiltered_fdr(clusters, scale).first()
    if not first or first["n"] == 0:
        return clusters.withColumn("verdict", F.lit("kept")), "none"
    if first["fdr"] <= max_fdr:
        return D.verdicts(clusters.withColumn("_all", F.lit(True)), ["n_reads"], [float("-inf")]).drop("_all"), "unfiltered"
    scores = D.score_table(clusters)
    single = D.cutoffs(scores, max_fdr, scale)
    names = list(D.SCORING)
    pairs = [(a, b) for a in pairs_with for b in names if a != b]
    best = D.rank_methods(single, D.pair_cutoffs(clusters, pairs, max_fdr, scale, single)).first()
    if best is None:
        return D.verdicts(clusters, [], []), "none"
    return D.verdicts(clusters, list(best["methods"]), list(best["bp"])), "&".join(best["methods"])


def build_annotation(loci: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Compiled annotation: segments with their feature combination by chromosome and strand."""
    if sizes is not None:
        loci = P.known_chromosomes(loci, sizes)
    return I.compressed(loci, ["chrom", "sense"])


def annotate_file(gff: DataFrame, loci: DataFrame, bounds: str = "off") -> DataFrame:
    return annotate_gff(gff, loci, bounds)
