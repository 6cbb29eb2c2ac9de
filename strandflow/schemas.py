"""Schemas of the tables that the engine reads and makes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    """A schema from ``name type`` pairs; StructType.fromDDL would need a running session."""
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    kinds |= {f"array<{k}>": T.ArrayType(v) for k, v in kinds.items()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split() for f in text.split(", "))])


#: Sequencing alignments; positions are 0-based, intervals half-open.
ALIGNMENT = _struct("lib string, tid int, chrom string, pos long, cigar string, is_reverse boolean, qname string, query string, md string, mapq int, x0 int, x1 int, as_ int, xs int, pp double")
#: Columns of GFF files (fixed values).
GFF = _struct("chrom string, source string, type string, start long, end long, score string, sense string, frame string, attr_str string")
#: Columns of gene tables (fixed values).
UCSC_GENE = _struct("bin int, name string, chrom string, sense string, txStart long, txEnd long, cdsStart long, cdsEnd long, exonCount long, exonStarts array<long>, exonEnds array<long>, id string, name2 string, cdsStartStat string, cdsEndStat string, exonFrames array<long>")
CHROM_SIZES = _struct("chrom string, size long")
LOCUS = _struct("chrom string, sense string, start long, end long, path string, name string")
TRACK_RLE = _struct("chrom string, strand string, start long, end long, score double")
#: The reported scores of a cluster, in their fixed order (fixed values).
SCORES = ["uniq_reads", "n_reads", "n_conv_pos", "length", "max_uniq", "avg_uniq", "cum_uniq", "max_mapq", "avg_mapq", "cum_mapq", "max_pp", "avg_pp", "cum_pp", "conversion_score", "signature_density", "iclip_score", "profile_KL", "seq_entropy", "entropy_score", "edits"]
CLUSTER_STATS = _struct("cid string, decoy boolean, " + ", ".join(f"{c} double" for c in SCORES[:-1]) + ", edits array<double>")
#: Edit types in the order of the edits vector (fixed values).
EDITS = ["AC", "AG", "AT", "A_", "CA", "CG", "CT", "C_", "GA", "GC", "GT", "G_", "TA", "TC", "TG", "T_", "_A", "_C", "_G", "_T"]
