"""Queries over alignments with edits: CIGAR and MD of every row of lineitem, both strands, three libraries.

``RAW`` makes a read of every row: twelve bases of a repeating genome with nothing, one or two mismatches, a deletion or
an insertion in them (``kind``), written as CIGAR, MD and query.  The engine parses these; the SQL takes the edits from
the figures that the read was made with, so the two ways share no step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables as T
from ..operators import clusters as M
from ..operators import edits as E
from ..operators import fdr as D
from ..operators import filters as P
from ..operators import intervals as I
from ..schemas import EDITS, SCORES
from ..sources import sinks as K
from .queries import _table
from .registry import query

_GENOME = "ACGTTGCAAGCTCCGATTAGGCATCGTACCATGGATTCAGCGTAACTGTCTGAGACCTTGGCAA"
_TURN = "CASE b % 3 WHEN 0 THEN translate({x}, 'ACGT', 'CGTA') WHEN 1 THEN translate({x}, 'ACGT', 'GTAC') ELSE translate({x}, 'ACGT', 'TACG') END"
RAW = f"""SELECT *, CASE kind WHEN 2 THEN concat(k, 'M1D', 12 - k, 'M') WHEN 3 THEN concat(k, 'M1I', 12 - k, 'M') ELSE '12M' END AS cigar,
  CASE kind WHEN 1 THEN concat(k, x, 11 - k) WHEN 2 THEN concat(k, '^', x, 12 - k) WHEN 5 THEN concat(k, x, 1, x2, 9 - k) ELSE '12' END AS md,
  CASE kind WHEN 1 THEN concat(substr(r, 1, k), m, substr(r, k + 2, 11 - k)) WHEN 2 THEN concat(substr(r, 1, k), substr(r, k + 2, 12 - k))
    WHEN 3 THEN concat(substr(r, 1, k), y, substr(r, k + 1, 12 - k)) WHEN 5 THEN concat(substr(r, 1, k), m, substr(r, k + 2, 1), m2, substr(r, k + 4, 9 - k)) ELSE substr(r, 1, 12) END AS query,
  CAST(pos + CASE WHEN kind = 2 THEN 13 ELSE 12 END AS BIGINT) AS aend
FROM (SELECT *, {_TURN.format(x="x")} AS m, {_TURN.format(x="x2")} AS m2, substr('ACGT', b + 1, 1) AS y
FROM (SELECT *, substr(r, k + 1, 1) AS x, substr(r, k + 3, 1) AS x2
FROM (SELECT *, substr('{_GENOME * 2}', 1 + CAST((pos + tid) % 64 AS INT), 14) AS r
FROM (SELECT CAST(l_suppkey AS INT) AS tid, CASE WHEN l_suppkey % 10 = 0 THEN concat('chrmarkov_', l_suppkey) ELSE concat('chr', l_suppkey) END AS chrom,
  CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, concat('lib', l_linenumber % 3) AS lib, CAST(l_orderkey % 3000 AS BIGINT) AS pos,
  CAST(1 + l_partkey % 5 AS BIGINT) AS mult, concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_x', 1 + l_partkey % 5) AS qname, CAST(l_partkey % 256 AS INT) AS mapq,
  CAST(1 + l_linenumber % 2 AS INT) AS x0, CAST(l_partkey % 4 AS INT) AS x1, CAST(l_partkey % 6 AS INT) AS kind, CAST(1 + (l_orderkey + l_linenumber) % 9 AS INT) AS k, CAST((l_partkey + l_orderkey) % 4 AS INT) AS b FROM lineitem) s0) s1) s2) s3"""
KEYS = ["tid", "chrom", "strand", "island"]
ID = ["tid", "strand", "island"]


def raw(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(RAW.replace("FROM lineitem", "FROM {t}"), t=_table(spark, d, "lineitem"))


def aligned(spark: SparkSession, d: str) -> DataFrame:
    """Alignments as a reader gives them."""
    out = raw(spark, d).withColumns({"is_reverse": F.col("strand") == "-", "as_": F.lit(None).cast("int"), "xs": F.lit(None).cast("int"), "pp": F.lit(None).cast("double")})
    return out.drop("aend", "kind", "k", "b", "x", "x2", "m", "m2", "y", "r", "mult")


def clustered(spark: SparkSession, d: str, count: str = "lin") -> DataFrame:
    out = E.with_edits(aligned(spark, d)).withColumns({"strand": F.when(F.col("is_reverse"), "-").otherwise("+"), "w": E.weight(F.col("qname"), count)})
    # what no score reads is not carried along
    return I.islands(out.drop("cigar", "md", "query", "is_reverse", "alen"), ["tid", "chrom", "strand"], ties=["qname"], width=512)


_W = "PARTITION BY tid, strand ORDER BY pos, aend, qname"
READS_SQL = f"""rd AS (SELECT *, CAST(mult AS DOUBLE) AS w FROM ({RAW}) t), mx AS (
  SELECT *, max(aend) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM rd
), isl AS (
  SELECT *, CAST(sum(CASE WHEN prev IS NULL OR pos > prev THEN 1 ELSE 0 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM mx
), ed0 AS (
  SELECT tid, chrom, strand, island, lib, qname, pos, w, unnest(CASE kind WHEN 1 THEN [{{'o': k, 'e': x || m}}] WHEN 2 THEN [{{'o': k, 'e': x || '_'}}] WHEN 3 THEN [{{'o': k, 'e': '_' || y}}] WHEN 5 THEN [{{'o': k, 'e': x || m}}, {{'o': k + 2, 'e': x2 || m2}}] ELSE [] END) AS u FROM isl
), ed AS (
  SELECT tid, chrom, strand, island, lib, qname, w, pos + u.o AS p, u.o AS o, u.e AS raw, CASE WHEN strand = '-' THEN translate(u.e, 'ACGT', 'TGCA') ELSE u.e END AS edit FROM ed0
)"""
_G = "tid, chrom, strand, island"


@query(f"WITH {READS_SQL} SELECT qname, lib, CAST(o AS INT) AS off, raw AS edit, count(*) AS n FROM ed GROUP BY ALL")
def f7_edits_whole(spark, d):
    """Edits of every alignment, from CIGAR and MD."""
    return E.each_edit(E.with_edits(aligned(spark, d)), "qname", "lib").groupBy("qname", "lib", F.col("e.off").cast("int").alias("off"), "e.edit").agg(F.count("*").alias("n"))


@query(f"WITH {READS_SQL} SELECT qname, lib, CAST(o AS INT) AS off, raw AS edit, count(*) AS n FROM ed GROUP BY ALL")
def f7_edit_function(spark, d):
    """F6, F7, section 2.14: the edits of every alignment by a table function in SQL text."""
    T.register(spark)
    return spark.sql("SELECT a.qname, a.lib, e.off, e.edit, count(*) AS n FROM {a} a, LATERAL alignment_edits(a.cigar, a.md, a.query) e GROUP BY ALL", a=aligned(spark, d))


@query(f"WITH {READS_SQL} SELECT count_function, lib, round(sum(v), 3) AS total FROM (SELECT lib, unnest([{{'c': 'uniq', 'v': 1.0::DOUBLE}}, {{'c': 'lin', 'v': w}}, {{'c': 'log', 'v': log2(w)}}, {{'c': 'arcsinh', 'v': ln(w + sqrt(w * w + 1))}}]) AS s FROM rd) t, LATERAL (SELECT s.c AS count_function, s.v AS v) GROUP BY ALL")
def a6_weights(spark, d):
    """Multiplicities under all count functions."""
    items = F.array(*[F.struct(F.lit(c).alias("c"), E.weight(F.col("qname"), c).alias("v")) for c in E.COUNT_FUNCTIONS])
    return aligned(spark, d).select("lib", F.explode(items).alias("s")).groupBy(F.col("s.c").alias("count_function"), "lib").agg(F.round(F.sum("s.v"), 3).alias("total"))


_STATS = f"""st AS (SELECT {_G}, unnest(['total', CASE kind WHEN 0 THEN 'perfect' WHEN 4 THEN 'perfect' WHEN 5 THEN '2_edit' ELSE '1_edit' END]) AS key, w FROM isl UNION ALL SELECT {_G}, edit, w FROM ed)"""


@query(f"WITH {READS_SQL}, {_STATS} SELECT tid, strand, island, key, sum(w) AS value FROM st GROUP BY ALL")
def a7_edit_statistics(spark, d):
    r = clustered(spark, d)
    return M.read_statistics(r, KEYS).select(*ID, "key", "value")


@query(f"WITH {READS_SQL} SELECT tid, strand, island, CAST(count(DISTINCT lib) AS INT) AS read_support, CAST(count(DISTINCT CASE WHEN edit = 'TC' THEN lib END) AS INT) AS sig_support, CAST(count(DISTINCT CASE WHEN lib = 'lib0' AND edit = 'GA' OR lib <> 'lib0' AND edit IN ('TC', 'T_') THEN lib END) AS INT) AS mixed_support FROM ed GROUP BY tid, strand, island")
def a8_supports(spark, d):
    """Libraries with edits and with signature edits, under the default mode and under modes by library."""
    rows = E.edit_rows(clustered(spark, d), KEYS)
    return M.supports(rows, KEYS, {}, {"lib0": "GA", "*": "TC"}).select(*ID, "read_support", "sig_support", F.col("sig_support_1").alias("mixed_support"))


@query(f"WITH {READS_SQL} SELECT tid, strand, island, CAST(p AS BIGINT) AS pos, sum(w) AS value FROM ed WHERE edit = 'TC' GROUP BY ALL")
def a9_signature_profile(spark, d):
    r = clustered(spark, d)
    return M.signature_profile(r, E.edit_rows(r, KEYS), KEYS, {}, ["pos", "qname"]).select(*ID, "pos", "value")


@query(f"""WITH {READS_SQL}, s AS (SELECT tid, strand, island, CAST(p AS BIGINT) AS pos, sum(w) AS value FROM ed WHERE edit = 'TC' AND lib <> 'lib1' GROUP BY ALL),
e AS (SELECT tid, strand, island, CASE WHEN strand = '-' THEN aend - 1 ELSE pos END AS pos, arg_max(w, struct_pack(a := pos, b := qname)) AS value FROM isl GROUP BY 1, 2, 3, 4)
SELECT tid, strand, island, pos, coalesce(e.value, s.value) AS value FROM s FULL JOIN e USING (tid, strand, island, pos)""")
def a9_iclip_profile(spark, d):
    """A9 with a library of mode iclip: 5' ends overwrite the profile."""
    r = clustered(spark, d)
    return M.signature_profile(r, E.edit_rows(r, KEYS), KEYS, {"lib1": "iclip"}, ["pos", "qname"]).select(*ID, "pos", "value")


_NUC = f"""nm AS (SELECT tid, strand, island, p, base, sum(v) AS value FROM (
  SELECT tid, strand, island, pos + i AS p, substr(r, CAST(i AS INT) + 1, 1) AS base, w AS v FROM isl, range(0, 13) t(i) WHERE pos + i < aend UNION ALL
  SELECT tid, strand, island, p, substr(edit, 1, 1), -w FROM ed WHERE edit NOT LIKE '%!_%' ESCAPE '!' UNION ALL
  SELECT tid, strand, island, p, substr(edit, 2, 1), w FROM ed WHERE edit NOT LIKE '%!_%' ESCAPE '!') GROUP BY ALL)"""


@query(f"WITH {READS_SQL}, {_NUC} SELECT tid, strand, island, CAST(p AS BIGINT) AS pos, base, value FROM nm")
def a14_nucleotides(spark, d):
    r = clustered(spark, d)
    return M.nucleotides(r, KEYS, ["pos", "qname"]).select(*ID, "pos", "base", "value")


def _ends(at: str, name: str) -> str:
    return f"{name} AS (SELECT tid, strand, island, -sum(p * log2(p)) AS e FROM (SELECT tid, strand, island, sum(w) / sum(sum(w)) OVER (PARTITION BY tid, strand, island) AS p FROM isl GROUP BY tid, strand, island, {at}) GROUP BY ALL)"


SCORES_SQL = f"""{READS_SQL}, {_NUC}, {_ends("CASE WHEN strand = '-' THEN aend ELSE pos END", "e5")}, {_ends("CASE WHEN strand = '-' THEN pos ELSE aend END", "e3")},
en AS (SELECT tid, strand, island, -sum(q * log2(q)) AS seq_entropy FROM (SELECT tid, strand, island, value / sum(value) OVER (PARTITION BY tid, strand, island, p) AS q FROM nm WHERE value > 0) GROUP BY ALL),
ev AS (SELECT tid, strand, island, pos AS p, w AS d FROM isl UNION ALL SELECT tid, strand, island, aend, -w FROM isl), dl AS (SELECT tid, strand, island, p, sum(d) AS d FROM ev GROUP BY ALL),
cv AS (SELECT tid, strand, island, lead(p) OVER c - p AS n, sum(d) OVER (c ROWS UNBOUNDED PRECEDING) AS v FROM dl WINDOW c AS (PARTITION BY tid, strand, island ORDER BY p)),
sh AS (SELECT *, v / sum(n * v) OVER (PARTITION BY tid, strand, island) AS q, sum(n) OVER (PARTITION BY tid, strand, island) AS l FROM cv WHERE n IS NOT NULL AND v > 0), kl AS (SELECT tid, strand, island, sum(n * q * log2(l * q)) AS profile_KL FROM sh GROUP BY ALL),
sp AS (SELECT tid, strand, island, p, sum(w) AS v FROM ed WHERE edit = 'TC' GROUP BY ALL),
sg AS (SELECT tid, strand, island, sum(v) AS conversion_score, CAST(count_if(v > 0) AS DOUBLE) AS n_conv_pos, CAST(arg_max(p, struct_pack(a := v, b := -p)) AS BIGINT) AS peak FROM sp GROUP BY ALL),
su AS (SELECT tid, strand, island, CAST(count(DISTINCT lib) AS INT) AS read_support, CAST(count(DISTINCT CASE WHEN edit = 'TC' THEN lib END) AS INT) AS sig_support, [{", ".join(f"coalesce(sum(w) FILTER (edit = '{e}'), 0.0)" for e in EDITS)}] AS edits FROM ed GROUP BY tid, strand, island),
ms AS (SELECT tid, chrom, strand, island, sum(w) AS n_reads, count(*) AS uniq_reads, min(pos) AS start, max(aend) AS "end", max(aend) - min(pos) AS length, sum(w * u) AS cum_uniq, max(u) AS max_uniq, sum(w * u) / sum(w) AS avg_uniq,
  sum(w * mapq) AS cum_mapq, CAST(max(mapq) AS DOUBLE) AS max_mapq, sum(w * mapq) / sum(w) AS avg_mapq, sum(w) * 0.5 AS cum_pp, 0.5::DOUBLE AS max_pp, 0.5::DOUBLE AS avg_pp FROM (SELECT *, CASE WHEN x0 = 1 THEN 255.0::DOUBLE / (x1 + 1) ELSE 0.0::DOUBLE END AS u FROM isl) GROUP BY 1, 2, 3, 4),
cs0 AS (SELECT ms.*, coalesce(conversion_score, 0) AS conversion_score, coalesce(n_conv_pos, 0) AS n_conv_pos, coalesce(peak, start) AS peak, coalesce(read_support, 0) AS read_support, coalesce(sig_support, 0) AS sig_support,
  coalesce(edits, list_transform(range(0, 20), lambda i: 0.0)) AS edits, e5.e AS entropy_5p, e3.e AS entropy_3p, coalesce(profile_KL, 0) AS profile_KL, coalesce(seq_entropy, 0) AS seq_entropy
  FROM ms JOIN e5 USING (tid, strand, island) JOIN e3 USING (tid, strand, island) LEFT JOIN kl USING (tid, strand, island) LEFT JOIN en USING (tid, strand, island) LEFT JOIN sg USING (tid, strand, island) LEFT JOIN su USING (tid, strand, island)),
cs AS (SELECT *, conversion_score / n_reads AS signature_density, (entropy_3p + 2.0 / (n_reads + 1)) / (entropy_5p + 2.0 / (n_reads + 1)) AS iclip_score, profile_KL + 0.1 * (1 - 10.0 / (10.0 + n_reads)) * seq_entropy AS entropy_score, regexp_matches(chrom, 'markov') AS decoy FROM cs0)"""
_NUMBERS = [c for c in SCORES[:-1] if c not in ("uniq_reads", "length")]


def scored(spark: SparkSession, d: str) -> DataFrame:
    out = M.score_clusters(clustered(spark, d), KEYS, ties=["pos", "qname"])
    return out.withColumns({"decoy": P.is_decoy(F.col("chrom")), "cid": F.concat_ws(":", "tid", "strand", "island")})


@query(f"""WITH {SCORES_SQL} SELECT tid, strand, island, CAST(uniq_reads AS BIGINT) AS uniq_reads, CAST(length AS BIGINT) AS length, {", ".join(f"round({c}, 3) + 0.0 AS {c}" for c in _NUMBERS)}, peak, read_support, sig_support,
array_to_string(list_transform(edits, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS edits FROM cs""")
def a26_cluster_scores(spark, d):
    """Every reported score of every cluster."""
    c = scored(spark, d)
    edits = F.array_join(F.transform("edits", lambda x: x.cast("long").cast("string")), ",")
    return c.select(*ID, "uniq_reads", "length", *[(F.round(x, 3) + 0.0).alias(x) for x in _NUMBERS], "peak", "read_support", "sig_support", edits.alias("edits"))


_GLOBAL = "CASE WHEN strand = '-' AND length(key) = 2 THEN translate(key, 'ACGT', 'TGCA') ELSE key END"
_EVENTS = ", ".join(f"({i}, '{e}', '{P.event_name(e)}')" for i, e in enumerate(P.EVENTS))


@query(f"""WITH {READS_SQL}, {_STATS}, gs AS (SELECT {_GLOBAL} AS k, sum(w) AS total, coalesce(sum(w) FILTER (NOT regexp_matches(chrom, 'markov')), 0) AS reference, coalesce(-sum(w) FILTER (regexp_matches(chrom, 'markov')), 0) AS decoy FROM st GROUP BY 1)
SELECT rank, event, coalesce(total, 0) AS total, coalesce(reference, 0) AS reference, coalesce(decoy, 0) AS decoy FROM (VALUES {_EVENTS}) v(rank, k, event) LEFT JOIN gs USING (k)""")
def a27_statistics_whole(spark, d):
    """Statistics over all clusters."""
    r = clustered(spark, d)
    return P.global_statistics(M.read_statistics(r, KEYS).withColumn("decoy", P.is_decoy(F.col("chrom"))))


@query(f"""WITH {SCORES_SQL} SELECT tid, strand, island, CASE WHEN uniq_reads < 2 THEN 'discarded_few_reads' WHEN conversion_score < 1 THEN 'discarded_few_conversions' WHEN max_uniq < 1 THEN 'discarded_non_uniq'
WHEN read_support < 2 THEN 'discarded_insuff_read_support' WHEN sig_support < 2 THEN 'discarded_insuff_conversion_support' END AS reason FROM cs""")
def p9_require_conversions(spark, d):
    """P5-P9 with required signature support."""
    return scored(spark, d).select(*ID, P.discard_reason(min_support=2, require_conversions=True).alias("reason"))


def _at(*names: str) -> str:
    return " + ".join(f"edits[{EDITS.index(n) + 1}]" for n in names)


_DEL, _INS = [f"{b}_" for b in "ACGT"], [f"_{b}" for b in "ACGT"]
_METHODS = {
    "signature": "conversion_score", "iclip": "iclip_score", "sig_density": "conversion_score / n_reads", "sig_density_pseudo": "(0.04 + conversion_score + 1) / (n_reads + 2 + 0.04)", "length": "length", "entropy": "entropy_score",
    "4su": _at("TC", "T_"), "6sg": _at("GA", "G_"), "4su_density": f"({_at('TC', 'T_')}) / n_reads", "6sg_density": f"({_at('GA', 'G_')}) / n_reads", "indels": _at(*_DEL, *_INS), "deletions": _at(*_DEL), "all_edits": "list_sum(edits)",
    "n_reads": "n_reads", "cum_uniq": "cum_uniq", "avg_mapq": "avg_mapq", "max_pp": "max_pp", "n_best": "0", "n_uniq": "0", "uniqness": "0", "best_mapq": "0", "mean_pp": "0", "median_pp": "0",
}
_SCORE_ROWS = ", ".join(f"{{'m': '{m}', 'v': CAST({x} AS DOUBLE)}}" for m, x in _METHODS.items())


@query(f"WITH {SCORES_SQL} SELECT s.m AS method, decoy, count(*) AS n, round(sum(s.v), 2) + 0.0 AS total, round(max(s.v), 4) + 0.0 AS most FROM (SELECT decoy, unnest([{_SCORE_ROWS}]) AS s FROM cs) GROUP BY ALL")
def f20_scores(spark, d):
    """all scoring functions over all clusters."""
    s = D.score_table(scored(spark, d))
    return s.groupBy("method", "decoy").agg(F.count("*").alias("n"), (F.round(F.sum("value"), 2) + 0.0).alias("total"), (F.round(F.max("value"), 4) + 0.0).alias("most"))


@query(f"""WITH {SCORES_SQL} SELECT chrom || chr(9) || 'strandflow' || chr(9) || 'ccr' || chr(9) || (peak + 1 - 20) || chr(9) || (peak + 1 + 20) || chr(9) || CAST(conversion_score AS VARCHAR) || chr(9) || strand || chr(9) || '.' || chr(9) || 'name="' || tid || ':' || strand || ':' || island || '";' AS value FROM cs""")
def k2_peak_lines(spark, d):
    """Regions around the peaks as GFF lines."""
    return K.peak_gff(scored(spark, d), 20)


@query(f"""WITH {SCORES_SQL} SELECT chrom || chr(9) || 'strandflow' || chr(9) || 'cluster' || chr(9) || (start + 1) || chr(9) || "end" || chr(9) || CAST(conversion_score AS VARCHAR) || chr(9) || strand || chr(9) || CAST(round(entropy_score, 3) + 0.0 AS VARCHAR) || chr(9)
|| 'name="' || tid || ':' || strand || ':' || island || '"; n_reads="' || CAST(n_reads AS VARCHAR) || '"; n_uniq="' || uniq_reads || '"; ccr="' || (peak + 1) || '";' AS value FROM cs""")
def k1_cluster_lines(spark, d):
    """Clusters as GFF lines."""
    return K.cluster_gff(scored(spark, d).withColumn("entropy_score", F.round("entropy_score", 3) + 0.0))


_CELLS = ", ".join(f"CAST({c} AS VARCHAR)" if c in ("uniq_reads", "length") else f"CAST(round({c}, 3) + 0.0 AS VARCHAR)" for c in SCORES[:-1])


@query(f"WITH {SCORES_SQL} SELECT concat_ws(chr(9), concat(tid, ':', strand, ':', island), CASE WHEN decoy THEN 'True' ELSE 'False' END, {_CELLS}, array_to_string(list_transform(edits, lambda x: CAST(CAST(x AS DOUBLE) AS VARCHAR)), ',')) AS value FROM cs")
def k3_stats_lines(spark, d):
    """K3: cluster statistics as lines."""
    c = scored(spark, d)
    return K.stats_lines(c.withColumns({n: F.round(n, 3) + 0.0 for n in _NUMBERS}))[1]


@query(f"SELECT c AS chrom, count(*) AS n FROM (SELECT CASE WHEN tid % 7 = 0 THEN concat('rRNA_', tid) ELSE chrom END AS c FROM ({RAW}) t) WHERE c NOT LIKE 'rRNA%' GROUP BY c")
def p3_not_ribosomal(spark, d):
    """Every seventh chromosome is a ribosomal one."""
    r = raw(spark, d).withColumn("chrom", F.when(F.col("tid") % 7 == 0, F.concat(F.lit("rRNA_"), "tid")).otherwise(F.col("chrom")))
    return P.not_ribosomal(r).groupBy("chrom").agg(F.count("*").alias("n"))
