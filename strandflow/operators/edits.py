"""Edit parsing: CIGAR and MD strings to edits, weights, strand-corrected statistics and profiles.

The walks are folds over token arrays with higher-order functions; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import strand_edit

_INS = "array<struct<off:int,edit:string>>"
#: How a read's multiplicity counts.
COUNT_FUNCTIONS = {"lin": lambda m: m.cast("double"), "uniq": lambda m: F.lit(1.0), "arcsinh": lambda m: F.asinh(m.cast("double")), "log": lambda m: F.log2(m.cast("double"))}
#: Edit types that a signature's name stands for (fixed values).  A test by name itself is a substring test.
SIGNATURES = {"TC": ("TC", "T_"), "GA": ("GA", "G_"), "hits": (), "iclip": ()}


def multiplicity(qname: Column) -> Column:
    """The number after ``_x`` at the end of a read's name, or null."""
    text = F.regexp_extract(qname, r"_x(\d+)$", 1)
    return F.when(text != "", text.cast("long"))


def weight(qname: Column, count: str = "uniq") -> Column:
    """Without a suffix a read weighs 1 whatever the count function."""
    m = multiplicity(qname)
    return F.when(m.isNull(), F.lit(1.0)).otherwise(COUNT_FUNCTIONS[count](m))


# SQL of the walks: operations of the CIGAR; insertions, and the query without them, over ``_ops``; the reference over ``_walk``.
# Tokens of MD are numbers (below ':'), letters or ^letters.
OPS = r"""transform(regexp_extract_all(cigar, '(\\d+)([A-Z])', 0), t -> struct(CAST(left(t, length(t) - 1) AS INT) AS n, right(t, 1) AS op))"""
#: Reference bases of the CIGAR, by themselves: who reads places alone needs no walk.
LENGTH = "aggregate(_ops, 0, (s, x) -> s + CASE WHEN x.op IN ('M', 'D') THEN x.n ELSE 0 END)"
WALK = f"""
        aggregate(_ops, struct(0 AS j, query AS seq, CAST(array() AS {_INS}) AS ins, 0 AS alen), (s, x) -> CASE
          WHEN x.op = 'M' THEN struct(s.j + x.n AS j, s.seq AS seq, s.ins AS ins, s.alen + x.n AS alen)
          WHEN x.op = 'D' THEN struct(s.j AS j, s.seq AS seq, s.ins AS ins, s.alen + x.n AS alen)
          WHEN x.op = 'I' THEN struct(s.j AS j, concat(substring(s.seq, 1, s.j), substring(s.seq, s.j + x.n + 1)) AS seq,
            concat(s.ins, transform(sequence(1, x.n), k -> struct(s.j AS off, concat('_', substring(s.seq, s.j + k, 1)) AS edit))) AS ins, s.alen AS alen)
          ELSE s END)"""
MD = r"""
        aggregate(regexp_extract_all(md, '(\\d+|[A-Z]|\\^[A-Z]+)', 1), struct(0 AS j, _walk.seq AS seq, CAST(array() AS {_INS}) AS edits), (s, t) -> CASE
          WHEN t < ':' THEN struct(s.j + CAST(t AS INT) AS j, s.seq AS seq, s.edits AS edits)
          WHEN t LIKE '^%' THEN struct(s.j + length(t) - 1 AS j, concat(substring(s.seq, 1, s.j), substring(t, 2), substring(s.seq, s.j + 1)) AS seq,
            concat(s.edits, transform(sequence(2, length(t)), k -> struct(s.j + k - 2 AS off, concat(substring(t, k, 1), '_') AS edit))) AS edits)
          ELSE struct(s.j + 1 AS j, concat(substring(s.seq, 1, s.j), t, substring(s.seq, s.j + 2)) AS seq,
            concat(s.edits, array(struct(s.j AS off, concat(t, substring(s.seq, s.j + 1, 1)) AS edit))) AS edits) END)""".replace("{_INS}", _INS)


def with_edits(aln: DataFrame) -> DataFrame:
    """Adds edits (array of struct<off, edit>, offsets from pos on the reference), n_edits, alen, pend and ref (the
    reference slice).  Clips are skipped; alignments with N, = or X in the CIGAR are dropped.

    Deletions do not move the offset of a later insertion: an insertion's offset counts aligned read bases only.
    """
    out = aln.where(~F.col("cigar").rlike("[N=X]"))
    out = out.withColumn("_ops", F.expr(OPS)).withColumn("_walk", F.expr(WALK)).withColumn("_md", F.expr(MD))
    out = out.withColumns({"edits": F.concat("_walk.ins", "_md.edits"), "alen": F.expr(LENGTH), "ref": F.col("_md.seq")})
    return out.withColumns({"n_edits": F.size("edits"), "pend": F.col("pos") + F.col("alen")}).drop("_ops", "_walk", "_md")


def each_edit(reads: DataFrame, *cols: str) -> DataFrame:
    """One row per edit: ``cols`` and e.  Before a plain explode Spark filters the reads by the number of their edits, and
    puts the walks of with_edits into that filter, three times over; an outer one has none."""
    return reads.select(*cols, F.explode_outer("edits").alias("e")).where("e IS NOT NULL")


def edit_rows(reads: DataFrame, keys: list[str]) -> DataFrame:
    """One row per edit: keys, lib, pos (on the reference), edit (as on the strand), w."""
    out = each_edit(reads, *keys, "lib", "strand", "pos", "w")
    return out.select(*keys, "lib", (F.col("pos") + F.col("e.off")).alias("pos"), strand_edit(F.col("e.edit"), F.col("strand")).alias("edit"), "strand", "w")


def is_signature(edit: Column, lib: Column, modes: dict[str, str]) -> Column:
    """An edit belongs to its library's mode if it is a substring of the mode's name; libraries without a mode take the
    events of mode ``*``, or TC."""
    if "*" in modes:
        events = SIGNATURES[modes["*"]]
        rest = edit.isin(*events) if events else F.lit(False)
    else:
        rest = F.lit("TC").contains(edit)
    out = None
    for name, mode in modes.items():
        if name != "*":
            cond = F.lit(mode).contains(edit)
            out = F.when(lib == name, cond) if out is None else out.when(lib == name, cond)
    return rest if out is None else out.otherwise(rest)


def library_modes(libs: list[str], modes: list[str]) -> dict[str, str]:
    """Modes paired with libraries by place; libraries beyond them take the default."""
    return dict(zip(libs, modes, strict=False))
