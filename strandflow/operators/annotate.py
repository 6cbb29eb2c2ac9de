"""Annotation of intervals with sense and antisense features, and counts over feature paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.sequence import flip
from ..scratch import settle
from .intervals import JOIN_BIN, near, range_join


def _places(loci: DataFrame) -> DataFrame:
    """Loci of one place and path as one row with their features and elements: each text is made once, not once a hit."""
    root = F.element_at(F.split("path", "/"), 1)
    path = F.regexp_replace("path", "/+$", "")
    by = loci.groupBy("chrom", F.col("sense").alias("_ls"), F.col("start").alias("r_start"), F.col("end").alias("r_end"), "path")
    out = by.agg(F.collect_set(F.concat_ws("/", root, "name")).alias("_features"), F.collect_set(F.concat_ws("/", path, F.col("name"))).alias("_elements"))
    return out.withColumn("_classes", F.array(path)).drop("path")


def _features(hits: DataFrame, keys: list[str], same: Column, other: Column) -> DataFrame:
    """Sorted sets of the classes, features and elements over each place, on both strands in one pass."""
    every = lambda strand, c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(strand, F.filter(f"_{c}", lambda x: x.isNotNull()))))))
    return hits.groupBy(*keys).agg(*[every(strand, c).alias(f"{p}{c}") for p, strand in (("", same), ("as_", other)) for c in ("classes", "features", "elements")])


def _with_kinds(out: DataFrame) -> DataFrame:
    """Adds ``antisense`` to the classes under an antisense transcript, and ``intergenic`` where there is none."""
    anti = F.exists("as_classes", lambda c: c.startswith("transcript"))
    classes = F.when(anti, F.array_sort(F.array_union("classes", F.array(F.lit("antisense"))))).otherwise(F.col("classes"))
    return out.withColumn("classes", F.when(F.size(classes) == 0, F.array(F.lit("intergenic"))).otherwise(classes))


def annotate(intervals: DataFrame, loci: DataFrame, id_col: str = "id", start: str = "start", end: str = "end", sense: str = "sense", width: int = JOIN_BIN) -> DataFrame:
    """Adds classes, as_classes, features, as_features, elements and as_elements (sorted arrays).

    ``loci`` have chrom, sense, start, end, path and name.  Both strands come from one range join on the chromosome; an
    antisense transcript adds class ``antisense``, and no class at all gives ``intergenic``.  ``id_col`` is the intervals'
    key; what lies over a place is found once, however many of them share it.
    """
    place = ["chrom", "_s", "_start", "_end"]
    left = intervals.select("chrom", F.col(sense).alias("_s"), F.col(start).alias("_start"), F.col(end).alias("_end")).distinct()
    hits = range_join(left, _places(loci), ["chrom"], ls="_start", le="_end", width=width)
    found = _features(hits, place, F.col("_ls") == F.col("_s"), F.col("_ls") == flip(F.col("_s"))).withColumnRenamed("chrom", "_chrom")
    at = reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in (("chrom", "_chrom"), (sense, "_s"), (start, "_start"), (end, "_end"))])
    out = intervals.join(found, at, "left").drop("_chrom", "_s", "_start", "_end")
    none = F.array().cast("array<string>")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("classes", "features", "elements", "as_classes", "as_features", "as_elements")})
    return _with_kinds(out)


def attribute_string(prefix: str = "") -> Column:
    """CLASSES, AS_CLASSES, SENSE and ANTISENSE as an attribute string; the prefix goes before each key only."""
    join = lambda c: F.concat_ws(",", c)
    parts = [("CLASSES", X.compact_classes(join("classes"))), ("AS_CLASSES", X.compact_classes(join("as_classes"))), ("SENSE", X.compact_features(join("features"))), ("ANTISENSE", X.compact_features(join("as_features")))]
    return F.concat_ws(" ", *[F.concat(F.lit(f'{prefix}{k}="'), v, F.lit('";')) for k, v in parts])


#: Rows of a place that get their text together.
LOT = 1000


def annotate_gff(gff: DataFrame, loci: DataFrame, bounds: str = "off", width: int = JOIN_BIN) -> DataFrame:
    """GFF rows (1-based) with annotation appended to attr_str; bounds: off, left, right or both adds the three bases
    around the interval's ends, left and right swapped on -."""
    place, minus, names = ["chrom", "sense", "start", "end"], F.col("sense") == "-", {"": (F.col("start") - 1, F.col("end"))}
    for side in ("LEFT", "RIGHT"):
        if bounds in (side.lower(), "both"):
            s = F.when(minus if side == "RIGHT" else ~minus, F.col("start") - 2).otherwise(F.col("end") - 2)
            names[f"{side}_"] = (s, s + 3)
    # texts are made once for many rows of a place, where they are used: they may be long, and no one of them is shuffled
    rest = [c for c in gff.columns if c not in place]
    lot = F.floor(F.row_number().over(Window.partitionBy(*place).orderBy(*place)) / LOT)
    rows = gff.withColumn("_lot", lot).groupBy(*place, "_lot").agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    ends = [c for w in names.values() for c in w]
    rows = rows.withColumns({"_lo": F.least(*ends), "_hi": F.greatest(*ends)})
    out = near(rows, settle(_places(loci).drop("_elements"), "loci"), ["chrom"], "_lo", "_hi", width=width)
    over = lambda w, strand: F.coalesce(F.filter("near", lambda x: (x["r_start"] < w[1]) & (x["r_end"] > w[0]) & (x["_ls"] == strand)), F.array())
    sides = {"": F.col("sense"), "as_": flip(F.col("sense"))}
    out = out.select(*place, "_rows", *[over(w, strand).alias(f"_h_{k}{p}") for k, w in names.items() for p, strand in sides.items()])
    sets = lambda x: F.sort_array(F.array_distinct(F.flatten(x)))
    for k in names:
        for p in sides:
            hits = f"_h_{k}{p}"
            out = out.withColumns({f"{p}classes": F.filter(sets(f"{hits}._classes"), lambda c: c.isNotNull()), f"{p}features": sets(f"{hits}._features")}).drop(hits)
        out = _with_kinds(out).withColumn(f"_a_{k}", attribute_string(k)).drop(*[f"{p}{c}" for p in sides for c in ("classes", "features")])
    out = out.select(*place, F.concat_ws(" ", *[f"_a_{k}" for k in names]).alias("_texts"), F.explode("_rows").alias("_r"))
    out = out.select(*place, "_texts", "_r.*")
    return out.withColumn("attr_str", F.concat_ws(" ", "attr_str", "_texts")).select(*gff.columns)


def path_counts(annotated: DataFrame) -> DataFrame:
    """(path, n): annotated rows under each distinct prefix of their elements' paths, antisense ones under ``antisense/``;
    most frequent first."""
    both = F.concat(F.col("elements"), F.transform("as_elements", lambda e: F.concat(F.lit("antisense/"), e)))
    # elements have few paths and many names: prefixes are made of the paths
    head = lambda e: F.substring(e, F.lit(1), F.length(e) - F.length(F.substring_index(e, "/", -1)) - 1)
    rows = annotated.select(both.alias("_e")).select("_e", F.array_distinct(F.transform(F.filter("_e", lambda e: e.contains("/")), head)).alias("_h"))
    rows = rows.select("_e", F.array_distinct(F.flatten(F.transform("_h", X.path_prefixes))).alias("_p"))
    return rows.select(F.explode(F.concat("_p", F.array_except("_e", "_p"))).alias("path")).groupBy("path").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("path"))


def with_category(annotated: DataFrame) -> DataFrame:
    return annotated.withColumn("category", X.hierarchical_category(F.concat_ws(",", "classes"), F.col("chrom")))
