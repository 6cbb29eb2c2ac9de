"""Filters: line filters, the ordered and counted chain of discards, masks, decoys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import EDITS
from ..scratch import settle
from .intervals import range_join


def score_threshold(lines: DataFrame, columns: list[int], thresholds: list[float], line_col: str = "value") -> DataFrame:
    """Tab-separated lines of which any listed 1-based column reaches its threshold (negative column: stays at or under it).

    One threshold serves all columns; several are paired by place, repeated as needed.  Column 0 and one past the end
    read as 0; other cells that are no numbers never match; # lines pass.
    """
    cells = F.split(line_col, "\t")

    def cell(n: int) -> Column:
        got = F.get(cells, abs(n) - 1).try_cast("double") if n else F.lit(0.0)
        return F.when(F.lit(abs(n)) == F.size(cells) + 1, 0.0).otherwise(got)

    tests = []
    for i, c in enumerate(columns):
        t = thresholds[i % len(thresholds)]
        tests.append(cell(c) <= t if c < 0 else cell(c) >= t)
    return lines.where(F.col(line_col).startswith("#") | F.coalesce(reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests]), F.lit(False)))


def column_sum(lines: DataFrame, columns: list[int], name: str = "sum", line_col: str = "value") -> DataFrame:
    """Appends the sum of the listed 1-based columns (negative: subtracted) as a further cell; # lines get the name."""
    cells = F.split(line_col, "\t")
    total = reduce(Column.__add__, [(F.get(cells, abs(c) - 1).try_cast("double") * (1 if c > 0 else -1)) for c in columns])
    return lines.withColumn(line_col, F.concat_ws("\t", line_col, F.when(F.col(line_col).startswith("#"), F.lit(name)).otherwise(total.cast("string"))))


def not_ribosomal(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    return df.where(~F.col(chrom).startswith("rRNA"))


def is_decoy(chrom: Column, flag: str = "markov") -> Column:
    return chrom.rlike(flag)


def filter_unique(df: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id occurs once."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(id_col))).where("_n = 1").drop("_n")


def filter_consecutive(df: DataFrame, id_col: str, ordinal: str = "ordinal", width: int = 1 << 16) -> DataFrame:
    """Rows whose id neither the row before nor the one after has, in the order of ``ordinal`` (from 0, without gaps); an id
    that recurs apart from them stays.  Null counts as an id.

    Neighbours are looked for in bins of ``width`` rows; a bin's edges meet those of the bins beside it.
    """
    rows = settle(df.withColumn("_bin", F.floor(F.col(ordinal) / width)), "neighbours")
    item = F.struct(F.col(id_col).alias("id"))
    edges = settle(rows.groupBy("_bin").agg(F.min_by(item, ordinal).alias("_first"), F.max_by(item, ordinal).alias("_last")), "neighbours")
    prev = edges.select((F.col("_bin") + 1).alias("_bin"), F.col("_last").alias("_prev"))
    succ = edges.select((F.col("_bin") - 1).alias("_bin"), F.col("_first").alias("_next"))
    w = Window.partitionBy("_bin").orderBy(ordinal)
    near = rows.withColumns({"_b": F.lag(item).over(w), "_a": F.lead(item).over(w)}).join(prev, "_bin", "left").join(succ, "_bin", "left")
    alone = ~item.eqNullSafe(F.coalesce("_b", "_prev")) & ~item.eqNullSafe(F.coalesce("_a", "_next"))
    return near.where(alone).select(*df.columns)


def known_chromosomes(df: DataFrame, sizes: DataFrame, chrom: str = "chrom") -> DataFrame:
    return df.join(sizes.select(F.col("chrom").alias("_c")), F.col(chrom) == F.col("_c"), "left_semi")


def region(df: DataFrame, chrom: str, start: int, end: int, start_col: str = "pos", end_col: str = "pend", chrom_col: str = "chrom") -> DataFrame:
    """Rows that overlap a 0-based, half-open region."""
    return df.where((F.col(chrom_col) == chrom) & (F.col(start_col) < end) & (F.col(end_col) > start))


def parse_masks(masks: list[str]) -> list[tuple[str, int, int]]:
    """``chrom:start-end``; chromosome names may hold colons and dashes."""
    out = []
    for m in masks:
        chrom, _, span = m.rpartition(":")
        start, _, end = span.partition("-")
        out.append((chrom, int(start), int(end)))
    return out


def masked(df: DataFrame, masks: DataFrame, start: str = "start", end: str = "end", chrom: str = "chrom") -> Column | DataFrame:
    """Rows of ``df`` under no mask (chrom, start, end); touching counts as under it."""
    right = masks.select(F.col("chrom").alias(chrom), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return range_join(df, right, [chrom], "left_anti", start, end, closed=True)


def not_under(df: DataFrame, features: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Rows of ``df`` that overlap no feature."""
    right = features.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return range_join(df, right, keys, "left_anti", start, end)


def discard_reason(min_reads: int = 2, min_conv: float = 1, min_uniq: float = 1, min_support: int = 1, require_conversions: bool = False, masked_col: str | None = None, tracked_col: str | None = None, support: bool = True) -> Column:
    """The first test that a cluster fails, or null; tests run in this order."""
    out = F.when(F.col("uniq_reads") < min_reads, "discarded_few_reads")
    out = out.when(F.col("conversion_score") < min_conv, "discarded_few_conversions")
    out = out.when(F.col("max_uniq") < min_uniq, "discarded_non_uniq")
    if support:
        out = out.when(F.col("read_support") < min_support, "discarded_insuff_read_support")
        if require_conversions:
            out = out.when(F.col("sig_support") < min_support, "discarded_insuff_conversion_support")
    if tracked_col:
        out = out.when(F.col(tracked_col), "discarded_track_overlap")
    if masked_col:
        out = out.when(F.col(masked_col), "discarded_masked")
    return out


def stage_counters(clusters: DataFrame) -> DataFrame:
    """(key, n): total, decoy_hits, reference_hits, each reason, kept, decoy_kept, reference_kept; from one aggregation."""
    by = clusters.groupBy("reason", "decoy").agg(F.count("*").alias("n"))
    side = F.when(F.col("decoy"), "decoy").otherwise("reference")
    names = F.array(F.lit("total"), F.concat(side, F.lit("_hits")), F.coalesce("reason", F.lit("kept")), F.when(F.col("reason").isNull(), F.concat(side, F.lit("_kept"))))
    return by.select(F.explode(F.array_compact(names)).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))


#: What discard_reason can give.
REASONS = ["few_reads", "few_conversions", "non_uniq", "insuff_read_support", "insuff_conversion_support", "track_overlap", "masked"]


def observed_stages(clusters: DataFrame, counters: Observation) -> DataFrame:
    """``clusters`` (with reason and decoy) as they are; the action that computes them fills ``counters`` in the same pass."""
    kept, decoy = F.col("reason").isNull(), F.col("decoy")
    tests = {"total": F.lit(True), "decoy_hits": decoy, "reference_hits": ~decoy, "kept": kept, "decoy_kept": kept & decoy, "reference_kept": kept & ~decoy}
    tests |= {f"discarded_{r}": F.col("reason") == f"discarded_{r}" for r in REASONS}
    return clusters.observe(counters, *[F.count_if(t).alias(k) for k, t in tests.items()])


def stage_rows(spark: SparkSession, counters: Observation) -> DataFrame:
    """(key, n) of the counters that are not 0, as stage_counters gives them."""
    return spark.createDataFrame([(k, n) for k, n in counters.get.items() if n], "key string, n long")


#: Rows of the statistics in their order: totals, then edits by base, insertions and deletions.
EVENTS = ["total", "uniq", "perfect", "edits", *[e for e in EDITS if "_" not in e], *[e for e in EDITS if e[0] == "_"], *[e for e in EDITS if e[1] == "_"]]


def event_name(e: str) -> str:
    if e == "uniq":
        return "distinct"
    if len(e) != 2:
        return e
    return f"{e[1]}_ins" if e[0] == "_" else f"{e[0]}_del" if e[1] == "_" else f"{e[0]}:{e[1]}"


def global_statistics(stats: DataFrame) -> DataFrame:
    """(event, total, reference, decoy) from a long table (strand, decoy, key, value) of cluster statistics.

    Edits of - clusters are complemented (again), keys with N are left out, decoy figures are negative, and the rows
    ``uniq`` and ``edits`` are 0.
    """
    two = F.length("key") == 2
    key = F.when((F.col("strand") == "-") & two, F.translate("key", "ACGT", "TGCA")).otherwise(F.col("key"))
    sums = stats.where(~F.col("key").contains("N")).groupBy(key.alias("k")).agg(F.sum("value").alias("total"), F.sum(F.when(~F.col("decoy"), F.col("value"))).alias("reference"), F.sum(F.when(F.col("decoy"), -F.col("value"))).alias("decoy"))
    events = stats.sparkSession.createDataFrame([(i, e, event_name(e)) for i, e in enumerate(EVENTS)], "rank int, k string, event string")
    out = events.join(sums.where(~F.col("k").isin("uniq", "edits")), "k", "left")
    return out.select("rank", "event", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("total", "reference", "decoy")])
