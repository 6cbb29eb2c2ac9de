"""Interval operators: islands, numbering, coverage, run lengths, pile-up segments, range joins.

Order-sensitive steps never put a whole chromosome into one task.  A sequence (chromosome and strand) is cut into bins
of positions; what a bin needs from the bins before it (a maximum, a sum, a count) is aggregated per bin first, carried
over bins in a window over that small table and joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle
from .ordered import global_rank

BIN = 1 << 20
#: Width of the least bins of range joins.
JOIN_BIN = 1 << 12


def _bin(pos: str, width: int) -> Column:
    return F.floor(F.col(pos) / width).cast("long")


#: Rows of one task where a table's rows are counted before they are dealt: tasks grow in number with it, not in size.
TASK_ROWS = 500_000


def _dealt(df: DataFrame, rows: int, by: list[str]) -> DataFrame:
    """``df`` of ``rows`` rows dealt by the columns ``by``; a small table is left to the session's settings."""
    n = rows // TASK_ROWS + 1
    return df.repartition(n, *by) if n > 8 else df


def _carry(df: DataFrame, keys: list[str], value: Column, combine, default=None) -> DataFrame:
    """keys, _bin, _carry: ``combine`` of ``value`` over all earlier bins of the same keys."""
    by = df.groupBy(*keys, "_bin").agg(value.alias("_v"))
    w = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    out = combine("_v").over(w)
    return by.select(*keys, "_bin", (F.coalesce(out, F.lit(default)) if default is not None else out).alias("_carry"))


def running_sum(df: DataFrame, keys: list[str], pos: str, value: str, out: str, width: int = BIN, ties: list[str] | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows of ``keys`` up to this one, by ``pos`` (then ``ties``)."""
    df = df.withColumn("_bin", _bin(pos, width))
    carry = _carry(df, keys, F.sum(value), F.sum, 0)
    w = Window.partitionBy(*keys, "_bin").orderBy(pos, *(ties or [])).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(carry, [*keys, "_bin"]).withColumn(out, F.col("_carry") + F.sum(value).over(w)).drop("_bin", "_carry")


def islands(df: DataFrame, keys: list[str], start: str = "pos", end: str = "pend", ties: list[str] | None = None, width: int = BIN) -> DataFrame:
    """Adds ``island``: the number, from 1, of each row's island among those of its keys.

    A row opens an island if it starts beyond the greatest end so far; book-ended rows (start == greatest end) join.
    """
    df = df.withColumn("_bin", _bin(start, width))
    # what a bin needs from earlier ones is found over keys, starts and ends alone; whole rows are dealt and written once
    small = settle(df.select(*keys, "_bin", start, end), "islands")
    rows, place = small.count(), [*keys, "_bin"]
    carry = _carry(small, keys, F.max(end), F.max)
    # of a bin's own openings those up to the carried end are none: they are its first ones, so their number is enough
    openings = _opened(_dealt(small, rows, place), keys, start, end, []).where("_new = 1").select(*keys, "_bin", start).join(carry, [*keys, "_bin"])
    held = openings.groupBy(*keys, "_bin").agg(F.count_if(F.col(start) <= F.col("_carry")).alias("_none"), F.count("*").alias("_all"))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(*keys, "_bin", "_none", F.coalesce(F.sum(F.col("_all") - F.col("_none")).over(earlier), F.lit(0)).alias("_offset"))
    upto = Window.partitionBy(*keys, "_bin").orderBy(start, end, *(ties or [])).rowsBetween(Window.unboundedPreceding, 0)
    # numbered before the join, so that whole rows are sorted once
    out = _opened(_dealt(df, rows, place), keys, start, end, ties or []).withColumn("_own", F.sum("_new").over(upto)).join(held, place)
    return settle(out.withColumn("island", F.col("_offset") + F.greatest(F.col("_own") - F.col("_none"), F.lit(0))).drop("_bin", "_own", "_none", "_offset", "_new"), "islands")


def _opened(df: DataFrame, keys: list[str], start: str, end: str, ties: list[str]) -> DataFrame:
    """Adds ``_new``: 1 if a row starts beyond the greatest end before it in its bin."""
    before = Window.partitionBy(*keys, "_bin").orderBy(start, end, *ties).rowsBetween(Window.unboundedPreceding, -1)
    top = F.max(end).over(before)
    return df.withColumn("_new", F.when(top.isNull() | (F.col(start) > top), 1).otherwise(0))


def merge_sources(*sources: DataFrame) -> DataFrame:
    """Union of alignment tables; their order is given by (tid, pos, lib) wherever a window sorts.  Empty inputs count for nothing."""
    return reduce(DataFrame.unionByName, sources)


def extents(df: DataFrame, keys: list[str], start: str = "pos", end: str = "pend", extra: list[Column] | None = None) -> DataFrame:
    """Start, end, length and number of rows of each island, and whatever further aggregates the caller wants."""
    out = df.groupBy(*keys, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"), *(extra or []))
    return out.withColumn("length", F.col("end") - F.col("start"))


def number_clusters(df: DataFrame, strand: str = "strand", tid: str = "tid", start: str = "pos", ties: list[str] | None = None) -> DataFrame:
    """(tid, strand, island, cid): names in order of emission.

    An island is emitted when the next one on its strand opens, or at the end of its chromosome: there the strand of the
    next chromosome's first read goes first, at the end of input ``+``.  ``df`` has an ``island`` column.  Only first
    reads of islands are ordered, not reads: islands are numbered without gaps, so the next one is found by its number,
    and the ranks come from one sort of all islands.
    """
    order = [start, *(ties or [])]
    first = settle(df.groupBy(tid, strand, "island").agg(F.min(F.struct(*order)).alias("f")), "numbers")
    chrom = first.groupBy(tid).agg(F.min(F.struct("f", strand)).alias("c"))
    # one row a chromosome
    nxt = chrom.select(tid, F.lead(f"c.{strand}").over(Window.orderBy(tid)).alias("next_strand"))
    follow = first.select(tid, strand, (F.col("island") - 1).alias("island"), F.col("f").alias("g"))
    out = first.join(nxt, tid).join(follow, [tid, strand, "island"], "left")
    tie = F.when(F.col("g").isNotNull(), 0).when(F.col(strand) == F.coalesce("next_strand", F.lit("+")), 0).otherwise(1)
    # inside a chromosome islands closed by a later one come first, by its first read; then the two last ones
    out = global_rank(out.select(tid, strand, "island", F.col("g").isNull().alias("last"), "g", tie.alias("tie")), [F.col(c) for c in (tid, "last", "g", "tie")], "r")
    return out.select(tid, strand, "island", F.format_string("CID_%06d", F.col("r") + 1).alias("cid"))


def coverage(df: DataFrame, keys: list[str], start: str = "pos", end: str = "pend", weight: str | Column = "mult", width: int = BIN, every_end: bool = False) -> DataFrame:
    """Runs of equal positive coverage: keys, start, end, value.  A sweep over interval ends; no position is expanded.

    ``every_end``: runs are also cut where an interval ends and another begins, so that their intervals are the same.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    ends = df.select(*keys, F.explode(F.array(F.struct(F.col(start).alias("p"), w.alias("d")), F.struct(F.col(end).alias("p"), (-w).alias("d")))).alias("x"))
    deltas = ends.groupBy(*keys, F.col("x.p").alias("p")).agg(F.sum("x.d").alias("d"))
    deltas = deltas if every_end else deltas.where("d <> 0")
    deltas = settle(deltas.withColumn("_bin", _bin("p", width)), "coverage")
    # from other bins: what is open where a bin begins, and where the next one's first step is
    held, bins = deltas.groupBy(*keys, "_bin").agg(F.sum("d").alias("_d"), F.min("p").alias("_p")), Window.partitionBy(*keys).orderBy("_bin")
    held = held.select(*keys, "_bin", F.coalesce(F.sum("_d").over(bins.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_open"), F.lead("_p").over(bins).alias("_next"))
    inside = Window.partitionBy(*keys, "_bin").orderBy("p")
    # summed before the join, so that steps are sorted once
    own = _dealt(deltas, deltas.count(), [*keys, "_bin"]).select(*keys, "_bin", F.col("p").alias("start"), F.lead("p").over(inside).alias("_lead"), F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_depth"))
    out = own.join(held, [*keys, "_bin"]).select(*keys, "start", F.coalesce("_lead", "_next").alias("end"), (F.col("_open") + F.col("_depth")).alias("value"))
    return out.where("value > 0 AND end IS NOT NULL")


def next_position(df: DataFrame, keys: list[str], pos: str, out: str, width: int = BIN) -> DataFrame:
    """Adds ``out``: the next greater-or-equal position among rows of the same keys; null at the last row."""
    df = df.withColumn("_bin", _bin(pos, width))
    first = df.groupBy(*keys, "_bin").agg(F.min(pos).alias("_v"))
    first = first.select(*keys, "_bin", F.lead("_v").over(Window.partitionBy(*keys).orderBy("_bin")).alias("_carry"))
    w = Window.partitionBy(*keys, "_bin").orderBy(pos)
    return df.join(first, [*keys, "_bin"]).withColumn(out, F.coalesce(F.lead(pos).over(w), F.col("_carry"))).drop("_bin", "_carry")


def previous(df: DataFrame, keys: list[str], pos: str, value: Column, out: str, width: int = BIN, ties: list[str] | None = None) -> DataFrame:
    """Adds ``out``: ``value`` of the row before, by ``pos`` (then ``ties``) among rows of the same keys; null at the first."""
    df = df.withColumn("_bin", _bin(pos, width))
    order = [pos, *(ties or [])]
    last = df.groupBy(*keys, "_bin").agg(F.max_by(value, F.struct(*order)).alias("_v"))
    carry = last.select(*keys, "_bin", F.lag("_v").over(Window.partitionBy(*keys).orderBy("_bin")).alias("_carry"))
    w = Window.partitionBy(*keys, "_bin").orderBy(*order)
    return df.join(carry, [*keys, "_bin"]).withColumn(out, F.coalesce(F.lag(value).over(w), F.col("_carry"))).drop("_bin", "_carry")


def run_length(df: DataFrame, keys: list[str], pos: str = "pos", value: str = "value", default: float = 0, width: int = BIN) -> DataFrame:
    """Positions with values to runs: contiguous positions of equal value, the default left out; keys, start, end, score.

    Inside a bin, positions of one value that follow each other keep their distance to their number among those of that
    value; runs that meet at the edge of two bins are put together afterwards.
    """
    rows = df.where(F.col(value) != default).withColumn("_bin", _bin(pos, width))
    number = F.row_number().over(Window.partitionBy(*keys, "_bin", value).orderBy(pos))
    runs = rows.withColumn("_g", F.col(pos) - number).groupBy(*keys, "_bin", value, "_g").agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("end"))
    return merge_runs(runs.select(*keys, "start", "end", value), keys, value, width).withColumnRenamed(value, "score")


#: Places of one piece of a chromosome in highest_runs.
RUN_BIN = 1 << 9


def highest_runs(df: DataFrame, keys: list[str], start: str = "pos", end: str = "pend", value: str = "value", default: float = 0, width: int = BIN, piece: int = RUN_BIN) -> DataFrame:
    """run_length of the highest value over each position, straight from intervals: keys, start, end, score.  No position is
    a row.

    Intervals are cut at pieces of ``piece`` places.  Of those of a piece that begin together with one value only the longest
    counts, so a piece has a bounded number of them however deep it is; its runs are found between the bounds of its
    intervals.  Runs that meet at the edge of two pieces are put together afterwards.
    """
    base = F.col("_piece") * piece
    own = df.where(F.col(start) < F.col(end)).select(*keys, F.col(start).alias("s"), F.col(end).alias("e"), F.col(value).alias("v"), F.explode(F.sequence(F.floor(F.col(start) / piece), F.floor((F.col(end) - 1) / piece))).alias("_piece"))
    own = own.select(*keys, "_piece", F.greatest(F.col("s") - base, F.lit(0)).cast("int").alias("s"), F.least(F.col("e") - base, F.lit(piece)).cast("int").alias("e"), "v").where("v IS NOT NULL")
    longest = own.groupBy(*keys, "_piece", "s", "v").agg(F.max("e").alias("e"))
    at = longest.groupBy(*keys, "_piece").agg(F.collect_list(F.struct("s", "e", "v")).alias("_r"))
    at = at.withColumn("_b", F.array_sort(F.array_distinct(F.concat("_r.s", "_r.e"))))
    top = F.expr("transform(slice(_b, 1, size(_b) - 1), (p, i) -> struct(p AS s, _b[i + 1] AS e, array_max(filter(_r, r -> r.s <= p AND r.e > p).v) AS v))")
    at = at.withColumn("_t", F.filter(top, lambda x: x["v"].isNotNull() & (x["v"] != default)))
    # a run begins where its neighbour does not touch it or has another value, and ends likewise
    first = F.expr("filter(_t, (x, i) -> i = 0 OR _t[i - 1].e <> x.s OR _t[i - 1].v <> x.v)")
    last = F.expr("filter(_t, (x, i) -> i = size(_t) - 1 OR _t[i + 1].s <> x.e OR _t[i + 1].v <> x.v)")
    at = at.select(*keys, "_piece", F.explode(F.arrays_zip(first.alias("a"), last.alias("b"))).alias("x"))
    runs = at.select(*keys, (base + F.col("x.a.s")).alias("start"), (base + F.col("x.b.e")).alias("end"), F.col("x.a.v").alias(value))
    runs = settle(runs, "runs")
    edge = (F.col("start") % piece == 0) | (F.col("end") % piece == 0)
    return merge_runs(runs.where(edge), keys, value, width).unionByName(runs.where(~edge)).withColumnRenamed(value, "score")


def merge_runs(df: DataFrame, keys: list[str], value: str = "value", width: int = BIN) -> DataFrame:
    """Runs that touch and have equal values become one."""
    rows = previous(settle(df, "runs"), keys, "start", F.struct(F.col("end").alias("end"), F.col(value).alias("value")), "_last", width)
    joins = (F.col("_last.end") == F.col("start")) & F.col("_last.value").eqNullSafe(F.col(value))
    rows = settle(rows.withColumn("_new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).drop("_last"), "runs")
    out = running_sum(rows, keys, "start", "_new", "_run", width)
    return out.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first(value).alias(value)).drop("_run")


def expand_runs(df: DataFrame, value: str = "score") -> DataFrame:
    """Runs to positions."""
    return df.withColumn("pos", F.explode(F.expr("sequence(start, end - 1)"))).drop("start", "end")


def read_starts(df: DataFrame, keys: list[str], start: str = "pos", end: str = "pend", strand: str = "strand", weight: str = "mult", window: tuple[int, int] | None = None) -> DataFrame:
    """Weights at 5' ends: the first base on +, the last on -.  With a window, ends outside it are moved to its border."""
    at = F.when(F.col(strand) == "-", F.col(end) - 1).otherwise(F.col(start))
    if window:
        df = df.where((F.col(start) < window[1]) & (F.col(end) > window[0]))
        at = F.greatest(F.lit(window[0]), F.least(F.lit(window[1] - 1), at))
    return df.withColumn("pos5", at).groupBy(*keys, "pos5").agg(F.sum(weight).alias("value"))


def score_track(df: DataFrame, keys: list[str], line: str = "line_no", score: str = "score") -> DataFrame:
    """Score per position; of several rows over one position the last line counts."""
    return df.withColumn("pos", F.explode(F.expr("sequence(start, end - 1)"))).groupBy(*keys, "pos").agg(F.max_by(score, line).alias("value"))


# ---------------------------------------------------------------------------------------------------------------------
# range joins
# ---------------------------------------------------------------------------------------------------------------------
def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with row ids that every later read sees alike: written, since an unwritten input may come in another order
    each time it is computed."""
    return settle(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


#: Each level of bins is so many times as wide as the one before.
STEP, TOP = 8, 12
#: The HOT_BINS largest bins of those with over HOT_ROWS rows of a side are split by salt; any other one has less than
#: 1 / HOT_BINS of the rows.
HOT_ROWS, HOT_BINS = 100_000, 1000


def _level(s: Column, e: Column, width: int) -> Column:
    """The least level whose bins are as wide as the interval is long: it reaches two bins of it at most."""
    return reduce(lambda out, k: F.when(e - s <= width * STEP**k, k).otherwise(out), range(TOP - 1, -1, -1), F.lit(TOP))


def _width(level: str, width: int) -> Column:
    return F.lit(width) * F.pow(F.lit(STEP), F.col(level)).cast("long")


def range_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", ls: str = "start", le: str = "end", rs: str = "r_start", re: str = "r_end", width: int = JOIN_BIN, closed: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Overlapping pairs (half-open; closed: touching counts) of rows with equal ``keys``, named alike on both sides.

    Bins form levels, each ``STEP`` times as wide as the one below; an interval's own level is the first whose bins are as
    wide as it is long.  Two rows meet at the higher of their levels: left rows are dealt to their bins of every level,
    from their own up, that right rows have as their own, and right rows to those above their own that left rows have.
    So an interval makes two rows a level at most, however long it is.  A pair that meets in two bins counts in the first
    common one, so nothing is deduplicated.  Bins with over ``hot_rows`` rows of a side are a grid of salts: each side's
    rows are split along one axis and repeated along the other.

    ``how``: inner, left_anti or left_semi; these number the left rows, which are written first, since two branches of the
    plan must see the same numbers.
    """
    hot_rows, last = HOT_ROWS if hot_rows is None else hot_rows, 0 if closed else 1
    if how != "inner":
        left = numbered(left, "_row")
    right_keys = [f"_k_{k}" for k in keys]
    a = left.withColumn("_j_own", _level(F.col(ls), F.col(le), width))
    b = right.withColumnsRenamed(dict(zip(keys, right_keys, strict=True))).withColumn("_j_rown", _level(F.col(rs), F.col(re), width))
    # rows by the first bin of their own level, both sides in one pass: what the choice of levels and hot bins needs
    own = [df.groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(level).alias("_l"), F.floor(F.col(s) / _width(level, width)).alias("_b")).agg(F.count("*").alias("_n")) for df, by, level, s in ((a, keys, "_j_own", ls), (b, right_keys, "_j_rown", rs))]
    stats = settle(own[0].withColumn("_side", F.lit(0)).unionByName(own[1].withColumn("_side", F.lit(1))), "bins")
    # at most 2 * (TOP + 1) values
    seen = stats.select("_side", "_l").distinct().collect()
    has = [sorted(r["_l"] for r in seen if r["_side"] == k) for k in (0, 1)]

    def at_levels(df: DataFrame, level: Column, names: tuple[str, str], s: str, e: str) -> DataFrame:
        """A row for each bin of the given levels (a column of arrays)."""
        df, w = df.select("*", F.explode(level).alias(names[0])), _width(names[0], width)
        return df.withColumn(names[1], F.explode(F.sequence(F.floor(F.col(s) / w), F.floor(F.greatest(F.col(e) - last, F.col(s)) / w))))

    def dealt(x: DataFrame, y: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Turn 0: pairs whose right row is on the left one's level or a higher one; turn 1: on a lower one."""
        lower, upper = ("_j_lvl", "_j_bin"), ("_j_rlvl", "_j_rbin")
        up = lambda own, levels, above: F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda k: k >= F.col(own) + above)
        turns = [(at_levels(x, up("_j_own", has[1], 0), lower, ls, le), at_levels(y, F.array("_j_rown"), upper, rs, re))]
        if has[0] and has[1] and has[0][-1] > has[1][0]:
            turns.append((at_levels(x, F.array("_j_own"), lower, ls, le), at_levels(y, up("_j_rown", has[0], 1), upper, rs, re)))
        x, y = (reduce(DataFrame.unionByName, side) for side in zip(*[(p.withColumn("_j_turn", F.lit(i)), q.withColumn("_j_rturn", F.lit(i))) for i, (p, q) in enumerate(turns)], strict=True))
        return x, y

    place, r_place = [*keys, "_j_turn", "_j_lvl", "_j_bin"], [*right_keys, "_j_rturn", "_j_rlvl", "_j_rbin"]
    # the bins of ``stats`` as rows of one base each, dealt like the rows that they stand for
    base = F.col("_b") * _width("_l", width)
    some = dealt(stats.where("_side = 0").select(*keys, F.col("_l").alias("_j_own"), base.alias(ls), (base + 1).alias(le), "_n"), stats.where("_side = 1").select(*[F.col(k).alias(r) for k, r in zip(keys, right_keys, strict=True)], F.col("_l").alias("_j_rown"), base.alias(rs), (base + 1).alias(re), "_n"))
    rows = [df.select(*[F.col(c).alias(p) for c, p in zip(by, place, strict=True)], *[F.when(F.lit(k == j), F.col("_n")).otherwise(0).alias(n) for j, n in enumerate(("_nl", "_nr"))]) for k, (df, by) in enumerate(zip(some, (place, r_place), strict=True))]
    sums = rows[0].unionByName(rows[1]).groupBy(*place).agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr"))
    parts = [F.greatest(F.lit(1), F.ceil(F.col(n) / hot_rows)).cast("int").alias(n) for n in ("_nl", "_nr")]
    hot = sums.where(F.greatest("_nl", "_nr") > hot_rows).orderBy(F.desc(F.greatest("_nl", "_nr"))).limit(HOT_BINS).select(*place, *parts).collect()
    x, y = dealt(a, b)
    x, y = _salted(x, place, place, hot, ("_nl", "_nr"), ("_j_u", "_j_v")), _salted(y, r_place, place, hot, ("_nr", "_nl"), ("_j_rv", "_j_ru"))
    meet = reduce(Column.__and__, [F.col(p) == F.col(q) for p, q in zip([*place, "_j_u", "_j_v"], [*r_place, "_j_ru", "_j_rv"], strict=True)])
    over = (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) if closed else (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le))
    w = _width("_j_lvl", width)
    first = F.col("_j_bin") == F.greatest(F.floor(F.col(ls) / w), F.floor(F.col(rs) / w))
    if how == "inner":
        return x.join(y, meet & over & first).select(*left.columns, *[c for c in right.columns if c not in keys])
    hits = x.join(y, meet & over & first, "left_semi").select("_row").distinct()
    return left.join(hits, "_row", how).drop("_row")


def _salted(df: DataFrame, at: list[str], place: list[str], hot: list, n: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Adds a row's cells in the grid of salts of its bin: its own salt, and every one of the other side; 0, 0 where the bin
    isn't hot.  A row's salt comes from its contents and its part of the input, so rows that repeat are split too."""
    if not hot:
        return df.withColumns({c: F.lit(0) for c in names})
    cols = df.columns
    kinds = [f"`_g_{p}` {df.schema[c].dataType.simpleString()}" for c, p in zip(at, place, strict=True)]
    grid = df.sparkSession.createDataFrame(hot, ", ".join([*kinds, "_nl int", "_nr int"]))
    on = reduce(Column.__and__, [F.col(c) == F.col(f"_g_{p}") for c, p in zip(at, place, strict=True)])
    # at most HOT_BINS rows
    out = df.join(F.broadcast(grid), on, "left").withColumn(names[0], F.pmod(F.xxhash64(*cols, F.spark_partition_id()), F.coalesce(F.col(n[0]), F.lit(1))).cast("int"))
    return out.withColumn(names[1], F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n[1]), F.lit(1)) - 1))).select(*cols, *names)


#: Blocks of one task where what lies over them is gathered: a task's rows may be few and what they make of it long.
TASK_BLOCKS = 128


def near(left: DataFrame, right: DataFrame, keys: list[str], ls: str = "start", le: str = "end", rs: str = "r_start", re: str = "r_end", width: int = JOIN_BIN) -> DataFrame:
    """Adds ``near``: the rows of ``right`` (an array of structs of its columns without the keys) that lie over the row's
    block, all that overlap the row among them; null if there are none.

    Rows of about one length that begin in one bin are a block.  What lies over a block is gathered once, so no pair of
    rows is shuffled or written, however long the texts are that a row makes of it.
    """
    place = [*keys, "_lvl", "_blk"]
    left = left.withColumn("_lvl", _level(F.col(ls), F.col(le), width)).withColumn("_blk", F.floor(F.col(ls) / _width("_lvl", width)))
    blocks = settle(left.groupBy(*place).agg(F.min(ls).alias("_bs"), F.max(le).alias("_be")), "blocks")
    n = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks.count() // TASK_BLOCKS + 1)
    pairs = range_join(blocks, right, keys, ls="_bs", le="_be", rs=rs, re=re, width=width)
    found = pairs.select(*place, F.struct(*[c for c in right.columns if c not in keys]).alias("_x")).repartition(n, *place).groupBy(*place).agg(F.collect_list("_x").alias("near"))
    return left.repartition(n, *place).join(found, place, "left").drop("_lvl", "_blk")


def overlap_count(regions: DataFrame, reads: DataFrame, keys: list[str], weight: str = "mult", width: int = JOIN_BIN) -> DataFrame:
    """Weighted number of reads over each region (region columns and ``reads``; 0 where there are none)."""
    cols = regions.columns
    r = numbered(regions, "_region")
    hits = range_join(r, reads.select(*keys, F.col("pos").alias("r_start"), F.col("pend").alias("r_end"), F.col(weight).alias("_w")), keys, width=width)
    sums = hits.groupBy("_region").agg(F.sum("_w").alias("_sum"))
    return r.join(sums, "_region", "left").select(*cols, F.coalesce("_sum", F.lit(0)).alias("reads"))


def _bounds(loci: DataFrame, keys: list[str]) -> DataFrame:
    """The blocks between neighbouring starts and ends: keys, start, end."""
    bounds = settle(loci.select(*keys, F.explode(F.array("start", "end")).alias("p")).distinct(), "segments")
    return next_position(bounds, keys, "p", "q").where("q IS NOT NULL").select(*keys, F.col("p").alias("start"), F.col("q").alias("end"))


def segments(loci: DataFrame, keys: list[str], width: int = JOIN_BIN) -> DataFrame:
    """Maximal blocks over which the set of loci is constant: keys, start, end and one row per covering locus."""
    right = loci.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), *[c for c in loci.columns if c not in (*keys, "start", "end")])
    return range_join(_bounds(loci, keys), right, keys, width=width).drop("r_start", "r_end")


def segment_depths(loci: DataFrame, keys: list[str], width: int = JOIN_BIN) -> DataFrame:
    """The blocks of ``segments`` with the number of their loci (n), without a row for each of these."""
    return coverage(loci.where("start < end"), keys, "start", "end", F.lit(1).cast("long"), width, every_end=True).withColumnRenamed("value", "n")


def gathered(loci: DataFrame, keys: list[str]) -> DataFrame:
    """Loci of one place and path as one row with all their names (an array, column name)."""
    return loci.groupBy(*keys, "start", "end", "path").agg(F.collect_set("name").alias("name"))


def compress(seg: DataFrame, keys: list[str]) -> DataFrame:
    """Segments with their loci as one string: names grouped by path, sorted, ``path/n1,n2`` joined by ``$``.

    ``seg``: segments of loci, or of ``gathered`` ones.  Its rows are shuffled once, by their segments.
    """
    seg = seg.repartition(*keys, "start", "end")
    several = seg.schema["name"].dataType.typeName() == "array"
    names = F.array_distinct(F.flatten(F.collect_list("name"))) if several else F.collect_set("name")
    by_path = seg.groupBy(*keys, "start", "end", "path").agg(F.concat_ws(",", F.array_sort(names)).alias("names"))
    one = F.concat(F.regexp_replace("path", "/+$", ""), F.lit("/"), F.col("names"))
    return by_path.groupBy(*keys, "start", "end").agg(F.concat_ws("$", F.array_sort(F.collect_set(one))).alias("combination"))


def compressed(loci: DataFrame, keys: list[str], width: int = JOIN_BIN) -> DataFrame:
    """``compress`` of the segments of loci (keys, start, end, path, name), without a row for each locus over a segment."""
    loci = settle(gathered(loci, keys), "loci")
    right = loci.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"), "path", "name")
    # names of a path are put together before they are sorted; paths that differ in slashes at their end stay apart
    over = near(_bounds(loci, keys), right, keys, width=width)
    over = over.select(*keys, "start", "end", F.filter("near", lambda x: (x["r_start"] < F.col("end")) & (x["r_end"] > F.col("start"))).alias("_x")).where(F.size("_x") > 0)
    names = lambda p: F.sort_array(F.array_distinct(F.flatten(F.transform(F.filter("_x", lambda x: x["path"].eqNullSafe(p)), lambda x: x["name"]))))
    one = lambda p: F.concat(F.regexp_replace(p, "/+$", ""), F.lit("/"), F.concat_ws(",", names(p)))
    combos = F.filter(F.transform(F.array_distinct("_x.path"), one), lambda c: c.isNotNull())
    return over.select(*keys, "start", "end", F.concat_ws("$", F.sort_array(F.array_distinct(combos))).alias("combination"))
