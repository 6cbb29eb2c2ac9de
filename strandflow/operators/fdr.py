"""Target/decoy false-discovery cutoffs: one score, two scores, ranking and filtering."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EDITS
from ..scratch import Scratch, settle
from .ordered import running_totals

_I = {e: i for i, e in enumerate(EDITS)}
_DELETIONS = ("A_", "C_", "G_", "T_")


def _e(*names: str) -> Column:
    out = F.lit(0.0)
    for n in names:
        out = out + F.col("edits")[_I[n]]
    return out


#: Scores of a cluster by name, as functions that make a column.  Those whose column the statistics lack are 0.
SCORING: dict[str, Callable[[], Column]] = {
    "signature": lambda: F.col("conversion_score"),
    "iclip": lambda: F.col("iclip_score"),
    "sig_density": lambda: F.col("conversion_score") / F.col("n_reads"),
    "sig_density_pseudo": lambda: (F.lit(0.04) + F.col("conversion_score") + 1) / (F.col("n_reads") + 2 + 0.04),
    "length": lambda: F.col("length"),
    "entropy": lambda: F.col("entropy_score"),
    "4su": lambda: _e("TC", "T_"),
    "6sg": lambda: _e("GA", "G_"),
    "4su_density": lambda: _e("TC", "T_") / F.col("n_reads"),
    "6sg_density": lambda: _e("GA", "G_") / F.col("n_reads"),
    "indels": lambda: _e(*_DELETIONS, "_A", "_C", "_G", "_T"),
    "deletions": lambda: _e(*_DELETIONS),
    "all_edits": lambda: _e(*_I),
    "n_reads": lambda: F.col("n_reads"),
    "cum_uniq": lambda: F.col("cum_uniq"),
    "avg_mapq": lambda: F.col("avg_mapq"),
    "max_pp": lambda: F.col("max_pp"),
} | dict.fromkeys(("n_best", "n_uniq", "uniqness", "best_mapq", "mean_pp", "median_pp"), lambda: F.lit(0.0))


def register(name: str, score: Callable[[], Column]) -> None:
    """Add or replace a scoring function; its column may be a pandas UDF over cluster statistics."""
    SCORING[name] = score


def scoring(name: str) -> Column:
    return SCORING[name]().cast("double")


def fdr(real: Column, decoy: Column, scale: float = 0.5) -> Column:
    """(fp + 1) / (tp + fp + 2) with fp = decoy / scale and tp = max(0, real - fp); 0.5 without data."""
    fp = decoy / F.lit(scale)
    tp = F.greatest(F.lit(0.0), real - fp)
    return (fp + 1) / (tp + fp + 2)


def unfiltered_fdr(df: DataFrame, scale: float = 0.5) -> DataFrame:
    n = df.agg(F.count_if(~F.col("decoy")).alias("r"), F.count_if("decoy").alias("d"))
    return n.select(fdr(F.col("r"), F.col("d"), scale).alias("fdr"), (F.col("r") + F.col("d")).alias("n"))


def score_table(clusters: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Long table: method, value, decoy (and cid), one row per cluster and score; one pass over the clusters."""
    names = names or list(SCORING)
    items = F.array(*[F.struct(F.lit(n).alias("method"), scoring(n).alias("value")) for n in names])
    return clusters.select("cid", "decoy", F.explode(items).alias("s")).select("cid", "decoy", "s.method", "s.value")


def curve(scores: DataFrame, scale: float = 0.5) -> DataFrame:
    """For every method and distinct value: rows at or above it (ref, dec, kept) and their FDR.

    The histogram of distinct values is made first (map-side combine); its running totals come from one sort of all
    methods' values, so a score with a value of its own for every row is no burden for one task.
    """
    hist = scores.groupBy("method", "value").agg(F.count_if(~F.col("decoy")).alias("r"), F.count_if("decoy").alias("d"))
    out = running_totals(hist, ["method"], [F.desc("value")], {"r": "ref", "d": "dec"}).drop("r", "d")
    return out.withColumns({"kept": F.col("ref") + F.col("dec"), "fdr": fdr(F.col("ref"), F.col("dec"), scale)})


def cutoffs(scores: DataFrame, max_fdr: float = 0.05, scale: float = 0.5) -> DataFrame:
    """(method, bp, fdr, kept, loss): the least value whose FDR is under the limit (strictly); the curve need not fall."""
    return _cutoffs_of(curve(scores, scale), max_fdr)


def _cutoffs_of(c: DataFrame, max_fdr: float) -> DataFrame:
    total = c.groupBy("method").agg(F.max("kept").alias("total"))
    best = c.where(F.col("fdr") < max_fdr).groupBy("method").agg(F.min(F.struct("value", "fdr", "kept")).alias("b"))
    out = best.join(total, "method")
    return out.select("method", F.col("b.value").alias("bp"), F.col("b.fdr").alias("fdr"), F.col("b.kept").alias("kept"), (F.lit(1.0) - F.col("b.kept") / F.col("total")).alias("loss"))


#: Parts into which a tile is cut along each axis, and tiles of each pair of scores that one round cuts.
PARTS, TILES = 64, 16
_TILE = "xlo long, xhi long, ylo long, yhi long, ref0 long, dec0 long, kept long"


def _fdr_of(real: np.ndarray, decoy: np.ndarray, scale: float) -> np.ndarray:
    """``fdr`` of arrays, operation by operation."""
    fp = decoy / scale
    return (fp + 1) / (np.maximum(0.0, real - fp) + fp + 2)


def cut_tile(tile: tuple[int, ...], cells: tuple[np.ndarray, ...], max_fdr: float, scale: float, parts: int) -> tuple[tuple[int, ...] | None, list[tuple[int, ...]]]:
    """The best corner of a tile's parts (kept, U0, U1, ref, dec), and the parts that may hold a better pair of cutoffs.

    A cutoff's place on its axis is the number of rows that it keeps by itself.  A tile is xlo < U0 <= xhi, ylo < U1 <= yhi
    and what its lower corner keeps; ``cells`` are rows of the histogram over its parts (cx, cy, ref, dec; 0: at or before
    the tile's low edge).  Every part's upper corner keeps the most rows of the part, so it settles the part if it is under
    the limit; otherwise the part stays open if as many rows as at its upper corner with as few decoys as at its lower
    one would be under the limit.
    """
    xlo, xhi, ylo, yhi, ref0, dec0, _ = tile
    wx, wy = step(xlo, xhi, parts), step(ylo, yhi, parts)
    nx, ny = -(-(xhi - xlo) // wx), -(-(yhi - ylo) // wy)
    sums = np.zeros((2, nx + 1, ny + 1), np.int64)
    cx, cy, ref, dec = cells
    np.add.at(sums[0], (cx, cy), ref)
    np.add.at(sums[1], (cx, cy), dec)
    sums[:, 0, 0] += (ref0, dec0)
    ref, dec = sums.cumsum(1).cumsum(2)
    xs, ys = np.minimum(xlo + wx * np.arange(nx + 1), xhi), np.minimum(ylo + wy * np.arange(ny + 1), yhi)
    r, d = ref[1:, 1:], dec[1:, 1:]
    good = _fdr_of(r, d, scale) < max_fdr
    best = max(((int(r[i, j] + d[i, j]), int(xs[i + 1]), int(ys[j + 1]), int(r[i, j]), int(d[i, j])) for i, j in zip(*np.nonzero(good & (r + d == (r + d)[good].max())), strict=True)), default=None) if good.any() else None
    wide = (np.diff(xs)[:, None] > 1) | (np.diff(ys)[None] > 1)
    unsure = ~good & wide & (_fdr_of(r, dec[:-1, :-1], scale) < max_fdr)
    return best, [(int(xs[i]), int(xs[i + 1]), int(ys[j]), int(ys[j + 1]), int(ref[i, j]), int(dec[i, j]), int(r[i, j] + d[i, j])) for i, j in zip(*np.nonzero(unsure), strict=True)]


def step(lo: int, hi: int, parts: int) -> int:
    """Width of a tile's parts along an axis."""
    return max(1, -(-(hi - lo) // parts))


def _search(points: DataFrame, roots: DataFrame, max_fdr: float, scale: float, parts: int, tiles: int) -> DataFrame:
    """pair, kept, u0, u1, ref, dec: the best pair of cutoffs of each pair of scores, by best-first branch and bound.

    ``points``: pair, u0, u1, ref, dec; ``roots``: pair, u0, u1 (the greatest places that cutoffs may have), l0, l1 (the
    place before the least).  Open tiles are
    a table; a round takes the ``tiles`` of each pair that may keep the most rows, counts their parts in one pass over the
    points (what crosses the shuffle is the parts, not the points), and drops open tiles that can't beat the best corner.
    """
    scratch = Scratch(points.sparkSession, "tiles")
    found = "pair int, what string, " + _TILE

    def look(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        best, open_ = None, []
        for _, mine in rows.groupby("tile"):
            one = tuple(int(mine[c].iloc[0]) for c in ("xlo", "xhi", "ylo", "yhi", "ref0", "dec0", "kept"))
            seen = mine.dropna(subset="cx")
            b, o = cut_tile(one, tuple(seen[c].to_numpy(np.int64) for c in ("cx", "cy", "ref", "dec")), max_fdr, scale, parts)
            best, open_ = max(filter(None, (best, b)), default=None), open_ + o
        # a best corner in the columns of a tile: its place as xhi and yhi, its counts as ref0 and dec0
        out = [(key[0], "best", 0, best[1], 0, best[2], best[3], best[4], best[0])] if best else []
        return pd.DataFrame(out + [(key[0], "open", *t) for t in open_], columns=[f.split()[0] for f in found.split(", ")])

    now = roots.select("pair", F.lit("open").alias("what"), F.col("l0").alias("xlo"), F.col("u0").alias("xhi"), F.col("l1").alias("ylo"), F.col("u1").alias("yhi"), *[F.lit(0).cast("long").alias(c) for c in ("ref0", "dec0", "kept")])
    now = scratch.write(now.where("xhi > xlo AND yhi > ylo"), 1)
    first = Window.partitionBy("pair").orderBy(F.desc("kept"), "xlo", "ylo")
    width = lambda a: F.greatest(F.lit(1), F.ceil((F.col(f"{a}hi") - F.col(f"{a}lo")) / parts)).cast("long")
    part = lambda a, u: F.when(F.col(u) <= F.col(f"{a}lo"), 0).otherwise(F.ceil((F.col(u) - F.col(f"{a}lo")) / F.col(f"w{a}"))).cast("int")
    while now.where("what = 'open'").limit(1).count():
        ranked = now.where("what = 'open'").withColumn("tile", F.row_number().over(first))
        take = ranked.where(F.col("tile") <= tiles).withColumns({"wx": width("x"), "wy": width("y")})
        # at most ``tiles`` rows a pair
        inside = points.join(F.broadcast(take.withColumnRenamed("pair", "_pair")), (F.col("pair") == F.col("_pair")) & (F.col("u0") <= F.col("xhi")) & (F.col("u1") <= F.col("yhi")) & ((F.col("u0") > F.col("xlo")) | (F.col("u1") > F.col("ylo"))))
        counts = inside.groupBy("pair", "tile", part("x", "u0").alias("cx"), part("y", "u1").alias("cy")).agg(F.sum("ref").alias("ref"), F.sum("dec").alias("dec"))
        looked = take.join(counts, ["pair", "tile"], "left").groupBy("pair").applyInPandas(look, found)
        rest = ranked.where(F.col("tile") > tiles).drop("tile").unionByName(now.where("what = 'best'")).unionByName(looked)
        # the best corner so far stands in every row; tiles that can't keep more, or as many further out, are done
        lead = F.max(F.when(F.col("what") == "best", F.struct("kept", "xhi", "yhi", "ref0", "dec0"))).over(Window.partitionBy("pair")).alias("_b")
        rest = rest.select("*", lead).where(F.when(F.col("what") == "best", F.col("_b") == F.struct("kept", "xhi", "yhi", "ref0", "dec0")).otherwise(F.col("_b").isNull() | (F.struct("kept", "xhi", "yhi") > F.struct("_b.kept", "_b.xhi", "_b.yhi"))))
        before, now = now, scratch.write(rest.drop("_b").distinct())
        scratch.drop(before)
    return now.select("pair", "kept", F.col("xhi").alias("u0"), F.col("yhi").alias("u1"), F.col("ref0").alias("ref"), F.col("dec0").alias("dec"))


def pair_cutoffs(clusters: DataFrame, pairs: list[tuple[str, str]], max_fdr: float = 0.05, scale: float = 0.5, single: DataFrame | None = None) -> DataFrame:
    """(m0, m1, b0, b1, fdr, kept, loss): for each pair of scores the pair of cutoffs that keeps the most rows.

    Cutoffs go up to the single-score cutoffs (or the greatest value) and leave out each score's least value; of pairs that
    keep as many the least b0, then the least b1.  Each value's place is the number of rows it keeps by itself; the rows of
    each pair of scores are points, and the best corner is found by branch and bound over tiles of the plane
    (``_search``), so neither sets of rows nor the grid of all cutoffs is built.
    """
    spark = clusters.sparkSession
    wanted = sorted({m for p in pairs for m in p})
    # the scores are read by several branches: written once, without what made them
    base = settle(clusters.select("cid", "decoy", *[scoring(m).alias(f"s_{m}") for m in wanted]), "pairs")
    scores = base.select("cid", "decoy", F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"s_{m}").alias("value")) for m in wanted])).alias("s")).select("cid", "decoy", "s.method", "s.value")
    steps = settle(curve(scores, scale), "pairs")
    # a few numbers a score; ``room``: the place of the least value but one
    limits = {r["method"]: r for r in steps.groupBy("method").agg(F.max("value").alias("high"), F.max("kept").alias("total"), F.min("value").alias("low")).collect()}
    bp = {r["method"]: r["bp"] for r in (single if single is not None else _cutoffs_of(steps, max_fdr)).collect()}
    top = {m: r["high"] if bp.get(m) is None else bp[m] for m, r in limits.items()}
    pairs = [(a, b) for a, b in pairs if a in limits and b in limits]
    if not pairs:
        return spark.createDataFrame([], "m0 string, m1 string, b0 double, b1 double, fdr double, kept long, loss double")
    ends = F.create_map(*[F.lit(x) for m, r in limits.items() for x in (m, F.struct(F.lit(r["low"]).alias("low"), F.lit(top[m]).alias("top")))])[F.col("method")]
    inside = steps.where((F.col("value") > ends["low"]) & (F.col("value") <= ends["top"])).groupBy("method").agg(F.min("kept").alias("least"), F.max("kept").alias("most"))
    room = {r["method"]: (r["least"] - 1, r["most"]) for r in inside.collect()}
    value = lambda m: F.least(F.col(f"s_{m}"), F.lit(top[m]))
    items = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("m0"), F.lit(b).alias("m1"), value(a).alias("v0"), value(b).alias("v1")) for i, (a, b) in enumerate(pairs)])
    hist = base.select("decoy", F.explode(items).alias("s")).groupBy("s.pair", "s.m0", "s.m1", "s.v0", "s.v1").agg(F.count_if(~F.col("decoy")).alias("ref"), F.count_if("decoy").alias("dec"))
    place = lambda k: steps.select(F.col("method").alias(f"m{k}"), F.col("value").alias(f"v{k}"), F.col("kept").alias(f"u{k}"))
    points = settle(hist.join(place(0), ["m0", "v0"]).join(place(1), ["m1", "v1"]).select("pair", "u0", "u1", "ref", "dec"), "pairs")
    names = spark.createDataFrame([(i, a, b, *room.get(a, (0, 0)), *room.get(b, (0, 0)), limits[a]["total"]) for i, (a, b) in enumerate(pairs)], "pair int, m0 string, m1 string, l0 long, u0 long, l1 long, u1 long, total long")
    best = settle(_search(points, names, max_fdr, scale, PARTS, TILES).join(F.broadcast(names.select("pair", "m0", "m1", "total")), "pair"), "pairs")
    # the value whose place is the last one up to the corner's; ``best`` has a row a pair
    for k in (0, 1):
        at = best.select("pair", F.col(f"m{k}").alias("method"), F.col(f"u{k}").alias("u"))
        held = steps.join(F.broadcast(at), "method").where("kept <= u").groupBy("pair").agg(F.min("value").alias(f"b{k}"))
        best = best.join(F.broadcast(held), "pair")
    return best.select("m0", "m1", "b0", "b1", fdr(F.col("ref"), F.col("dec"), scale).alias("fdr"), "kept", (F.lit(1.0) - F.col("kept") / F.col("total")).alias("loss"))


def rank_methods(single: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates, best first: more rows kept, single scores before pairs, then names, FDR, loss and cutoffs (all descending)."""
    a = single.select("kept", F.lit(1.0).alias("rank"), F.array("method").alias("methods"), "fdr", "loss", F.array("bp").alias("bp"))
    b = pairs.select("kept", F.lit(0.5).alias("rank"), F.array("m0", "m1").alias("methods"), "fdr", "loss", F.array("b0", "b1").alias("bp"))
    return a.unionByName(b).orderBy(*[F.desc(c) for c in ("kept", "rank", "methods", "fdr", "loss", "bp")])


def verdicts(clusters: DataFrame, methods: list[str], bps: list[float]) -> DataFrame:
    """Adds verdict: decoy, low_score or kept."""
    ok = F.lit(bool(methods))
    for m, b in zip(methods, bps, strict=True):
        ok = ok & (scoring(m) >= b)
    return clusters.withColumn("verdict", F.when(F.col("decoy"), "decoy").when(ok, "kept").otherwise("low_score"))
