"""Approximate nearest neighbours: a forest of random-projection trees, searched through one queue for all trees, and
exact distances to the rows of the leaves that the search reaches.

* A tree is complete: a node splits at the median of the projections on a random direction of its own, drawn from a seed.
  Medians are fitted on a bounded sample (``SAMPLE`` rows), each tree in a task of its own; a forest is then at most
  ``TREES`` x 2**``DEPTH`` numbers, whatever the input, and goes to every task.  Every row is dealt to a leaf of each tree.
* A query keeps one priority queue over all trees: a node's priority is the greatest distance from the query to a plane
  that had to be crossed on the way (0 on the query's own side).  The first search takes leaves until they hold ``FIRST``
  rows; the distance of the ``k``-th neighbour among those, ``r``, bounds the true one from above.  The second search goes
  on through the same queue to all leaves of priority up to ``REACH`` * r / sqrt(dimensions): directions are random, so the
  projection of the vector to a neighbour has that spread, whatever the data.  A neighbour is missed only if in every
  tree some plane lies between that reach and its projection.  So the number of leaves follows the data: few where
  neighbours are much nearer than other rows, most where they are not.
* Distances: queries and rows of a leaf meet in blocks (``BLOCK_ROWS`` by ``BLOCK_QUERIES``), so a leaf that a third of all
  rows share is dealt over many tasks.  A block's product of matrices chooses rows, their distances are computed anew as
  the root of summed squared differences in double precision, and only the best ``k`` of each query and block leave it.

Measured recall of the 10 nearest against brute force (every query): see README.

Defined results: vectors that are null, all zero, or hold null or non-finite components take no part; of vectors of
different lengths only those of the most common length do (ties: the longest).  A row's own are all rows with its id, so
rows that repeat an id are one candidate each to others and none to each other; queries that repeat an id and vector are
one query, those that repeat the id alone are ranked each by itself.  Fewer candidates than ``k``: all of them.  Ties go to
the smaller id.  A null id is no query and no candidate.  An empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

TREES = 4
#: Rows that a leaf is meant to hold, and levels at most.
LEAF, DEPTH = 256, 12
#: Rows of the sample that medians are fitted on (on average), and rows that the first search looks at.
SAMPLE, FIRST = 32_768, 1024
REACH = 1.0
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024


def directions(tree: int, depth: int, dim: int) -> np.ndarray:
    """Unit vectors of a tree's inner nodes, numbered like a heap from 0."""
    d = np.random.Generator(np.random.PCG64(1000 + tree)).standard_normal((2**depth - 1, dim))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def fit(x: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """Thresholds of a tree's inner nodes: medians of the rows that reach them."""
    dirs, at, out = directions(tree, depth, x.shape[1]), np.zeros(len(x), np.int64), np.zeros(2**depth - 1)
    for level in range(depth):
        first = 2**level - 1
        for node in range(first, 2 * first + 1):
            mine = np.flatnonzero(at == node)
            p = x[mine] @ dirs[node]
            out[node] = np.median(p) if len(p) else 0.0
            at[mine] = 2 * node + 1 + (p > out[node])
    return out


def leaves(x: np.ndarray, tree: int, thresholds: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    depth = (len(thresholds) + 1).bit_length() - 1
    dirs, at = directions(tree, depth, x.shape[1]), np.zeros(len(x), np.int64)
    for _ in range(depth):
        at = 2 * at + 1 + (np.einsum("ij,ij->i", x, dirs[at]) > thresholds[at])
    return at - len(thresholds)


def search(margins: list[np.ndarray], sizes: list[np.ndarray], first: int, reach: float | None, done: float = -1.0) -> tuple[list[tuple[int, int]], float]:
    """Leaves (tree, leaf) of one query in order of the shared queue, and the priority up to which all leaves are taken.

    ``margins``: by tree, the query's distance to each inner node's plane, positive on the right.  Without ``reach``, until
    the leaves hold ``first`` rows (leaves of equal priority together); with it, those of priority up to ``reach`` that lie
    beyond ``done``.
    """
    queue = [(0.0, t, 0) for t in range(len(margins))]
    out, rows, last = [], 0, -1.0
    while queue:
        p, t, node = heapq.heappop(queue)
        if p > reach if reach is not None else rows >= first and p > last:
            break
        if node >= len(margins[t]):
            last = p
            if p > done:
                leaf = node - len(margins[t])
                out.append((t, leaf))
                rows += int(sizes[t][leaf])
            continue
        m = float(margins[t][node])
        near = 2 * node + 1 + (m > 0)
        heapq.heappush(queue, (p, t, near))
        heapq.heappush(queue, (max(p, abs(m)), t, 4 * node + 3 - near))
    return out, last


def best_of_block(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the ``k`` nearest rows: index of the query, index of the row, distance."""
    whose, which, far = [], [], []
    square = (x * x).sum(1)
    for s in range(0, len(q), 128):
        part = q[s : s + 128]
        d = square[None] - 2 * (part @ x.T) + (part * part).sum(1)[:, None]
        d[q_ids[s : s + 128][:, None] == x_ids[None]] = np.inf
        kth = np.partition(d, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(part), np.finfo(float).max)
        # rounding of the product: a few units in the last place of the squares' size
        slack = 1e-12 * (square.max() + (part * part).sum(1))
        for i in range(len(part)):
            near = np.flatnonzero((d[i] <= kth[i] + slack[i]) & np.isfinite(d[i]))
            exact = np.sqrt(((x[near] - part[i]) ** 2).sum(1))
            near = near[order := np.lexsort((x_ids[near], exact))][:k]
            whose.append(np.full(len(near), s + i))
            which.append(near)
            far.append(exact[order][:k])
    if not whose:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(whose), np.concatenate(which), np.concatenate(far)


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def valid(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id long, v array<double>: the rows that take part."""
    v = F.col("v")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))) & F.exists(v, lambda a: a != 0)
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)


def nearest(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, reach: float = REACH) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query (rows whose id is divisible by ``every``)."""
    spark = table.sparkSession
    scratch = C.Scratch(spark, "forest")
    empty = "query_id long, rank int, vec_id long, score double"
    rows = valid(table, id_col, vec_col)
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], empty)
    dim, n = lengths
    rows = rows.where(F.size("v") == dim)
    depth = min(DEPTH, max(0, (n // LEAF).bit_length() - 1))

    # fit: a bounded sample, chosen by the vectors' hash, a tree a task
    def grow(t: pd.DataFrame) -> pd.DataFrame:
        tree = int(t["tree"].iloc[0])
        return pd.DataFrame({"tree": [tree], "thresholds": [fit(np.array(t["v"].tolist(), np.float64), tree, depth)]})

    share = min(1.0, SAMPLE / n)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = sample.select(F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), "v")
    grown = {r["tree"]: np.array(r["thresholds"]) for r in sample.groupBy("tree").applyInPandas(grow, "tree int, thresholds array<double>").collect()}
    thresholds = [grown.get(t, np.zeros(2**depth - 1)) for t in range(trees)]

    def deal(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.batches(source):
            x = _matrix(b.column("v"))
            for t in range(trees if len(x) else 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(leaves(x, t, thresholds[t]).astype(np.int32)), b.column("vec_id"), b.column("v")], names=["tree", "leaf", "vec_id", "v"])

    index = scratch.write(rows.mapInArrow(deal, "tree int, leaf int, vec_id long, v array<double>"))
    # at most TREES x 2**DEPTH rows
    counted = index.groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(2**depth, np.int64) for _ in range(trees)]
    for t, leaf, c in counted:
        sizes[t][leaf] = c
    queries = scratch.write(rows.where(F.col("vec_id") % every == 0).distinct().withColumn("q", F.monotonically_increasing_id()))

    def reached(found: bool):
        """Leaves of each query; ``found``: after the first search, whose ``r`` and ``done`` the rows have."""

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dirs = [directions(t, depth, dim) for t in range(trees)]
            for b in C.batches(source):
                x = _matrix(b.column("v"))
                margins = [x @ d.T - h for d, h in zip(dirs, thresholds, strict=True)]
                out, upto = [], []
                for i in range(len(x)):
                    m = [a[i] for a in margins]
                    if found:
                        r, done = b.column("r")[i].as_py(), b.column("done")[i].as_py()
                        got, last = search(m, sizes, 0, np.inf if r is None else reach * r / dim**0.5, done)
                    else:
                        got, last = search(m, sizes, FIRST, None)
                    out.append(got)
                    upto.append(last)
                at = np.repeat(np.arange(len(x)), [len(g) for g in out])
                pairs = np.array([p for g in out for p in g], np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([b.column("q").take(pa.array(at)), b.column("vec_id").take(pa.array(at)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.array(upto)[at])], names=["q", "query_id", "tree", "leaf", "done"])

        return run

    sought = "q long, query_id long, tree int, leaf int, done double"
    size_table = spark.createDataFrame([(int(t), int(leaf), int(c)) for t, leaf, c in counted], "tree int, leaf int, n long")

    def measured(where: DataFrame) -> DataFrame:
        """q, query_id, vec_id, score: the best ``k`` of each query and block."""
        asked = where.groupBy("tree", "leaf").agg(F.count("*").alias("m"))
        grid = size_table.join(asked, ["tree", "leaf"]).select("tree", "leaf", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("rb"), F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("qb"))
        # at most a row a leaf
        grid = F.broadcast(grid)
        one = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
        every_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = where.join(grid, ["tree", "leaf"]).withColumn("y", one("q", F.col("qb"))).withColumn("x", every_of(F.col("rb")))
        left = left.select("q", "tree", "leaf", "x", "y").join(queries.select("q", F.col("vec_id").alias("query_id"), F.col("v").alias("qv")), "q")
        right = index.join(grid, ["tree", "leaf"]).withColumn("x", one("vec_id", F.col("rb"))).withColumn("y", every_of(F.col("qb")))

        def block(a: pa.Table, b: pa.Table) -> pa.Table:
            qx, bx = _matrix(a.column("qv").combine_chunks()), _matrix(b.column("v").combine_chunks())
            q_ids, x_ids = a.column("query_id").to_numpy(), b.column("vec_id").to_numpy()
            if len(qx) and len(bx):
                i, j, d = best_of_block(qx, q_ids, bx, x_ids, k)
            else:
                i, j, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
            return pa.table({"q": a.column("q").to_numpy()[i], "query_id": q_ids[i], "vec_id": x_ids[j], "score": d})

        by = ["tree", "leaf", "x", "y"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(block, "q long, query_id long, vec_id long, score double")

    best = Window.partitionBy("q").orderBy("score", "vec_id")
    top = lambda df: df.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    first = scratch.write(queries.select("q", "vec_id", "v").mapInArrow(reached(False), sought))
    near = scratch.write(top(measured(first)))
    # r: only where k neighbours are known
    so_far = near.groupBy("q").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("r")).join(first.groupBy("q").agg(F.max("done").alias("done")), "q", "right")
    second = scratch.write(queries.join(so_far, "q").select("q", "vec_id", "v", "r", "done").mapInArrow(reached(True), sought))
    out = top(near.drop("rank").unionByName(measured(second)))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
