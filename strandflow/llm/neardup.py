"""Near-duplicate documents: an LSH forest over MinHash signatures, every link confirmed on full shingle sets.

Words lie between ASCII white space, A-Z lower-cased; a document's set holds its distinct 5-word shingles (a shorter
document: its whole word sequence as one; without words: empty, linked with nothing).  Two documents are linked if
100 * |A & B| >= percent * |A | B| (``PERCENT`` where no other is given); components of that graph are groups, named by their smallest doc_id.

How it runs:

1. One pass over the texts makes, per document, the size of its set, a 126-bit id of it (from a cryptographic digest of
   all its shingle hashes) and one key for each of ``TREES`` trees: ``DEPTH`` MinHash values of 16 bits, the first on
   top.  Documents with one set id have equal sets and are one class (``groupBy`` with map-side combine), so exact
   copies never meet in a join.
2. The forest: the keys of all trees are sorted (a range sort by tree, key and class, so a key that most classes share is
   dealt over many tasks too).  Neighbours in this order share the longest prefixes there are: the leading 16-bit
   values in which two neighbours agree are their common prefix.  The depth is chosen region by region: neighbours are
   linked from ``DEPTH - 1`` common values on, and in regions where ``REGION`` rows to either side share that prefix, at
   ``DEPTH`` only.  No region is read deeper, whatever its size: that would lose links.  Neighbours over the edge of two
   sorted partitions meet in a table of one row a partition.
3. Connected regions are confirmed on full sets: prefix filtering over rare-first shingles gives every pair that can
   reach the threshold, and pairs already connected are skipped.  Regions over ``BLOCK`` classes or ``BLOCK_SHINGLES``
   shingles are split; each pair of blocks is a task of its own, so no task grows with a region.  The texts of a region
   of n blocks are read n times.

A pair at similarity 0.85 is missed by all trees with probability (1 - 0.85**4)**20 < 4e-7, one at 0.8 with
(1 - 0.8**4)**20 < 2.7e-5.

Defined results: null text = no words; rows that repeat a doc_id and text get equal rows; an empty table gives an empty
result; columns beside doc_id and text are not read; ids keep their type.  A null doc_id is never the smallest of a
group that has another id; a group without any has component_id null and its rows are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WORDS = 5
TREES, DEPTH = 20, 4
REGION = 64
BLOCK, BLOCK_SHINGLES = 1000, 500_000
PERCENT = 85
#: Type of set ids: a decimal of 126 bits.
SET = "decimal(38,0)"
_A = C._random_u64(TREES * DEPTH, 21) | np.uint64(1)
_B = C._random_u64(TREES * DEPTH, 22)
_W = C._random_u64(WORDS, 23) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in C.sized(texts):
        words, at = C.hash_words(texts[a:b], C.SPACE_WORD)
        n = len(words) - WORDS + 1
        grams = np.zeros(max(n, 0), np.uint64)
        for k in range(WORDS if n > 0 else 0):
            grams += words[k : k + n] * _W[k]
        grams = C.mix(grams)
        for s, e in zip(at[:-1], at[1:], strict=True):
            if e - s >= WORDS:
                g = np.sort(grams[s : e - WORDS + 1])
                out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
            elif e > s:
                h = np.array([e - s], np.uint64)
                for w in words[s:e]:
                    h = C.mix(h * _W[0] + w)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row per set; sets must not be empty."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    return np.stack([np.minimum.reduceat(flat * a + b, at) for a, b in zip(_A, _B, strict=True)], axis=1)


def set_id(shingles: np.ndarray) -> Decimal:
    """A number for a set of sorted shingle hashes."""
    return Decimal(int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), "little") >> 2)


def _pass_one(texts: list[str | None]) -> list:
    sets = shingle_sets(C.utf8(texts))
    ids: list = [None] * len(sets)
    keys: list = [None] * len(sets)
    full = [i for i, s in enumerate(sets) if len(s)]
    for a, b in C.sized([sets[i].data for i in full], 250_000):
        part = full[a:b]
        # the least values are small numbers: mixed, their upper bits differ
        sig = C.mix(signatures([sets[i] for i in part]).reshape(len(part), TREES, DEPTH)) >> np.uint64(48)
        key = np.zeros((len(part), TREES), np.uint64)
        for d in range(DEPTH):
            key = key << np.uint64(16) | sig[:, :, d]
        for i, row in zip(part, key.view(np.int64), strict=True):
            ids[i], keys[i] = set_id(sets[i]), row
    return [[len(s) for s in sets], ids, keys]


def forest_edges(classes: DataFrame, scratch: C.Scratch) -> DataFrame:
    """(a, b): classes that are neighbours in the sorted order of a tree and agree deep enough for their region."""
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = classes.select(F.posexplode("keys").alias("tree", "key"), "set_id")
    # written: the bounds of the range partitions are drawn anew each time the sort runs
    order = ["tree", "key", "set_id"]
    rows = scratch.write(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    w = Window.partitionBy("part").orderBy(*order)
    ends = rows.groupBy("part").agg(F.max(F.struct(*order)).alias("last"))  # one row a partition
    ends = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("edge"))
    at = F.struct(*order)
    near = rows.select("part", *order, F.lag(at).over(w).alias("before"), F.lag(F.struct("tree", "key"), REGION).over(w).alias("far"), F.lead(F.struct("tree", "key"), REGION).over(w).alias("ahead"))
    near = near.join(F.broadcast(ends), "part").withColumn("inside", F.col("before").isNotNull()).withColumn("before", F.coalesce("before", "edge"))

    def alike(other: str, depth: int):
        """Same tree and ``depth`` common leading values; null counts as unlike."""
        same = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.col(f"{other}.key")), 16 * (DEPTH - depth)) == 0
        return F.coalesce((F.col("tree") == F.col(f"{other}.tree")) & same, F.lit(False))

    dense = alike("far", DEPTH - 1) | alike("ahead", DEPTH - 1)
    joined = alike("before", DEPTH) | (~dense & alike("before", DEPTH - 1))
    near = near.select("part", *order, "before", joined.alias("joined"), F.when(~(joined & F.col("inside")), F.col("set_id")).alias("head"))
    # inside a partition all rows of a run are linked with its first one: fewer steps to their component than a chain
    near = near.withColumn("head", F.last("head", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    edge = F.when(F.col("head") != F.col("set_id"), F.col("head")).otherwise(F.col("before.set_id"))
    return near.where("joined").select(F.col("set_id").alias("a"), edge.alias("b")).where("a <> b")


def connected_components(edges: DataFrame, scratch: C.Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges; root is the component's smallest node.

    Alternates large-star and small-star steps, each an aggregation and a join; a node's neighbours are never listed.
    """
    e = scratch.write(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    state, rows = None, 2 * e.count()  # a step makes at most two rows of one
    while True:
        # the minima are written: a merge join then shuffles both sides, and the rows of a hub can be split
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), rows)
        large = scratch.write(both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), rows)
        down = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), rows)
        small = large.join(down.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("x")).select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        nxt = scratch.write(small, rows)
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(e, low, large, down)
        e = nxt
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def link_sets(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Component label (smallest index) of each set, over all pairs that reach the threshold."""
    n = len(sets)
    label = np.arange(n)
    size = np.array([len(s) for s in sets])
    if n < 2:
        return label
    if n == 2:
        both = np.intersect1d(sets[0], sets[1], assume_unique=True).size
        if 100 * both >= percent * (size.sum() - both):
            label[1] = 0
        return label
    _, inv, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))  # rare shingles first
    at = np.cumsum([0, *size])
    rows = [np.sort(rank[inv[at[i] : at[i + 1]]]) for i in range(n)]
    keep = size - (percent * size + 99) // 100 + 1
    token = np.concatenate([r[:k] for r, k in zip(rows, keep, strict=True)])
    owner = np.repeat(np.arange(n), keep)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    mark = np.zeros(len(count), bool)
    for i in range(n):
        pre = rows[i][: keep[i]]
        lo, hi = np.searchsorted(token, pre), np.searchsorted(token, pre, "right")
        wide = np.flatnonzero(hi - lo > 1)
        if not len(wide):
            continue
        near = np.unique(np.concatenate([owner[lo[k] : hi[k]] for k in wide]))
        near = near[near < i]
        near = near[(label[near] != label[i]) & (100 * size[near] >= percent * size[i]) & (percent * size[near] <= 100 * size[i])]
        if not len(near):
            continue
        mark[rows[i]] = True
        for j in near:
            if label[j] != label[i]:
                both = int(mark[rows[j]].sum())
                if 100 * both >= percent * (size[i] + size[j] - both):
                    x, y = sorted((label[i], label[j]))
                    label[label == y] = x
        mark[rows[i]] = False
    return label


def _confirm(source: Iterator[pa.RecordBatch], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task; only the running task's sets are held."""
    key, ids, sets = None, [], []
    out: list[tuple[Decimal, Decimal]] = []

    def close() -> None:
        out.extend((ids[k], ids[x]) for k, x in enumerate(link_sets(sets, percent)) if x != k)

    def made() -> pa.RecordBatch:
        kind = pa.decimal128(38, 0)
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], names=["a", "b"])

    for batch in C.batches(source):
        for part in C.slices(batch):
            rows = zip(*[part.column(c).to_pylist() for c in ("cluster", "x", "y", "set_id")], strict=True)
            for (*task, i), s in zip(rows, shingle_sets(C.utf8(part.column("text").to_pylist())), strict=True):
                if task != key:
                    close()
                    key, ids, sets = task, [], []
                if ids and ids[-1] == i:  # a repeated row; rows of a task are sorted by set
                    continue
                ids.append(i)
                sets.append(s)
        yield made()
        out.clear()
    close()
    yield made()


def _grouped(docs: DataFrame, id_col: str, text_col: str, percent: int, scratch: C.Scratch) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles and group: the (none, doc_id, th) of the row that stands for the component; null without words."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    one = scratch.write(C.per_text(src, f"n_shingles long, set_id {SET}, keys array<long>", lambda: _pass_one))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("rep")
    classes = one.where("n_shingles > 0").groupBy("set_id").agg(rep, F.first("keys").alias("keys"), F.first("n_shingles").alias("n"))
    # written, so that joins with it shuffle both sides and a hot set can be split
    classes = scratch.write(classes)
    cluster = connected_components(forest_edges(classes, scratch), scratch)
    cluster = scratch.write(cluster.unionByName(cluster.select(F.col("root").alias("node"), "root").distinct()))
    member = cluster.join(classes.select("set_id", "rep", "n"), F.col("node") == F.col("set_id")).select("set_id", "rep", "n", F.col("root").alias("cluster"))
    blocks = scratch.write(member.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("nb")))
    member = member.join(blocks, "cluster").select("set_id", "cluster", "nb", F.col("rep.doc_id").alias("rid"), F.col("rep.th").alias("rth"))
    texts = src.join(member.hint("shuffle_hash"), (F.col("th") == F.col("rth")) & F.col("doc_id").eqNullSafe(F.col("rid"))).withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("nb")))
    tasks = texts.select("set_id", "cluster", "text", "own", F.explode(F.expr("sequence(0, nb - 1)")).alias("other")).select("set_id", "cluster", "text", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = tasks.repartition(n_tasks, "cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "set_id").mapInArrow(lambda source: _confirm(source, percent), f"a {SET}, b {SET}")
    links = scratch.write(links)
    found = scratch.write(connected_components(links, scratch) if blocks.where("nb > 1").limit(1).count() else links.select(F.col("a").alias("node"), F.col("b").alias("root")))
    label = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    label = label.join(classes.select("set_id", "rep"), F.col("node") == F.col("set_id")).select("set_id", "root", "rep")
    root = label.groupBy("root").agg(F.min("rep").alias("linked"))
    named = label.join(root, "root").select(F.col("set_id").alias("set"), "linked")
    names = scratch.write(classes.select("set_id", "rep").join(named, F.col("set_id") == F.col("set"), "left").select(F.col("set_id").alias("own_set"), F.coalesce("linked", "rep").alias("group")))
    return one.join(names, F.col("set_id") == F.col("own_set"), "left").select("doc_id", "th", "n_shingles", "group")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``docs``."""
    rows = _grouped(docs, id_col, text_col, percent, C.Scratch(docs.sparkSession, "neardup"))
    comp = F.coalesce("group.doc_id", "doc_id")
    return rows.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each group and every row without words, all columns as they are; of rows that repeat a doc_id and text, one stays."""
    scratch = C.Scratch(docs.sparkSession, "neardup-kept")
    rows = _grouped(docs, id_col, text_col, percent, scratch)
    alone = F.col("group").isNull() | (F.col("doc_id").eqNullSafe(F.col("group.doc_id")) & (F.col("th") == F.col("group.th")))
    th, kid, kth = C.fresh(docs, "text_hash", "kept_id", "kept_hash")
    kept = scratch.write(rows.where(alone).groupBy(F.col("doc_id").alias(kid), F.col("th").alias(kth)).agg(F.count("*").alias("n")))
    out = docs.withColumn(th, F.xxhash64(text_col))
    out = out.join(kept.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(kid)) & (F.col(th) == F.col(kth)), "left_semi")
    return (out.dropDuplicates([id_col, th]) if kept.where("n > 1").limit(1).count() else out).select(*docs.columns)
