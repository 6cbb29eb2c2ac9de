"""Packing documents into sequences of at most 2048 tokens: cutting stock by column generation.

A document is its token ids and then id ``END``.  It is cut after every full sequence; each such piece is a sequence of
its own, and what is left (1 to 2048 tokens) is the document's rest.  Rests are counted by length class (``GRAIN``
tokens wide), and the histogram, at most 256 numbers whatever the input, goes to the driver.  There a linear program
over patterns (how many rests of each class share a sequence) is solved by column generation: the simplex method keeps
one pattern per class, and a knapsack dynamic program finds the pattern that the dual prices value most.  Each pattern
is used as often as its rounded-down share says; the few rests beyond that (fewer than 256 patterns' worth) are packed
best fit, and where such a sequence would stay under ``TIGHT`` full, its rests are cut into powers of two, which need no
padding.

Documents get their places by rank within their class.  Ranks are row numbers within (class, salt) plus the number of
rests before that salt, so a class that holds most documents is still dealt over all salts.  The pattern table (at most
256 patterns by 256 classes, and one row for each of the few rests beyond) is joined by class and range of ranks.

Texts are read and tokenised once; checksums of all pieces that may be needed are made then.  The vocabulary file is
opened by its path on every executor.

Defined results: null text is empty and gives one piece, the closing id; an empty table gives an empty result; rows
that repeat are packed each by itself; ids keep their type, nulls included; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .tokens import word_tokenizer

LENGTH = 2048
GRAIN = 8
END = 1
TIGHT = 0.985
#: The linear program ends when no pattern can lower the bound by more than this share.
GAP = 2e-4
_END = np.array([END], "<u4").tobytes()


PIECES = "n long, full array<long>, rest_crc long, powers array<long>"


def _pieces(path: str):
    """Per text: number of ids, checksums of its full sequences, of its rest, and of the rest's powers of two."""
    lib = word_tokenizer(path)
    step = 4 * LENGTH

    def judge(texts: list[str | None]) -> list:
        n, full, rest, powers = [], [], [], []
        for data in lib.encode([t or "" for t in texts]):
            data += _END
            cut = (len(data) - 1) // step * step
            n.append(len(data) // 4)
            full.append([zlib.crc32(data[i : i + step]) for i in range(0, cut, step)])
            rest.append(zlib.crc32(data[cut:]))
            left, crcs = (len(data) - cut) // 4, []
            for k in range(left.bit_length() - 1, -1, -1):
                if left >> k & 1:
                    crcs.append(zlib.crc32(data[cut : cut + (4 << k)]))
                    cut += 4 << k
            powers.append(crcs)
        return [n, full, rest, powers]

    return judge


def best_patterns(size: np.ndarray, price: np.ndarray, room: int, most: int = 12) -> tuple[list[np.ndarray], float]:
    """Unbounded knapsack over ``room`` at these prices: its best pattern's worth, and good patterns, best first.

    Each good pattern has one chosen size in it and fills the rest in the best way.  Sizes ascend.
    """
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    upto = np.searchsorted(size, np.arange(room + 1), "right").tolist()
    for c in range(1, room + 1):
        k = upto[c]
        value[c] = value[c - 1]
        if k:
            v = value[c - size[:k]] + price[:k]
            i = v.argmax()
            if v[i] > value[c] + 1e-12:
                value[c], choice[c] = v[i], i
    worth = price + value[room - size]
    out = []
    for i in np.argsort(-worth, kind="stable")[:most]:
        column, c = np.zeros(len(size)), room - int(size[i])
        column[i] = 1
        while c > 0:
            if choice[c] < 0:
                c -= 1
            else:
                column[choice[c]] += 1
                c -= int(size[choice[c]])
        out.append(column)
    return out, float(worth.max())


def first_fit(size: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that fill a sequence with the greatest sizes that still fit, each used until a size in it is used up.

    A column for each size: those before it in the order of use have used up another one, so the columns are a basis.
    """
    m, left = len(size), demand.astype(float).copy()
    patterns, use, open_ = np.zeros((m, m)), np.zeros(m), np.ones(m, bool)
    while open_.any():
        column, space = np.zeros(m), room
        for c in np.flatnonzero(open_)[::-1]:
            # at most as many as are left, but one of the first
            column[c] = min(space // size[c], max(1, int(left[c])))
            space -= int(column[c]) * int(size[c])
        inside = np.flatnonzero(column)
        share = left[inside] / column[inside]
        gone = inside[share.argmin()]
        patterns[:, gone], use[gone] = column, share.min()
        left[inside] = np.maximum(left[inside] - column[inside] * share.min(), 0)
        left[gone], open_[gone] = 0, False
    return patterns, use


def solve_patterns(size: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used in the linear program's solution.

    It ends when no more than a share ``gap`` of the sequences could be saved: by their tokens, or by the prices of the
    best pattern.
    """
    m = len(size)
    patterns, use = first_fit(size, demand, room)
    inverse = np.linalg.inv(patterns)
    least = float(size @ demand) / room
    for _ in range(60 * m + 200):
        if use.sum() - least <= gap * use.sum():
            break
        price = inverse.sum(0)
        columns, worth = best_patterns(size, price, room)
        least = max(least, float(price @ demand) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or use.sum() - least <= gap * use.sum():
            break
        for column in columns:
            if price @ column <= 1 + 1e-9:
                continue
            step = inverse @ column
            ratio = np.where(step > 1e-10, use / np.where(step > 1e-10, step, 1), np.inf)
            out = int(ratio.argmin())
            theta = ratio[out]
            use = np.maximum(use - theta * step, 0)
            use[out] = theta
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
            patterns[:, out] = column
            price = inverse.sum(0)
    return patterns.astype(np.int64), use


def plan(counts: dict[int, int], room: int = LENGTH // GRAIN, tight: float = TIGHT) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (class, first rank, end rank, first sequence or -1 - number, copies) and the number of sequences.

    Rank r of a row's range goes to sequence first + (r - first rank) % copies; a negative number marks a rest that is
    cut into powers of two.
    """
    size = np.array(sorted(counts))
    if not len(size):
        return [], 0
    demand = np.array([counts[c] for c in size], np.int64)
    patterns, use = solve_patterns(size, demand.astype(float), room)
    rows, seen, sequences = [], np.zeros(len(size), np.int64), 0
    for j in range(len(size)):
        copies = int(np.floor(use[j] + 1e-9))
        a = patterns[:, j]
        short = a > 0
        copies = min(copies, int(((demand - seen)[short] // a[short]).min()))
        if copies <= 0:
            continue
        for c in np.flatnonzero(short):
            rows.append((int(size[c]), int(seen[c]), int(seen[c] + a[c] * copies), sequences, copies))
            seen[c] += a[c] * copies
        sequences += copies
    left = [c for c in range(len(size) - 1, -1, -1) for _ in range(int(demand[c] - seen[c]))]
    space, bins = np.zeros(len(left), np.int64), []
    for c in left:
        fit = np.flatnonzero(space[: len(bins)] >= size[c])
        if len(fit):
            k = int(fit[space[fit].argmin()])
        else:
            k = len(bins)
            bins.append([])
            space[k] = room
        bins[k].append(c)
        space[k] -= size[c]
    cut = 0
    for k, members in enumerate(bins):
        loose = space[k] > (1 - tight) * room
        for c in members:
            rows.append((int(size[c]), int(seen[c]), int(seen[c] + 1), -1 - cut if loose else sequences, 1))
            seen[c] += 1
            cut += loose
        sequences += not loose
    return rows, sequences


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; one row per piece."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "packing")
    path = path or public_tokenizers.path("word_bpe_49k.json")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = C.per_text(src, PIECES, lambda: _pieces(path))
    n_full = F.size("full")
    rest = F.col("n") - n_full * F.lit(LENGTH).cast("long")
    made = scratch.write(made.withColumns({"rest": rest, "class": F.ceil(rest / GRAIN).cast("int"), "salt": F.pmod(F.xxhash64("doc_id", "n", "rest_crc", F.spark_partition_id()), F.lit(salts)).cast("int")}))

    by_salt = made.groupBy("class", "salt").agg(F.count("*").alias("k"))
    before = by_salt.select("class", "salt", F.coalesce(F.sum("k").over(Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    counts = {r[0]: r[1] for r in made.groupBy("class").count().collect()}
    rows, sequences = plan(counts)
    rows = [tuple(map(int, x)) for x in rows]
    table = spark.createDataFrame(rows, "p_class int, first long, end long, seq long, copies long")
    order = ["doc_id", "n", "rest_crc"]
    ranked = made.select("doc_id", "n", n_full.alias("n_full"), "rest", "class", "salt", "rest_crc", "powers").withColumn("r", F.row_number().over(Window.partitionBy("class", "salt").orderBy(*order)) - 1)
    ranked = ranked.join(F.broadcast(before), ["class", "salt"]).withColumn("r", F.col("r") + F.col("before"))
    placed = ranked.join(F.broadcast(table), (F.col("class") == F.col("p_class")) & (F.col("r") >= F.col("first")) & (F.col("r") < F.col("end")))
    start = F.col("n_full") * F.lit(LENGTH).cast("long")
    shared = placed.where("seq >= 0").select("doc_id", start.alias("start"), F.col("rest").alias("length"), F.col("rest_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.col("seq") + (F.col("r") - F.col("first")) % F.col("copies")).alias("sequence_id"))
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    shared = shared.withColumn("offset", F.coalesce(F.sum("length").over(w), F.lit(0)))

    totals = made.groupBy("salt").agg(F.sum(n_full).alias("k"))
    base = totals.select("salt", (F.coalesce(F.sum("k").over(Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.lit(sequences)).alias("base"))
    long = made.where(n_full > 0).select("doc_id", "n", "rest_crc", "full", "salt", n_full.alias("n_full"))
    long = long.withColumn("mine", F.coalesce(F.sum("n_full").over(Window.partitionBy("salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole = long.join(F.broadcast(base), "salt").select("doc_id", "n", (F.col("base") + F.col("mine")).alias("from"), F.posexplode("full").alias("i", "crc"))
    whole = whole.select("doc_id", (F.col("i") * F.lit(LENGTH).cast("long")).alias("start"), F.lit(LENGTH).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.col("from") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    parts = placed.where("seq < 0").select("doc_id", "n", start.alias("at"), F.col("seq"), F.expr("filter(sequence(11, 0, -1), k -> shiftright(rest, k) % 2 = 1)").alias("ks"), "powers")
    parts = parts.select("*", F.posexplode("ks").alias("i", "k"))
    size = F.expr("shiftleft(1L, k)")
    after = F.expr("aggregate(slice(ks, 1, i), 0L, (s, x) -> s + shiftleft(1L, x))")
    # numbers below 0 are free: 12 a rest
    parts = parts.select("doc_id", (F.col("at") + after).alias("start"), size.alias("length"), F.expr("powers[i]").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.col("seq") * 12 - F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(whole).unionByName(parts)
