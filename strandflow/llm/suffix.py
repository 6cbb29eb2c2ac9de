"""Removal of repeated 200-byte strings, by deep-shallow suffix sorting.

Every byte that lies in a ``LENGTH``-byte string which also starts anywhere else (same document included) is removed.
Matches never cross documents and are judged on the input.

Sorting all suffixes of a corpus would move every byte many times, so suffixes are sorted where strings can repeat:

1. Each ``LENGTH``-byte window has an anchor: its leftmost ``GRAM``-byte substring of least hash.  Equal windows have
   equal anchors at equal offsets; there is about one anchor in 90 bytes.  Texts are reduced to distinct ones first;
   a text with copies is removed whole, if it has a window at all, and stands once as a partner for others.
2. Anchor hashes that occur once are dropped (a count with map-side combine).  For the others the bytes of all windows
   with that anchor are cut out as one context (at most 2 * LENGTH - GRAM bytes), and equal contexts are merged.
3. The contexts of an anchor are sorted twice: the suffixes from the anchor on, and the reversed prefixes before it.
   The sort is deep-shallow: multikey quicksort by 8-byte words to depth ``SHALLOW``; groups that are still tied are
   ordered by a blind trie each (a Patricia tree whose descent looks at branching bytes only, with one comparison per
   insertion).  Both sorts give longest common prefixes of neighbours, and so, for each offset, classes of equal left
   and right parts; a window repeats if another context has both classes in common with it.
4. An anchor with more than ``HOT`` different contexts is never gathered: its windows are counted as rows.

Defined results: null text is empty; texts under LENGTH bytes lose nothing; rows that repeat are copies of each other
(also rows with the same doc_id); an empty table gives an empty result; columns beside doc_id and text are not read; ids
keep their type, nulls included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import common as C

LENGTH, GRAM = 200, 24
SHALLOW = 64
HOT = 50_000
#: Contexts that one sorting step takes, beyond those of one anchor.
STEP = 20_000
_WIDE = LENGTH - GRAM + 1
_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def pieces(texts: list[bytes], limit: int) -> Iterator[tuple[int, int, bytes]]:
    """(index, place, bytes); texts over ``limit`` in pieces that share LENGTH - 1 bytes, so each window is in one."""
    for k, t in enumerate(texts):
        for s in range(0, max(len(t) - LENGTH + 1, 1), limit):
            yield k, s, t[s : s + limit + LENGTH - 1]


def anchors(texts: list[bytes], limit: int = 1 << 22) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(index, hash, place, first window, last window) of the anchors of each text; a very long text comes in pieces."""
    cut = list(pieces(texts, limit))
    for a, b in C.sized([x[2] for x in cut]):
        part = [x[2] for x in cut[a:b]]
        size = np.array([len(t) for t in part])
        at = np.cumsum([0, *size])
        buf = np.frombuffer(b"".join(part), np.uint8)
        n = len(buf) - GRAM + 1
        if len(buf) < LENGTH:
            continue
        prefix = C.prefix_hash(C.BYTE_CODE[buf])
        gram = C.mix((prefix[GRAM:] - prefix[:-GRAM]) * C.powers(len(prefix))[1][:n])
        key = (gram & ~_PLACE) | np.arange(n, dtype=np.uint64)
        low, width = key, 1
        while 2 * width <= _WIDE:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (_WIDE - width)], low[_WIDE - width :])
        place = (low & _PLACE).astype(np.int64)
        for k in np.flatnonzero(size >= LENGTH):
            s, e = at[k], at[k + 1] - LENGTH + 1
            own = place[s:e]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            last = np.append(first[1:], len(own)) - 1
            m, (doc, base, _) = own[first], cut[a + k]
            yield doc, gram[m].view(np.int64), m - s + base, first + base, last + base


def _hashes(texts: list[str | None]) -> list:
    out: list = [np.zeros(0, np.int64)] * len(texts)
    for k, h, *_ in anchors(C.utf8(texts)):
        out[k] = np.concatenate([out[k], h]) if len(out[k]) else h
    return [out]


CONTEXT = "h long, lft int, ctx binary, ta long, tb long, at int"


def _contexts():
    kinds = [f.type for f in to_arrow_schema(StructType.fromDDL(CONTEXT))]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text the contexts of its wanted anchors (column hs)."""
        for batch in C.batches(source):
            for part in C.slices(batch):
                texts = C.utf8(part.column("text").to_pylist())
                ta, tb, hs = part.column("ta").to_numpy(), part.column("tb").to_numpy(), part.column("hs")
                rows: list[tuple] = []
                for k, h, place, first, last in anchors(texts):
                    wanted = np.flatnonzero(np.isin(h, hs[k].values.to_numpy(zero_copy_only=False)))
                    cut = [texts[k][s : e + LENGTH] for s, e in zip(first[wanted].tolist(), last[wanted].tolist(), strict=True)]
                    rows.append((h[wanted], (place - first)[wanted], cut, np.full(len(wanted), ta[k]), np.full(len(wanted), tb[k]), first[wanted]))
                if rows:
                    h, lft, cut, a, b, at = zip(*rows, strict=True)
                    made = [np.concatenate(h), np.concatenate(lft), [c for x in cut for c in x], np.concatenate(a), np.concatenate(b), np.concatenate(at)]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds, strict=True)], names=["h", "lft", "ctx", "ta", "tb", "at"])

    return run


# ---------------------------------------------------------------------------------------------------------------------
# sorting
# ---------------------------------------------------------------------------------------------------------------------
def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of distinct strings of one length, and each one's common prefix with the one before it."""
    width = len(strings[0])
    nums = [int.from_bytes(s, "big") for s in strings]

    def common(i: int, j: int) -> int:
        return width - ((nums[i] ^ nums[j]).bit_length() + 7) // 8

    if len(strings) == 2:
        return ([0, 1] if nums[0] < nums[1] else [1, 0]), [0, common(0, 1)]
    # an inner node is [depth, {byte: child}], a leaf is the string's number
    root: list | int = 0
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while not isinstance(node, int):
            down = node[1].get(s[node[0]])
            node = down if down is not None else next(iter(node[1].values()))
        depth = common(i, node)
        other = strings[node][depth]
        parent, node = None, root
        while not isinstance(node, int) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, int) and node[0] == depth:
            node[1][s[depth]] = i
            continue
        fresh = [depth, {other: node, s[depth]: i}]
        if parent is None:
            root = fresh
        else:
            parent[1][s[parent[0]]] = fresh
    order: list[int] = []
    lcp: list[int] = []
    stack: list[tuple[list | int, int]] = [(root, 0)]
    while stack:
        node, above = stack.pop()
        if isinstance(node, int):
            order.append(node)
            lcp.append(above)
        else:
            keys = sorted(node[1], reverse=True)
            stack += [(node[1][k], node[0]) for k in keys[:-1]]
            stack.append((node[1][keys[-1]], above))
    return order, lcp


def deep_shallow(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows within their (ascending) groups, and each row's common prefix with the one before it (-1 at a
    group's start; the row's width for equal rows)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8")
    order = np.arange(n)
    lcp = np.full(n, -1, np.int64)
    same = np.zeros(n, bool)  # tied with the one before
    same[1:] = group[1:] == group[:-1]
    shallow = min(SHALLOW // 8, words.shape[1])
    for level in range(shallow):  # multikey quicksort, a word at a time, inside ties
        part = same.copy()
        part[:-1] |= same[1:]
        at = np.flatnonzero(part)
        if not len(at):
            break
        number = np.cumsum(~same[at])
        w = words[order[at], level].astype(np.uint64)
        by = np.lexsort((w, number))
        order[at], w = order[at][by], w[by]
        apart = np.zeros(len(at), bool)
        apart[1:] = same[at][1:] & (w[1:] != w[:-1])
        k = np.flatnonzero(apart)
        diff = w[k] ^ w[k - 1]
        # leading zero bytes of the difference
        lcp[at[k]] = 8 * level + sum((diff < np.uint64(1 << (8 * z))).astype(np.int64) for z in range(1, 8))
        same[at[k]] = False
    begin = np.flatnonzero(np.diff(np.append(same, False).astype(np.int8), prepend=0) == 1) - 1
    end = np.flatnonzero(np.diff(np.append(same, False).astype(np.int8), prepend=0) == -1)
    lcp[same] = width
    if 8 * shallow >= width:
        return order, lcp
    for s, e in zip(begin.tolist(), end.tolist(), strict=True):  # ties s..e-1: a blind trie each
        members = order[s:e].tolist()
        alike: dict[bytes, list[int]] = {}
        for m in members:
            alike.setdefault(rows[m, 8 * shallow :].tobytes(), []).append(m)
        if len(alike) > 1:
            strings = list(alike)
            by, common = blind_trie(strings)
            k = s
            for i, c in zip(by, common, strict=True):
                own = alike[strings[i]]
                order[k : k + len(own)] = own
                if k > s:
                    lcp[k] = 8 * shallow + c
                k += len(own)
    return order, lcp


def repeated_windows(group: np.ndarray, left: np.ndarray, contexts: list[bytes], often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the runs of bytes covered by repeated windows; ``group`` ascends; ``often``: more than one copy."""
    n = len(contexts)
    size = np.array([len(c) for c in contexts])
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    at = np.cumsum([0, *size])[:-1]
    right = np.zeros((n, LENGTH), np.uint8)
    back = np.zeros((n, _WIDE - 1), np.uint8)
    for matrix, length in ((right, size - left), (back, left)):
        length = np.minimum(length, matrix.shape[1])
        col = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        row = np.repeat(np.arange(n), length)
        origin = np.repeat(at + left, length)
        matrix[row, col] = flat[origin + col] if matrix is right else flat[origin - 1 - col]
    classes = []
    for matrix in (right, back):
        order, lcp = deep_shallow(matrix, group)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        classes.append((place, lcp))
    (pr, lr), (pl, ll) = classes
    repeated = np.zeros((n, _WIDE + 1), bool)
    for d in range(_WIDE):
        live = np.flatnonzero((d <= left) & (d >= left + LENGTH - size))
        if len(live) < 1:
            continue
        rid, lid = np.cumsum(lr < LENGTH - d)[pr[live]], np.cumsum(ll < d)[pl[live]]
        key = (lid.astype(np.int64) << 32) | rid
        by = np.argsort(key, kind="stable")
        tie = key[by][1:] == key[by][:-1]
        dup = np.zeros(len(live), bool)
        dup[by[1:][tie]] = True
        dup[by[:-1][tie]] = True
        repeated[live, left[live] - d] = dup | often[live]
    edge = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    who, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return who, start, stop - 1 + LENGTH


def _sorted_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; whole anchors are judged together, about STEP contexts at a time."""

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy()
        who, start, end = repeated_windows(np.cumsum(np.diff(h, prepend=h[:1]) != 0), pdf["lft"].to_numpy(np.int64), [bytes(c) for c in pdf["ctx"]], pdf["n"].to_numpy() > 1)
        return pd.DataFrame({"ca": pdf["ca"].to_numpy()[who], "cb": pdf["cb"].to_numpy()[who], "s": start.astype(np.int32), "e": end.astype(np.int32)})

    rest = None
    for pdf in C.batches(batches):
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        h = pdf["h"].to_numpy()
        cuts = np.append(np.flatnonzero(np.diff(h)) + 1, len(h)) if len(h) else np.zeros(1, int)
        done = 0
        for c, nxt in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if nxt - done > STEP or nxt == len(h):
                if c > done:
                    yield judge(pdf.iloc[done:c])
                done = c
        rest = pdf.iloc[done:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield judge(rest)


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"


def _judged(text: bytes, whole: bool, spans: list[dict] | None) -> tuple:
    merged: list[list[int]] = []
    if whole:
        merged = [[0, len(text)]]
    else:
        for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
    kept, at = hashlib.sha256(), 0
    for s, e in merged:
        kept.update(text[at:s])
        at = e
    kept.update(text[at:])
    return len(text), sum(e - s for s, e in merged), len(merged), kept.hexdigest(), [x[0] for x in merged], [x[1] for x in merged]


def _finish(schema: StructType):
    kinds = [f.type for f in to_arrow_schema(schema)][1:]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.batches(source):
            for part in C.slices(batch):
                cells = [part.column(c).to_pylist() for c in ("text", "whole", "spans")]
                rows = [_judged(t, w, s) for t, w, s in zip(C.utf8(cells[0]), *cells[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names=schema.names)

    return run


def _text_id(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), text).alias("ta"), F.xxhash64(F.lit(2), text).alias("tb")]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends (byte offsets of the removed runs); one row per row of ``docs``."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "suffix")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *_text_id(text))
    long = src.where(F.octet_length("text") >= LENGTH)

    made = scratch.write(C.per_text(long, "hs array<long>", lambda: _hashes))
    copies = made.groupBy("ta", "tb").agg(F.count("*").alias("n"), F.min(F.struct("doc_id")).alias("rep"))
    whole = scratch.write(copies.where("n > 1").select("ta", "tb"))
    # one row of each text: its copies have the same hashes
    one = made.groupBy("ta", "tb").agg(F.first("hs").alias("hs"))
    each = one.select("ta", "tb", F.explode("hs").alias("h"))
    # written, so that the join shuffles both sides and a hot anchor can be split
    often = scratch.write(each.groupBy("h").count().where("count > 1").select("h"))
    wanted = each.join(often, "h").groupBy("ta", "tb").agg(F.collect_set("h").alias("hs"))
    wanted = scratch.write(wanted.join(copies.select("ta", "tb", "rep"), ["ta", "tb"]))
    scratch.drop(made)

    found = wanted.select(F.col("ta").alias("wa"), F.col("tb").alias("wb"), "hs", F.col("rep.doc_id").alias("rep"))
    cut = long.join(found.hint("shuffle_hash"), (F.col("ta") == F.col("wa")) & (F.col("tb") == F.col("wb")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    cut = cut.select("text", "ta", "tb", "hs").mapInArrow(_contexts(), CONTEXT)
    cut = scratch.write(cut.withColumns({"ca": F.xxhash64(F.lit(1), "h", "lft", "ctx"), "cb": F.xxhash64(F.lit(2), "h", "lft", "ctx")}))
    scratch.tidy()

    distinct = scratch.write(cut.groupBy("h", "lft", "ctx", "ca", "cb").agg(F.count("*").alias("n")))
    kinds = scratch.write(distinct.groupBy("h").agg(F.count("*").alias("kinds")))
    lone = distinct.join(kinds.where("kinds = 1").select("h"), "h").where("n > 1").select("ca", "cb", F.lit(0).alias("s"), F.octet_length("ctx").alias("e"))
    some = distinct.join(kinds.where((F.col("kinds") > 1) & (F.col("kinds") <= HOT)).select("h"), "h")
    some = some.repartition(parts, "h").sortWithinPartitions("h").mapInPandas(_sorted_contexts, "ca long, cb long, s int, e int")
    hot = distinct.join(kinds.where(F.col("kinds") > HOT).select("h"), "h")
    rows = hot.select("h", "lft", "ctx", "ca", "cb", "n", F.explode(F.expr(f"sequence(0, octet_length(ctx) - {LENGTH})")).alias("i"))
    window = [F.col("h"), (F.col("lft") - F.col("i")).alias("d"), F.expr(f"xxhash64(1, substring(ctx, i + 1, {LENGTH}))").alias("x"), F.expr(f"xxhash64(2, substring(ctx, i + 1, {LENGTH}))").alias("y")]
    rows = rows.select(*window, "ca", "cb", "i", "n")
    twice = rows.groupBy("h", "d", "x", "y").agg(F.sum("n").alias("total")).where("total > 1")
    hot = rows.join(twice, ["h", "d", "x", "y"]).select("ca", "cb", F.col("i").alias("s"), (F.col("i") + LENGTH).alias("e"))
    result = lone.unionByName(some).unionByName(hot)
    spans = cut.select("ca", "cb", "ta", "tb", "at").join(result, ["ca", "cb"]).select("ta", "tb", F.struct((F.col("at") + F.col("s")).alias("s"), (F.col("at") + F.col("e")).alias("e")).alias("x"))
    spans = spans.join(whole, ["ta", "tb"], "left_anti").groupBy("ta", "tb").agg(F.collect_list("x").alias("spans")).withColumn("whole", F.lit(False))
    none = F.lit(None).cast("array<struct<s:int,e:int>>")
    spans = scratch.write(spans.unionByName(whole.select("ta", "tb", none.alias("spans"), F.lit(True).alias("whole"))))
    scratch.drop(cut, distinct)
    scratch.tidy()
    named = spans.select(F.col("ta").alias("sa"), F.col("tb").alias("sb"), "spans", "whole")
    out = src.join(named.hint("shuffle_hash"), (F.col("ta") == F.col("sa")) & (F.col("tb") == F.col("sb")), "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
    schema = StructType([src.schema["doc_id"], *StructType.fromDDL(RESULT).fields])
    return out.mapInArrow(_finish(schema), schema)
