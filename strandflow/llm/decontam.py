"""Benchmark decontamination with suffix arrays over training text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window is ``WINDOW`` consecutive words of a
benchmark item; an item of fewer words, but not none, is one window.  A document word inside any occurrence of a window
is hit, and a document is contaminated if it has hits and 20 * n_hit >= n_words.

Each shard of documents (a part of one Arrow batch, ``SHARD_BYTES`` or one longer document) gets its own word-level
suffix array.  A suffix can only match if its first word and its first pair of words occur in the benchmark, so only
such suffixes are sorted: by their first two words, then level by level by the next two inside the ties that are left,
as far as a window reaches.  Every benchmark suffix that holds a window is then binary-searched in the shard's array.
The range that shares the whole window gives all locations; each of them is followed to its real end, so a passage of any length is one match,
and the longest one of each benchmark suffix is known.

Nothing is shuffled: the benchmark is the stated query set.  It is read in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` bytes (one longer item is a block of its own); each block is a broadcast of its own, about 5 bytes a
byte of text, and every shard meets every block.  A worker holds one block at a time: beyond the first, blocks are
loaded for a shard and dropped again.

Defined results: null or empty text has no words (n_words 0, not contaminated); a null or empty item has no window;
items with equal text all count; rows that repeat are judged alike; an empty benchmark hits nothing; ids keep their
type, nulls included; a null item_id reads as an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import common as C

WINDOW = 13
SHARD_BYTES = 4_000_000
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8_000_000
_BITS = 20


class Block:
    """Query suffixes of some benchmark items: their words one after another, each item followed by ``WINDOW`` zeros."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.ids = [i for i, _ in items]
        words, at = C.hash_words([t for _, t in items], C.ALNUM_WORD)
        size = np.diff(at)
        owner = np.repeat(np.arange(len(items), dtype=np.int32), size)
        self.place = (np.arange(len(words)) + WINDOW * owner).astype(np.int64)
        self.words = np.zeros(len(words) + WINDOW * len(items) + WINDOW, np.uint64)
        self.words[self.place] = words
        self.owner = owner
        self.begin = (at[:-1] + WINDOW * np.arange(len(items))).astype(np.int64)  # place of each item's first word
        self.left = (np.repeat(at[1:], size) - np.arange(len(words))).astype(np.int32)  # words from here to the item's end
        self.full = np.minimum(size, WINDOW).astype(np.int32)[owner]  # length of the item's windows
        self.is_window = self.left >= self.full
        self.first = np.zeros(1 << _BITS, bool)
        self.pair = np.zeros(1 << _BITS, bool)
        single = self.full == 1  # one-word items
        self.first[words[single] >> np.uint64(64 - _BITS)] = True
        more = self.place[self.left > 1]
        self.pair[_pair(self.words[more], self.words[more + 1])] = True
        self.any_single = bool(single.any())


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - _BITS)).astype(np.int64)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """``starts`` in the order of words[start:start+depth]; words must be padded by ``depth``."""
    order = starts[np.lexsort((words[starts + 1], words[starts]))]
    level, tied = 2, np.arange(len(order))
    same = np.zeros(len(order), bool)
    same[1:] = (words[order[1:]] == words[order[:-1]]) & (words[order[1:] + 1] == words[order[:-1] + 1])
    while level < depth and same.any():
        group = same.copy()
        group[:-1] |= same[1:]
        tied = np.flatnonzero(group)
        part = order[tied]
        number = np.cumsum(~same[tied])
        a, b = words[part + level], words[part + level + 1] if level + 1 < depth else None
        keys = (a, number) if b is None else (b, a, number)
        by = np.lexsort(keys)
        order[tied] = part = part[by]
        more = np.zeros(len(tied), bool)
        more[1:] = same[tied][1:] & (a[by][1:] == a[by][:-1])
        if b is not None:
            more[1:] &= b[by][1:] == b[by][:-1]
        same = np.zeros(len(order), bool)
        same[tied] = more
        level += 2
    return order


def search(words: np.ndarray, order: np.ndarray, queries: np.ndarray, place: np.ndarray, length: np.ndarray, upper: bool) -> np.ndarray:
    """For each query suffix (queries[place:]), how many suffixes come before it (upper: before or share its first ``length`` words)."""
    lo, hi = np.zeros(len(place), np.int64), np.full(len(place), len(order), np.int64)
    while (lo < hi).any():
        live = np.flatnonzero(lo < hi)
        mid = (lo[live] + hi[live]) // 2
        at = order[mid]
        state = np.zeros(len(live), np.int8)  # -1: suffix before query, 1: after
        for k in range(WINDOW):
            w, q = words[at + k], queries[place[live] + k]
            open_ = (state == 0) & (k < length[live])
            state[open_ & (w < q)] = -1
            state[open_ & (w > q)] = 1
        before = (state < 0) | (upper & (state == 0))
        lo[live[before]] = mid[before] + 1
        hi[live[~before]] = mid[~before]
    return lo


def common_words(words: np.ndarray, at: np.ndarray, queries: np.ndarray, place: np.ndarray, left: np.ndarray) -> np.ndarray:
    """How many words from each ``at`` equal those of the query suffix, to the real end of the match."""
    n, live = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(live):
        k = n[live]
        live = live[k < left[live]]
        live = live[words[at[live] + n[live]] == queries[place[live] + n[live]]]
        n[live] += 1
    return n


class Shard:
    """Words of some texts and what the benchmark's blocks hit in them."""

    def __init__(self, texts: list[bytes]):
        self.texts = len(texts)
        words, self.at = C.hash_words(texts, C.ALNUM_WORD)
        # A 0 after each text keeps matches inside it: no benchmark word hashes to 0.
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.at))
        self.words = np.zeros(len(words) + len(texts) + WINDOW + 2, np.uint64)
        self.place = np.arange(len(words)) + self.owner
        self.words[self.place] = words
        self.base = self.at[:-1] + np.arange(len(texts))
        self.cover = np.zeros(len(self.words) + 1, np.int64)
        self.items: list[set[str]] = [set() for _ in texts]

    def windows(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """(query suffix, place in the words) of every occurrence of a window of the block."""
        none = np.zeros(0, np.int64)
        keep = b.pair[_pair(self.words[self.place], self.words[self.place + 1])]
        if b.any_single:
            keep |= b.first[self.words[self.place] >> np.uint64(64 - _BITS)]
        starts = self.place[keep]
        q = np.flatnonzero(b.is_window)
        if not len(starts) or not len(q):
            return none, none
        order = suffix_array(self.words, starts)
        first = search(self.words, order, b.words, b.place[q], b.full[q], False)
        last = search(self.words, order, b.words, b.place[q], b.full[q], True)
        n = last - first
        return np.repeat(q, n), order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)]

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, place, "right") - 1

    def meet(self, b: Block) -> None:
        q, where = self.windows(b)
        np.add.at(self.cover, where, 1)
        np.add.at(self.cover, where + b.full[q], -1)
        for d, k in np.unique(np.stack([self.text_of(where), b.owner[q]], 1), axis=0).tolist() if len(q) else []:
            self.items[d].add(b.ids[k])

    def longest(self, b: Block) -> list[tuple[int, str, int, int, int]]:
        """(text, item, word place in the text, word place in the item, words) of the verbatim matches of a window or
        more that nothing longer holds: they end where the texts differ, on both sides."""
        q, where = self.windows(b)
        if not len(q):
            return []
        # an occurrence whose words before are equal too is the tail of a longer match
        left = (b.place[q] > b.begin[b.owner[q]]) & (where > 0)
        left[left] = self.words[where[left] - 1] == b.words[b.place[q][left] - 1]
        q, where = q[~left], where[~left]
        n = common_words(self.words, where, b.words, b.place[q], b.left[q])
        d = self.text_of(where)
        return [(t, b.ids[b.owner[k]], w, i, m) for t, k, w, i, m in zip(d.tolist(), q.tolist(), (where - self.base[d]).tolist(), (b.place[q] - b.begin[b.owner[q]]).tolist(), n.tolist(), strict=True)]

    def figures(self) -> list[tuple[int, int, int, str, bool]]:
        """Per text n_words, n_hit, n_items, items, contaminated."""
        hit = np.cumsum(self.cover)[:-1][self.place] > 0
        n_hit = np.bincount(self.owner[hit], minlength=self.texts).tolist()
        n = np.diff(self.at).tolist()
        return [(n[d], n_hit[d], len(self.items[d]), ",".join(sorted(self.items[d])), n_hit[d] > 0 and 20 * n_hit[d] >= n[d]) for d in range(self.texts)]


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list:
    """Broadcasts of bounded size, read from the benchmark one row at a time."""
    sc, out, part, size = benchmark.sparkSession.sparkContext, [], [], 0
    for name, text in benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        if not text:
            continue
        part.append((name if name is not None else "", text.encode("utf-8")))
        size += len(part[-1][1])
        if len(part) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            out.append(sc.broadcast(Block(part)))
            part, size = [], 0
    if part:
        out.append(sc.broadcast(Block(part)))
    return out


def _loaded(broadcasts: list) -> Iterator[Block]:
    """The blocks, one after another; only the first stays in the worker."""
    for k, b in enumerate(broadcasts):
        yield b.load_from_path(b._path) if k and getattr(b, "_path", None) else b.value


def judged(texts: list[bytes], broadcasts: list) -> list[tuple[int, int, int, str, bool]]:
    out = []
    for a, e in C.sized(texts, SHARD_BYTES):
        shard = Shard(texts[a:e])
        for block in _loaded(broadcasts):
            shard.meet(block)
        out += shard.figures()
    return out


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    broadcasts = benchmark_blocks(benchmark)

    def judge(texts: list[str | None]) -> list:
        n, hit, items, names, bad = zip(*judged(C.utf8(texts), broadcasts), strict=True)
        return [n, hit, items, [hashlib.sha256(x.encode()).hexdigest() for x in names], bad]

    return C.per_text(src, RESULT, lambda: judge, SHARD_BYTES)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    broadcasts = benchmark_blocks(benchmark)
    return C.filter_rows(docs, text_col, lambda: lambda texts: [not x[4] for x in judged(texts, broadcasts)])


def locations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every verbatim match of a window or more, to its real ends: doc_id, item_id, word_at (in the document), item_word_at, n_words."""
    broadcasts = benchmark_blocks(benchmark)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["doc_id"], *StructType.fromDDL("item_id string, word_at long, item_word_at long, n_words long").fields])
    kinds = [f.type for f in to_arrow_schema(schema)][1:]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.batches(source):
            for part in C.slices(batch, limit=SHARD_BYTES):
                shard = Shard(C.utf8(part.column("text").to_pylist()))
                got = [x for block in _loaded(broadcasts) for x in shard.longest(block)]
                which, *rest = zip(*got, strict=True) if got else [[]] * 5
                ids = part.column("doc_id").take(pa.array(which, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(v, k) for v, k in zip(rest, kinds, strict=True)]], names=schema.names)

    return src.mapInArrow(run, schema)
