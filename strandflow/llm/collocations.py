"""Phrase collocations per language: merged count-min sketches first, exact counts of what survives them, then scores.

Words lie between spaces and tabs, A-Z lower-cased; punctuation and line ends cut a text into pieces, and phrases (1 to
``LONGEST`` words) stay inside one.

1. Every task adds the phrases of its texts to a count-min sketch: ``ROWS`` rows of one-byte counters that stop at 255, at
   hashes of language and phrase.  Tasks send what their sketches hold in blocks, and blocks of the same place are added
   (again up to 255).  A counter is never less than the count of any phrase at it, up to 255, so a phrase seen
   ``MIN_COUNT`` times or more has no lesser estimate: nothing frequent is lost.
2. The merged sketch goes to every task of the second pass.  A phrase survives if its estimate reaches ``MIN_COUNT`` and
   those of its two parts without the last and first word do.  Only survivors become rows; they are counted in each slice
   of texts, then by Spark with map-side combine.  Inside a slice, words and phrases are numbered by their content, not by
   hashes, so counts are exact.
3. Phrases counted ``MIN_COUNT`` times are one table.  Every cut of a candidate joins it twice, since both parts of a
   frequent phrase are frequent.  A candidate's shorter sub-phrases get its count, and those with a longer phrase that
   holds them often enough are dropped.  The first of each language are chosen in two steps, by language and salt, then
   by language, so no task sorts a language.

The sketch has a cell for every ``LOAD`` bytes of text, between 2**16 and 2**``WIDEST`` cells a row: that is the bound of
what is broadcast (``ROWS`` x 2**``WIDEST`` bytes).  Beyond it estimates grow, more phrases survive the first pass and the
second one counts more of them; results are the same.  Sketching runs in as many tasks as the cluster has cores, not as
there are splits, so merging sketches does not grow with the input.

Defined results: null text is empty; null lang is ``und`` and counts together with a lang of that name; rows that repeat
count as often as they occur; texts without words count for nothing; an empty table gives an empty result; columns beside
lang and text are not read; ties go to the phrase that comes first in byte order.  A very long text is a slice of its
own; it takes about 60 bytes of memory for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

LONGEST = 4
MIN_COUNT = 30
#: Percent of a candidate's count that a longer phrase which holds it must reach to drop it.
SUBSUMED = 80
FIRST = 2000
ROWS, LOAD, WIDEST = 2, 24, 25
#: Cells in a block of the merged sketch.
BLOCK = 1 << 16
SLICE = 1_000_000
SALTS = 64
#: Characters that end a piece.
BREAK = C.byte_class([*b".,;:!?", *range(0x0A, 0x0E)])
WORD = ~(BREAK | C.byte_class(b" \t"))
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_W = C._random_u64(LONGEST, 41) | np.uint64(1)


class Slice:
    """Words of some texts of one language, in order: bounds in ``data``, content hashes, and for each phrase length where
    phrases start that stay in their piece."""

    def __init__(self, texts: list[bytes], lang: bytes):
        self.data = b"\n".join(texts).translate(_LOWER) + b"\n"
        buf = np.frombuffer(self.data, np.uint8)
        edge = np.diff(WORD[buf].view(np.int8), prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.searchsorted(np.flatnonzero(BREAK[buf]), self.start)
        n = len(self.start)
        # the longest phrase that starts at each word
        self.room = np.ones(n, np.int8)
        for k in range(1, LONGEST):
            self.room[: max(n - k, 0)] += (piece[k:] == piece[: max(n - k, 0)]).astype(np.int8)
        prefix = C.prefix_hash(C.BYTE_CODE[buf])
        words = C.mix(C.span_hash(prefix, self.start, self.end) + (self.end - self.start).astype(np.uint64))
        seed = C.mix(np.array([int.from_bytes(lang[:8].ljust(8, b"\0"), "little") ^ len(lang)], np.uint64))
        self.hashes, h = [], seed + np.zeros(n, np.uint64)
        for k in range(LONGEST):
            m = max(n - k, 0)
            h = h[:m] * _W[k] + words[k:]
            self.hashes.append(C.mix(h))

    def phrases(self, k: int) -> np.ndarray:
        """Words at which a phrase of ``k`` + 1 words starts."""
        return np.flatnonzero(self.room[: len(self.hashes[k])] > k)


def cells(h: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Cell of each hash in every row of a sketch; ``width`` is a power of two, at most 2**32."""
    for r in range(ROWS):
        yield ((h >> np.uint64(32 * r)) & np.uint64(width - 1)).astype(np.int64)


def estimates(sketch: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.minimum.reduce([row[c] for row, c in zip(sketch, cells(h, sketch.shape[1]), strict=True)]) if len(h) else np.zeros(0, np.uint8)


def survivors(s: Slice, sketch: np.ndarray, least: int) -> list[np.ndarray]:
    """By phrase length, the words at which a phrase starts that may be frequent, as its parts may."""
    out, before = [], np.ones(len(s.start) + 1, bool)
    for k in range(LONGEST):
        fine = np.zeros(len(s.start) + 1, bool)
        at = s.phrases(k)
        at = at[before[at] & before[at + 1]] if k else at
        at = at[estimates(sketch, s.hashes[k][at]) >= least]
        fine[at] = True
        out.append(at)
        before = fine
    return out


def counted(s: Slice, found: list[np.ndarray]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Length, phrases and their counts in the slice.  Numbers stand for contents: words by Arrow's dictionary, a phrase by
    the numbers of its first words and of its last word."""
    if not len(s.start):
        return
    # a slice is below 2 GB: its words are strings over its bytes
    buf = pa.py_buffer(s.data)
    lone = np.empty(2 * len(s.start) + 1, np.int64)
    lone[0:-1:2], lone[1::2], lone[-1] = s.start, s.end, s.end[-1]
    words = pa.LargeStringArray.from_buffers(len(lone) - 1, pa.py_buffer(lone), buf).take(pa.array(np.arange(0, len(lone) - 1, 2)))
    coded = words.dictionary_encode()
    number, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
    size = len(names)
    ids = number
    for k, at in enumerate(found):
        if k:
            whole = np.full(len(number), -1, np.int64)
            prior = found[k - 1]
            whole[prior] = ids
            # a survivor's first part is a survivor too
            key = whole[at] * size + number[at + k]
        else:
            key = number[at]
        _, first, ids, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        if len(first):
            at = at[first]
            parts = [names.take(pa.array(number[at + i])) for i in range(k + 1)]
            yield k + 1, pc.binary_join_element_wise(*parts, " ") if k else parts[0], n


def _by_lang(b: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for part in C.slices(b, limit=SLICE):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            if text:
                texts.setdefault(lang, []).append(text.encode())
        yield from texts.items()


def sketched(src: DataFrame, width: int) -> np.ndarray:
    """The merged sketch of all phrases."""

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((ROWS, width), np.uint8)
        for b in C.batches(source):
            for lang, texts in _by_lang(b):
                s = Slice(texts, lang.encode())
                h = np.concatenate([s.hashes[k][s.phrases(k)] for k in range(LONGEST)])
                for row, c in zip(sketch, cells(h, width), strict=True):
                    c.sort()
                    starts = np.flatnonzero(np.diff(c, prepend=-1))
                    n = np.diff(starts, append=len(c))
                    at = c[starts]
                    row[at] = np.minimum(row[at] + n, 255).astype(np.uint8)
        for r in range(ROWS):
            for i in range(0, width, BLOCK):
                if sketch[r, i : i + BLOCK].any():
                    yield pa.RecordBatch.from_pydict({"r": pa.array([r], pa.int32()), "i": pa.array([i], pa.int32()), "held": [sketch[r, i : i + BLOCK].tobytes()]})

    def merge(blocks: Iterator[pa.RecordBatch]) -> pa.Table:
        total = None
        for b in blocks:
            for x in b.column("held"):
                one = np.frombuffer(x.as_buffer(), np.uint8).astype(np.uint16)
                total = one if total is None else np.minimum(total + one, 255)
            r, i = b.column("r")[0], b.column("i")[0]
        return pa.RecordBatch.from_arrays([pa.array([r.as_py()], pa.int32()), pa.array([i.as_py()], pa.int32()), pa.array([total.astype(np.uint8).tobytes()])], names=["r", "i", "held"])

    def merged(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield merge(blocks)

    out = np.zeros((ROWS, width), np.uint8)
    schema = "r int, i int, held binary"
    tasks = src.coalesce(max(1, src.sparkSession.sparkContext.defaultParallelism)).mapInArrow(add, schema)
    for x in tasks.groupBy("r", "i").applyInArrow(merged, schema).toLocalIterator():
        held = np.frombuffer(x["held"], np.uint8)
        out[x["r"], x["i"] : x["i"] + len(held)] = held
    return out


def frequent(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases that occur ``least`` times, and (lang, n) of all word occurrences."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = 1 << min(max((size // LOAD).bit_length(), 16), WIDEST)
    sketch = spark.sparkContext.broadcast(sketched(src, width))
    kinds = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sketch.value
        for b in C.batches(source):
            for lang, texts in _by_lang(b):
                s = Slice(texts, lang.encode())
                # all words of the language: a row of length 0
                rows = [(0, pa.array([""]), np.array([len(s.start)]))] if len(s.start) else []
                for k, phrase, n in [*rows, *counted(s, survivors(s, held, least))]:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), k, np.int32)), phrase, pa.array(n.astype(np.int64))], schema=kinds)

    counts = src.mapInArrow(count, "lang string, k int, phrase string, f long").groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
    kept = C.Scratch(spark, "collocations").write(counts.where(f"k = 0 OR f >= {least}"))
    return kept.where("k > 0"), kept.where("k = 0").select("lang", F.col("f").alias("n"))


def scored(freq: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, score of every candidate: the figures of its lowest-scoring cut."""
    cut = freq.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = cut.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("c"))
    cut = cut.select("lang", "phrase", "k", "a", "c", F.array_join(F.slice("w", F.lit(1), F.col("c")), " ").alias("left"), F.array_join(F.slice("w", F.col("c") + 1, F.col("k") - F.col("c")), " ").alias("right"))
    part = lambda of, name: freq.select("lang", F.col("phrase").alias(of), F.col("f").alias(name))
    both = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    both = both.withColumn("twice", wide("a") * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("sum", wide("l") + wide("r")).withColumn("score", F.expr("twice div sum"))
    least = both.groupBy("lang", "phrase").agg(F.min(F.struct("score", "c", "l", "r")).alias("m"), F.first("a").alias("a"), F.first("k").alias("k"))
    return least.select("lang", "phrase", "k", "a", "m.l", "m.r", "m.score")


def subsumed(freq: DataFrame, percent: int = SUBSUMED) -> DataFrame:
    """(lang, phrase) of candidates inside a longer one that occurs nearly as often."""
    longer = freq.where("k > 2").select("lang", "k", "f", F.split("phrase", " ").alias("w"))
    spans = F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> array_join(slice(w, i, s), ' '))))")
    inner = longer.select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("top"))
    wide = lambda c, x: F.col(c).cast("decimal(20,0)") * F.lit(x)
    return freq.join(inner, ["lang", "phrase"]).where(wide("top", 100) >= wide("f", percent)).select("lang", "phrase")


def mine(docs: DataFrame, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first collocations."""
    freq, words = frequent(docs)
    left = scored(freq).join(subsumed(freq), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    # a row a language
    return some.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


MINE_SQL = r"""WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {docs}
), p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) AS ks
), c AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL
), t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang
), q AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM c WHERE f >= 30
), s AS (SELECT lang, k, phrase, f, w, unnest(range(1, k)) AS cut FROM q WHERE k > 1
), b AS (
  SELECT s.lang, s.k, s.phrase, s.f AS a, cut, x.f AS l, y.f AS r, CAST(CAST(s.f AS HUGEINT) * 2000000 // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM s JOIN c AS x ON x.lang = s.lang AND x.phrase = array_to_string(s.w[1:cut], ' ') JOIN c AS y ON y.lang = s.lang AND y.phrase = array_to_string(s.w[cut + 1:s.k], ' ')
), m AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), spans AS (SELECT lang, f, w, k, unnest(range(2, k)) AS size FROM q WHERE k > 2
), inner_ AS (SELECT lang, f, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM spans)
), top AS (SELECT lang, phrase, max(f) AS top FROM inner_ GROUP BY ALL
), k AS (SELECT m.* FROM m LEFT JOIN top USING (lang, phrase) WHERE top IS NULL OR CAST(top AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000"""
