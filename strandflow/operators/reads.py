"""Read-level operators: duplicate collapse, read statistics, length and base histograms, decoy sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import settle
from .ordered import global_rank


_LOW = "abcdefghijklmnopqrstuvwxyz"


def upper(seq: str | Column) -> Column:
    """ASCII letters in upper case; sequences have no others."""
    return F.translate(seq, _LOW, _LOW.upper())


def collapse(reads: DataFrame, lib: str = "lib", seq: str = "seq", qual: str = "qual", line: str = "line_no") -> DataFrame:
    """Distinct upper-case sequences with counts: rank (from 0, by count, then sequence), count, seq, qual, name.

    The quality is that of the first read that has one.  Ranks come from per-partition row numbers of a range-sorted
    table plus partition sizes, so no task sorts all sequences.
    """
    by = reads.groupBy(upper(seq).alias("seq")).agg(F.count("*").alias("count"), F.min_by(qual, F.when(F.coalesce(qual, F.lit("")) != "", F.col(line))).alias("qual"))
    out = global_rank(by, [F.desc("count"), F.asc("seq")], "rank")
    return out.withColumn("name", F.format_string(f"@{lib}_%d_x%d", "rank", "count"))


def read_statistics(reads: DataFrame, seq: str = "seq") -> DataFrame:
    """total and unique reads."""
    by = reads.groupBy(upper(seq).alias("s")).agg(F.count("*").alias("n"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("uniq"))


def length_histogram(reads: DataFrame, seq: str = "seq", low: int = 15, high: int = 76) -> DataFrame:
    """(length, raw, uniq): zero-filled from low to high, and whatever else occurs."""
    by = reads.groupBy(upper(seq).alias("s")).agg(F.count("*").alias("n")).groupBy(F.length("s").alias("length")).agg(F.sum("n").alias("raw"), F.count("*").alias("uniq"))
    span = reads.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("length"))
    return span.join(by, "length", "full").select("length", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("uniq", F.lit(0)).alias("uniq"))


def base_frequencies(seqs: DataFrame, seq: str = "seq", num: int = 20) -> DataFrame:
    """(side, pos, base, freq): bases at the first ``num`` positions from both ends of distinct sequences, with one pseudo-count
    each; other letters count in the total only."""
    s = seqs.select(upper(seq).alias("s")).distinct()
    sides = s.select(F.explode(F.array(F.struct(F.lit("5p").alias("side"), F.col("s").alias("t")), F.struct(F.lit("3p").alias("side"), F.reverse("s").alias("t")))).alias("x"))
    cells = sides.select("x.side", F.posexplode(F.split(F.substring("x.t", 1, num), "")).alias("pos", "b")).where("b <> ''")
    by = cells.groupBy("side", "pos").agg(F.count("*").alias("n"), *[F.count_if(F.col("b") == x).alias(x) for x in "ACGT"])
    return by.select("side", "pos", F.explode(F.array(*[F.struct(F.lit(x).alias("base"), ((F.col(x) + 1) / (F.col("n") + 4)).alias("freq")) for x in "ACGT"])).alias("x")).select("side", "pos", "x.base", "x.freq")


def fastq_records(lines: DataFrame, line: str = "line_no", text: str = "value") -> DataFrame:
    """Four-line records from numbered lines; blank lines do not count."""
    ranked = global_rank(lines.where(F.trim(text) != ""), [F.col(line).asc()], "_i")
    by = ranked.groupBy(F.floor(F.col("_i") / 4).alias("record"))
    pick = lambda k: F.max(F.when(F.col("_i") % 4 == k, F.col(text)))
    return by.agg(F.regexp_replace(pick(0), "^@", "").alias("name"), pick(1).alias("seq"), pick(3).alias("qual"))


#: Chunks whose maps one task puts together.
COMPOSE = 4096


class Chain:
    """Steps of a first-order chain as maps from a letter to the next one.

    The random number of a place comes from its place alone, by a counter-based generator, so any part of the chain can be
    made anywhere; map 0 sends every letter to the first one.
    """

    def __init__(self, counts: list[list[float]], length: int, seed: int, chunk: int, start: int):
        p = np.array(counts, float)
        self.cum = (p / p.sum(1, keepdims=True)).cumsum(1)
        self.cum[:, -1] = 1.0
        self.length, self.seed, self.chunk, self.start = length, seed, chunk, start

    def maps(self, i: int) -> np.ndarray:
        """(places of chunk ``i``, 4): what each letter becomes."""
        first, n = i * self.chunk, min(self.chunk, self.length - i * self.chunk)
        bits = np.random.Philox(key=self.seed)
        bits.advance(first // 4)  # four numbers a step of the counter
        u = np.random.Generator(bits).random(n + first % 4)[first % 4 :]
        out = (u[:, None, None] >= self.cum[None, :, :]).sum(2).astype(np.uint8)
        if i == 0:
            out[0] = self.start
        return out

    def letters(self, i: int, before: int) -> bytes:
        rows, seq, last = self.maps(i).tolist(), bytearray(), before
        for row in rows:
            last = row[last]
            seq.append(last)
        return bytes(seq).translate(bytes.maketrans(bytes(range(4)), b"acgt"))


def composed(maps: np.ndarray) -> np.ndarray:
    """All maps one after the other, as one."""
    while len(maps) > 1:
        odd = maps[-1:] if len(maps) % 2 else maps[:0]
        pairs = maps[: len(maps) - len(odd)]
        maps = np.concatenate([np.take_along_axis(pairs[1::2], pairs[::2].astype(np.int64), 1), odd])
    return maps[0]


def _entries(maps: DataFrame, n: int) -> DataFrame:
    """(chunk, before): the letter before each chunk, from maps (chunk, map) of ``n`` chunks: maps of groups of chunks are
    composed first, their entries are found in the same way, then those of the chunks of each group."""

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(pdf.sort_values("chunk")["map"].tolist(), np.uint8)
        return pd.DataFrame({"chunk": [int(pdf["group"].iloc[0])], "map": [composed(rows).tolist()]})

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        out, last = [], int(pdf["entry"].iloc[0])
        for m in pdf["map"]:
            out.append(last)
            last = int(m[last])
        return pd.DataFrame({"chunk": pdf["chunk"], "before": out})

    grouped = maps.withColumn("group", F.floor(F.col("chunk") / COMPOSE).cast("long"))
    if n <= COMPOSE:
        led = grouped.withColumn("entry", F.lit(0))
    else:
        upper = settle(grouped.groupBy("group").applyInPandas(compose, "chunk long, map array<int>"), "maps")
        led = grouped.join(_entries(upper, -(-n // COMPOSE)).select(F.col("chunk").alias("group"), F.col("before").alias("entry")), "group")
    return led.groupBy("group").applyInPandas(follow, "chunk long, before int")


def markov(spark: SparkSession, counts: list[list[float]], length: int, seed: int | None = None, chunk: int = 1 << 16, start: int = 0) -> DataFrame:
    """(chunk, seq): one walk of a first-order chain over acgt with the given 4 x 4 pair counts; its first letter is ``a``.

    A step maps each letter to the next one, and maps can be put together before the letter that comes in is known.  So
    chunks are made in parallel twice: first as maps, whose composition in order gives the letter before each chunk, then
    as letters.  The walk depends on the seed alone, not on the size of the chunks.
    """
    seed = int(np.random.SeedSequence().entropy % (1 << 63)) if seed is None else seed
    chain, n = Chain(counts, length, seed, chunk, start), -(-length // chunk)

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"chunk": pdf["id"], "map": [composed(chain.maps(int(i))).tolist() for i in pdf["id"]]})

    def write_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, before in zip(pdf["chunk"], pdf["before"], strict=True):
                yield pd.DataFrame({"chunk": [i], "seq": [chain.letters(int(i), int(before)).decode()]})

    maps = settle(spark.range(0, n).mapInPandas(sum_up, "chunk long, map array<int>"), "maps")
    entries = settle(_entries(maps, n), "maps")
    return entries.repartition("chunk").mapInPandas(write_out, "chunk long, seq string")
