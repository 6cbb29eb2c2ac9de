"""Sequence functions: complements, k-mers, translation, open reading frames, base codes."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import settle

#: IUPAC codes and their complements (fixed values); S, W and N are their own.
_IUPAC, _IUPAC_C = "acgtkmrybvhd", "tgcamkyrvbdh"


def complement(seq: Column) -> Column:
    """IUPAC complement, keeping case."""
    return F.translate(seq, _IUPAC + _IUPAC.upper(), _IUPAC_C + _IUPAC_C.upper())


def edit_complement(edit: Column) -> Column:
    """Complement of upper-case bases; ``N`` and ``_`` stay."""
    return F.translate(edit, "ACGT", "TGCA")


def rev_comp(seq: Column) -> Column:
    return F.reverse(complement(seq))


def strand_edit(edit: Column, strand: Column) -> Column:
    """An edit as seen on its strand."""
    return F.when(strand == "-", edit_complement(edit)).otherwise(edit)


def flip(strand: Column) -> Column:
    return F.translate(strand, "+-", "-+")


def k_mers(k: int, alphabet: str = "acgt") -> list[str]:
    """All words of length k in lexicographic order of the alphabet."""
    return ["".join(x) for x in itertools.product(alphabet, repeat=k)]


def k_mer_table(spark: SparkSession, k: int, alphabet: str = "acgt") -> DataFrame:
    # one task: each product of tables has as many as both together
    letters = spark.range(1, numPartitions=1).select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).alias("i")) for i, c in enumerate(alphabet)])))
    out = letters.select(F.col("c").alias("kmer"), F.col("i").cast("long").alias("rank"))
    for _ in range(k - 1):
        out = out.crossJoin(letters).select(F.concat("kmer", "c").alias("kmer"), (F.col("rank") * len(alphabet) + F.col("i")).alias("rank"))
    return out


#: Letters that are counted at once.
_LETTERS = 1 << 20


def _count_words(texts: pa.Array, k: int) -> Iterator[pa.RecordBatch]:
    """How often each word of k letters occurs in texts of k letters or more; words do not cross texts."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // _LETTERS
    for g in np.unique(group):
        lo, hi = np.searchsorted(group, [g, g + 1])
        letters = np.frombuffer("".join(texts[lo:hi].to_pylist()).encode("utf-32-le"), np.uint32)
        seen = np.bincount(letters) > 0
        codes, size = (np.cumsum(seen) - 1)[letters], int(seen.sum())
        words, kinds = np.zeros(len(letters) - k + 1, np.int64), 1
        for j in range(k):
            if kinds * size > 1 << 62:
                known, words = np.unique(words, return_inverse=True)
                kinds = len(known)
            words, kinds = words * size + codes[j : j + len(words)], kinds * size
        inside = np.ones(len(letters), bool)
        for j in range(1, k):
            inside[np.cumsum(lengths[lo:hi]) - j] = False
        at = np.flatnonzero(inside[: len(words)])
        if kinds <= _LETTERS:
            n, first = np.bincount(words[at], minlength=kinds), np.zeros(kinds, np.int64)
            first[words[at]] = at
            first, n = first[n > 0], n[n > 0]
        else:
            _, first, n = np.unique(words[at], return_index=True, return_counts=True)
            first = at[first]
        yield pa.RecordBatch.from_arrays([pa.array(["".join(map(chr, letters[i : i + k])) for i in first], pa.string()), pa.array(n, pa.int64())], ["kmer", "n"])


def k_mer_counts(seqs: DataFrame, seq_col: str, k: int) -> DataFrame:
    """Overlapping k-mers over all sequences (lower case): kmer, count, fraction."""
    words = seqs.select(F.lower(seq_col).alias("s")).where(F.length("s") >= k)
    # a task's words are counted before they become rows
    counted = words.mapInArrow(lambda batches: (out for b in batches if b.num_rows for out in _count_words(b.column(0), k)), "kmer string, n long")
    # written: its total is another reading of it
    out = settle(counted.groupBy("kmer").agg(F.sum("n").alias("count")), "words")
    total = out.agg(F.sum("count").alias("total"))
    return out.crossJoin(F.broadcast(total)).select("kmer", "count", (F.col("count") / F.col("total")).alias("fraction"))


def numeric(seq: Column) -> Column:
    """Base codes 0-3 as an array, empty for an empty text; n counts as a."""
    codes = F.transform(F.split(F.translate(F.lower(seq), "nacgt", "00123"), ""), lambda c: c.cast("int"))
    return F.when(seq == "", F.array().cast("array<int>")).otherwise(codes)


def genetic_code() -> dict[str, str]:
    """Codon to amino acid; stop codons are absent.  The amino acids are listed in TCAG order of the three bases."""
    # The standard genetic code (fixed values); * is a stop.
    acids = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
    return {c: a for c, a in zip(k_mers(3, "TCAG"), acids, strict=True) if a != "*"}


CODE = genetic_code()


def _codons(seq: Column, frame: int) -> Column:
    """Codons of a frame; a codon is read if more than ``frame`` + 4 letters follow its first one, so the last ones are left out.

    Cut by one pass of a pattern: a substring is looked for from the start of its text each time.
    """
    n = F.length(seq) - 2 * frame - 4
    whole = F.regexp_extract_all(F.substring(seq, frame + 1, 1 << 30), F.lit("(?s)..."), F.lit(0))
    count = F.when(n > 0, F.floor((n - 1) / 3).cast("int") + 1).otherwise(0)
    return F.coalesce(F.slice(whole, 1, count), F.array().cast("array<string>"))


#: Letters as digits, other ones 4, so that a codon is a number and its acid a place in a list: a map is searched from its
#: start for every codon.
_DIGITS = "TCAGtcag0123", "012301234444"
ACIDS = [CODE.get("".join("TCAG"[int(d)] for d in f"{i:03}"), "*") if set(f"{i:03}") <= set("0123") else "*" for i in range(445)]


def _acids(seq: Column, frame: int) -> Column:
    digits = F.regexp_replace(F.translate(seq, *_DIGITS), r"(?s)[^0-4]", "4")
    return F.transform(_codons(digits, frame), lambda c: F.get(F.array(*map(F.lit, ACIDS)), c.cast("int")))


def translate(seq: Column, frame: int = 0) -> Column:
    """Protein from the first start codon to the first stop (or unknown) codon after it."""
    whole = F.array_join(_acids(seq, frame), "")
    return F.regexp_extract(whole, r"(M[^*]*)", 1)


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` in which ``name`` stands for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def orfs_sql(seq: str = "seq") -> str:
    """SQL of all reading frames of a text that a stop or unknown codon closes: array of struct<frame, start, end, protein>.

    Each starts at the first start codon after the stop before it; what follows the last stop is open and left out.
    """
    codons = "slice(regexp_extract_all(substring(t, f + 1), '(?s)...', 0), 1, CAST(greatest(floor((length(t) - 2 * f - 5) / 3) + 1, 0) AS INT))"
    code = ", ".join(f"'{a}'" for a in ACIDS)
    acids = f"transform({codons}, c -> get(array({code}), CAST(c AS INT)))"
    digits = f"regexp_replace(translate({seq}, '{_DIGITS[0]}', '{_DIGITS[1]}'), '(?s)[^0-4]', '4')"
    # places of the stops; what stands before each one, from its first start codon on
    stops = "filter(transform(a, (x, i) -> CASE WHEN x = '*' THEN i END), i -> i IS NOT NULL)"
    parts = "transform(slice(split(array_join(a, ''), '[*]', -1), 1, size(s)), (p, k) -> struct(substring(p, locate('M', p)) AS protein, locate('M', p) AS m, IF(k = 0, 0, s[k - 1] + 1) AS b, s[k] AS e))"
    found = f"transform(filter({parts}, x -> x.m > 0), x -> struct(CAST(f AS INT) AS frame, CAST((x.b + x.m - 1) * 3 + f AS BIGINT) AS start, CAST(x.e * 3 + f + 3 AS BIGINT) AS end, x.protein AS protein))"
    return let("t", digits, f"flatten(transform(sequence(0, 2), f -> {let('a', acids, let('s', stops, found))}))")


def all_orfs(seqs: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """One row a reading frame: id, frame, start, end, protein."""
    rows = seqs.select(F.col(id_col).cast("string").alias("id"), F.col(seq_col).alias("seq"))
    return rows.select("id", F.inline(F.expr(orfs_sql())))


def find_orf(seqs: DataFrame, id_col: str, seq_col: str, least: int = 30) -> DataFrame:
    """The longest reading frame of each sequence (ties: the greatest protein, then start); ('', -1, -1) without one of ``least`` acids."""
    found = all_orfs(seqs, id_col, seq_col).where(F.length("protein") >= least)
    best = found.groupBy("id").agg(F.max(F.struct(F.length("protein").alias("n"), "protein", "start", "end")).alias("b"))
    out = seqs.select(F.col(id_col).cast("string").alias("id")).join(best, "id", "left")
    return out.select("id", F.coalesce("b.protein", F.lit("")).alias("protein"), F.coalesce("b.start", F.lit(-1)).alias("start"), F.coalesce("b.end", F.lit(-1)).alias("end"))
