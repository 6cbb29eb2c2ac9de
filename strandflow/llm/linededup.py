"""Line-level deduplication by content-defined chunks of lines.  DataFrame functions only.

A document's lines are hashed; a rolling hash over the last ``WINDOW`` line hashes that is 0 modulo ``DIVISOR`` ends a
chunk after that line.  Since a boundary depends on the nearest lines alone, a passage that many documents share is cut
at the same places wherever it stands.  A chunk of at least ``MIN_LINES`` lines, not all blank, that occurs more than
once anywhere is kept where it comes first (by doc_id, then place) and removed elsewhere.

Passes: chunk hashes are counted (map-side combine, no text is moved); chunks with a repeated hash are then grouped by
their bytes, so equal hashes alone remove nothing; each document finally gets the list of its own chunks to drop.  No
step gathers the places of a chunk: groups are counts and minima.

``passages=True`` extends the matches, for what chunks alone miss: the edges of a passage share a chunk with lines of
their own document, and a short passage may hold no whole chunk.  Units are then, besides the chunks, each two
neighbouring lines that are not blank (with the blank lines between) and each line of ``LONG_LINE`` characters; a line
goes if any unit that it stands in occurs earlier.  So every repeated passage of two lines goes whole, at any place and
in any context.  The first copy of a line always stays: a unit that holds it has no earlier copy.  Units are compared
by SHA-256, and no text is moved.

Defined results: null text stays null, without lines; a text whose chunks are all removed becomes empty; rows with the
same doc_id and text are one document and get the same result; a null doc_id is allowed and comes first; columns of any
names may stand beside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW, DIVISOR, MIN_LINES = 2, 3, 2
#: Characters from which a line alone is a passage.
LONG_LINE = 40
SOLID = "[^ \n\r\t]"
#: Column of what is left of a text that loses something.
CUT = "_ld_cut"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row: a lambda's argument is bound, where a column could be inlined into
    every use, inside loops too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ends(lines: Column) -> Column:
    """Number of the line after each chunk of a text's lines."""

    def rolling(h: Column, i: Column) -> Column:
        out = F.get(h, i)
        for k in range(1, WINDOW):
            out = out + F.lit(31**k) * F.when(i >= k, F.get(h, i - k)).otherwise(0)
        return out

    def ends(h: Column) -> Column:
        last = F.size(h) - 1
        return F.filter(F.transform(h, lambda _, i: F.when((rolling(h, i) % DIVISOR == 0) | (i == last), i + 1)), lambda x: x.isNotNull())

    line_hash = lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long")
    return let(F.transform(lines, line_hash), ends)


def chunks(text: Column) -> Column:
    """A text's chunks, each an array of lines."""

    def cut(lines: Column, e: Column) -> Column:
        return F.transform(e, lambda end, k: F.when(k == 0, F.slice(lines, F.lit(1), end)).otherwise(F.slice(lines, F.get(e, k - 1) + 1, end - F.get(e, k - 1))))

    return let(F.split(text, "\n", -1), lambda lines: let(_ends(lines), lambda e: cut(lines, e)))


def units(text: Column) -> Column:
    """What may repeat in a text, each with its first line (from 0), number of lines and hash (null if all are blank)."""
    # a unit is one number until it is hashed: array_union compares structs one by one
    unit = lambda first, n: first.cast("long") * (1 << 31) + n

    def found(lines: Column) -> Column:
        spans = let(_ends(lines), lambda e: F.transform(e, lambda end, k: let(F.when(k == 0, 0).otherwise(F.get(e, k - 1)), lambda s: F.when(end - s >= MIN_LINES, unit(s, end - s)))))
        solid = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(SOLID), i)), lambda i: i.isNotNull())
        pairs = let(solid, lambda p: F.transform(p, lambda i, k: let(F.get(p, k + 1), lambda j: unit(i, j - i + 1))))
        single = F.transform(lines, lambda x, i: F.when((F.length(x) >= LONG_LINE) & x.rlike(SOLID), unit(i, F.lit(1))))
        return F.filter(F.array_union(spans, F.array_union(pairs, single)), lambda u: u.isNotNull())

    def hashed(lines: Column, u: Column) -> Column:
        first, n = F.shiftright(u, 31).cast("int"), u.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
        h = let(F.array_join(F.slice(lines, first + 1, n), "\n"), lambda t: F.when(t.rlike(SOLID), F.unhex(F.sha2(t.cast("binary"), 256))))
        return F.struct(first.alias("i"), n.alias("n"), h.alias("h"))

    return let(F.split(text, "\n", -1), lambda lines: F.transform(found(lines), lambda u: hashed(lines, u)))


def _exploded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.col(id_col).alias("_ld_id"), F.col(text_col).alias("_ld_text"), F.xxhash64(text_col).alias("_ld_th")).where("_ld_text IS NOT NULL")
    rows = src.select("_ld_id", "_ld_th", F.posexplode(chunks(F.col("_ld_text"))).alias("_ld_k", "_ld_c"))
    rows = rows.where(F.size("_ld_c") >= MIN_LINES).withColumn("_ld_t", F.array_join("_ld_c", "\n")).where(F.col("_ld_t").rlike("[^ \n\r\t]"))
    return rows.select("_ld_id", "_ld_th", "_ld_k", "_ld_t", F.xxhash64("_ld_t").alias("_ld_h"))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ld_id, _ld_th (hash of the text) and _ld_gone, in this order (numbers of the chunks to drop) of the documents that lose any."""
    scratch = C.Scratch(docs.sparkSession, "linededup")
    rows = scratch.write(_exploded(docs, id_col, text_col))
    # written, so that the merge join shuffles both sides and a hot chunk can be split
    n = rows.count()
    again = scratch.write(rows.groupBy("_ld_h").count().where("count > 1").select("_ld_h"), n)
    often = scratch.write(rows.join(again.hint("merge"), "_ld_h"))
    scratch.drop(rows, again)
    scratch.tidy()
    place = F.struct(F.col("_ld_id"), F.col("_ld_th"), F.col("_ld_k"))
    same = often.groupBy("_ld_h", "_ld_t").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    same = scratch.write(same.select(F.col("_ld_h").alias("h"), F.col("_ld_t").alias("text"), "first"))
    late = often.join(same.hint("merge"), (F.col("_ld_h") == F.col("h")) & (F.col("_ld_t") == F.col("text"))).where(place > F.col("first"))
    gone = scratch.write(late.groupBy("_ld_id", "_ld_th").agg(F.collect_set("_ld_k").alias("_ld_gone")), n)
    scratch.drop(often, same)
    scratch.tidy()
    return gone


def passage_removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_ld_id, _ld_th (hash of the text) and _ld_gone, in this order (numbers of the lines to drop) of the documents that lose any."""
    scratch = C.Scratch(docs.sparkSession, "linededup")
    src = docs.select(F.col(id_col).alias("_ld_id"), F.col(text_col).alias("_ld_text"), F.xxhash64(text_col).alias("_ld_th")).where("_ld_text IS NOT NULL")
    rows = src.select("_ld_id", "_ld_th", F.explode(units(F.col("_ld_text"))).alias("u")).select("_ld_id", "_ld_th", "u.*").where("h IS NOT NULL")
    rows = scratch.write(rows)
    n = rows.count()
    place = F.struct(F.col("_ld_id"), F.col("_ld_th"), F.col("i"))
    # written, so that the merge join shuffles both sides and a hot unit can be split
    same = scratch.write(rows.groupBy("h").agg(F.count("*").alias("m"), F.min(place).alias("first")).where("m > 1").select("h", "first"), n)
    late = rows.join(same.hint("merge"), "h").where(place > F.col("first"))
    lines = F.flatten(F.collect_list(F.expr("sequence(i, i + n - 1)")))
    gone = scratch.write(late.groupBy("_ld_id", "_ld_th").agg(F.array_distinct(lines).alias("_ld_gone")), n)
    scratch.drop(rows, same)
    scratch.tidy()
    return gone


def _joined(docs: DataFrame, id_col: str, text_col: str, passages: bool = False) -> DataFrame:
    own, gid, gth, lost, cut_col = C.fresh(docs, "_ld_own", "_ld_id", "_ld_th", "_ld_gone", CUT)
    gone = (passage_removals if passages else removals)(docs, id_col, text_col).toDF(gid, gth, lost)
    src = docs.withColumn(own, F.xxhash64(text_col))
    out = src.join(gone.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(gid)) & (F.col(own) == F.col(gth)), "left")
    gone = F.col(lost)

    def judge(c: Column) -> Column:
        kept = F.array_join(F.flatten(F.filter(c, lambda x, k: ~F.array_contains(gone, k))), "\n")
        lines = F.aggregate(gone, F.lit(0).cast("long"), lambda s, k: s + F.size(F.get(c, k)))
        return F.struct(kept.alias("kept"), F.size(gone).cast("long").alias("removed"), lines.alias("removed_lines"))

    def judge_lines(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.struct(F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("kept"))

    # only documents that lose something are cut again
    cut = let(F.split(F.col(text_col), "\n", -1), judge_lines) if passages else let(chunks(F.col(text_col)), judge)
    return out.withColumn(cut_col, F.when(gone.isNotNull(), cut))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """``docs`` with repeated chunks of lines, or all repeated passages, removed from the text; all rows and columns stay."""
    out = _joined(docs, id_col, text_col, passages)
    cut = C.fresh(docs, CUT)[0]
    return out.select(*[F.coalesce(f"{cut}.kept", F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed (chunks), n_removed_lines, kept_bytes, kept_sha256; one row per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = _joined(src, "doc_id", "text")
    n = lambda c: F.coalesce(F.col(f"{CUT}.{c}"), F.lit(0).cast("long"))
    kept = F.coalesce(f"{CUT}.kept", "text", F.lit(""))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long")
    return out.select("doc_id", lines.alias("n_lines"), n("removed").alias("n_removed"), n("removed_lines").alias("n_removed_lines"), F.octet_length(kept).cast("long").alias("kept_bytes"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


#: The same in DuckDB, over table {docs} with columns doc_id and text.
REPORT_SQL = r"""
WITH line AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {docs} WHERE text IS NOT NULL)
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM line
), ended AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 3 = 0 AS stop FROM hashed
), numbered AS (
  SELECT doc_id, i, line, coalesce(sum(stop::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ended
), chunk AS (
  SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM numbered GROUP BY doc_id, k
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, k) AS place FROM chunk
), judged AS (
  SELECT *, n >= 2 AND regexp_matches(t, '[^ \n\r\t]') AND place > 1 AS gone FROM ranked
), summed AS (
  SELECT doc_id, sum(n)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_removed,
    coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed_lines, coalesce(string_agg(t, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_removed_lines, 0) AS n_removed_lines, strlen(coalesce(kept, ''))::BIGINT AS kept_bytes, sha256(coalesce(kept, '')) AS kept_sha256
FROM {docs} d LEFT JOIN summed s ON s.doc_id = d.doc_id
"""
