"""Licence scans by canonical digests.

A text's canonical form is lower case, without lines that carry a copyright statement, with equivalent spellings made
equal, and with every run of other characters than letters and digits as one space.  The SHA-256 of the whole text's
form is joined with those of known licences; so is that of each line's form, which finds one-line notices in longer
texts.  The known table is a parameter; the default one is a fixed list, far under any broadcast limit, and a larger one
is left to the planner.  Long licences are known by the digest of their canonical form alone.

Defined results: null text is empty; an empty canonical form matches nothing; a text that is several known licences
(equal forms under two names) gets all names, sorted; rows that repeat get equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .license_texts import DIGESTS, KNOWN

#: Equivalent spellings, applied in this order (fixed values).
SPELLINGS = [("licence", "license"), ("organisation", "organization"), ("https://", "http://"), ("favour", "favor"), ("honour", "honor"), ("acknowledgement", "acknowledgment"), ("non-infringement", "noninfringement"), ("sub-license", "sublicense"), ("whilst", "while")]
#: A statement of copyright, not any mention of the word.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t]+([(]c[)]|©|[0-9])|[(]c[)][ \t]*[0-9]|©|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form with line ends kept."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, COPYRIGHT, "")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.regexp_replace(out, OTHER, " ")


def canonical(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def known_digests(spark, known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """known (a digest) and license, for texts and for digests of texts."""
    rows = spark.createDataFrame(known, "license string, body string").select("license", digest(canonical(canonical_lines(F.col("body")))).alias("known"))
    if digests:
        rows = rows.unionByName(spark.createDataFrame(digests, "license string, known string"))
    return rows.where("known IS NOT NULL").groupBy("known").agg(F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_sha256 (of the canonical form; null if it is empty), license (of the whole text, or null) and notices (of its lines, sorted, comma-joined); one row per row of ``docs``."""
    known = known if known is not None else F.broadcast(known_digests(docs.sparkSession))  # one row per text of KNOWN and DIGESTS
    src = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("form"))
    line = F.array_distinct(F.filter(F.transform(F.split("form", "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    src = src.select("doc_id", digest(canonical(F.col("form"))).alias("text_sha256"), F.transform(line, lambda x: F.unhex(F.sha2(x.cast("binary"), 256))).alias("lines"))
    # written: texts are brought to their form once, whole texts and lines are looked up from the digests.  The digest
    # of the lines' digests stands for the row: rows with equal ones have equal lines.
    src = Scratch(docs.sparkSession, "licenses").write(src.withColumn("lines_id", F.sha2(F.array_join(F.transform("lines", lambda x: F.hex(x)), "").cast("binary"), 256)))
    lines = src.select(F.col("lines_id").alias("owner"), F.explode("lines").alias("line"))
    hits = lines.join(known, F.lower(F.hex("line")) == F.col("known")).groupBy("owner").agg(F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("notices"))
    out = src.select("doc_id", "lines_id", "text_sha256").join(known, F.col("text_sha256") == F.col("known"), "left")
    return out.join(hits, F.col("lines_id") == F.col("owner"), "left").select("doc_id", "text_sha256", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scan_sql(table: str = "documents", known: list[tuple[str, str]] = KNOWN, digests: list[tuple[str, str]] = DIGESTS) -> str:
    """The same in DuckDB."""

    def form(x: str) -> str:
        out = f"regexp_replace(lower(coalesce({x}, '')), {_literal(COPYRIGHT)}, '', 'g')"
        for a, b in SPELLINGS:
            out = f"replace({out}, {_literal(a)}, {_literal(b)})"
        return f"regexp_replace({out}, {_literal(OTHER)}, ' ', 'g')"

    whole = lambda x: f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))"
    values = ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b in known)
    more = ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b in digests)
    return f"""
WITH known AS (
  SELECT known, string_agg(DISTINCT license, ',' ORDER BY license) AS license FROM (
    SELECT sha256({whole(form("body"))}) AS known, license FROM (VALUES {values}) t(license, body)
    UNION ALL SELECT known, license FROM (VALUES {more}) t(license, known)
  ) GROUP BY 1
), formed AS (
  SELECT doc_id, {form("text")} AS form FROM {table}
), src AS (
  SELECT doc_id, CASE WHEN {whole("form")} <> '' THEN sha256({whole("form")}) END AS text_sha256, form FROM formed
), hits AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT doc_id, sha256(trim(unnest(string_split(form, chr(10))))) AS line FROM src) JOIN known ON line = known
  GROUP BY doc_id
)
SELECT s.doc_id, s.text_sha256, k.license, coalesce(h.notices, '') AS notices
FROM src s LEFT JOIN known k ON k.known = s.text_sha256 LEFT JOIN hits h ON h.doc_id = s.doc_id
"""
