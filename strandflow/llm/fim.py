"""Fill-in-the-middle transformation of whole documents, as relations of text units.

A unit is white space followed by a word, or white space that ends a text.  Two cut requests a document, drawn from the
SHA-256 of its id, say after which unit the prefix and the middle end.  The units of the documents that are to be cut are
one table (document, ordinal, length): ``posexplode`` makes it, a window sums its lengths up, the cut requests are joined
to it by ordinal, and the two offsets found are aggregated per document.  Substrings between them, put together in the
order of the form, are the output; the text is rebuilt from the output and the form alone.

Documents that stay plain are neither written nor shuffled.  The others are written with row numbers first, so that every
branch of the plan sees the same numbers; their texts are shuffled once, by row number, in an exchange that units and
substrings share, and units are summed up and meet their requests where their text is.  No Python runs.

Defined results: null text is empty; empty texts and texts that hold a sentinel stay plain; a null doc_id counts as the
empty string in the draw; rows that repeat are transformed each by itself, alike; an empty table gives an empty result;
columns beside doc_id and text are not read; ids keep their type.  A very long text is one row and its units are rows
that Spark sorts and spills, so no task holds more than its text and the list of its units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SEED = 42
#: Percent of documents that are transformed, and percent of those with the suffix first.
RATE, SPM_RATE = 50, 80


def _draws(doc_id: Column, seed: int, n: int = 4) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def put_together(form: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    return F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))


def restore(df: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Adds the text, rebuilt from the output and its form alone.

    A sentinel can't begin in a text part and end in a real one, or the other way round, so the first one found is real.
    """
    marks, cut = len(PREFIX), F.col(form) != "plain"
    one, two, three = C.fresh(df, "_first", "_later", "_second")
    upto = lambda text, mark: F.call_function("substring_index", text, mark, F.lit(1))
    after = lambda text, n: F.substring(text, n + marks + 1, F.length(text))
    out = df.withColumn(one, F.when(cut, upto(after(F.col(output), F.lit(0)), F.when(F.col(form) == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)))))
    out = out.withColumn(two, after(F.col(output), F.length(one) + marks)).withColumn(three, upto(F.col(two), F.lit(MIDDLE)))
    middle = after(F.col(two), F.length(three))
    text = F.when(F.col(form) == "psm", F.concat(one, middle, three)).when(F.col(form) == "spm", F.concat(three, middle, one)).otherwise(F.col(output))
    return out.withColumn(name, text).drop(one, two, three)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output; one row per row."""
    scratch = C.Scratch(docs.sparkSession, "fim")
    h = _draws(F.col("doc_id"), seed)
    plain = (F.col("text") == "") | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE) | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    units = F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("form", form)
    src = src.withColumn("n", F.size(units).cast("long"))
    kept = src.where("form = 'plain'").select("doc_id", "n", "form", F.lit(None).cast("long").alias("prefix_chars"), F.lit(None).cast("long").alias("middle_chars"), F.col("text").alias("output"))
    cut = scratch.write(src.where("form <> 'plain'").withColumn("row", F.monotonically_increasing_id()))

    # shuffled by row once: the units and the substrings below read the same exchange
    texts = cut.select("row", "text").repartition("row")
    unit = texts.select("row", F.posexplode(units).alias("ordinal", "unit")).select("row", "ordinal", F.length("unit").alias("chars"))
    upto = Window.partitionBy("row").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    ends = unit.select("row", (F.col("ordinal") + 1).cast("long").alias("unit"), F.sum("chars").over(upto).alias("end"))

    # units lie by row already, so both requests of a document come as one row; one before the first unit finds none: 0
    a, b = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    asked = cut.select("row", "doc_id", "form", "n", F.least(a, b).alias("c0"), F.greatest(a, b).alias("c1"))
    found = ends.join(asked.select("row", "c0", "c1"), "row").where("unit = c0 OR unit = c1")
    found = found.groupBy("row").agg(*[F.max(F.when(F.col("unit") == F.col(f"c{k}"), F.col("end"))).alias(f"at{k}") for k in (0, 1)])
    out = texts.join(asked.select("row", "doc_id", "form", "n"), "row").join(found, "row", "left")
    out = out.withColumns({f"at{k}": F.coalesce(f"at{k}", F.lit(0)).cast("int") for k in (0, 1)}).withColumn("between", F.col("at1") - F.col("at0"))
    part = lambda start, chars: F.substring("text", start, chars)
    output = put_together(F.col("form"), part(F.lit(1), F.col("at0")), part(F.col("at0") + 1, F.col("between")), part(F.col("at1") + 1, F.length("text")))
    return kept.unionByName(out.select("doc_id", "n", "form", F.col("at0").cast("long").alias("prefix_chars"), F.col("between").cast("long").alias("middle_chars"), output.alias("output")))


def digests(docs: DataFrame) -> DataFrame:
    """The outputs by their digests, beside those of the texts rebuilt from them."""
    sha = lambda c, name: F.sha2(F.col(c).cast("binary"), 256).alias(name)
    return restore(transform(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output", "output_sha256"), sha("restored", "restored_sha256"))


#: The same rows in DuckDB; its list functions cut each text by itself.
DIGESTS_SQL = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM {docs}
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), f AS (
  SELECT *, len(units) AS n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS c0, greatest(h1 % (n + 1), h2 % (n + 1)) AS c1 FROM f
), p AS (
  SELECT doc_id, CAST(n AS BIGINT) AS n, form, text, array_to_string(units[1:c0], '') AS prefix, array_to_string(units[c0 + 1:c1], '') AS middle, array_to_string(units[c1 + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""
