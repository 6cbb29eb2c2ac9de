"""Cell, attribute and path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_list(cell: Column, kind: str) -> Column:
    """A list cell: ``;`` counts as ``,``, one trailing comma is dropped, blank gives an empty list."""
    flat = F.regexp_replace(F.regexp_replace(F.trim(cell), ";", ","), ",$", "")
    parts = F.transform(F.split(flat, ","), lambda x: F.trim(x).try_cast(kind))
    return F.when(flat == "", F.array().cast(f"array<{kind}>")).otherwise(parts)


def attributes(cell: Column) -> Column:
    """Attribute column to map; a later key wins; values hold no white space."""
    # key, separator, value, end (fixed values)
    pattern = F.lit(r"""(\w+)([ ="]+)(\S+?)(["\;\s]+|$)""")
    both = F.struct(F.regexp_extract_all(cell, pattern, F.lit(1)).alias("k"), F.regexp_extract_all(cell, pattern, F.lit(3)).alias("v"))

    def last(p: Column) -> Column:
        """The pairs without those whose key comes again."""
        k = p["k"]
        return F.filter(F.arrays_zip(k.alias("k"), p["v"].alias("v")), lambda x, i: ~F.array_contains(F.slice(k, i + 2, F.greatest(F.size(k) - i - 1, F.lit(0))), x["k"]))

    # the patterns run once a cell: what a function of an array's elements names is computed for each of them
    found = F.get(F.transform(F.array(both), last), 0)
    return F.map_from_entries(F.transform(found, lambda x: F.struct(x["k"], x["v"])))


def to_bool(cell: Column) -> Column:
    """``False`` (text) and empty are false; everything else is true."""
    return F.when(cell.isNull() | cell.isin("False", ""), False).otherwise(True)


# The parts of paths that compact names leave out (fixed values).
def compact_classes(s: Column) -> Column:
    return F.regexp_replace(s, "(transcript/processing/)|(transcript/translation/)", "")


def compact_features(s: Column) -> Column:
    return F.replace(s, F.lit("transcript/"), F.lit(""))


def path_head(p: Column) -> Column:
    """What comes before the last slash, without trailing slashes."""
    return F.regexp_replace(F.regexp_extract(p, "^(.*/)?([^/]*)$", 1), "/+$", "")


def path_tail(p: Column) -> Column:
    return F.regexp_extract(p, "([^/]*)$", 1)


def path_prefixes(p: Column) -> Column:
    """All prefixes that end before a slash, and the path itself."""
    parts = F.split(p, "/")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def channel(combination: Column) -> Column:
    """A ``$``-joined combination to struct<categories, features, elements> (sorted, distinct)."""
    items = F.filter(F.split(combination, r"\$"), lambda x: x != "")
    entries = F.flatten(F.transform(items, lambda a: F.transform(F.split(path_tail(a), ","), lambda n: F.struct(path_head(a).alias("path"), n.alias("name")))))
    pick = lambda f: F.array_sort(F.array_distinct(F.transform(entries, f)))
    return F.struct(pick(lambda e: e["path"]).alias("categories"), pick(lambda e: F.concat_ws("/", F.element_at(F.split(e["path"], "/"), 1), e["name"])).alias("features"), pick(lambda e: F.concat_ws("/", e["path"], e["name"])).alias("elements"))


#: Annotation classes by first match on ``classes,chromosome``: (name, pattern, pattern that must not match); fixed values.
#: Rules without a pattern never fire and are left out.
CATEGORIES: list[tuple[str, str, str | None]] = [
    ("mt-transcript", "chrM", None),
    ("RMRP", "RMRP", None),
    ("miRNA", "miRNA", None),
    ("snoRNA", "(snoRNA)|(SNORA)", None),
    ("snRNA", "(snRNA)|(RNU12)", None),
    ("scRNA", "scRNA", None),
    ("vtRNA", "(vtRNA)|(VTRNA)", None),
    ("srpRNA", "srpRNA", None),
    ("RNAse-P", "RPPH", None),
    ("(pseudo-)tRNA", "tRNA", None),
    ("(pseudo-)rRNA", "(rRNA)|(RNA5SP)|(RNA5-8SP)|(RNA18SP)|(RNA28SP)", None),
    ("other_structural", "Y_RNA", None),
    ("CDS", "transcript/coding(.*?)exon(.*?)CDS", None),
    ("5'UTR", "transcript/coding(.*?)exon(.*?)UTR5", None),
    ("3'UTR", "transcript/coding(.*?)exon(.*?)UTR3", None),
    ("intronic", "intron", "exon"),
    ("antisense", "(antisense)", None),
    ("lincRNA/long ncRNA", "(transcript/(noncoding)|(ncRNA))|(lincRNA)", "(miRNA)|(snoRNA)|(snRNA)|(tRNA)|(rRNA)|(bed2gff.py)|(transcript/coding)"),
    ("3'extension", "downstream", None),
    ("promoter/enhancer", "(promoter)|(enhancer)", None),
    ("repeat", "repeat", "transcript"),
    ("intergenic", "(intergenic)", "transcript"),
]
NO_CATEGORY = "None (this should not happen)"


def hierarchical_category(classes: Column, chrom: Column) -> Column:
    text = F.concat_ws(",", classes, chrom)
    out = None
    for name, yes, no in CATEGORIES:
        cond = text.rlike(yes) if no is None else text.rlike(yes) & ~text.rlike(no)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(NO_CATEGORY)


def category_sql(text: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    arms = [f"WHEN regexp_matches({text}, {quote(yes)})" + (f" AND NOT regexp_matches({text}, {quote(no)})" if no else "") + f" THEN {quote(name)}" for name, yes, no in CATEGORIES]
    return "CASE " + " ".join(arms) + f" ELSE {quote(NO_CATEGORY)} END"
