"""Table functions for SQL text: ``FROM t, LATERAL reading_frames(t.seq)``.

They are SQL functions, which Catalyst replaces by their bodies, so no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.edits import MD, OPS, WALK
from .sequence import let, orfs_sql

#: Name: parameters, columns, and an array of structs in their order.
FUNCTIONS = {
    "reading_frames": ("seq STRING", "frame INT, start BIGINT, end BIGINT, protein STRING", orfs_sql()),
    # number: from 1, in reading order
    "transcript_exons": ("sense STRING, exon_starts ARRAY<BIGINT>, exon_ends ARRAY<BIGINT>", "number INT, start BIGINT, end BIGINT", "transform(exon_starts, (s, i) -> struct(IF(sense = '-', size(exon_starts) - i, i + 1) AS number, s AS start, exon_ends[i] AS end))"),
    "transcript_introns": ("sense STRING, exon_starts ARRAY<BIGINT>, exon_ends ARRAY<BIGINT>", "number INT, start BIGINT, end BIGINT", "transform(slice(exon_starts, 2, greatest(size(exon_starts) - 1, 0)), (s, i) -> struct(IF(sense = '-', size(exon_starts) - 1 - i, i + 1) AS number, exon_ends[i] AS start, s AS end))"),
    # offsets on the reference, as edits.with_edits gives them; none where the CIGAR holds N, = or X
    "alignment_edits": ("cigar STRING, md STRING, query STRING", "off INT, edit STRING", f"IF(cigar RLIKE '[N=X]', array(), {let('_ops', OPS, let('_walk', WALK, f'concat(_walk.ins, ({MD}).edits)'))})"),
}


def register(spark: SparkSession) -> None:
    """Make the table functions known to a session."""
    for name, (parameters, columns, rows) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN SELECT * FROM inline({rows})")
