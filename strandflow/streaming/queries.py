"""Registered streaming queries: each runs over what its table holds and returns the rows that it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import shared_dir
from .operators import STATE_STORE, merged_islands, released_islands, run_once, sessions, sum_lines


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/strandflow/stream-{uuid.uuid4().hex}"


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A stream over a table that is a file or a folder of files."""
    path = f"{sf_dir}/{table}.parquet"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()
    source = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 4)
    return source.parquet(path) if folder else source.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


#: The order of a table's files is no order in time: no event is late before the input has ended.
NEVER_DAYS = 36_500


def _run_to_end(spark: SparkSession, rows: DataFrame, plan, last) -> DataFrame:
    """What ``plan`` writes over a stream and, once that is read to its end, over the rows of ``last()``."""
    out = _folder(spark)
    spark.createDataFrame([], rows.schema).write.parquet(f"{out}/last")
    query = plan(rows.unionByName(spark.readStream.schema(rows.schema).parquet(f"{out}/last")))
    run_once(query, f"{out}/rows", f"{out}/state")
    last().select(*[F.col(f.name).cast(f.dataType) for f in rows.schema]).write.mode("append").parquet(f"{out}/last")
    run_once(query, f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of events, also the last ones: an event without user, far behind all others, closes them."""
    pick = lambda df: df.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")

    def last() -> DataFrame:
        top = pick(spark.read.parquet(f"{sf_dir}/events.parquet")).agg(F.max("ts").alias("top")).where("top IS NOT NULL")
        return top.select(F.lit(None).alias("user_id"), F.expr(f"top + INTERVAL '{NEVER_DAYS + 1}' DAY").alias("ts"), F.lit(None).alias("value"))

    return _run_to_end(spark, pick(_stream(spark, sf_dir, "events")), lambda s: sessions(s, late=f"{NEVER_DAYS} days"), last).withColumn("total", F.round("total", 4))


def stream_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Islands with explicit state over lineitem's intervals, in whatever order its files come."""

    def pick(df: DataFrame) -> DataFrame:
        strand = F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand")
        pos = F.col("l_orderkey") % 15000
        return df.select(F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")).alias("chrom"), strand, pos.alias("pos"), (pos + F.col("l_quantity").cast("long")).alias("pend"))

    def last() -> DataFrame:
        keys = pick(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).select("chrom", "strand").distinct()
        return keys.withColumns({"pos": F.lit(None), "pend": F.lit(None)})

    return _run_to_end(spark, pick(_stream(spark, sf_dir, "lineitem")), merged_islands, last)


#: Stretches of places that arrive one after the other, and what a row may be late by.
ARRIVALS, LATE = 4, 16


def arriving_islands(spark: SparkSession, reads: DataFrame, arrivals: int, late: int) -> tuple[DataFrame, list]:
    """released_islands over reads (chrom, strand, pos, pend) whose stretches of positions are written one after the other,
    and each run's last progress.  A row far behind the others, without chromosome, closes what is open."""
    out = _folder(spark)
    reads = reads.where("pos IS NOT NULL").withColumn("place", F.col("pos"))
    top = reads.agg(F.max(F.greatest("place", "pend"))).first()[0]
    if top is None:
        return spark.createDataFrame([], "chrom string, strand string, start long, end long, n long"), []
    width, runs = top // arrivals + 1, []
    far = {c: F.lit(top + late + 2) for c in ("pos", "pend", "place")}
    last = spark.range(1).select(*[far.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in reads.schema])
    for k in range(arrivals + 1):
        rows = reads.where(F.floor(F.col("pos") / width) == k) if k < arrivals else last
        rows.write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(reads.schema).parquet(f"{out}/in")
        runs.append(run_once(released_islands(stream, late), f"{out}/rows", f"{out}/state", conf=STATE_STORE).recentProgress)
    return spark.read.parquet(f"{out}/rows").where("chrom IS NOT NULL"), runs


def _reads(df: DataFrame) -> DataFrame:
    pos = F.col("l_orderkey") % 15000
    return df.select(F.concat(F.lit("chr"), F.col("l_suppkey").cast("string")).alias("chrom"), F.when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"), pos.alias("pos"), (pos + F.col("l_quantity").cast("long")).alias("pend"))


def stream_released_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Islands over lineitem's intervals that arrive in stretches of positions; what is closed is emitted and freed."""
    return arriving_islands(spark, _reads(spark.read.parquet(f"{sf_dir}/lineitem.parquet")), ARRIVALS, LATE)[0]


def stream_line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stateless line sum over a stream."""
    out = _folder(spark)
    s = _stream(spark, sf_dir, "lineitem").select(F.concat_ws("\t", "l_returnflag", F.col("l_quantity").cast("string"), F.col("l_partkey").cast("string")).alias("value"))
    run_once(sum_lines(s, [2, -3]), f"{out}/rows", f"{out}/state")
    return spark.read.parquet(f"{out}/rows")


QUERIES = {"stream_sessions": stream_sessions, "stream_islands": stream_islands, "stream_released_islands": stream_released_islands, "stream_line_sums": stream_line_sums}

#: The batch forms.  A session is open as long as the next event comes before its gap has passed.
SQL = {
    "stream_sessions": """WITH e AS (SELECT user_id, ts, value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL), n AS (
  SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS nw FROM e
), g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM n)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY user_id, s""",
    "stream_islands": """WITH r AS (SELECT concat('chr', l_suppkey) AS chrom, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, l_orderkey % 15000 AS pos, l_orderkey % 15000 + CAST(l_quantity AS BIGINT) AS pend FROM lineitem), m AS (
  SELECT *, max(pend) OVER (PARTITION BY chrom, strand ORDER BY pos, pend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM r
), i AS (SELECT *, sum(CASE WHEN prev IS NULL OR pos > prev THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY pos, pend ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT chrom, strand, min(pos) AS start, max(pend) AS "end", count(*) AS n FROM i GROUP BY chrom, strand, island""",
    "stream_line_sums": """SELECT concat_ws(chr(9), l_returnflag, CAST(l_quantity AS VARCHAR), l_partkey) || chr(9) || CAST(l_quantity - l_partkey AS VARCHAR) AS value FROM lineitem""",
}
SQL["stream_released_islands"] = SQL["stream_islands"]
