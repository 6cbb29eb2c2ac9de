"""Ranks and running totals over a whole sorted table, without a window that one task must hold.

The table is written, since the sort reads it twice (to draw the bounds of its range partitions, then to sort), and
written again as sorted, since the bounds are drawn anew each time a sort runs; a row's figure is the one inside its partition plus what the partitions before it hold, a table of one row a partition and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    return settle(settle(df, "unordered").orderBy(*order).withColumn("_p", F.spark_partition_id()), "ordered")


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Row number from 0 in a total order."""
    parts = _placed(df, order)
    local = parts.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    base = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return local.join(F.broadcast(base), "_p").withColumn(name, F.col("_b") + F.col("_r")).drop("_p", "_r", "_b")


def running_totals(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds, for each ``column: name`` of ``sums``, the total of the column over the rows of the same ``by`` up to this one;
    ``order`` is total within ``by``."""
    parts = _placed(df, [*[F.col(c) for c in by], *order])
    upto = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    held = parts.groupBy("_p", *by).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    held = held.select("_p", *by, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums])
    out = parts.withColumns({f"_l_{c}": F.sum(c).over(upto) for c in sums}).join(held, ["_p", *by])
    return out.withColumns({n: F.col(f"_b_{c}") + F.col(f"_l_{c}") for c, n in sums.items()}).drop("_p", *[f"_{x}_{c}" for c in sums for x in "bl"])
