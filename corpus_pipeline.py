"""The training-data pipeline: toxic documents go, repeated passages of lines go, one document of each group of
near-duplicates stays, contaminated documents go, and the rest is packed into sequences.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``docs``.  ``run`` writes each stage's
result to the shared folder and reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.llm import decontam, linededup, neardup, packing, toxicity
from strandflow.llm.common import Scratch, read_table

#: Five words and similarity 0.8 or more; op10's own contract is 0.85.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(docs, passages=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, percent=NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_dedup", dedup_near), ("decontamination", decontaminate), ("packing", pack)]
#: The trained classifier and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
