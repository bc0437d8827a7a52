"""The corpus pipeline: five stages from raw documents to token ids.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs,
sf_dir) and returns a DataFrame; it works on every row its predecessor kept, and
all but the last return the columns of ``documents``.  ``run`` writes each
stage's result as Parquet into the shared checkpoint folder and reads it back as
the next one's input, so a lost executor repeats work of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import line_join, minhash_oph, mix_pareto, quality_mcd, sp_viterbi
from forumlens.llm.common import written

# A robust estimate over the rows, a similarity join, a sample and a segmentation
# search: not expressible as one SQL statement; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_mcd.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_join.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_oph.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_pareto.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    enc = sp_viterbi.encode(docs, sp_viterbi.Vocabulary(), check=True)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mix", mix),
          ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
