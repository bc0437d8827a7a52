"""Helpers the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import checkpoint_dir

# Word separators of every operator here: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column that lambdas of ``body`` read would otherwise be computed again
    for each array element.
    """
    return F.transform(F.array(value), body)[0]


def text_of(c: str | Column) -> Column:
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and a
    lost executor costs no recomputation of what stands before."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sent_if_few(rows: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """``rows`` for a join: sent to all tasks while at most ``limit``, which is counted first."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
