"""Result sinks: a plain Parquet folder per analysis, and runs published by a manifest.

``publish`` writes all results of a run below ``<root>/runs/<run id>`` and names the
run in ``<root>/CURRENT`` only when every one of them is complete.  Readers resolve that
file first, so they see the results of one whole run, before, during and after a later
run, whether it succeeds or not.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "CURRENT"


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write an analysis result as Parquet; ``overwrite`` makes reruns idempotent."""
    df.write.mode(mode).parquet(path)
    return path


def write_all(results: dict[str, DataFrame], out_root: str) -> dict[str, str]:
    """Write several results under ``out_root/<name>``."""
    return {name: write_results(df, os.path.join(out_root, name)) for name, df in results.items()}


def _files(spark: SparkSession, path: str):
    """The path as Hadoop's own, and the file context of its store."""
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(sc._jsc.hadoopConfiguration())


def current_run(spark: SparkSession, root: str) -> str | None:
    """The run that the manifest names; None before the first."""
    path, fs = _files(spark, os.path.join(root, MANIFEST))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def publish(spark: SparkSession, results: dict[str, DataFrame], root: str) -> str:
    """Write all results as one run, then switch the manifest to it; returns the run id.

    The manifest is written beside its place and renamed over it, which the store does
    in one step.  A run that fails leaves its folder, which no reader looks at.
    """
    run = uuid.uuid4().hex
    for name, df in results.items():
        df.write.mode("errorifexists").parquet(os.path.join(root, "runs", run, name))
    beside, fs = _files(spark, os.path.join(root, f".{MANIFEST}-{run}"))
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(run.encode()))
    finally:
        stream.close()
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), sc._jsc.hadoopConfiguration())
    overwrite = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = sc._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, _files(spark, os.path.join(root, MANIFEST))[0], overwrite)
    return run


def read_published(spark: SparkSession, root: str, name: str, run: str | None = None) -> DataFrame:
    """A result of the current (or a named) run."""
    run = run or current_run(spark, root)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(os.path.join(root, "runs", run, name))


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest runs; the current one stays. Returns the deleted."""
    runs, fs = _files(spark, os.path.join(root, "runs"))
    found = sorted(((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(runs)), reverse=True)
    gone = [name for _, name in found[keep:] if name != current_run(spark, root)]
    for name in gone:
        fs.delete(_files(spark, os.path.join(root, "runs", name))[0], True)
    return gone
