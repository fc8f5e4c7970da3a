"""Convergence reports (I5, K1) over the plans' per-round change counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def label_trace(trace: DataFrame, run: str) -> DataFrame:
    """Tag a ``(iteration, n_changes)`` trace with the name of its run."""
    return trace.select(F.lit(run).alias("run"), "iteration", "n_changes")


def append_trace(trace: DataFrame, run: str, path: str) -> None:
    """Adds the trace of a run to the table at ``path``; a run that is written again
    replaces itself, so a repeated job leaves one."""
    (label_trace(trace, run).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """All runs that were appended: ``run, iteration, n_changes``."""
    return (spark.read.schema("iteration int, n_changes bigint, run string").parquet(path)
            .select("run", "iteration", "n_changes"))


def running_changes(traces: DataFrame) -> DataFrame:
    """Per run and round: changes and their running total."""
    w = Window.partitionBy("run").orderBy("iteration").rowsBetween(
        Window.unboundedPreceding, 0)
    return traces.withColumn("cumulative_changes", F.sum("n_changes").over(w))


def convergence_report(traces: DataFrame) -> DataFrame:
    """One row per run: rounds, first round with no change, total changes."""
    return traces.groupBy("run").agg(
        F.max("iteration").alias("rounds"),
        F.min(F.when(F.col("n_changes") == 0, F.col("iteration"))).alias("first_zero"),
        F.sum("n_changes").cast("bigint").alias("total_changes"))
