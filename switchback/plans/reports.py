"""Health reports over the store tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_version(trails: DataFrame) -> DataFrame:
    return trails.filter(F.col("dataset_version").isNull()).agg(F.count(F.lit(1)).alias("missing_dataset_version"))


def state_rows(state: DataFrame) -> DataFrame:
    return state.agg(F.count(F.lit(1)).alias("crawl_state_rows"))


def version_distribution(trails: DataFrame) -> DataFrame:
    """Rows per version, newest first."""
    counts = trails.groupBy("dataset_version").agg(F.count(F.lit(1)).alias("trails"))
    return counts.orderBy(F.col("dataset_version").desc_nulls_first())


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    columns = ["run_id", "status", "started_at", "finished_at", "row_count", "notes"]
    return runs.select(*[c for c in columns if c in runs.columns]).orderBy(F.col("started_at").desc()).limit(n)


def failed_spike(runs: DataFrame) -> DataFrame:
    """Failed addresses per run next to the run before, in time order.

    The run log has one row per run, so ordering all of it in one task is cheap
    at any data size.
    """
    over = Window.orderBy("started_at", "run_id")
    return runs.select(
        "run_id", "started_at", "failed_urls",
        F.lag("failed_urls").over(over).alias("previous_failed"),
        (F.col("failed_urls") - F.lag("failed_urls").over(over)).alias("increase"),
    )


def error_breakdown(state: DataFrame) -> DataFrame:
    return state.groupBy("last_status", "last_error").agg(F.count(F.lit(1)).alias("n"))
