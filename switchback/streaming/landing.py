"""The incremental job over a landing folder.

Structured Streaming keeps track of which landed page files are done; every
micro-batch is one run of the job, whose listing is the batch itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from switchback import schemas as S
from switchback.plans.weekly import RunParams, weekly_job
from switchback.sources.writers import current_version, read_runs, write_stage


def _next_time(spark: SparkSession, store: str) -> datetime:
    """Now, or the second after the current snapshot where batches follow each other faster than that."""
    now = datetime.now(timezone.utc).replace(microsecond=0)
    current = current_version(spark, store)
    if current is None:
        return now
    return max(now, datetime.strptime(current, "%Y%m%dT%H%M%S%z") + timedelta(seconds=1))


def run_landed(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    features: Callable[[], DataFrame],
    elevations: Callable[[], DataFrame | None],
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Processes everything new in ``landing`` and stops. ``checkpoint`` must be a shared folder.

    A micro-batch that is repeated after a failure finds its run in the log and does nothing:
    runs carry the stream's identity, its checkpoint folder, and the batch number.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def run(batch: DataFrame, number: int) -> None:
        mine = (F.col("params")["checkpoint"] == checkpoint) & (F.col("params")["batch"] == str(number))
        if not read_runs(spark, store).filter(mine & (F.col("status") == "success")).isEmpty():
            return
        identity = {"checkpoint": checkpoint, "batch": number, "landing": landing}
        params = RunParams.at(_next_time(spark, store), f"{stream}_b{number}", max_pages=None, notes=identity, **options)
        # landed once and read back in the caller's session: the batch's own session
        # re-reads the source on every action and may run without adaptive plans
        write_stage(batch.select("url", "html", "status"), store, params.run_id, "landed")
        pages = spark.read.parquet(f"{store}/stages/run_id={params.run_id}/stage=landed")
        listing = pages.select("url").distinct().withColumn("pos", F.xxhash64("url"))
        weekly_job(spark, store, listing, pages, features(), elevations(), params)

    source = spark.readStream.schema(S.PAGE).option("maxFilesPerTrigger", max_files).parquet(landing)
    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
