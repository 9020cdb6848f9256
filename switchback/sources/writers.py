"""Outputs: text exports, stage tables, snapshots.

The store keeps every table as one folder per snapshot. A run writes new
folders and, last, its own row of the run log; the newest successful run names
the current snapshots, so readers never see half a run and a lost or repeated
run leaves the previous snapshots in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchback import schemas as S


def flat_text(df: DataFrame) -> DataFrame:
    """Arrays as comma-joined text, the rest unchanged."""
    arrays = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return df.select(*[F.array_join(c, ",").alias(c) if c in arrays else F.col(c) for c in df.columns])


def write_trails_csv(df: DataFrame, path: str) -> None:
    """Text with a header; white space at the ends of a value is kept."""
    kept = {"header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    flat_text(df).write.mode("overwrite").options(**kept).csv(path)


def write_trails_json(df: DataFrame, path: str) -> None:
    """One JSON record per line; NULL fields are written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_stage(df: DataFrame, base: str, run_id: str, stage: str) -> DataFrame:
    """Writes one stage of a run and returns it read back, so later steps start from the table."""
    path = f"{base}/stages/run_id={run_id}/stage={stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, store: str) -> DataFrame:
    return _read_or_empty(spark, f"{store}/pipeline_runs", S.PIPELINE_RUNS)


def write_run(run: DataFrame, store: str, run_id: str) -> None:
    """A run owns one partition of the log; writing it again replaces its row."""
    run.drop("run_id").coalesce(1).write.mode("overwrite").parquet(f"{store}/pipeline_runs/run_id={run_id}")


def current_version(spark: SparkSession, store: str) -> str | None:
    done = read_runs(spark, store).filter(F.col("status") == "success")
    return done.agg(F.max("dataset_version").alias("v")).first()["v"]


def read_current(spark: SparkSession, store: str, table: str, schema: T.StructType, version: str | None) -> DataFrame:
    """The table as of ``version``; without one, an empty table."""
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store}/{table}/snapshot={version}")


def open_store(spark: SparkSession, store: str) -> str | None:
    """Current snapshots and the run log as temporary views of their names; returns the version they show."""
    version = current_version(spark, store)
    tables = {"trails": S.store_schema(), "crawl_state": S.CRAWL_STATE, "dataset_versions": S.DATASET_VERSIONS}
    for name, schema in tables.items():
        read_current(spark, store, name, schema, version).createOrReplaceTempView(name)
    read_runs(spark, store).createOrReplaceTempView("pipeline_runs")
    return version


def write_snapshot(df: DataFrame, store: str, table: str, version: str) -> None:
    df.write.mode("overwrite").parquet(f"{store}/{table}/snapshot={version}")
