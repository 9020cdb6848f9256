"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "switchback", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC clock, adaptive plans)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, where intermediate tables are written.

    Only a local session without one gets a scratch folder, one per session and
    removed when the process ends; a cluster session without one is an error,
    since a machine-local folder would not survive the loss of an executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="switchback-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def table_path(spark: SparkSession) -> str:
    """A new folder for an intermediate table, below the application's folder in the shared one."""
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    Unlike a checkpoint the table has the size of its files as its statistics.
    A checkpoint keeps the estimate of its plan, and in a loop of joins that
    estimate is multiplied each round until planning itself runs out of memory.
    Tables lie in a folder of the application, so a clean-up can tell them apart.
    """
    spark = df.sparkSession
    path = table_path(spark)
    df.write.parquet(path)
    landed = spark.read.schema(df.schema).parquet(path)
    landed._table_path = path
    return landed


def land_bucketed(df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Writes ``df`` hashed by ``keys`` into buckets and reads it back.

    A join on just these keys then moves the other side only, however often it
    is repeated. The table is listed in the session's catalog under a name of
    its own, its files lie beside those of ``cut_lineage``.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"bucketed_{uuid.uuid4().hex}", table_path(spark)
    writer = df.repartition(count, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(count, *keys).saveAsTable(name)
    landed = spark.table(name)
    landed._table_path, landed._table_name = path, name
    return landed


def drop_tables(*tables: DataFrame) -> None:
    """Removes tables that ``cut_lineage`` or ``land_bucketed`` returned, once nothing reads them any more; other DataFrames are left alone.

    What was made of a dropped table has to be written before.
    """
    for df in tables:
        path, name, spark = getattr(df, "_table_path", None), getattr(df, "_table_name", None), df.sparkSession
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if path:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
