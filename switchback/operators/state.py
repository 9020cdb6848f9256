"""Change detection, upserts and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchback import fixed_values as V
from switchback.functions.values import finite


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of the row as JSON with sorted keys; NULL fields are part of it."""
    return F.sha2(F.to_json(F.struct(*sorted(columns or df.columns)), {"ignoreNullFields": "false"}), 256)


def changed_rows(crawled: DataFrame, state: DataFrame, key: str = "url", row_id: str = "id") -> DataFrame:
    """Rows of ``crawled`` whose ``new_hash`` is not the stored one; unknown addresses count as changed."""
    stored = state.select(key, F.col("last_hash").alias("_stored"))
    fresh = crawled.join(stored, key, "left").filter(~F.col("new_hash").eqNullSafe(F.col("_stored")))
    return fresh.filter(F.col(row_id).isNotNull() & (F.col(row_id) != "")).drop("_stored")


def keep_rows(df: DataFrame, wanted: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in ``wanted``."""
    return df.join(wanted.select(key), key, "left_semi")


def state_updates(ok: DataFrame, failed: DataFrame, state: DataFrame, at: Column) -> DataFrame:
    """New state rows: hashes of parsed pages, and failures that keep their old hash."""
    text = lambda v: F.lit(v).cast("string")
    done = ok.select(
        "url", F.col("new_hash").alias("last_hash"), at.alias("last_crawled_at"),
        F.lit(V.SUCCESS_STATUS).alias("last_status"), text(None).alias("last_error"),
    )
    lost = failed.select("url").join(state.select("url", "last_hash"), "url", "left").select(
        "url", "last_hash", at.alias("last_crawled_at"),
        F.lit(V.FAILURE_STATUS).alias("last_status"), text(V.FAILURE_ERROR).alias("last_error"),
    )
    return done.unionByName(lost)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {twice[0].asDict()} in upsert source")


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], null_overwrites: bool = True, check: bool = True
) -> DataFrame:
    """``target`` with ``source`` merged in by key.

    A matched row takes the columns ``source`` supplies, NULLs included unless
    ``null_overwrites`` is off, and keeps its others; an unmatched source row is
    added. Both sides hold a key once (``check`` rejects a source that does not),
    so the join has no heavy key. ``target`` is left-joined with ``source`` and
    united with the source rows it lacks, so while the source is small enough to
    be broadcast, the target is not moved. The result must go to a new snapshot path.
    """
    if check:
        assert_unique(source, keys)
    supplied = [c for c in source.columns if c not in keys]
    incoming = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in supplied], F.lit(True).alias("_hit"))
    merged = target.join(incoming, keys, "left")
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    added = source.join(known, keys, "left_anti")

    def pick(c: str) -> Column:
        if c not in supplied:
            return F.col(c)
        if c not in target.columns:
            return F.col(f"_new_{c}").alias(c)
        new = F.col(f"_new_{c}")
        value = new if null_overwrites else F.coalesce(new, F.col(c))
        return F.when(F.col("_hit"), value).otherwise(F.col(c)).alias(c)

    names = [c for c in target.columns if c not in keys] + [c for c in supplied if c not in target.columns]
    matched = merged.select(*keys, *[pick(c) for c in names])
    new = added.select(*[F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in matched.columns])
    return matched.unionByName(new)


def replace_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` whole, and the rows of ``target`` whose key it does not hold.

    What an upsert comes to when ``source`` supplies every column. No row is
    merged with another, so a key that several source rows hold keeps them all.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.select(*target.columns).unionByName(kept)


def stamp_version(df: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """All rows under one version, and the number of rows that had another (or none) before."""
    stale = ~F.col("dataset_version").eqNullSafe(F.lit(version))
    return df.withColumn("dataset_version", F.lit(version)), df.agg(F.count_if(stale).alias("marked_rows"))


def sanitize(df: DataFrame, int_columns: list[str] = V.INTEGER_COLUMNS) -> DataFrame:
    """NaN and infinite numbers to NULL; integer columns truncated (ids stay 64 bits wide)."""
    out = {}
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = finite(c)
        if field.name in int_columns:
            c = c.try_cast("bigint" if field.name == "osm_id" else "int")
        out[field.name] = c
    return df.select(*[c.alias(n) for n, c in out.items()])


def to_store_shape(df: DataFrame) -> DataFrame:
    return df.drop(*V.INTERMEDIATE_COLUMNS).withColumnsRenamed(V.STORE_RENAMES)


def conform_schema(df: DataFrame, schema: T.StructType, retired: list[str] = V.RETIRED_COLUMNS) -> DataFrame:
    """Columns and types of ``schema`` first (missing ones as NULL), then any others that are not retired."""
    have = set(df.columns)
    declared = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [c for c in df.columns if c not in schema.names and c not in retired]
    return df.select(*declared, *extra)


def register_version(versions: DataFrame, version: str, notes: str, at: Column) -> DataFrame:
    """Version list with ``version`` in it; a known version keeps its creation time and takes the new notes."""
    row = versions.sparkSession.range(1).select(F.lit(version).alias("dataset_version"), F.lit(notes).alias("notes"))
    merged = upsert(versions, row, ["dataset_version"], check=False)
    return merged.withColumn("created_at", F.coalesce("created_at", at.cast("timestamp")))


def snapshot_id(ts: Column) -> Column:
    """Sortable id of a UTC time (the session clock runs in UTC)."""
    return F.date_format(ts, V.SNAPSHOT_FORMAT)


def run_metrics(sitemap_hikes, known, frontier, crawled, failed, changed) -> DataFrame:
    """One row of stage counts. Each argument is a DataFrame; every one is scanned once."""
    named = {
        "sitemap_hike_urls": sitemap_hikes, "known_urls": known, "to_crawl": frontier,
        "crawled_rows": crawled, "failed_urls": failed, "changed_rows": changed,
    }
    parts = None
    for name, df in named.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        parts = one if parts is None else parts.union(one)
    return parts.agg(*[F.max(F.when(F.col("metric") == n, F.col("n"))).alias(n) for n in named])


def log_run(runs: DataFrame, run: DataFrame) -> DataFrame:
    """Run log with ``run`` in it, one row per run id."""
    return upsert(runs, run, ["run_id"])
