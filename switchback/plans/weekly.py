"""The incremental job: discover, choose, extract, detect changes, enrich, score, publish."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback import schemas as S
from switchback.operators import state as ST
from switchback.operators import urls as U
from switchback.operators.pages import extract_pages, failed_urls
from switchback.operators.scoring import add_difficulty_score, add_runnable_pct
from switchback.plans.enrich import attach_enrichment, enrich_trails
from switchback.sources import writers as W


@dataclass(frozen=True)
class RunParams:
    """Identity and bounds of one run; given, not drawn, so that a run can be repeated."""

    run_id: str
    dataset_version: str
    started_at: datetime
    max_pages: int | None = 50
    null_status_ok: bool = True
    schema_version: str = "v1.0"
    heading_class: str | None = V.HEADING_CLASS
    name_method: str = "blocks"
    notes: dict = field(default_factory=dict)

    @classmethod
    def at(cls, when: datetime, tag: str, **options) -> "RunParams":
        version = when.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
        return cls(f"run_{version}_{tag}", version, when, **options)


def weekly_job(
    spark: SparkSession,
    store: str,
    sitemap: DataFrame,
    pages: DataFrame,
    features: DataFrame,
    elevations: DataFrame | None,
    params: RunParams,
) -> dict[str, int]:
    """Runs one increment against the store and returns its metrics.

    New snapshots of trails, versions and crawl state are written first and the
    run log row last; a failed run only adds a ``failed`` row, so its pages are
    taken up again by the next run.
    """
    stats: dict[str, int | str] = {}
    current = W.current_version(spark, store)
    if current is not None and params.dataset_version <= current:
        raise ValueError(f"version {params.dataset_version} is not newer than {current}")
    try:
        row_count, notes = _increment(spark, store, current, sitemap, pages, features, elevations, params, stats)
    except Exception as e:
        stats["error"] = repr(e)
        _log(spark, store, params, "failed", 0, stats, V.NOTE_EXCEPTION)
        raise
    _log(spark, store, params, "success", row_count, stats, notes)
    return stats


def _increment(spark, store, current, sitemap, pages, features, elevations, params, stats) -> tuple[int, str]:
    version = params.dataset_version
    at = F.lit(params.started_at).cast("timestamp")
    trails = W.read_current(spark, store, "trails", S.store_schema(), current)
    state = W.read_current(spark, store, "crawl_state", S.CRAWL_STATE, current)
    versions = W.read_current(spark, store, "dataset_versions", S.DATASET_VERSIONS, current)
    stage = lambda df, name: W.write_stage(df, store, params.run_id, name)

    hikes = U.filter_urls(sitemap)
    listed = U.frontier_stats(hikes, state).first()
    stats.update(sitemap_hike_urls=listed["listed"], known_urls=listed["known_urls"])
    frontier = stage(U.select_frontier(hikes, state, params.max_pages), "00_frontier")

    wanted = frontier.groupBy("url").agg(F.min("pos").alias("_pos"))
    landed = latest_pages(pages, params.null_status_ok).join(wanted.select("url"), "url", "left_semi")
    parsed = extract_pages(landed, params.heading_class).withColumn("url", F.col("source_url")).join(wanted, "url")
    # every address that parsed has its own state; trails are unique by id only where they are published
    crawled = stage(parsed.withColumn("new_hash", ST.row_hash(parsed, [c for c in parsed.columns if c != "_pos"])), "01_crawled")
    failed = failed_urls(wanted, crawled)
    changed = U.dedupe_first(ST.changed_rows(crawled, state), "id", "_pos")

    counts = ST.run_metrics(hikes, state, frontier, crawled, failed, changed).first().asDict()
    stats.update({k: counts[k] for k in ("to_crawl", "crawled_rows", "failed_urls", "changed_rows")})
    if counts["crawled_rows"] == 0 and counts["failed_urls"] == 0:
        raise RuntimeError("nothing crawled in this run")
    stats["remaining_uncrawled"] = U.remaining(spark.createDataFrame([listed]), crawled).first()[0]

    if counts["changed_rows"] == 0:
        published, row_count, notes = trails, 0, V.NOTE_NO_CHANGE
    else:
        base = changed.drop("url", "new_hash", "_pos")
        enriched = stage(attach_enrichment(base, enrich_trails(base, features, elevations, params.name_method)), "02_enriched")
        scored = add_runnable_pct(add_difficulty_score(enriched)).withColumn("dataset_version", F.lit(version))
        scored = stage(scored, "03_scored")
        fresh = ST.sanitize(ST.to_store_shape(scored))
        published = ST.conform_schema(ST.upsert(trails, fresh, ["id"]), S.store_schema())
        row_count, notes = counts["changed_rows"], ""
        stats.update(enriched_rows=row_count, upserted=row_count)
        stats["attempted_matches"] = enriched.agg(F.count("match_confidence")).first()[0]

    stamped, marked = ST.stamp_version(published, version)
    stats["dataset_version_marked_rows"] = marked.first()["marked_rows"]
    updates = ST.state_updates(crawled, failed, state, at)
    W.write_snapshot(stamped, store, "trails", version)
    W.write_snapshot(ST.register_version(versions, version, "weekly_ingest", at), store, "dataset_versions", version)
    W.write_snapshot(ST.upsert(state, updates, ["url"]), store, "crawl_state", version)
    return row_count, notes


def latest_pages(pages: DataFrame, null_status_ok: bool = True) -> DataFrame:
    """(url, html) of the pages that were landed successfully, the last landing of each address.

    Only status 200 counts; pages without a status count if ``null_status_ok``.
    Landings are ordered by ``landed_at`` where there is such a column, then by content.
    """
    fine = F.col("status") == V.SUCCESS_STATUS if "status" in pages.columns else F.lit(None).cast("boolean")
    pages = pages.filter(F.coalesce(fine, F.lit(null_status_ok)))
    at = F.col("landed_at") if "landed_at" in pages.columns else F.lit(None).cast("timestamp")
    place = F.struct(at.alias("at"), F.xxhash64("html").alias("content"))
    return pages.groupBy("url").agg(F.max_by("html", place).alias("html"))


def _log(spark, store, params: RunParams, status: str, row_count: int, stats: dict, notes: str) -> None:
    text = lambda d: {k: str(v) for k, v in d.items()}
    bounds = {"max_pages": params.max_pages, **params.notes}
    row = (
        params.run_id, params.dataset_version, params.schema_version, status, params.started_at,
        datetime.now(timezone.utc), row_count, text(stats), text(bounds), notes,
    )
    run = spark.createDataFrame([row], S.PIPELINE_RUNS)
    W.write_run(ST.log_run(spark.createDataFrame([], S.PIPELINE_RUNS), run), store, params.run_id)
