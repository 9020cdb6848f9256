"""Scores, incremental state, snapshots and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback import schemas as S
from switchback.operators import scoring as SC
from switchback.operators import state as ST
from switchback.plans import reports as R
from verification import sql_parts as Q
from verification.registry import query

# ---- scores -----------------------------------------------------------------

PENALTY = Q.lookup(Q.trim("surface_primary"), V.SURFACE_PENALTIES, "{d}")
FEATURES = """
fe AS (SELECT *, CASE WHEN mi > 0 THEN mi END AS dm FROM (SELECT *, coalesce(distance, osm_distance_mi) AS mi FROM {f_trails})),
fx AS (SELECT *, CAST(elevation AS DOUBLE) AS gain, CAST(elevation AS DOUBLE) / dm AS gpm FROM fe)"""


@query(
    "score_features",
    f"WITH {FEATURES} SELECT id, {Q.rnd('dm', 6)} AS distance_mi, gain AS gain_ft, {Q.rnd('gpm', 4)} AS gain_per_mile_ft, max_grade_p95, ({PENALTY.replace('{d}', '0.5')})::DOUBLE AS surface_penalty FROM fx",
)
def score_features(t):
    from switchback.functions.values import py_round

    out = SC.score_features(t.f_trails)
    return out.select(
        "id", py_round(F.col("distance_mi"), 6).alias("distance_mi"), "gain_ft",
        py_round(F.col("gain_per_mile_ft"), 4).alias("gain_per_mile_ft"), "max_grade_p95", "surface_penalty",
    )


def clip10(x: str) -> str:
    return Q.even1(f"greatest(0.0::DOUBLE, least(10.0::DOUBLE, {x}))")


@query(
    "score_heuristic",
    f"""WITH {FEATURES} SELECT id, {clip10(f'''(0.45::DOUBLE * coalesce(gpm / 1000, 0) + 0.35::DOUBLE * coalesce(max_grade_p95 / 20, 0)
  + 0.1::DOUBLE * ({PENALTY.replace('{d}', '0.5')})::DOUBLE + 0.1::DOUBLE * coalesce(dm / 15, 0)) * 10''')} AS difficulty_score_0_10 FROM fx""",
)
def score_heuristic(t):
    # no label column, so the whole job falls back to the weighted sum
    return SC.add_difficulty_score(t.f_trails.drop("calculated_difficulty")).select("id", "difficulty_score_0_10")


def ridge_sql() -> str:
    """Normal equations of the standardised features, eliminated step by step in SQL."""
    names = ["gpm", "grade", "pen", "dm"]
    n = range(4)
    cols = [f"covar_pop(z{i}, z{j}) AS c{i}{j}" for i in n for j in n] + [f"covar_pop(z{i}, y) AS b{i}" for i in n]
    steps, prev = [], "s0"
    for p in n:
        new = []
        for i in n:
            for j in n:
                new.append((f"m{i}{j}" if i == p else f"m{i}{j} - m{i}{p} / m{p}{p} * m{p}{j}") + f" AS m{i}{j}")
            new.append((f"v{i}" if i == p else f"v{i} - m{i}{p} / m{p}{p} * v{p}") + f" AS v{i}")
        steps.append(f"s{p + 1} AS (SELECT ybar, {', '.join(new)} FROM {prev})")
        prev = f"s{p + 1}"
    impute = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM ft WHERE y IS NOT NULL)) AS x{i}" for i, c in enumerate(names))
    stats = ", ".join(f"avg(x{i}) AS mu{i}, CASE WHEN stddev_pop(x{i}) = 0 THEN 1 ELSE stddev_pop(x{i}) END AS sd{i}" for i in n)
    z = ", ".join(f"(x{i} - mu{i}) / sd{i} AS z{i}" for i in n)
    start = ", ".join([f"n * c{i}{j} + {1 if i == j else 0} AS m{i}{j}" for i in n for j in n] + [f"n * b{i} AS v{i}" for i in n])
    predicted = "ybar + " + " + ".join(f"v{i} / m{i}{i} * z{i}" for i in n)
    return f"""WITH {FEATURES},
ft AS (SELECT id, gpm, max_grade_p95 AS grade, ({PENALTY.replace('{d}', '0.5')})::DOUBLE AS pen, dm, ({Q.lookup(Q.trim('calculated_difficulty'), V.LABEL_LEVELS)})::DOUBLE AS y FROM fx),
im AS (SELECT id, y, {impute} FROM ft),
st AS (SELECT {stats} FROM im WHERE y IS NOT NULL),
zz AS (SELECT id, y, {z} FROM im, st),
cv AS (SELECT count(*) AS n, avg(y) AS ybar, {', '.join(cols)} FROM zz WHERE y IS NOT NULL),
s0 AS (SELECT ybar, {start} FROM cv), {', '.join(steps)}
SELECT id, {clip10(f'({predicted}) / 2 * 10')} AS difficulty_score_0_10 FROM zz, s4"""


@query("score_ridge", ridge_sql())
def score_ridge(t):
    return SC.add_difficulty_score(t.f_trails).select("id", "difficulty_score_0_10")


@query(
    "feature_medians",
    """
SELECT median(l_extendedprice) AS price, median(l_quantity) AS quantity, median(l_discount) AS discount FROM {lineitem}
""",
)
def feature_medians(t):
    names = {"l_extendedprice": "price", "l_quantity": "quantity", "l_discount": "discount"}
    rows = t.lineitem.select(*names)
    medians = SC.exact_medians(rows, list(names))
    return rows.agg(*[F.max(F.lit(medians[c])).alias(n) for c, n in names.items()])


@query(
    "runnable_pct",
    f"""WITH {FEATURES},
q AS (SELECT id, least(2.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(max_grade_p95, 0) / 25.0::DOUBLE)) AS s, least(2.0::DOUBLE, greatest(0.0::DOUBLE, coalesce(gpm, 0) / 1500.0::DOUBLE)) AS c,
  ({PENALTY.replace('{d}', '0.6')})::DOUBLE AS p FROM fx)
SELECT id, {Q.even1('greatest(0.0::DOUBLE, least(100.0::DOUBLE, (1.0::DOUBLE - (0.55::DOUBLE * s + 0.25::DOUBLE * c + 0.2::DOUBLE * p) / 2.0::DOUBLE) * 100.0::DOUBLE))')} AS trail_runnable_pct FROM q""",
)
def runnable_pct(t):
    return SC.add_runnable_pct(t.f_trails).select("id", "trail_runnable_pct")


@query(
    "score_coverage",
    "SELECT count(*) AS n_rows, count(max_grade_p95) AS n_max_grade_p95, count(distance) AS n_distance, count(calculated_difficulty) AS n_calculated_difficulty FROM {f_trails}",
)
def score_coverage(t):
    return SC.coverage(t.f_trails, ["max_grade_p95", "distance", "calculated_difficulty"])


# ---- change detection and state ----------------------------------------------


@query(
    "row_hash",
    "SELECT o_orderkey, sha256('{\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || ',\"o_orderpriority\":\"' || o_orderpriority || '\",\"old\":null}') AS new_hash FROM {orders}",
)
def row_hash(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.lit(None).cast("string").alias("old"))
    return rows.select("o_orderkey", ST.row_hash(rows).alias("new_hash"))


CHANGED = """SELECT c.id, c.url, c.new_hash FROM {f_crawled} c LEFT JOIN {f_state} s ON s.url = c.url WHERE NOT c.parse_failed AND c.new_hash IS DISTINCT FROM s.last_hash"""


@query("changed_rows", CHANGED)
def changed_rows(t):
    crawled = t.f_crawled.filter("NOT parse_failed").select("id", "url", "new_hash")
    return ST.changed_rows(crawled, t.f_state).select("id", "url", "new_hash")


@query(
    "changed_kept",
    f"SELECT 'wta_' || page_id AS id, length(html) AS n FROM {{pages}} WHERE 'wta_' || page_id IN (SELECT id FROM ({CHANGED}))",
)
def changed_kept(t):
    crawled = t.f_crawled.filter("NOT parse_failed").select("id", "url", "new_hash")
    pages = t.pages.select(F.concat(F.lit("wta_"), F.col("page_id").cast("string")).alias("id"), F.length("html").cast("bigint").alias("n"))
    return ST.keep_rows(pages, ST.changed_rows(crawled, t.f_state))


STATE_ROWS = """SELECT c.url, CASE WHEN c.parse_failed THEN s.last_hash ELSE c.new_hash END AS last_hash, DATE '2024-06-01' AS last_crawled_at,
  CASE WHEN c.parse_failed THEN 0 ELSE 200 END AS last_status, CASE WHEN c.parse_failed THEN 'parse_failed_or_unreachable' END AS last_error
FROM {f_crawled} c LEFT JOIN {f_state} s ON s.url = c.url"""


def updates(t):
    at = F.lit("2024-06-01").cast("date")
    return ST.state_updates(t.f_crawled.filter("NOT parse_failed"), t.f_crawled.filter("parse_failed"), t.f_state, at)


@query("state_rows", STATE_ROWS)
def state_rows(t):
    return updates(t)


@query(
    "state_upsert",
    f"""
WITH u AS ({STATE_ROWS}) SELECT * FROM u UNION ALL SELECT * FROM {{f_state}} s WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.url = s.url)
""",
)
def state_upsert(t):
    """Every update stays: pages may share an address."""
    return ST.replace_rows(t.f_state, updates(t), ["url"])


@query(
    "sanitize",
    """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice END AS gain_ft, CAST(trunc(p_retailprice) AS INTEGER) AS elevation, p_partkey * 10000000000 AS osm_id FROM {part}
""",
)
def sanitize(t):
    odd = F.when(F.col("p_partkey") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    rows = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, odd).otherwise(F.col("p_retailprice")).alias("gain_ft"),
        F.col("p_retailprice").alias("elevation"), (F.col("p_partkey") * F.lit(10000000000)).cast("double").alias("osm_id"),
    )
    return ST.sanitize(rows)


UPSERTED = """SELECT coalesce(t.id, u.id) AS id, CASE WHEN u.id IS NOT NULL THEN {pick} ELSE t.a END AS a, t.kept, t.dataset_version
FROM {{f_target}} t FULL JOIN {{f_updates}} u ON u.id = t.id"""


@query("upsert_trails", UPSERTED.format(pick="u.a"))
def upsert_trails(t):
    return ST.upsert(t.f_target, t.f_updates, ["id"])


@query("upsert_keep_old", UPSERTED.format(pick="coalesce(u.a, t.a)"))
def upsert_keep_old(t):
    return ST.upsert(t.f_target, t.f_updates, ["id"], null_overwrites=False)


@query(
    "store_shape",
    "SELECT id, name, distance, elevation AS trailhead_lat, osm_distance_mi AS trailhead_lng FROM {f_trails}",
)
def store_shape(t):
    rows = t.f_trails.select(
        "id", "name", "parking", "distance", F.col("distance").alias("distance_mi"), F.lit(0.5).alias("surface_penalty"),
        F.lit(1.0).alias("wta_diff_level"), F.col("elevation").alias("latitude"), F.col("osm_distance_mi").alias("longitude"),
    )
    return ST.to_store_shape(rows)


@query("stamp_version", "SELECT id, a, kept, 'v2' AS dataset_version FROM {f_target}")
def stamp_version(t):
    return ST.stamp_version(t.f_target, "v2")[0]


@query("stamp_count", "SELECT count(*) FILTER (dataset_version IS DISTINCT FROM 'v2') AS marked_rows FROM {f_target}")
def stamp_count(t):
    return ST.stamp_version(t.f_target, "v2")[1]


@query(
    "conform_schema",
    "SELECT id, CAST(a AS VARCHAR) AS a, NULL::DOUBLE AS gain_ft, NULL::VARCHAR AS description, kept, dataset_version FROM {f_target}",
)
def conform_schema(t):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id bigint, a string, gain_ft double, description string")
    old = t.f_target.withColumns({"grade_p95": F.lit(1.0), "log_distance": F.lit(2.0)})
    return ST.conform_schema(old, schema)


@query(
    "snapshot_ids",
    "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS dataset_version FROM {events}",
)
def snapshot_ids(t):
    return t.events.select("event_id", ST.snapshot_id(F.col("ts")).alias("dataset_version"))


@query(
    "register_version",
    """
SELECT run_id AS dataset_version, CASE WHEN run_id = (SELECT max(run_id) FROM {f_runs}) THEN 'weekly_ingest' ELSE status END AS notes,
  started_at::TIMESTAMP AS created_at FROM {f_runs}
UNION ALL SELECT 'zzz', 'weekly_ingest', TIMESTAMP '2024-06-01 00:00:00'
""",
)
def register_version(t):
    known = t.f_runs.select(
        F.col("run_id").alias("dataset_version"), F.col("started_at").cast("timestamp").alias("created_at"), F.col("status").alias("notes")
    )
    at = F.lit("2024-06-01").cast("timestamp")
    newest = t.f_runs.agg(F.max("run_id")).first()[0]
    both = ST.register_version(ST.register_version(known, newest, "weekly_ingest", at), "zzz", "weekly_ingest", at)
    return both.select("dataset_version", "notes", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    "log_run",
    """
SELECT run_id, 'success' AS status, row_count * 2 AS row_count, failed_urls, started_at FROM {f_runs} WHERE status = 'failed'
UNION ALL SELECT run_id, status, row_count, failed_urls, started_at FROM {f_runs} WHERE status <> 'failed'
""",
)
def log_run(t):
    again = t.f_runs.filter("status = 'failed'").select(
        "run_id", F.lit("success").alias("status"), (F.col("row_count") * 2).alias("row_count")
    )
    return ST.log_run(t.f_runs, again)


@query(
    "run_metrics",
    f"""
SELECT (SELECT count(*) FROM {{f_sitemap}}) AS sitemap_hike_urls, (SELECT count(*) FROM {{f_state}}) AS known_urls, (SELECT count(*) FROM {{f_crawled}}) AS to_crawl,
  (SELECT count(*) FROM {{f_crawled}} WHERE NOT parse_failed) AS crawled_rows, (SELECT count(*) FROM {{f_crawled}} WHERE parse_failed) AS failed_urls,
  (SELECT count(*) FROM ({CHANGED})) AS changed_rows
""",
)
def run_metrics(t):
    ok = t.f_crawled.filter("NOT parse_failed").select("id", "url", "new_hash")
    failed = t.f_crawled.filter("parse_failed")
    return ST.run_metrics(t.f_sitemap, t.f_state, t.f_crawled, ok, failed, ST.changed_rows(ok, t.f_state))


# ---- reports --------------------------------------------------------------------


@query("missing_version", "SELECT count(*) AS missing_dataset_version FROM {f_target} WHERE dataset_version IS NULL")
def missing_version(t):
    return R.missing_version(t.f_target)


@query("state_coverage", "SELECT count(*) AS crawl_state_rows FROM {f_state}")
def state_coverage(t):
    return R.state_rows(t.f_state)


@query("versions_report", "SELECT dataset_version, count(*) AS trails FROM {f_target} GROUP BY 1 ORDER BY 1 DESC")
def versions_report(t):
    return R.version_distribution(t.f_target)


@query("recent_runs", "SELECT run_id, status, started_at, row_count FROM {f_runs} ORDER BY started_at DESC LIMIT 20")
def recent_runs(t):
    return R.recent_runs(t.f_runs)


@query(
    "failed_spike",
    """
SELECT run_id, started_at, failed_urls, lag(failed_urls) OVER (ORDER BY started_at) AS previous_failed,
  failed_urls - lag(failed_urls) OVER (ORDER BY started_at) AS increase FROM {f_runs}
""",
)
def failed_spike(t):
    return R.failed_spike(t.f_runs)


@query("error_breakdown", "SELECT last_status, last_error, count(*) AS n FROM {f_state} GROUP BY ALL")
def error_breakdown(t):
    return R.error_breakdown(t.f_state)
