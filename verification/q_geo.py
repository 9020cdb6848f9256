"""Tracks, matching and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions import geo
from switchback.functions import text as X
from switchback.functions.values import py_round, quick_round
from switchback.operators import matching as MT
from switchback.operators import tracks as TR
from switchback.operators.stitching import stitch_trailheads, stitched_lines
from switchback.plans.enrich import attach_enrichment, enrich_all, enrich_trails
from switchback.session import cut_lineage
from verification import sql_parts as Q
from verification.registry import query

# ---- tracks -----------------------------------------------------------------

STEPS = f"""
p AS (SELECT feature_id, pos, lat, lng, elevation_m, row_number() OVER w AS rn, count(*) OVER (PARTITION BY feature_id) AS n,
    CASE WHEN lag(lat) OVER w IS NULL THEN 0.0::DOUBLE ELSE {Q.hav('lag(lat) OVER w', 'lag(lng) OVER w', 'lat', 'lng')} END AS d
  FROM {{f_tracks}} WINDOW w AS (PARTITION BY feature_id ORDER BY pos))"""


def walk(step: float, cap: int) -> str:
    """Rows (feature_id, i, pos, lat, lng, elevation_m) of the thinned tracks, by stepping through every track row by row."""
    return f"""WITH RECURSIVE {STEPS},
walk AS (SELECT feature_id, rn, 0.0::DOUBLE AS acc, 1 AS kept_n, TRUE AS keep FROM p WHERE rn = 1
  UNION ALL
  SELECT p.feature_id, p.rn, CASE WHEN w.acc + p.d >= {step} AND w.kept_n < {cap} THEN 0.0::DOUBLE ELSE w.acc + p.d END,
    CASE WHEN w.acc + p.d >= {step} AND w.kept_n < {cap} THEN w.kept_n + 1 ELSE w.kept_n END,
    w.acc + p.d >= {step} AND w.kept_n < {cap}
  FROM walk w JOIN p ON p.feature_id = w.feature_id AND p.rn = w.rn + 1),
m AS (SELECT p.*, w.keep OR p.n <= 2 AS keep, max(w.kept_n) OVER (PARTITION BY p.feature_id) AS total FROM walk w JOIN p ON p.feature_id = w.feature_id AND p.rn = w.rn),
tail AS (SELECT feature_id, arg_max(lat, rn) AS tlat, arg_max(lng, rn) AS tlng FROM m WHERE keep GROUP BY feature_id),
s AS (SELECT m.feature_id, CAST(row_number() OVER (PARTITION BY m.feature_id ORDER BY m.rn) AS INTEGER) - 1 AS i, m.pos, m.lat, m.lng, m.elevation_m, m.n
  FROM m JOIN tail t ON t.feature_id = m.feature_id
  WHERE m.keep OR (m.rn = m.n AND m.total < {cap} AND (m.lat <> t.tlat OR m.lng <> t.tlng)))
"""


@query(
    "track_length",
    f"WITH {STEPS} SELECT feature_id, count(*) AS n_points, {Q.rnd('sum(d)', 3)} AS length_m, {Q.rnd('sum(d) / 1609.344', 3)} AS length_mi FROM p GROUP BY feature_id",
)
def track_length(t):
    out = TR.line_length(t.f_tracks)
    return out.withColumns({c: py_round(F.col(c), 3) for c in ("length_m", "length_mi")})


@query("track_resample", walk(45.0, 220) + "SELECT feature_id, i, pos, lat, lng FROM s")
def track_resample(t):
    thinned = TR.resample(t.f_tracks, V.GRADE_STEP_M, V.GRADE_MAX_POINTS)
    return thinned.select("feature_id", F.posexplode("samples").alias("i", "p")).select("feature_id", "i", "p.*")


@query("track_resample_coarse", walk(1200.0, 12) + "SELECT feature_id, i, pos, lat, lng FROM s")
def track_resample_coarse(t):
    thinned = TR.resample(t.f_tracks, 1200.0, 12)
    return thinned.select("feature_id", F.posexplode("samples").alias("i", "p")).select("feature_id", "i", "p.*")


@query(
    "track_grade",
    walk(45.0, 220)
    + f""", g AS (SELECT feature_id, i, n, elevation_m, {Q.hav('lag(lat) OVER w', 'lag(lng) OVER w', 'lat', 'lng')} AS d, elevation_m - lag(elevation_m) OVER w AS rise
  FROM s WINDOW w AS (PARTITION BY feature_id ORDER BY i)),
a AS (SELECT feature_id, max(n) AS n, count(*) = count(elevation_m) AS whole,
    list_sort(list(abs(rise) / d * 100) FILTER (d > 1 AND abs(rise) / d * 100 <= 60)) AS gs, sum(greatest(rise, 0)) FILTER (d > 1) AS up FROM g GROUP BY feature_id)
SELECT feature_id,
  CASE WHEN n >= 3 AND whole AND len(gs) > 0 THEN {Q.rnd('gs[CAST(floor(0.95::DOUBLE * (len(gs) - 1)) AS INTEGER) + 1]', 1)} END AS max_grade_p95,
  CASE WHEN n >= 3 AND whole AND up <> 0 THEN CAST(round_even(up * 3.28084::DOUBLE, 0) AS INTEGER) END AS derived_gain_ft FROM a""",
)
def track_grade(t):
    thinned = TR.resample(t.f_tracks, V.GRADE_STEP_M, V.GRADE_MAX_POINTS)
    heights = t.f_tracks.select("feature_id", "pos", "elevation_m")
    return TR.grade_features(thinned, heights, on=("feature_id", "pos"))


def chunks(v: str) -> str:
    """Five-bit text of a zigzag number in DuckDB."""
    letter = lambda k: (
        f"chr(CAST((({v} >> {5 * k}) & 31) + CASE WHEN ({v} >> {5 * k + 5}) > 0 THEN 32 ELSE 0 END + 63 AS INTEGER))"
    )
    parts = [letter(0)] + [f"CASE WHEN ({v} >> {5 * k}) > 0 THEN {letter(k)} ELSE '' END" for k in range(1, 7)]
    return " || ".join(parts)


ENCODE = f"""
u AS (SELECT feature_id, i, CAST(round_even(lat * 1e5, 0) AS BIGINT) AS y, CAST(round_even(lng * 1e5, 0) AS BIGINT) AS x FROM s),
v AS (SELECT feature_id, i, y - coalesce(lag(y) OVER w, 0) AS dy, x - coalesce(lag(x) OVER w, 0) AS dx FROM u WINDOW w AS (PARTITION BY feature_id ORDER BY i)),
z AS (SELECT feature_id, i, CASE WHEN dy < 0 THEN -2 * dy - 1 ELSE 2 * dy END AS zy, CASE WHEN dx < 0 THEN -2 * dx - 1 ELSE 2 * dx END AS zx FROM v)
SELECT feature_id, string_agg({chunks('zy')} || {chunks('zx')}, '' ORDER BY i) AS geometry_polyline FROM z GROUP BY feature_id"""


@query("track_polyline", walk(60.0, 160) + "," + ENCODE)
def track_polyline(t):
    return TR.encode_polylines(TR.resample(t.f_tracks, V.EXPORT_STEP_M, V.EXPORT_MAX_POINTS))


# ---- map features ---------------------------------------------------------------


def elements(ways: DataFrame) -> DataFrame:
    """Nested map elements of the derived ways: ways carry geometry, relations one tagged member way."""
    at = lambda i: F.struct(
        (F.col("lat0") + (i * F.col("rise")).cast("double") / F.lit(2500.0)).alias("lat"),
        (F.col("lng0") + i.cast("double") / F.lit(4000.0)).alias("lon"),
    )
    line = F.transform(F.sequence(F.lit(0), F.col("n") - 1), at)
    if "back" in ways.columns:
        line = F.when(F.col("back"), F.reverse(line)).otherwise(line)
    keys = ["name", "highway", "route", "access", "surface", "sac_scale"]
    values = [F.col("osm_name") if k == "name" else F.col(k) for k in keys]
    tags = F.map_from_entries(
        F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in zip(keys, values)]), lambda e: e["v"].isNotNull())
    )
    member = F.struct(
        F.lit("way").alias("type"), F.col("id").alias("ref"), F.lit("").alias("role"), tags.alias("tags"), line.alias("geometry")
    )
    is_way = F.col("type") == "way"
    return ways.select(
        "type", "id", tags.alias("tags"), F.when(is_way, line).alias("geometry"), F.when(~is_way, F.array(member)).alias("members")
    )


VERTICES = """
vx AS (SELECT *, lat0 + CAST(i * rise AS DOUBLE) / 2500.0::DOUBLE AS lat, lng0 + CAST(i AS DOUBLE) / 4000.0::DOUBLE AS lng
  FROM (SELECT *, unnest(range(0, n)) AS i FROM {f_ways}))"""
LENGTHS = f"""
ln AS (SELECT type, id, sum(d) AS m FROM (SELECT type, id, {Q.hav('lag(lat) OVER w', 'lag(lng) OVER w', 'lat', 'lng')} AS d FROM vx
  WINDOW w AS (PARTITION BY type, id ORDER BY i)) GROUP BY type, id)"""
ELIGIBLE = """
((type = 'way' AND (regexp_matches(highway, 'path|footway|track') OR highway = 'bridleway') AND coalesce(access <> 'private', TRUE)) OR (type = 'relation' AND route = 'hiking'))"""
PAIRS = f"""
pr AS (SELECT t.trail_id, t.name, t.distance_mi, v.type AS osm_type, v.id AS osm_id, min({Q.hav('t.lat', 't.lng', 'v.lat', 'v.lng')}) AS dist_m
  FROM {{f_trailheads}} t JOIN vx v ON abs(t.lat - v.lat) < 0.03 AND abs(t.lng - v.lng) < 0.05 WHERE {ELIGIBLE.replace('type', 'v.type')} GROUP BY ALL HAVING min({Q.hav('t.lat', 't.lng', 'v.lat', 'v.lng')}) <= 2600)"""


@query(
    "feature_scan",
    f"""WITH {VERTICES}, {LENGTHS}
SELECT w.type AS osm_type, w.id AS osm_id, w.n AS n_points, {Q.rnd('ln.m', 2)} AS length_m, w.osm_name AS feature_name,
  {Q.lookup('lower(trim(w.surface))', V.SURFACE_TAG_LABELS)} AS surface, {ELIGIBLE.replace('type', 'w.type')} AS eligible
FROM {{f_ways}} w JOIN ln ON ln.type = w.type AND ln.id = w.id""",
)
def feature_scan(t):
    f = MT.read_features(elements(t.f_ways))
    return f.select(
        "osm_type", "osm_id", F.size("points").alias("n_points"), py_round(geo.path_length_m(F.col("points")), 2).alias("length_m"),
        X.feature_name(F.col("tags")).alias("feature_name"),
        X.surface_from_tag(F.try_element_at("tags", F.lit("surface"))).alias("surface"),
        MT.is_trail_feature(F.col("osm_type"), F.col("tags")).alias("eligible"),
    )


@query(
    "way_geometry",
    "SELECT c_custkey AS id, 5 - CAST(c_custkey % 3 AS INTEGER) AS n_points FROM {customer}",
)
def way_geometry(t):
    """Geometry entries without both coordinates do not count."""
    gap = lambda i: F.when(i < F.col("c_custkey") % 3, F.lit(None).cast("double")).otherwise(F.lit(1.0) * i)
    geometry = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct(F.lit(45.0).alias("lat"), gap(i).alias("lon")))
    return t.customer.select(F.col("c_custkey").alias("id"), F.size(geo.way_points(geometry)).alias("n_points"))


RELATION_PARTS = 4


def relation_members():
    """Four consecutive stretches of a line, some laid backwards; the third starts 30 m off."""
    k = F.col("c_custkey")

    def member(j):
        flip = (F.shiftright(k, j) % 2) == 1
        off = F.when(F.lit(j) == 2, F.lit(0.0003)).otherwise(F.lit(0.0))
        line = F.transform(
            F.sequence(F.lit(3 * j), F.lit(3 * j + 3)),
            lambda i: F.struct((F.lit(45.0) + i / F.lit(1000.0) + off).alias("lat"), (F.lit(-121.0) - i / F.lit(2000.0)).alias("lon")),
        )
        return F.struct(
            F.lit("way").alias("type"), F.lit(j).cast("bigint").alias("ref"), F.lit("").alias("role"),
            F.create_map().cast("map<string,string>").alias("tags"), F.when(flip, F.reverse(line)).otherwise(line).alias("geometry"),
        )

    return F.array(*[member(j) for j in range(RELATION_PARTS)])


def _end(j: int, last: bool) -> tuple[str, str]:
    """SQL (lat, lng) of an end of member j as laid."""
    off = " + 0.0003" if j == 2 else ""
    a, b = (3 * j + 3, 3 * j) if last else (3 * j, 3 * j + 3)
    i = f"(CASE WHEN (c_custkey >> {j}) % 2 = 1 THEN {b} ELSE {a} END)"
    return f"(45.0::DOUBLE + {i} / 1000.0::DOUBLE{off})", f"(-121.0::DOUBLE - {i} / 2000.0::DOUBLE)"


def _relation_sql() -> str:
    """One step per member: which way round it goes, where the line then ends, what it adds."""
    lat, lng = _end(0, True)
    inner = Q.hav("45.0::DOUBLE", "-121.0::DOUBLE", "45.001::DOUBLE", "-121.0005::DOUBLE")
    steps = [f"r0 AS (SELECT c_custkey, {lat} AS ty, {lng} AS tx, 4 AS n FROM {{customer}})"]
    for j in range(1, RELATION_PARTS):
        (fy, fx), (ly, lx) = _end(j, False), _end(j, True)
        d_first, d_last = Q.hav("ty", "tx", fy, fx), Q.hav("ty", "tx", ly, lx)
        steps.append(
            f"r{j} AS (SELECT c_custkey, CASE WHEN {d_last} < {d_first} THEN {fy} ELSE {ly} END AS ty, "
            f"CASE WHEN {d_last} < {d_first} THEN {fx} ELSE {lx} END AS tx, "
            f"n + CASE WHEN least({d_first}, {d_last}) < 5 THEN 3 ELSE 4 END AS n FROM r{j - 1})"
        )
    end = RELATION_PARTS - 1
    return f"WITH {', '.join(steps)} SELECT c_custkey AS id, n AS n_points, {Q.rnd('ty', 4)} AS end_lat, {Q.rnd('tx', 4)} AS end_lng FROM r{end}"


@query("relation_points", _relation_sql())
def relation_points(t):
    rows = t.customer.select("c_custkey", relation_members().alias("members"))
    lines = rows.select("c_custkey", geo.element_lines(F.lit("relation"), F.lit(None), F.col("members")).alias("lines"))
    line = geo.with_joined_lines(lines, "lines", "p")
    end = F.element_at("p", -1)
    return line.select(
        F.col("c_custkey").alias("id"), F.size("p").alias("n_points"),
        py_round(end["lat"], 4).alias("end_lat"), py_round(end["lng"], 4).alias("end_lng"),
    )


# ---- matching ---------------------------------------------------------------------


def features(t) -> DataFrame:
    """The feature table, landed once per query as a job would find it."""
    return cut_lineage(MT.read_features(elements(t.f_ways)))


@query(
    "radius_candidates",
    f"WITH {VERTICES}, {PAIRS} SELECT trail_id, osm_type, osm_id, {Q.rnd('dist_m', 2)} AS dist_m FROM pr",
)
def radius_candidates(t):
    pairs = MT.radius_candidates(t.f_trailheads, MT.candidate_features(features(t)), digits=2)
    return pairs.select("trail_id", "osm_type", "osm_id", "dist_m")


SCORED = f"""
sc0 AS (SELECT pr.*, ln.m / 1609.344 AS mi, w.osm_name, w.highway, w.sac_scale, {Q.name_norm('pr.name')} AS a, {Q.name_norm('w.osm_name')} AS b
  FROM pr JOIN ln ON ln.type = pr.osm_type AND ln.id = pr.osm_id JOIN {{f_ways}} w ON w.type = pr.osm_type AND w.id = pr.osm_id),
sc AS (SELECT *, CASE WHEN dist_m <= 800 THEN 1 WHEN dist_m <= 1200 THEN 2 WHEN dist_m <= 1800 THEN 3 ELSE 4 END AS tier,
  0.5::DOUBLE * CASE WHEN osm_name IS NULL THEN 0.1::DOUBLE WHEN greatest(length(a), length(b)) = 0 THEN 1.0::DOUBLE
      ELSE 1.0::DOUBLE - levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE END
  + 0.2::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - least(1.0::DOUBLE, dist_m / 800.0::DOUBLE))
  + 0.15::DOUBLE * CASE WHEN distance_mi <> 0 AND mi > 0 THEN least(mi, distance_mi) / greatest(mi, distance_mi) ELSE 0.0::DOUBLE END
  + CASE WHEN osm_type = 'relation' THEN 0.2::DOUBLE ELSE 0.05::DOUBLE END
  + CASE WHEN highway IN ('path', 'track', 'footway', 'bridleway') THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
  + CASE WHEN sac_scale <> '' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS score FROM sc0)"""


@query(
    "candidate_scores",
    f"WITH {VERTICES}, {LENGTHS}, {PAIRS}, {SCORED} SELECT trail_id, osm_type, osm_id, {Q.rnd('score', 6)} AS score FROM sc",
)
def candidate_scores(t):
    candidates = MT.candidate_features(features(t))
    scored = MT.score_candidates(MT.candidate_pairs(t.f_trailheads, candidates), method="levenshtein")
    return scored.select("trail_id", "osm_type", "osm_id", quick_round(F.col("score"), 6).alias("score"))


def best_sql(stop: float) -> str:
    return f"""WITH {VERTICES}, {LENGTHS}, {PAIRS}, {SCORED},
st AS (SELECT trail_id, coalesce(min(tier) FILTER (score >= {stop}), 4) AS last FROM sc GROUP BY trail_id),
rk AS (SELECT sc.*, row_number() OVER (PARTITION BY sc.trail_id ORDER BY score DESC, tier, osm_type DESC, osm_id) AS n
  FROM sc JOIN st ON st.trail_id = sc.trail_id WHERE tier <= last)
SELECT t.trail_id, rk.osm_type, rk.osm_id, rk.tier, CASE WHEN t.lat IS NULL THEN NULL WHEN rk.score IS NULL THEN 0.0::DOUBLE ELSE {Q.rnd('least(1.0::DOUBLE, rk.score)', 3)} END AS match_confidence
FROM {{f_trailheads}} t LEFT JOIN (SELECT * FROM rk WHERE n = 1) rk ON rk.trail_id = t.trail_id"""


def best(t, stop: float, method: str) -> DataFrame:
    found = MT.match_trails(t.f_trailheads, MT.candidate_features(features(t)), method, stop)
    all_trails = t.f_trailheads.select("trail_id", "lat").join(found, "trail_id", "left")
    confidence = F.when(F.col("lat").isNotNull(), F.coalesce("match_confidence", F.lit(0.0)))
    return all_trails.select("trail_id", "osm_type", "osm_id", F.col("tier"), confidence.alias("match_confidence"))


@query("match_best", best_sql(0.72))
def match_best(t):
    return best(t, V.STOP_SCORE, "levenshtein")


@query("match_best_low_stop", best_sql(0.40))
def match_best_low_stop(t):
    return best(t, 0.40, "levenshtein")


@query("match_name_ratio")
def match_name_ratio(t):
    return best(t, V.STOP_SCORE, "blocks")


@query(
    "surface_mix",
    f"""WITH {VERTICES}, {LENGTHS},
l AS (SELECT w.id % 40 AS trail_id, {Q.lookup('lower(trim(w.surface))', V.SURFACE_TAG_LABELS)} AS label, w.id AS part_no, ln.m FROM {{f_ways}} w JOIN ln ON ln.id = w.id),
s AS (SELECT trail_id, label, sum(m) AS m, min(part_no) AS seen FROM l WHERE label IS NOT NULL AND m > 0 GROUP BY trail_id, label),
f AS (SELECT *, m / sum(m) OVER (PARTITION BY trail_id) AS share FROM s)
SELECT trail_id, arg_max(label, m) AS surface_primary,
  '{{' || string_agg('"' || label || '": ' || regexp_replace(printf('%.2f', share), '(\\.[0-9])0$', '\\1'), ', ' ORDER BY m DESC, seen) || '}}' AS surface_breakdown
FROM f GROUP BY trail_id""",
)
def surface_mix(t):
    f = features(t)
    ways = f.select(
        (F.col("osm_id") % 40).alias("trail_id"), F.col("osm_id").alias("part_no"),
        F.try_element_at("tags", F.lit("surface")).alias("surface_tag"), geo.path_length_m(F.col("points")).alias("length_m"),
    )
    return MT.surface_mix(ways)


STITCHED = f"""
ends AS (SELECT vx.id AS osm_id, e.flip, e.i AS near_i, e.j AS after_i, e.k AS far_i FROM (SELECT DISTINCT id, n, type FROM vx) vx,
  LATERAL (SELECT FALSE AS flip, 0 AS i, 1 AS j, n - 1 AS k UNION ALL SELECT TRUE, n - 1, n - 2, 0) e WHERE vx.type = 'way' AND n >= 2),
placed AS (SELECT e.osm_id, e.flip, a.lat, a.lng, f.lat AS far_lat, f.lng AS far_lng, b.lat AS after_lat, b.lng AS after_lng, ln.m
  FROM ends e JOIN vx a ON a.type = 'way' AND a.id = e.osm_id AND a.i = e.near_i JOIN vx b ON b.type = 'way' AND b.id = e.osm_id AND b.i = e.after_i
  JOIN vx f ON f.type = 'way' AND f.id = e.osm_id AND f.i = e.far_i JOIN ln ON ln.type = 'way' AND ln.id = e.osm_id),
links AS (SELECT x.osm_id AS from_id, x.flip AS from_flip, y.osm_id, y.flip, d, d < {V.JOINT_TOLERANCE_M} AS drop_first,
    CASE WHEN d < {V.JOINT_TOLERANCE_M} THEN to_after + y.m - first_m ELSE d + y.m END AS added
  FROM placed x JOIN placed y ON x.osm_id <> y.osm_id AND abs(x.far_lat - y.lat) < 0.002 AND abs(x.far_lng - y.lng) < 0.002,
  LATERAL (SELECT {Q.hav('x.far_lat', 'x.far_lng', 'y.lat', 'y.lng')} AS d, {Q.hav('x.far_lat', 'x.far_lng', 'y.after_lat', 'y.after_lng')} AS to_after,
    {Q.hav('y.lat', 'y.lng', 'y.after_lat', 'y.after_lng')} AS first_m) m WHERE d < {V.STITCH_GAP_M}),
joints AS (SELECT t.trail_id, p.osm_id, p.flip, p.m, {Q.hav('t.lat', 't.lng', 'p.lat', 'p.lng')} AS head_m, {Q.hav('t.lat', 't.lng', 'p.far_lat', 'p.far_lng')} AS other_m,
    coalesce(CASE WHEN t.distance_mi <> 0 THEN t.distance_mi END, {V.STITCH_DEFAULT_MILES}::DOUBLE) * {V.METRES_PER_MILE} AS target_m
  FROM pr JOIN placed p ON pr.osm_type = 'way' AND p.osm_id = pr.osm_id JOIN {{f_trailheads}} t ON t.trail_id = pr.trail_id),
seed AS (SELECT trail_id, arg_min({{'osm_id': osm_id, 'flip': flip, 'm': m, 'target_m': target_m}}, {{'a': head_m, 'b': osm_id, 'c': flip}}) AS s FROM joints GROUP BY trail_id),
grown AS (SELECT trail_id, 0 AS part_no, s.osm_id AS osm_id, s.flip AS flip, FALSE AS drop_first, s.target_m AS target_m, s.m AS line_m, [s.osm_id] AS used FROM seed
  UNION ALL
  SELECT trail_id, part_no + 1, c.osm_id, c.flip, c.drop_first, target_m, line_m + c.added, list_append(used, c.osm_id)
  FROM (SELECT g.trail_id, g.part_no, g.target_m, g.line_m, g.used,
      arg_min({{'osm_id': l.osm_id, 'flip': l.flip, 'drop_first': l.drop_first, 'added': l.added}},
        {{'a': l.d, 'b': least(j.head_m, j.other_m), 'c': l.osm_id, 'd': l.flip}}) AS c
    FROM grown g JOIN links l ON l.from_id = g.osm_id AND l.from_flip = g.flip
      JOIN joints j ON j.trail_id = g.trail_id AND j.osm_id = l.osm_id AND j.flip = l.flip
    WHERE g.line_m < g.target_m * {V.STITCH_TARGET_SHARE} AND g.part_no < {V.STITCH_MAX_ROUNDS} AND NOT list_contains(g.used, l.osm_id)
    GROUP BY g.trail_id, g.part_no, g.target_m, g.line_m, g.used))"""


@query(
    "stitch_trailhead",
    f"""WITH RECURSIVE {VERTICES}, {LENGTHS}, {PAIRS}, {STITCHED}
SELECT g.trail_id, count(*) AS n_ways, CAST(sum(w.n - CAST(g.drop_first AS INT)) AS BIGINT) AS n_points, {Q.rnd('max(g.line_m)', 2)} AS length_m
FROM grown g JOIN {{f_ways}} w ON w.id = g.osm_id GROUP BY g.trail_id""",
)
def stitch_trailhead(t):
    candidates = MT.candidate_features(features(t))
    heads = t.f_trailheads.filter("lat IS NOT NULL")
    plan = stitch_trailheads(heads, candidates)
    lines = stitched_lines(plan, candidates)
    parts = plan.groupBy("trail_id").agg(F.count(F.lit(1)).alias("n_ways"))
    return lines.join(parts, "trail_id").select(
        "trail_id", "n_ways", F.size("points").cast("bigint").alias("n_points"), py_round(geo.path_length_m(F.col("points")), 2).alias("length_m")
    )


def chains(sql: str) -> str:
    """The same text over the ways laid in chains, some backwards, and their trailheads."""
    turned = "CASE WHEN back THEN n - 1 - i ELSE i END"
    vertices = VERTICES.replace("CAST(i * rise AS DOUBLE)", f"CAST(({turned}) * rise AS DOUBLE)").replace("CAST(i AS DOUBLE)", f"CAST({turned} AS DOUBLE)")
    return sql.replace(VERTICES, vertices).replace("{f_ways}", "{f_chain_ways}").replace("{f_trailheads}", "{f_chain_heads}")


@query(
    "stitch_chains",
    chains(f"""WITH RECURSIVE {VERTICES}, {LENGTHS}, {PAIRS}, {STITCHED}
SELECT trail_id, part_no, osm_id, flip, drop_first AS drop FROM grown"""),
)
def stitch_chains(t):
    """Every way of every line, with the end it is joined at and whether its first point is left away."""
    candidates = MT.candidate_features(cut_lineage(MT.read_features(elements(t.f_chain_ways))))
    return stitch_trailheads(t.f_chain_heads.filter("lat IS NOT NULL"), candidates)


ENRICHED = f"""WITH RECURSIVE {VERTICES}, {LENGTHS}, {PAIRS}, {SCORED}, {STITCHED},
st AS (SELECT trail_id, coalesce(min(tier) FILTER (score >= {V.STOP_SCORE}), 4) AS last FROM sc GROUP BY trail_id),
rk AS (SELECT sc.*, row_number() OVER (PARTITION BY sc.trail_id ORDER BY score DESC, tier, osm_type DESC, osm_id) AS rank_no
  FROM sc JOIN st ON st.trail_id = sc.trail_id WHERE tier <= last),
won AS (SELECT rk.trail_id, rk.osm_type, rk.osm_id, rk.score, ln.m, t.distance_mi, rk.osm_type = 'way' AND rk.distance_mi <> 0 AND ln.m / {V.METRES_PER_MILE} < rk.distance_mi * {V.STITCH_RATIO} AS short
  FROM rk JOIN ln ON ln.type = rk.osm_type AND ln.id = rk.osm_id JOIN {{f_trailheads}} t ON t.trail_id = rk.trail_id WHERE rank_no = 1),
line AS (SELECT trail_id, max(line_m) AS line_m FROM grown GROUP BY trail_id),
kept AS (SELECT won.*, coalesce(short AND line.line_m > won.m + 0.000001::DOUBLE, FALSE) AS longer, line.line_m FROM won LEFT JOIN line ON line.trail_id = won.trail_id),
part AS (SELECT trail_id, 0 AS part_no, osm_id, m FROM kept WHERE NOT longer
  UNION ALL SELECT g.trail_id, g.part_no, g.osm_id, ln.m FROM grown g JOIN kept ON kept.trail_id = g.trail_id AND longer JOIN ln ON ln.type = 'way' AND ln.id = g.osm_id),
lab AS (SELECT trail_id, {Q.lookup('lower(trim(w.surface))', V.SURFACE_TAG_LABELS)} AS label, part_no, part.m FROM part JOIN {{f_ways}} w ON w.id = part.osm_id),
mix AS (SELECT trail_id, label, sum(m) AS m, min(part_no) AS seen FROM lab WHERE label IS NOT NULL AND m > 0 GROUP BY trail_id, label)
SELECT 'wta_' || CAST(t.trail_id AS VARCHAR) AS id, kept.osm_id, CASE WHEN longer THEN 'stitched' ELSE kept.osm_type END AS osm_type, w.osm_name,
  CASE WHEN kept.score IS NULL THEN 0.0::DOUBLE ELSE {Q.rnd('least(1.0::DOUBLE, kept.score)', 3)} END AS match_confidence,
  {Q.rnd(f'CASE WHEN longer THEN kept.line_m ELSE kept.m END / {V.METRES_PER_MILE}', 2)} AS osm_distance_mi,
  (SELECT arg_max(label, {{'m': mix.m, 's': -seen}}) FROM mix WHERE mix.trail_id = t.trail_id) AS surface_primary,
  (SELECT '{{' || string_agg('"' || label || '": ' || regexp_replace(printf('%.2f', mix.m / total.m), '(\\.[0-9])0$', '\\1'), ', ' ORDER BY mix.m DESC, seen) || '}}'
    FROM mix, (SELECT trail_id, sum(m) AS m FROM mix GROUP BY trail_id) total WHERE mix.trail_id = t.trail_id AND total.trail_id = t.trail_id) AS surface_breakdown
FROM {{f_trailheads}} t LEFT JOIN kept ON kept.trail_id = t.trail_id LEFT JOIN {{f_ways}} w ON w.id = kept.osm_id WHERE t.lat IS NOT NULL"""


def enriched(ways: DataFrame, heads: DataFrame) -> DataFrame:
    trails = heads.select(
        F.concat(F.lit("wta_"), F.col("trail_id").cast("string")).alias("id"), "name",
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude"), F.col("distance_mi").alias("distance"),
    )
    made = enrich_trails(trails, cut_lineage(MT.read_features(elements(ways))), method="levenshtein", store_polyline=False)
    return made.select("id", "osm_id", "osm_type", "osm_name", "match_confidence", "osm_distance_mi", "surface_primary", "surface_breakdown")


@query("enrich_ways", ENRICHED)
def enrich_ways(t):
    """The same job over ways and relations far apart."""
    return enriched(t.f_ways, t.f_trailheads)


@query("enrich_chains", chains(ENRICHED))
def enrich_chains(t):
    """The whole enrichment job where most matched ways are too short, so that stitching, its acceptance and the mixed surfaces decide."""
    return enriched(t.f_chain_ways, t.f_chain_heads)


@query(
    "enrich_assembly",
    """
SELECT id, name, CASE WHEN osm_distance_mi IS NOT NULL THEN k END AS osm_id, CASE WHEN osm_distance_mi IS NOT NULL THEN 'way' END AS osm_type,
  CASE WHEN osm_distance_mi IS NOT NULL THEN 0.5::DOUBLE END AS match_confidence FROM {f_trails}
""",
)
def enrich_assembly(t):
    enriched = t.f_trails.filter("osm_distance_mi IS NOT NULL").select(
        "id", F.col("k").alias("osm_id"), F.lit("way").alias("osm_type"), F.lit(0.5).alias("match_confidence")
    )
    return attach_enrichment(t.f_trails.select("id", "name"), enriched)


@query("enrich_trails")
def enrich_job(t):
    """The whole enrichment job over the derived trailheads and features, a row per trail; heights follow the latitude."""
    f = features(t)
    points = f.select(F.explode("points").alias("p")).select("p.*").distinct()
    heights = points.withColumn("elevation_m", F.floor(F.col("lat") * 1000.0) % 300 + F.lit(500.0))
    trails = t.f_trailheads.select(
        F.concat(F.lit("wta_"), F.col("trail_id").cast("string")).alias("id"), "name",
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude"), F.col("distance_mi").alias("distance"),
    )
    return enrich_all(trails, f, heights)
