import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from switchback import schemas as S
from switchback.functions import geo
from switchback.functions.text import normalize_name
from switchback.operators import matching as MT
from switchback.operators.stitching import stitch_trailheads, stitched_lines
from switchback.plans.enrich import enrich_trails
from tests.test_tracks import metres

HIGHWAYS = ["path", "footway", "track", "bridleway", "primary", "cycletrack"]
NAMES = [None, "Trail", "Lake Loop Trail", "lake loop", "Ridge", "Old Ridge Trail", "Summit Path"]


def length(points):
    return sum(metres(p, q) for p, q in zip(points, points[1:]))


def crowd(spark, seed=3, n_trails=40, n_features=160):
    """Many features around few places, some of them copies."""
    rng = random.Random(seed)
    features = []
    for i in range(n_features):
        at = (46.5 + rng.uniform(0, 0.05), -121.5 + rng.uniform(0, 0.05))
        line = [at]
        for _ in range(rng.randint(1, 5)):
            line.append((line[-1][0] + rng.uniform(-0.004, 0.004), line[-1][1] + rng.uniform(-0.004, 0.004)))
        tags = {"highway": rng.choice(HIGHWAYS)}
        if rng.random() < 0.7 and (name := rng.choice(NAMES)):
            tags["name"] = name
        if rng.random() < 0.2:
            tags["access"] = rng.choice(["private", "yes"])
        if rng.random() < 0.3:
            tags["sac_scale"] = "hiking"
        kind = "relation" if rng.random() < 0.15 else "way"
        if kind == "relation" and rng.random() < 0.8:
            tags["route"] = "hiking"
        features.append((kind, i, tags, line))
        if rng.random() < 0.2:
            features.append((kind, 1000 + i, tags, line))
    trails = [
        (f"t{i}", rng.choice([n for n in NAMES if n]), 46.5 + rng.uniform(0, 0.06), -121.5 + rng.uniform(0, 0.06), rng.choice([None, 0.0, 0.4, 2.5, 6.0]))
        for i in range(n_trails)
    ]
    trails += [(f"copy{i}", *trails[0][1:]) for i in range(5)] + [("nowhere", "X", None, -121.5, 1.0)]
    rows = [(k, i, tags, [{"lat": a, "lng": b} for a, b in line], None) for k, i, tags, line in features]
    schema = f"osm_type string, osm_id bigint, tags map<string,string>, points {geo.POINTS}, members {geo.MEMBERS}"
    return (
        trails, features,
        spark.createDataFrame(trails, "trail_id string, name string, lat double, lng double, distance_mi double"),
        spark.createDataFrame(rows, schema),
    )


def eligible(kind, tags):
    if kind == "relation":
        return tags.get("route") == "hiking"
    h = tags["highway"]
    return (any(w in h for w in ("path", "footway", "track")) or h == "bridleway") and tags.get("access") != "private"


def best_by_widening(trail, features, names, stop):
    _, name, lat, lng, miles = trail
    best, chosen = -1.0, None
    for radius in (800, 1200, 1800, 2600):
        # ways before relations, then by id: ties keep the first
        for kind, i, tags, line in sorted(features, key=lambda f: (f[0] != "way", f[1])):
            near = min(metres((lat, lng), p) for p in line)
            if near > radius or not eligible(kind, tags):
                continue
            label = tags.get("name")
            same = SequenceMatcher(None, names[name], names[label]).ratio() if label else 0.1
            own = length(line) / 1609.344
            agree = min(own, miles) / max(own, miles) if miles and own else 0.0
            score = 0.5 * same + 0.2 * max(0.0, 1 - min(1.0, near / 800)) + 0.15 * agree
            score += 0.2 if kind == "relation" else 0.05
            score += 0.1 if tags["highway"] in HIGHWAYS[:4] else 0.0
            score += 0.05 if tags.get("sac_scale") else 0.0
            if score > best + 1e-12:
                best, chosen = score, (kind, i)
        if best >= stop:
            break
    return chosen, best


@pytest.mark.parametrize("stop", [0.72, 0.45])
def test_match_equals_widening_search(spark, stop):
    trails, features, trail_df, feature_df = crowd(spark)
    names = {r["c"]: r["n"] for r in spark.createDataFrame([(n,) for n in NAMES if n], "c string").select("c", normalize_name(F.col("c")).alias("n")).collect()}
    got = {r["trail_id"]: r for r in MT.match_trails(trail_df, MT.candidate_features(feature_df), stop=stop).collect()}
    for trail in trails:
        if trail[2] is None:
            assert trail[0] not in got
            continue
        chosen, score = best_by_widening(trail, features, names, stop)
        if chosen is None:
            assert trail[0] not in got
        else:
            r = got[trail[0]]
            assert (r["osm_type"], r["osm_id"]) == chosen, trail
            assert math.isclose(r["score"], score, abs_tol=1e-9)


def test_radius_join_is_an_equi_join(spark):
    _, _, trails, features = crowd(spark)
    pairs = MT.radius_candidates(trails, MT.candidate_features(features))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_radius_join_at_the_date_line_and_far_north(spark):
    trails = [("a", "A", 10.0, 179.999, None), ("b", "B", 84.0, 20.0, None), ("c", "C", -33.0, -179.9995, None)]
    lines = [("way", 1, 10.0, -179.995), ("way", 2, 84.0, 20.2), ("way", 3, -33.001, 179.999), ("way", 4, 84.02, 19.9), ("way", 5, 10.0, 179.9)]
    df = spark.createDataFrame(trails, "trail_id string, name string, lat double, lng double, distance_mi double")
    rows = [(k, i, {"highway": "path"}, [{"lat": a, "lng": b}], None) for k, i, a, b in lines]
    features = spark.createDataFrame(rows, f"osm_type string, osm_id bigint, tags map<string,string>, points {geo.POINTS}, members {geo.MEMBERS}")
    got = {(r["trail_id"], r["osm_id"]) for r in MT.radius_candidates(df, MT.candidate_features(features)).collect()}
    want = {(t[0], f[1]) for t in trails for f in lines if metres((t[2], t[3]), (f[2], f[3])) <= 2600}
    assert got == want and len(want) == 4


def greedy_line(trail, ways):
    _, _, lat, lng, miles = trail
    head = (lat, lng)
    near = [(i, line) for i, line in ways if len(line) >= 2 and min(metres(head, p) for p in line) <= 2600]
    if not near:
        return None
    end = lambda line: min(metres(head, line[0]), metres(head, line[-1]))
    near.sort(key=lambda w: (end(w[1]), w[0]))
    first, line = near[0]
    line = line[::-1] if metres(head, line[-1]) < metres(head, line[0]) else list(line)
    used, target = [first], (miles or 5.0) * 1609.344
    for _ in range(50):
        if length(line) >= 0.9 * target:
            break
        pick, gap = None, 80.0
        for i, w in near:
            d = min(metres(line[-1], w[0]), metres(line[-1], w[-1]))
            if i not in used and d < gap:
                gap, pick = d, (i, w[::-1] if metres(line[-1], w[-1]) < metres(line[-1], w[0]) else list(w))
        if pick is None:
            break
        used.append(pick[0])
        line += pick[1][1:] if metres(line[-1], pick[1][0]) < 5 else pick[1]
    return used, line


def chains(rng):
    """Ways that meet end to end near a few trailheads, laid either way round, with copies and small gaps."""
    ways, trails = [], []
    for t in range(6):
        at = (46.0 + t * 0.1, -121.0)
        trails.append((f"t{t}", "T", at[0] + 0.0005, at[1], rng.choice([None, 0.5, 2.0])))
        for k in range(9):
            line = [at]
            for _ in range(rng.randint(1, 3)):
                line.append((line[-1][0] + rng.uniform(0.0005, 0.0012), line[-1][1] + rng.uniform(-0.001, 0.001)))
            ways.append((100 * t + k, line[::-1] if rng.random() < 0.5 else line))
            if rng.random() < 0.2:
                ways.append((100 * t + 50 + k, line))
            at = (line[-1][0] + rng.choice([0, 0.00001, 0.0004, 0.0012]), line[-1][1])
    return trails, ways


def test_stitching_equals_greedy_walk(spark):
    trails, ways = chains(random.Random(11))
    df = spark.createDataFrame(trails, "trail_id string, name string, lat double, lng double, distance_mi double")
    rows = [("way", i, {"highway": "path"}, [{"lat": a, "lng": b} for a, b in line], None) for i, line in ways]
    features = spark.createDataFrame(rows, f"osm_type string, osm_id bigint, tags map<string,string>, points {geo.POINTS}, members {geo.MEMBERS}")
    candidates = MT.candidate_features(features)
    plan = stitch_trailheads(df, candidates)
    used = {}
    for r in plan.orderBy("trail_id", "part_no").collect():
        used.setdefault(r["trail_id"], []).append(r["osm_id"])
    lines = {r["trail_id"]: [(p["lat"], p["lng"]) for p in r["points"]] for r in stitched_lines(plan, candidates).collect()}
    for trail in trails:
        want_used, want_line = greedy_line(trail, ways)
        assert used[trail[0]] == want_used
        assert lines[trail[0]] == want_line
    assert max(len(u) for u in used.values()) > 3


def test_relation_lines(spark):
    line = lambda *lats: [{"lat": x, "lon": 1.0} for x in lats]
    member = lambda kind, pts: {"type": kind, "ref": 1, "role": "", "tags": {}, "geometry": pts}
    elements = [
        ("relation", 1, None, None, [member("way", line(1.0, 1.1)), member("node", line(9.0)), member("way", line(1.2, 1.1)), member("way", line(1.3, 1.4))]),
        ("relation", 2, None, None, []),
        ("way", 3, {"name": "W"}, [{"lat": 1.0, "lon": 2.0}, {"lat": None, "lon": 2.0}, {"lat": 3.0, "lon": 4.0}], None),
        ("way", 4, None, None, None),
    ]
    got = {r["osm_id"]: [(p["lat"], p["lng"]) for p in r["points"]] for r in MT.read_features(spark.createDataFrame(elements, S.MAP_ELEMENT)).collect()}
    assert got == {1: [(1.0, 1.0), (1.1, 1.0), (1.2, 1.0), (1.3, 1.0), (1.4, 1.0)], 2: [], 3: [(1.0, 2.0), (3.0, 4.0)], 4: []}


def test_surface_mix(spark):
    rows = [("a", 0, "gravel", 60.0), ("a", 1, " Dirt", 40.0), ("a", 2, "unknown", 500.0), ("b", 0, None, 5.0), ("c", 0, "mud", 1.0), ("d", 0, "mud", 1.0), ("d", 1, "sand", 2.0)]
    df = spark.createDataFrame(rows, "trail_id string, part_no int, surface_tag string, length_m double")
    got = {r["trail_id"]: (r["surface_primary"], r["surface_breakdown"]) for r in MT.surface_mix(df).collect()}
    assert got == {
        "a": ("Gravel", '{"Gravel": 0.6, "Dirt/Soil": 0.4}'), "c": ("Mud", '{"Mud": 1.0}'), "d": ("Sand", '{"Sand": 0.67, "Mud": 0.33}'),
    }


def test_enrichment_states(spark):
    """Not attempted, nothing found, way, relation with tagged members, stitched."""
    path = lambda lat, n: [{"lat": lat + i * 0.001, "lon": -121.0} for i in range(n)]
    member = {"type": "way", "ref": 9, "role": "", "tags": {"surface": "gravel"}, "geometry": path(48.0, 30)}
    elements = [
        ("way", 1, {"highway": "path", "name": "Alpha", "surface": "dirt"}, path(46.0, 20), None),
        ("relation", 2, {"route": "hiking", "name": "Beta"}, None, [member]),
        ("way", 3, {"highway": "path", "name": "Gamma"}, path(47.0, 2), None),
        ("way", 4, {"highway": "track", "surface": "sand"}, path(47.001, 12), None),
    ]
    features = MT.read_features(spark.createDataFrame(elements, S.MAP_ELEMENT))
    trails = [("1", "Alpha", 46.0, -121.0, 1.2), ("2", "Beta", 48.0, -121.0, 2.0), ("3", "Gamma", 47.0, -121.0, 0.8), ("4", "Delta", 10.0, 10.0, 1.0), ("5", "E", None, 1.0, 1.0)]
    df = spark.createDataFrame(trails, "id string, name string, latitude double, longitude double, distance double")
    heights = spark.createDataFrame([(46.0 + i * 0.001, -121.0, 100.0 + 5 * i) for i in range(20)], S.ELEVATION)
    got = {r["id"]: r for r in enrich_trails(df, features, heights).collect()}
    assert "5" not in got
    assert got["4"]["match_confidence"] == 0.0 and got["4"]["osm_id"] is None
    assert (got["1"]["osm_type"], got["1"]["surface_primary"], got["1"]["max_grade_p95"]) == ("way", "Dirt/Soil", 4.5)
    assert got["1"]["derived_gain_ft"] == round(95 * 3.28084) and got["1"]["geometry_polyline"].startswith("_")
    assert (got["2"]["osm_type"], got["2"]["surface_breakdown"], got["2"]["max_grade_p95"]) == ("relation", '{"Gravel": 1.0}', None)
    assert (got["3"]["osm_type"], got["3"]["osm_id"], got["3"]["surface_primary"]) == ("stitched", 3, "Sand")
    assert got["3"]["osm_distance_mi"] == round(metres((47.0, -121.0), (47.012, -121.0)) / 1609.344, 2)


def test_parts_of_crowded_cells_lose_no_pair(spark):
    r = random.Random(21)
    places = [(46.5, -121.5), (0.0, 0.0), (-33.3, 179.999), (60.0, -180.0), (89.97, 10.0), (-89.99, -170.0)]
    at = lambda p, s: (max(-90.0, min(90.0, p[0] + r.uniform(-s, s))), (p[1] + r.uniform(-s, s) * 3 + 180) % 360 - 180)
    heads = [(f"t{i}", "n", *at(places[i % 6], 0.03), 1.0) for i in range(120)]
    ways = [("way", i, [at(places[i % 6], 0.04) for _ in range(3)]) for i in range(400)]
    trails = spark.createDataFrame(heads, "trail_id string, name string, lat double, lng double, distance_mi double")
    features = spark.createDataFrame([(k, i, [{"lat": a, "lng": b} for a, b in p]) for k, i, p in ways], f"osm_type string, osm_id bigint, points {geo.POINTS}")
    want = {}
    for t, _, lat, lng, _ in heads:
        for _, i, points in ways:
            d = min(metres((lat, lng), p) for p in points)
            if d <= 2600:
                want[t, i] = d
    for crowd in (1, 5, 40, 10**6):
        found = {(x["trail_id"], x["osm_id"]): x["dist_m"] for x in MT.radius_candidates(trails, features, 2600, crowd).collect()}
        assert found.keys() == want.keys() and all(abs(found[k] - d) < 1e-6 for k, d in want.items()), crowd


def test_one_crowded_cell_is_dealt_to_many_tasks(spark):
    points = spark.range(40_000).select(F.lit("way").alias("osm_type"), F.col("id").alias("osm_id"), F.array(F.struct((F.rand(1) / 100 + 46.5).alias("lat"), (F.rand(2) / 100 - 121.5).alias("lng"))).alias("points"))
    vertices = geo.with_cell(points.select("osm_id", F.col("points")[0]["lat"].alias("lat"), F.col("points")[0]["lng"].alias("lng")), F.col("lat"), F.col("lng"), 2600)
    parts = geo.with_subcell(vertices, F.col("lat"), F.col("lng"), 2600, F.lit(4)).groupBy("gy", "gx", "sy", "sx").count()
    assert parts.count() >= 40 and parts.agg(F.max("count")).first()[0] < 4000
    plan = MT.radius_candidates(spark.createDataFrame([("t", "n", 46.505, -121.495, 1.0)], "trail_id string, name string, lat double, lng double, distance_mi double"), points, 2600, 500)
    assert plan.count() == points.count()  # all lie within the radius


def test_a_round_of_growth_moves_the_lines_only(spark):
    from switchback.operators import stitching as ST
    from switchback.session import drop_tables, land_bucketed

    links = land_bucketed(spark.createDataFrame([(1, 5, False, 6, True, 3.0, True, 9.0, 2.0)], "trail_id long, from_id long, from_flip boolean, osm_id long, flip boolean, d double, drop boolean, added_m double, end_m double"), ST._AT)
    lines = spark.createDataFrame([(1, 5, False, 50.0, [(5, False, False)], 4.0, True)], f"trail_id long, from_id long, from_flip boolean, target_m double, plan {ST._STEP}, line_m double, open boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grown = ST._grow(lines, links)
        assert [s["osm_id"] for s in grown.first()["plan"]] == [5, 6] and grown.first()["line_m"] == 13.0
        plan = grown._jdf.queryExecution().optimizedPlan().toString()
        physical = grown._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in physical.splitlines() if "Bucketed: true" in line]
        assert "Relation spark_catalog" in plan and scan, physical
        above = physical[: physical.index(scan[0])].splitlines()
        assert not any("Exchange" in line and "hashpartitioning(from_id" in line for line in above[-3:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_tables(links)


def copies(spark, n, miles):
    """``n`` ways on each of two lines, the second going on from the first, and a trail per distance at one place."""
    lines = [[(46.0, -121.0), (46.001, -121.0)], [(46.001, -121.0), (46.0015, -121.0005), (46.002, -121.0)]]
    ways = [(2 * i + k, line) for i in range(n) for k, line in enumerate(lines)]
    trails = [(f"t{i}", f"n{i}", 45.9995, -121.0, m) for i, m in enumerate(miles)]
    rows = [("way", i, {"highway": "path", "name": f"w{i}"}, [{"lat": a, "lng": b} for a, b in line], None) for i, line in ways]
    features = spark.createDataFrame(rows, f"osm_type string, osm_id bigint, tags map<string,string>, points {geo.POINTS}, members {geo.MEMBERS}")
    df = spark.createDataFrame(trails, "trail_id string, name string, lat double, lng double, distance_mi double")
    return trails, ways, df, MT.candidate_features(features)


def test_copies_of_places_and_lines_are_measured_once(spark):
    trails, ways, df, candidates = copies(spark, 30, [1.0 + i for i in range(40)])
    assert MT.reached_shapes(df, MT._feature_shapes(candidates)).count() == 2 * len(trails)
    pairs = MT.radius_candidates(df, candidates)
    assert pairs.distinct().count() == pairs.count() == len(trails) * len(ways)
    # a trail that comes with two places and a way with two lines are one pair, at the least distance
    two = df.limit(1).union(df.limit(1).withColumn("lat", F.lit(46.0))).union(df.limit(1))
    found = MT.radius_candidates(two, candidates.withColumn("osm_id", F.lit(7).cast("bigint"))).collect()
    assert len(found) == 1 and found[0]["dist_m"] == 0.0


def test_best_match_neither_sorts_nor_moves_pairs(spark, monkeypatch):
    _, _, df, candidates = copies(spark, 30, [1.0 + i for i in range(40)])
    made, landed = [], MT.cut_lineage
    monkeypatch.setattr(MT, "cut_lineage", lambda top: (made.append(top), landed(top))[1])
    for method in ("levenshtein", "blocks"):
        assert MT.match_trails(df, candidates, method).count() == 40
    for top in made:  # the scan of all pairs ends in a hash aggregate of each task
        ends = [x for x in top._jdf.queryExecution().executedPlan().toString().splitlines() if "max(score" in x]
        assert len(ends) == 2 and all("HashAggregate" in x for x in ends)


def test_copies_of_places_and_ways_are_walked_once(spark, monkeypatch):
    from switchback.operators import stitching as ST

    trails, ways, df, candidates = copies(spark, 60, [0.0, 0.05, 0.2, 0.7, 1.5, 40.0, None, 0.7])
    sizes, land = [], ST.land_bucketed
    monkeypatch.setattr(ST, "land_bucketed", lambda links, keys: (sizes.append(links.count()), land(links, keys))[1])
    used = {}
    for r in stitch_trailheads(df.union(df.limit(2)), candidates).orderBy("trail_id", "part_no").collect():
        used.setdefault(r["trail_id"], []).append(r["osm_id"])
    assert used == {t[0]: greedy_line(t, ways)[0] for t in trails}
    assert sizes[0] <= 16 and max(map(len, used.values())) == 51


def test_pairs_are_made_in_many_tasks(spark):
    _, _, df, candidates = copies(spark, 30, [1.0 + i for i in range(40)])
    pairs = MT.radius_candidates(df, candidates).withColumn("task", F.spark_partition_id())
    assert pairs.select("task").distinct().count() >= 8
