import math
import random

from pyspark.sql import functions as F

from switchback.operators import tracks as TR


def metres(p, q):
    (a, b), (c, d) = p, q
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(h))


def brute_thin(points, step, cap):
    if len(points) <= 2:
        return points
    kept, since = [points[0]], 0.0
    for before, here in zip(points, points[1:]):
        since += metres(before, here)
        if since >= step and len(kept) < cap:
            kept.append(here)
            since = 0.0
    if len(kept) < cap and kept[-1] != points[-1]:
        kept.append(points[-1])
    return kept


def tracks():
    rng = random.Random(7)
    lines = {"one": [(47.0, -121.0)], "two": [(47.0, -121.0)] * 2}
    for name, n, size in (("dense", 400, 0.00004), ("sparse", 300, 0.002), ("mixed", 350, None), ("still", 60, 0.0)):
        at, line = (47.0, -121.0), []
        for _ in range(n):
            reach = size if size is not None else rng.choice([0.00001, 0.0003, 0.004])
            at = (at[0] + rng.uniform(-reach, reach), at[1] + rng.uniform(-reach, reach))
            line.append(at)
        lines[name] = line
    return lines


def frame(spark, lines):
    rows = [(k, 3 * i + 1, lat, lng) for k, line in lines.items() for i, (lat, lng) in enumerate(line)]
    return spark.createDataFrame(rows, "feature_id string, pos bigint, lat double, lng double").repartition(5)


def test_length_across_blocks(spark):
    lines = tracks()
    for block in (7, 65536):
        got = {r["feature_id"]: r for r in TR.line_length(frame(spark, lines), block=block).collect()}
        for k, line in lines.items():
            want = sum(metres(p, q) for p, q in zip(line, line[1:]))
            assert math.isclose(got[k]["length_m"], want, rel_tol=1e-9, abs_tol=1e-9)
            assert got[k]["n_points"] == len(line)


def test_resample_equals_walk(spark):
    lines = tracks()
    for step, cap, block in ((45.0, 220, 65536), (45.0, 12, 16), (20.0, 5, 10), (300.0, 40, 30)):
        out = TR.resample(frame(spark, lines), step, cap, block=block).collect()
        got = {r["feature_id"]: [(p["lat"], p["lng"]) for p in r["samples"]] for r in out}
        assert got == {k: brute_thin(line, step, cap) for k, line in lines.items()}


def test_resample_reads_only_what_the_walk_reaches(spark):
    line = {"long": [(40.0 + i * 0.001, -121.0) for i in range(3000)]}
    row = TR.resample(frame(spark, line), 45.0, 10, block=60).first()
    assert len(row["samples"]) == 10 and row["n_seen"] < 200


def test_polyline_sample(spark):
    points = [(0, 38.5, -120.2), (1, 40.7, -120.95), (2, 43.252, -126.453)]
    df = spark.createDataFrame([(1, 3, points)], "feature_id int, n_seen int, samples array<struct<pos:int,lat:double,lng:double>>")
    assert TR.encode_polylines(df).first()["geometry_polyline"] == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"


def test_lower_percentile(values, spark):
    rows = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(None,)], "v double")
    assert rows.agg(TR.lower_percentile(F.col("v"), 0.95)).first()[0] == 9.0
    assert rows.filter("v IS NULL").agg(TR.lower_percentile(F.col("v"), 0.95)).first()[0] is None


def grades(spark, line, heights):
    samples = TR.resample(frame(spark, {"t": line}), 45.0, 220)
    rows = [(lat, lng, h) for (lat, lng), h in zip(line, heights)]
    return TR.grade_features(samples, spark.createDataFrame(rows, "lat double, lng double, elevation_m double")).first()


def test_grade(spark):
    line = [(47.0 + i * 0.001, -121.0) for i in range(5)]
    flat = grades(spark, line, [100.0] * 5)
    assert (flat["max_grade_p95"], flat["derived_gain_ft"]) == (0.0, None)
    hilly = grades(spark, line, [100.0, 110.0, 105.0, 300.0, 300.0])
    # the step of 195 m is too steep to count as a grade, but counts as climb
    assert (hilly["max_grade_p95"], hilly["derived_gain_ft"]) == (4.5, round(205 * 3.28084))
    assert grades(spark, line, [100.0, None, 105.0, 300.0, 300.0])["max_grade_p95"] is None
    assert grades(spark, line[:2], [1.0, 20.0])["max_grade_p95"] is None


def test_a_feature_that_stands_still_stays_short(spark):
    still = spark.range(20_000).select(F.lit("s").alias("feature_id"), F.col("id").cast("int").alias("pos"), F.lit(46.0).alias("lat"), F.lit(-121.0).alias("lng"))
    moving = still.filter("pos < 4000").select(
        F.lit("m").alias("feature_id"), "pos", (F.col("lat") + F.floor(F.col("pos") / 1000) * 0.01).alias("lat"), "lng"
    )
    out = {r["feature_id"]: r for r in TR.resample(still.union(moving), 50.0, 10, block=500).collect()}
    assert out["s"]["n_seen"] == 20_000 and len(out["s"]["samples"]) == 1
    assert [p["pos"] for p in out["m"]["samples"]] == [0, 1000, 2000, 3000]
