"""Whole results: a row per trail, every pair, numbers as rounded one by one."""

import math
import random

from pyspark.sql import functions as F

from switchback import schemas as S
from switchback.functions.values import py_round, quick_round
from switchback.operators import matching as MT
from switchback.plans.enrich import enrich_all
from tests.test_matching import copies


def test_enrichment_has_a_row_per_trail(spark):
    elements = [("way", 1, {"highway": "path", "name": "Alpha"}, [{"lat": 46.0, "lon": -121.0}, {"lat": 46.01, "lon": -121.0}], None)]
    features = MT.read_features(spark.createDataFrame(elements, S.MAP_ELEMENT))
    trails = [("1", "Alpha", 46.0, -121.0, 1.0), ("2", "Far", 10.0, 10.0, 1.0), ("3", "E", None, 1.0, 1.0), ("4", "", 46.0, -121.0, 1.0), ("4", None, 46.0, -121.0, 1.0), (None, "N", None, 1.0, 1.0)]
    df = spark.createDataFrame(trails, "id string, name string, latitude double, longitude double, distance double")
    rows = enrich_all(df, features).collect()
    got = {r["id"]: (r["osm_id"], r["match_confidence"] is None) for r in rows}
    assert len(rows) == 5 and got == {"1": (1, False), "2": (None, False), "3": (None, True), "4": (None, True), None: (None, True)}


def test_quick_rounding_is_exact(spark):
    r = random.Random(8)
    given = [None, 0.0, -0.0, 0.5, 1.5, 2.675, 1.005, 0.125, -0.125, -0.001, 1e7 + 0.005, 123456789.125, 1e300, 2599.995, 0.0000005]
    given += [r.uniform(-3000, 3000) for _ in range(500)] + [round(r.uniform(0, 99), 2) + 0.005 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in given], "v double")
    for digits in (0, 2, 6):
        for x, y in df.select(py_round(F.col("v"), digits), quick_round(F.col("v"), digits)).collect():
            assert x == y and (x is None or math.copysign(1, x) == math.copysign(1, y))


def test_distances_are_rounded_before_pairs_are_made(spark):
    _, _, df, candidates = copies(spark, 30, [1.0 + i for i in range(4)])
    pairs = MT.radius_candidates(df, candidates, digits=2)
    want = MT.radius_candidates(df, candidates).withColumn("dist_m", py_round(F.col("dist_m"), 2))
    assert pairs.exceptAll(want).count() == want.exceptAll(pairs).count() == 0 and pairs.count() == 240
    lines = pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "format_number" not in lines[0] and any("format_number" in x for x in lines)
