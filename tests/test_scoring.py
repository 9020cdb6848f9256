import random

from pyspark.sql import functions as F
import statistics

import numpy as np

from switchback.operators import scoring as SC


def test_a_wide_column_takes_two_passes_and_a_wrong_sketch_only_more(spark, monkeypatch):
    rng = random.Random(6)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(4001)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    passes = []
    count = SC._count_buckets
    monkeypatch.setattr(SC, "_count_buckets", lambda *a: passes.append(1) or count(*a))
    assert SC.exact_medians(df, ["v"])["v"] == sorted(values)[2000] and len(passes) == 1  # beside the sketch's own
    monkeypatch.setattr(SC, "SKETCH_ACCURACY", 5)  # brackets from 0.1 to 0.9
    assert SC.exact_medians(df, ["v"], 64)["v"] == sorted(values)[2000]
    monkeypatch.setattr(SC.F, "percentile_approx", lambda c, p, a: F.array(F.max(c), F.max(c)))  # a sketch far off
    assert SC.exact_medians(df, ["v"])["v"] == sorted(values)[2000]


def test_exact_medians(spark):
    rng = random.Random(5)
    columns = {
        "even": [rng.gauss(0, 1e-9) for _ in range(400)],
        "heavy": [3.0] * 250 + [rng.random() for _ in range(150)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 6) for _ in range(400)],
        "gaps": [None if i % 2 else float(i * i) for i in range(400)],
        "none": [None] * 400,
        "close": [1.0 + i * 2.220446049250313e-16 for i in range(400)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    for buckets in (32, 1024):
        got = SC.exact_medians(df, list(columns), buckets)
        for c, values in columns.items():
            known = [v for v in values if v is not None]
            assert got[c] == (statistics.median(known) if known else None), c


def closed_form(x, y, alpha=1.0):
    for j in range(x.shape[1]):
        x[np.isnan(x[:, j]), j] = np.nanmedian(x[:, j])
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    return y.mean() + z @ w


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) * [100, 5, 0.1, 3] + [500, 8, 0.4, 6]
    x[:, 2] = 0.5
    y = rng.choice([0, 0.5, 1, 1.5, 2], 300)
    x[rng.random((300, 4)) < 0.1] = np.nan
    x[:, 2] = 0.5
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (float(t),) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in SC.FEATURES) + ", y double").repartition(4)
    model = SC.fit_ridge(df, "y")
    got = sorted(r[0] for r in df.select(model.predict()).collect())
    assert np.allclose(got, sorted(closed_form(x.copy(), y)), atol=1e-10)


def trails(spark, rows):
    return spark.createDataFrame(rows, "id int, distance double, elevation int, max_grade_p95 double, surface string, calculated_difficulty string")


def test_fallback_and_runnable(spark):
    df = trails(spark, [(1, 15.0, 15000, 20.0, "Gravel", None), (2, 0.0, None, None, None, "?")])
    got = {r["id"]: r["difficulty_score_0_10"] for r in SC.add_difficulty_score(df).collect()}
    assert got == {1: 9.2, 2: 0.5}
    pct = {r["id"]: r["trail_runnable_pct"] for r in SC.add_runnable_pct(df).collect()}
    assert pct == {1: 67.7, 2: 94.0}


def test_no_feature_values_leaves_the_mean(spark):
    df = trails(spark, [(1, None, None, None, None, "Easy"), (2, None, None, None, None, "Hard"), (3, 4.0, 100, None, None, None)])
    got = {r["id"]: r["difficulty_score_0_10"] for r in SC.add_difficulty_score(df).collect()}
    assert got[1] == got[2] == 5.0 and got[3] == 5.0
