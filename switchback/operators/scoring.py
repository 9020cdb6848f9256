"""Difficulty and runnability scores."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions.text import label_level, numeric, surface_penalty
from switchback.functions.values import np_round

FEATURES = ("gain_per_mile_ft", "max_grade_p95", "surface_penalty", "distance_mi")


def _first_known(df: DataFrame, *names: str) -> Column:
    return F.coalesce(*[numeric(F.col(n)) for n in names if n in df.columns], F.lit(None).cast("double"))


def score_features(df: DataFrame, penalty_default: float = V.DIFFICULTY_PENALTY_DEFAULT) -> DataFrame:
    """Inputs of both scores: page values first, map-derived values where the page has none.

    The surface comes from ``surface_primary`` whenever that column exists, row
    values notwithstanding, else from ``surface``.
    """
    miles = _first_known(df, "distance", "osm_distance_mi")
    surface = next((F.col(c) for c in ("surface_primary", "surface") if c in df.columns), F.lit(None).cast("string"))
    out = df.withColumns(
        {
            "distance_mi": F.when(miles > 0, miles),
            "gain_ft": _first_known(df, "elevation", "derived_gain_ft"),
            "max_grade_p95": _first_known(df, "max_grade_p95"),
            "surface_penalty": surface_penalty(surface, penalty_default),
        }
    )
    return out.withColumn("gain_per_mile_ft", F.col("gain_ft") / F.col("distance_mi"))


#: A quantile sketch of this accuracy is off by at most so many ranks in n: n / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000


def exact_medians(df: DataFrame, columns: list[str], buckets: int = 1024) -> dict[str, float | None]:
    """Exact medians (mean of the two middle values) without sorting or gathering the data.

    A quantile sketch gives a bracket that holds the middle ranks, of a few in
    ten thousand of the values, whatever their magnitudes. Every further pass
    counts the values of each column's bracket in equal buckets and narrows it
    to the bucket that holds the middle ranks; at most ``buckets`` rows per
    column return. Should the ranks lie outside of the bracket, it is widened to
    all values, so the sketch decides the number of passes only.
    """
    around = F.array(F.lit(0.5 - 2 / SKETCH_ACCURACY), F.lit(0.5 + 2 / SKETCH_ACCURACY))
    summary = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns],
        *[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"at_{c}") for c in columns],
    ).first()
    medians: dict[str, float | None] = {}
    brackets = {}  # column -> (low, high, values below or None where they are still to be counted, count)
    for c in columns:
        n, lo, hi = summary[f"n_{c}"], summary[f"lo_{c}"], summary[f"hi_{c}"]
        if n == 0:
            medians[c] = None
        elif lo == hi:
            medians[c] = float(lo)
        else:
            low, high = summary[f"at_{c}"]
            brackets[c] = (low, high, None, n)
    while brackets:
        for c, (cells, below, n) in _count_buckets(df, brackets, buckets).items():
            low_rank, high_rank = (n - 1) // 2, n // 2
            inside = sum(count for count, _, _ in cells)
            if not below <= low_rank <= high_rank < below + inside:
                brackets[c] = (summary[f"lo_{c}"], summary[f"hi_{c}"], 0, n)
                continue
            values = []
            for count, lo, hi in cells:
                for rank in (low_rank, high_rank):
                    if below <= rank < below + count:
                        # known exactly at the edges of a bucket
                        at_edge = lo if rank == below else hi if rank == below + count - 1 else None
                        values.append(lo if lo == hi else at_edge)
                        home = (lo, hi, below, n)
                below += count
            if None in values:
                brackets[c] = home
            else:
                medians[c] = (values[0] + values[1]) / 2.0
                del brackets[c]
    return medians


def _count_buckets(df: DataFrame, brackets: dict, buckets: int) -> dict:
    """Per column: ([(count, min, max) of each bucket in order], values below the bracket, count)."""
    entries = []
    for c, (lo, hi, below, _) in brackets.items():
        # halves, so that the width of a bracket cannot overflow
        width = hi / 2 - lo / 2
        place = (F.col(c) / 2 - F.lit(lo / 2)) / F.lit(width) * F.lit(float(buckets)) if width else F.lit(0.0)
        bucket = F.least(F.floor(place), F.lit(buckets - 1)).cast("int")
        entry = lambda b: F.struct(F.lit(c).alias("c"), b.alias("b"), F.col(c).alias("v"))  # noqa: B023, E731
        inside = F.when(F.col(c).between(F.lit(lo), F.lit(hi)), entry(bucket))
        entries.append(inside if below is not None else F.when(F.col(c) < F.lit(lo), entry(F.lit(-1))).otherwise(inside))
    long = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    counted = long.groupBy("c", "b").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    found = {c: ([], below or 0, n) for c, (_, _, below, n) in brackets.items()}
    for r in sorted(counted.collect(), key=lambda r: (r["c"], r["b"])):  # at most `buckets` rows per column
        if r["b"] < 0:
            found[r["c"]] = ([], r["n"], found[r["c"]][2])
        else:
            found[r["c"]][0].append((r["n"], r["lo"], r["hi"]))
    return found


@dataclass(frozen=True)
class RidgeModel:
    """``y = intercept + sum(weight * (x - mean) / scale)`` over imputed features."""

    features: tuple[str, ...]
    medians: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for f, median, mean, scale, weight in zip(self.features, self.medians, self.means, self.scales, self.weights):
            out = out + F.lit(weight) * ((F.coalesce(F.col(f), F.lit(median)) - F.lit(mean)) / F.lit(scale))
        return out


def fit_ridge(
    labelled: DataFrame, label: str, features: tuple[str, ...] = FEATURES, alpha: float = 1.0
) -> RidgeModel | None:
    """Ridge on median-imputed, standardised features; NULL labels must be filtered out before.

    One aggregate gives means and population covariances; only those few numbers
    reach the driver, where the normal equations of the scaled features are solved.
    A feature without any value is left out. None when there is no labelled row.
    """
    medians = exact_medians(labelled, list(features))
    used = [f for f in features if medians[f] is not None]
    x = {f: F.coalesce(F.col(f), F.lit(medians[f])) for f in used}
    y = F.col(label)
    pairs = [(a, b) for i, a in enumerate(used) for b in used[i:]]
    row = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("y"),
        *[F.avg(x[f]).alias(f"m_{f}") for f in used],
        *[F.covar_pop(x[f], y).alias(f"y_{f}") for f in used],
        *[F.covar_pop(x[a], x[b]).alias(f"c_{a}_{b}") for a, b in pairs],
    ).first()
    if row["n"] == 0:
        return None
    cov = np.array([[row[f"c_{min(a, b, key=used.index)}_{max(a, b, key=used.index)}"] for b in used] for a in used])
    spread = np.sqrt(np.diag(cov)) if used else np.zeros(0)
    scale = np.where(spread > 0, spread, 1.0)
    correlation = cov / np.outer(scale, scale) if used else np.zeros((0, 0))
    target = np.array([row[f"y_{f}"] for f in used]) / scale
    weights = np.linalg.solve(row["n"] * correlation + alpha * np.eye(len(used)), row["n"] * target)
    return RidgeModel(
        tuple(used),
        tuple(medians[f] for f in used),
        tuple(row[f"m_{f}"] for f in used),
        tuple(float(s) for s in scale),
        tuple(float(w) for w in weights),
        float(row["y"]),
    )


def _clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def predict_score(df: DataFrame, model: RidgeModel) -> DataFrame:
    scaled = model.predict() / F.lit(2.0) * F.lit(10.0)
    return df.withColumn("difficulty_score_0_10", np_round(_clip(scaled, 0.0, 10.0), 1))


def heuristic_score(df: DataFrame, weights: list[tuple[str, float | None, float]] = V.HEURISTIC_WEIGHTS) -> DataFrame:
    """Weighted sum of climb, steepness, surface and length, for data without any difficulty label.

    ``weights``: (column, unit, weight); a column without a unit is taken as it is.
    """
    part = lambda c, unit: F.col(c) if unit is None else F.coalesce(F.col(c) / F.lit(unit), F.lit(0.0))
    z = reduce(add, [F.lit(w) * part(c, unit) for c, unit, w in weights])
    return df.withColumn("difficulty_score_0_10", np_round(_clip(z * F.lit(10.0), 0.0, 10.0), 1))


def add_difficulty_score(df: DataFrame) -> DataFrame:
    """Ridge where any row has a difficulty label, else the weighted sum."""
    out = score_features(df)
    label = label_level(F.col("calculated_difficulty")) if "calculated_difficulty" in df.columns else F.lit(None)
    out = out.withColumn("wta_diff_level", label.cast("double"))
    labelled = out.select(*FEATURES, "wta_diff_level").filter(F.col("wta_diff_level").isNotNull())
    model = fit_ridge(labelled, "wta_diff_level")
    return heuristic_score(out) if model is None else predict_score(out, model)


def add_runnable_pct(df: DataFrame, weights: list[tuple[str, float | None, float]] = V.RUNNABLE_WEIGHTS) -> DataFrame:
    """Share of a trail that can be run, from steepness, climb and surface; ``weights`` as in :func:`heuristic_score`."""
    out = score_features(df, V.RUNNABLE_PENALTY_DEFAULT)

    def part(c: str, unit: float | None) -> Column:
        return _clip(F.col(c), 0.0, 1.0) if unit is None else _clip(F.coalesce(F.col(c), F.lit(0.0)) / F.lit(unit), 0.0, 2.0)

    burden = reduce(add, [F.lit(w) * part(c, unit) for c, unit, w in weights])
    pct = (F.lit(1.0) - burden / F.lit(2.0)) * F.lit(100.0)
    return out.withColumn("trail_runnable_pct", np_round(_clip(pct, 0.0, 100.0), 1))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in all and rows with a value, per column: one row of counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in columns])
