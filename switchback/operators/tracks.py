"""Lines given as rows (feature, position, lat, lng).

A single feature may hold a large share of all rows, so nothing here windows
over a whole feature. Rows are spread by (feature, block of positions); the
blocks of a feature are linked through one summary row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions.geo import apart, between, haversine_m
from switchback.functions.values import py_round

BLOCK = 65536


def _here() -> Column:
    return F.struct("lat", "lng")


def _spread(points: DataFrame, key: str, pos: str, block: int) -> DataFrame:
    """Rows laid out by (feature, block); windows and summaries below share this one shuffle."""
    return points.withColumn("_block", F.floor(F.col(pos) / F.lit(block))).repartition(key, "_block")


def with_steps(points: DataFrame, key: str = "feature_id", pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Adds ``step_m``, the metres from the previous point of the feature (0 at its first point)."""
    spread = _spread(points, key, pos, block)
    in_block = Window.partitionBy(key, "_block").orderBy(pos)
    ends = spread.groupBy(key, "_block").agg(F.max_by(_here(), F.col(pos)).alias("_last"))
    links = ends.select(
        key, "_block", F.lag("_last").over(Window.partitionBy(key).orderBy("_block")).alias("_carry")
    )
    previous = F.coalesce(F.col("_previous"), F.col("_carry"))
    return (
        spread.withColumn("_previous", F.lag(_here()).over(in_block))
        .join(links, [key, "_block"], "left")
        .withColumn("step_m", F.coalesce(apart(previous, _here()), F.lit(0.0)))
        .drop("_previous", "_carry", "_block")
    )


def line_length(points: DataFrame, key: str = "feature_id", pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """(feature, n_points, length_m, length_mi)."""
    total = with_steps(points, key, pos, block).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("step_m").alias("length_m")
    )
    return total.withColumn("length_mi", F.col("length_m") / F.lit(V.METRES_PER_MILE))


def resample(
    points: DataFrame,
    step_m: float,
    max_points: int,
    key: str = "feature_id",
    pos: str = "pos",
    block: int = BLOCK,
) -> DataFrame:
    """Thin every line to points at least ``step_m`` apart along it, ``max_points`` at most.

    The first point stays. Walking on, a point stays when the metres walked
    since the last one kept reach ``step_m``; the surplus is not carried over.
    The end point is added when there is room. Lines of one or two points stay.

    Result: (feature, n_seen, samples array<struct<pos, lat, lng>>).

    The walk depends on order and runs as a fold over the array of one feature,
    so that array is first cut to what the walk can reach: any stretch that
    enters three ``step_m`` cells in a row keeps a point, hence once twice
    ``max_points`` cells are behind a block, the walk has ended before it. Cell
    counts come from the block summaries. The cut is exact, and it bounds the
    array by a distance (2 * max_points * step_m and one block), not by how
    many rows the feature has.
    """
    spread = _spread(points, key, pos, block)
    in_block = Window.partitionBy(key, "_block").orderBy(pos)
    walked = in_block.rowsBetween(Window.unboundedPreceding, 0)
    stepped = spread.withColumn("_inner", F.coalesce(apart(F.lag(_here()).over(in_block), _here()), F.lit(0.0)))
    step = F.lit(float(step_m))

    local = stepped.withColumn("_run", F.sum("_inner").over(walked))
    entered = F.floor(F.col("_run") / step) > F.floor((F.col("_run") - F.col("_inner")) / step)
    blocks = local.groupBy(key, "_block").agg(
        F.min_by(_here(), F.col(pos)).alias("_first"),
        F.max_by(_here(), F.col(pos)).alias("_last"),
        F.min(pos).alias("_first_pos"),
        F.max(pos).alias("_last_pos"),
        F.sum("_inner").alias("_length"),
        F.count_if(entered).alias("_cells"),
    )
    along = Window.partitionBy(key).orderBy("_block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("_carry", F.lag("_last").over(along))
    blocks = blocks.withColumn("_gap", F.coalesce(apart(F.col("_carry"), F.col("_first")), F.lit(0.0)))
    blocks = blocks.withColumn("_offset", F.sum(F.col("_gap") + F.col("_length")).over(upto) - F.col("_length"))
    blocks = blocks.withColumn(
        "_new_start", F.floor(F.col("_offset") / step) > F.floor(F.lag("_offset").over(along) / step)
    )
    kept_inside = F.coalesce(F.sum(F.floor(F.col("_cells") / F.lit(2))).over(before), F.lit(0))
    kept_between = F.floor(F.sum(F.col("_new_start").cast("int")).over(upto) / F.lit(2)) - F.lit(1)
    blocks = blocks.select(
        key,
        "_block",
        "_gap",
        "_first_pos",
        (F.greatest(kept_inside, F.coalesce(kept_between, F.lit(0))) < max_points).alias("_needed"),
        F.when(F.lead("_block").over(along).isNull(), F.col("_last_pos")).alias("_end_pos"),
        F.when(F.lag("_block").over(along).isNull(), F.col("_first_pos")).alias("_start_pos"),
    )
    d = F.when(F.col(pos) == F.col("_first_pos"), F.col("_gap")).otherwise(F.col("_inner"))
    # a point without a step is never kept by the walk; only how many there are, and both ends, matter
    ends = F.coalesce(F.col(pos) == F.col("_start_pos"), F.lit(False)) | F.coalesce(F.col(pos) == F.col("_end_pos"), F.lit(False))
    moves = ~d.eqNullSafe(F.lit(0.0)) | ends if step_m > 0 else F.lit(True)
    reach = (
        stepped.join(blocks, [key, "_block"])
        .filter(F.col("_needed") | (F.col(pos) == F.col("_end_pos")))
        .select(key, F.when(moves, F.struct(F.col(pos).alias("pos"), "lat", "lng", d.alias("d"))).alias("_p"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("_p")).alias("_line"), F.count(F.lit(1)).cast("int").alias("n_seen"))
    )
    return reach.select(key, "n_seen", thin("_line", step_m, max_points, F.col("n_seen")).alias("samples"))


def thin(column: str, step_m: float, max_points: int, n_points: Column | None = None) -> Column:
    """The walk of :func:`resample` over a column of (pos, lat, lng, d = metres from the point before) arrays.

    ``n_points`` is the number of points where the array leaves out some without a step.
    """
    line = F.col(column)
    plain = lambda p: F.struct(p["pos"].alias("pos"), p["lat"].alias("lat"), p["lng"].alias("lng"))
    n = F.size(line)
    first, end = plain(F.element_at(line, 1)), plain(F.element_at(line, -1))
    start = F.struct(F.array(first).alias("kept"), F.lit(0.0).alias("acc"))

    def walk(state: Column, p: Column) -> Column:
        acc = state["acc"] + p["d"]
        keep = (acc >= F.lit(float(step_m))) & (F.size(state["kept"]) < max_points)
        return F.struct(
            F.when(keep, F.concat(state["kept"], F.array(plain(p)))).otherwise(state["kept"]).alias("kept"),
            F.when(keep, F.lit(0.0)).otherwise(acc).alias("acc"),
        )

    def finish(state: Column) -> Column:
        kept = state["kept"]
        tail = F.element_at(kept, -1)
        moved = (tail["lat"] != end["lat"]) | (tail["lng"] != end["lng"])
        return F.when(moved & (F.size(kept) < max_points), F.concat(kept, F.array(end))).otherwise(kept)

    thinned = F.aggregate(F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))), start, walk, finish)
    return F.when((n if n_points is None else n_points) <= 2, F.transform(line, plain)).otherwise(thinned)


def with_distances(column: str) -> Column:
    """Column of points to the (pos, lat, lng, d) array that :func:`thin` walks over."""
    points = F.col(column)
    return F.transform(
        points,
        lambda p, i: F.struct(
            i.alias("pos"),
            p["lat"].alias("lat"),
            p["lng"].alias("lng"),
            F.when(i == 0, F.lit(0.0)).otherwise(between(F.get(points, i - 1), p)).alias("d"),
        ),
    )


def grade_features(
    samples: DataFrame, elevations: DataFrame, key: str = "feature_id", on: tuple[str, ...] = ("lat", "lng")
) -> DataFrame:
    """Steepness and climb per line: (feature, max_grade_p95, derived_gain_ft).

    ``samples`` is the result of :func:`resample` (its arrays are bounded by
    ``max_points``), ``elevations`` holds ``elevation_m`` per sample point. One
    missing elevation voids the line; fewer than three points give NULL.
    """
    heights = elevations.groupBy(*on).agg(F.max("elevation_m").alias("elevation_m"))
    rows = samples.select(key, "n_seen", F.posexplode("samples").alias("_i", "_p")).select(key, "n_seen", "_i", "_p.*")
    rows = rows.join(heights, list(on), "left")
    along = Window.partitionBy(key).orderBy("_i")
    rows = rows.select(
        key,
        "n_seen",
        "elevation_m",
        haversine_m(F.lag("lat").over(along), F.lag("lng").over(along), F.col("lat"), F.col("lng")).alias("_d"),
        (F.col("elevation_m") - F.lag("elevation_m").over(along)).alias("_rise"),
    )
    long_enough = F.col("_d") > V.GRADE_MIN_SEGMENT_M
    grade = F.when(long_enough, F.abs(F.col("_rise")) / F.col("_d") * F.lit(100.0))
    lines = rows.groupBy(key).agg(
        F.max("n_seen").alias("_n"),
        F.count_if(F.col("elevation_m").isNull()).alias("_missing"),
        lower_percentile(F.when(grade <= V.GRADE_MAX_PCT, grade), V.GRADE_QUANTILE).alias("_p95"),
        F.sum(F.when(long_enough, F.greatest(F.col("_rise"), F.lit(0.0)))).alias("_gain"),
    )
    usable = (F.col("_n") >= 3) & (F.col("_missing") == 0)
    gain = F.when(F.col("_gain") != 0.0, py_round(F.col("_gain") * F.lit(V.FEET_PER_METRE), 0).cast("int"))
    return lines.select(
        key,
        F.when(usable, py_round(F.col("_p95"), 1)).alias("max_grade_p95"),
        F.when(usable, gain).alias("derived_gain_ft"),
    )


def lower_percentile(c: Column, q: float) -> Column:
    """Aggregate: the value at rank floor(q * (n - 1)) of the sorted non-NULL values.

    For groups of bounded size (resampled lines); it sorts the group in memory.
    """
    values = F.array_sort(F.collect_list(c))
    return F.get(values, F.floor(F.lit(q) * (F.size(values) - 1)).cast("int"))


def encode_polylines(samples: DataFrame, key: str = "feature_id", out: str = "geometry_polyline") -> DataFrame:
    """One encoded string per line: 1e-5 degree deltas, zigzag, groups of five bits."""
    return samples.withColumn(out, encode_points("samples")).drop("samples", "n_seen")


def encode_points(column: str) -> Column:
    """Encoded text of a column of points (a column, not an expression: every step looks back into it)."""
    points = F.col(column)

    def units(c: Column) -> Column:
        return F.rint(c * F.lit(1e5)).cast("bigint")

    def delta(i: Column, p: Column, name: str) -> Column:
        before = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(units(F.get(points, i - 1)[name]))
        return units(p[name]) - before

    deltas = F.flatten(F.transform(points, lambda p, i: F.array(delta(i, p, "lat"), delta(i, p, "lng"))))
    zigzag = F.transform(deltas, lambda v: F.shiftleft(v, 1).bitwiseXOR(F.shiftright(v, 63)))
    # no step on the globe needs more bits than the text has room for; a line with one has no text
    fits = F.forall(zigzag, lambda v: F.shiftrightunsigned(v, 35) == 0)
    return F.when(fits, F.array_join(F.transform(zigzag, _five_bit_text), ""))


def _five_bit_text(v: Column) -> Column:
    # seven groups hold 35 bits; a full turn of longitude needs 27
    letters = []
    for k in range(7):
        rest, more = F.shiftright(v, 5 * k), F.shiftright(v, 5 * (k + 1)) > 0
        code = rest.bitwiseAND(F.lit(31).cast("bigint")) + F.when(more, F.lit(32)).otherwise(F.lit(0)) + F.lit(63)
        letter = F.char(code)
        letters.append(letter if k == 0 else F.when(rest > 0, letter).otherwise(F.lit("")))
    return F.concat(*letters)
