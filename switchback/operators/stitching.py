"""Joining ways end to end, starting at a trailhead.

Each trail grows its own line: first the way with an end nearest to the
trailhead, then again and again the unused way with an end nearest to the open
end of the line (under ``gap`` metres), until the line is long enough or nothing
connects. Which ends lie near which is found once for the whole map, by one
join on grid cells; a trailhead's share of these links is written hashed by
(trailhead, open end). A round of growth is then one join that moves the open
lines only, for all trailheads at once, so the number of jobs depends on the
longest chain and never on the number of trails, and no task holds all ways
around a trailhead.

Copies cost nothing: trails that start at one place walk the same way until
they are long enough, so a place is walked once and each trail takes its part of
the line; and ways with the same points are one way with several ids, of which a
line takes the lowest it has not used yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions import geo
from switchback.operators.matching import nearest_vertices, points_digest
from switchback.session import cut_lineage, drop_tables, land_bucketed

_STEP = "array<struct<osm_id:bigint,flip:boolean,drop:boolean>>"
_AT = ["trail_id", "from_id", "from_flip"]


def distinct_ways(ways: DataFrame, copies: int) -> DataFrame:
    """(osm_id, ids, points): ways with the same points once, under their lowest id.

    ``ids`` are their ``copies`` lowest ids. A line takes the lowest it has not
    used, so one of fewer ways never asks for more of them.
    """
    told = ways.filter("osm_id IS NOT NULL").select("osm_id", "points", points_digest(F.col("points")).alias("_shape"))
    place = F.row_number().over(Window.partitionBy("_shape").orderBy("osm_id"))
    lowest = told.select("_shape", "osm_id").distinct().withColumn("_place", place).filter(F.col("_place") <= copies)
    named = lowest.groupBy("_shape").agg(F.min("osm_id").alias("osm_id"), F.sort_array(F.collect_list("osm_id")).alias("ids"))
    return told.groupBy("_shape").agg(F.first("points").alias("points")).join(named, "_shape").select("osm_id", "ids", "points")


def way_ends(ways: DataFrame) -> DataFrame:
    """Two rows per way (osm_id, ids, points), one for each end one can join it at.

    ``near`` is that end, ``after`` the point behind it, ``far`` the other end;
    ``after_m`` and ``length_m`` give the way's length without and with its first segment.
    """
    n = F.size("points")
    at = lambda i: F.element_at("points", i)
    measured = ways.filter(n >= 2).select("osm_id", "ids", "points", geo.path_length_m(F.col("points")).alias("length_m"))

    def end(flip: bool) -> Column:
        near, after, far = (at(-1), at(-2), at(1)) if flip else (at(1), at(2), at(-1))
        return F.struct(
            F.lit(flip).alias("flip"),
            near.alias("near"),
            after.alias("after"),
            far.alias("far"),
            (F.col("length_m") - geo.between(near, after)).alias("after_m"),
        )

    ends = F.explode(F.array(end(False), end(True))).alias("_e")
    return measured.select("osm_id", "ids", "length_m", ends).select("osm_id", "ids", "length_m", "_e.*")


def end_links(ends: DataFrame, gap: float = V.STITCH_GAP_M) -> DataFrame:
    """Where one can go on: (from_id, from_flip, osm_id, ids, flip, d, drop, added_m).

    A line whose last way was laid as (from_id, from_flip) ends at that way's
    far end; (osm_id, flip) are the ways with an end under ``gap`` metres from
    there; a way follows itself only as another copy. ``drop`` leaves the doubled first point away; ``added_m`` is what the
    line gains. One join on cells over all ends of the map.
    """
    tails = ends.select(F.col("osm_id").alias("from_id"), F.col("flip").alias("from_flip"), F.col("far").alias("tail"))
    tails = geo.with_cells_around(tails, F.col("tail.lat"), F.col("tail.lng"), gap)
    near = geo.with_cell(ends.drop("far"), F.col("near.lat"), F.col("near.lng"), gap)
    met = tails.join(near, ["gy", "gx"]).filter((F.col("from_id") != F.col("osm_id")) | (F.size("ids") > 1))
    met = met.withColumn("d", geo.between(F.col("tail"), F.col("near"))).filter(F.col("d") < gap)
    drop = F.col("d") < V.JOINT_TOLERANCE_M
    added = F.when(drop, geo.between(F.col("tail"), F.col("after")) + F.col("after_m")).otherwise(F.col("d") + F.col("length_m"))
    return met.select("from_id", "from_flip", "osm_id", "ids", "flip", "d", drop.alias("drop"), added.alias("added_m"))


def stitch_trailheads(
    trails: DataFrame,
    candidates: DataFrame,
    radius: float = V.SEARCH_RADII_M[-1],
    gap: float = V.STITCH_GAP_M,
    share: float = V.STITCH_TARGET_SHARE,
    max_rounds: int = V.STITCH_MAX_ROUNDS,
) -> DataFrame:
    """(trail_id, part_no, osm_id, flip, drop): the ways of each trail's line, in order."""
    ways = cut_lineage(distinct_ways(candidates.filter(F.col("osm_type") == "way"), max_rounds + 1))
    heads = trails.filter("lat IS NOT NULL AND lng IS NOT NULL").select(
        "trail_id",
        F.concat_ws(" ", "lat", "lng").alias("place"),
        "lat",
        "lng",
        (
            F.coalesce(F.when(F.col("distance_mi") != 0, F.col("distance_mi")), F.lit(V.STITCH_DEFAULT_MILES))
            * F.lit(V.METRES_PER_MILE)
        ).alias("target_m"),
    )
    # a place's line goes on until the longest of its trails has enough
    places = cut_lineage(heads.groupBy("place", "lat", "lng").agg(F.max("target_m").alias("target_m")))
    lines = ways.select(F.col("osm_id").alias("shape"), "points")
    around = nearest_vertices(places.withColumnRenamed("place", "head"), lines, radius)
    around = around.select(F.col("head").alias("trail_id"), F.col("shape").alias("osm_id"))
    ends = cut_lineage(way_ends(ways))
    of_place = places.select(F.col("place").alias("trail_id"), F.struct("lat", "lng").alias("head"), "target_m")
    joints = around.join(ends.select("osm_id", "flip", "near", "far", "length_m"), "osm_id").join(of_place, "trail_id")
    joints = joints.withColumn("head_m", geo.between(F.col("head"), F.col("near")))
    joints = joints.withColumn("end_m", F.least(F.col("head_m"), geo.between(F.col("head"), F.col("far"))))
    joints = cut_lineage(joints.select("trail_id", "osm_id", "flip", "head_m", "end_m", "length_m", "target_m"))
    # a line walks on ways around its place only
    own = joints.select("trail_id", "osm_id", "flip", "end_m")
    here = own.select("trail_id", F.col("osm_id").alias("from_id"), F.col("flip").alias("from_flip"))
    links = land_bucketed(here.join(end_links(ends, gap), ["from_id", "from_flip"]).join(own, ["trail_id", "osm_id", "flip"]), _AT)

    # the way with the nearest end, joined at that end
    seeds = cut_lineage(joints.groupBy("trail_id").agg(F.min(F.struct("head_m", "osm_id", "flip", "length_m", "target_m")).alias("s")))
    growing = F.col("line_m") < F.col("target_m") * F.lit(share)
    first = cut_lineage(seeds.select(
        "trail_id",
        F.col("s.osm_id").alias("from_id"),
        F.col("s.flip").alias("from_flip"),
        F.col("s.target_m").alias("target_m"),
        F.array(F.struct(F.col("s.osm_id"), F.col("s.flip"), F.lit(False).alias("drop"))).cast(_STEP).alias("plan"),
        F.col("s.length_m").alias("line_m"),
    ).withColumn("open", growing))
    rounds = [first]
    for _ in range(max_rounds):
        going = rounds[-1].filter("open")
        if going.isEmpty():
            break
        rounds.append(cut_lineage(_grow(going, links).withColumn("open", F.col("open") & growing)))
    drop_tables(links, joints, ends, ways)
    # lines that closed in a round, and those still open after the last one
    closed = [r.filter(~F.col("open")) for r in rounds[:-1]] + [rounds[-1]]
    plans, grown = (
        _united([r.select(F.col("trail_id").alias("place"), *columns) for r in tables])
        for tables, columns in ((closed, ["plan"]), (rounds, [F.size("plan").alias("n"), "line_m"]))
    )
    steps = grown.groupBy("place").agg(F.array_sort(F.collect_set(F.struct("n", "line_m"))).alias("steps"))
    walked = plans.join(steps, "place").join(seeds.select(F.col("trail_id").alias("place"), F.col("s").alias("seed")), "place")
    return _own_parts(heads, cut_lineage(walked), share)


def _united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _own_parts(heads: DataFrame, walked: DataFrame, share: float) -> DataFrame:
    """Each trail's part of the line of its place: up to the first way that makes it long enough.

    A trail that comes several times has the line with the nearest first way, of equal ones the shortest target.
    """
    start = F.struct("seed.head_m", "seed.osm_id", "seed.flip", "seed.length_m", "target_m", "place")
    once = heads.join(walked.select("place", "seed"), "place").groupBy("trail_id").agg(F.min(start).alias("s"))
    asked = once.select("trail_id", "s.place", "s.target_m").join(walked.select("place", "plan", "steps"), "place")
    enough = F.filter("steps", lambda x: ~(x["line_m"] < F.col("target_m") * F.lit(share)))
    n = F.coalesce(F.get(enough, 0)["n"], F.size("plan"))
    parts = asked.select("trail_id", F.posexplode(F.slice("plan", F.lit(1), n)).alias("part_no", "p"))
    return parts.select("trail_id", "part_no", "p.*")


def _grow(lines: DataFrame, links: DataFrame) -> DataFrame:
    """One round: every line takes its nearest connecting way, or closes."""
    used = F.transform("plan", lambda p: p["osm_id"])
    ids = F.col("ids") if "ids" in links.columns else F.array("osm_id")
    reach = lines.select(*_AT, used.alias("used")).join(links, _AT).withColumn("id", F.array_min(F.array_except(ids, "used")))
    nearest = F.min(F.struct("d", "end_m", "id", "flip", "drop", "added_m", "osm_id"))
    chosen = reach.filter("id IS NOT NULL").groupBy(*_AT).agg(nearest.alias("c"))
    step = F.array(F.struct("c.id", "c.flip", "c.drop")).cast(_STEP)
    grown = F.col("c").isNotNull()
    return lines.join(chosen, _AT, "left").select(
        "trail_id",
        F.when(grown, F.col("c.osm_id")).otherwise(F.col("from_id")).alias("from_id"),
        F.when(grown, F.col("c.flip")).otherwise(F.col("from_flip")).alias("from_flip"),
        "target_m",
        F.when(grown, F.concat("plan", step)).otherwise(F.col("plan")).alias("plan"),
        F.when(grown, F.col("line_m") + F.col("c.added_m")).otherwise(F.col("line_m")).alias("line_m"),
        grown.alias("open"),
    )


def stitched_lines(plan: DataFrame, candidates: DataFrame) -> DataFrame:
    """Geometry of stitched lines: (trail_id, points). A line has at most one way per round."""
    ways = candidates.filter(F.col("osm_type") == "way").select("osm_id", "points")
    parts = plan.join(ways, "osm_id")
    turned = F.when(F.col("flip"), F.reverse("points")).otherwise(F.col("points"))
    laid = F.slice(turned, F.when(F.col("drop"), F.lit(2)).otherwise(F.lit(1)), F.size("points"))
    parts = parts.groupBy("trail_id").agg(F.array_sort(F.collect_list(F.struct("part_no", laid.alias("p")))).alias("_l"))
    return parts.select("trail_id", F.flatten(F.transform("_l", lambda x: x["p"])).alias("points"))
