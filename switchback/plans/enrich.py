"""Trails to enriched trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback import schemas as S
from switchback.functions import geo
from switchback.functions.values import py_round
from switchback.operators import matching as MT
from switchback.operators import tracks as TR
from switchback.operators.stitching import stitch_trailheads, stitched_lines
from switchback.operators.urls import dedupe_first, take_first
from switchback.session import cut_lineage
from switchback.sources.readers import read_trails_csv
from switchback.sources.writers import write_trails_csv, write_trails_json


#: A line longer by less than this is the same line, its segments added up in another order.
LEAST_GAIN_M = 1e-6


def matchable(trails: DataFrame) -> DataFrame:
    """Trails with a position and a name; the others are never attempted."""
    known = F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~F.isnan("lat") & ~F.isnan("lng")
    return trails.filter(known & F.col("name").isNotNull() & (F.col("name") != ""))


def matched_facts(best: DataFrame, trails: DataFrame, features: DataFrame) -> DataFrame:
    """Best matches with what is asked of the feature, without its geometry: (trail_id, ..., osm_name, own_m).

    Name and length are found once per matched feature, not once per trail.
    """
    found = features.join(best.select(*MT.FEATURE_KEYS).distinct(), MT.FEATURE_KEYS, "left_semi")
    facts = found.select(
        *MT.FEATURE_KEYS, F.try_element_at("tags", F.lit("name")).alias("osm_name"), geo.path_length_m(F.col("points")).alias("own_m")
    )
    miles = trails.select("trail_id", "lat", "lng", "distance_mi")
    return best.join(facts, MT.FEATURE_KEYS).join(miles, "trail_id")


def too_short(ratio: float = V.STITCH_RATIO) -> Column:
    """A single way much shorter than the trail is worth a try at stitching."""
    miles = F.col("distance_mi")
    return (F.col("osm_type") == "way") & (miles != 0) & (F.col("own_m") / F.lit(V.METRES_PER_MILE) < miles * F.lit(ratio))


def feature_shape() -> Column:
    """The name of a matched feature's own line."""
    return F.concat_ws(":", "osm_type", F.col("osm_id").cast("string"))


def accepted_stitches(matched: DataFrame, candidates: DataFrame, ratio: float = V.STITCH_RATIO) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stitched lines that replace a short single way, where they are longer.

    Returns (trail_id, shape) of the trails, (shape, part_no, osm_id, flip, drop)
    and (shape, points). A shape is a digest of the ways and turns of a line, so
    trails with the same line share one, and its points are laid once.
    """
    asked = cut_lineage(matched.filter(F.coalesce(too_short(ratio), F.lit(False))).select("trail_id", "lat", "lng", "distance_mi", "own_m"))
    plan = cut_lineage(stitch_trailheads(asked.drop("own_m").withColumn("name", F.lit("")), candidates))
    steps = F.array_sort(F.collect_list(F.struct("part_no", "osm_id", "flip", "drop")))
    of_trail = cut_lineage(plan.groupBy("trail_id").agg(F.concat(F.lit("stitched:"), F.sha2(F.to_json(steps), 256)).alias("shape")))
    told_by = of_trail.groupBy("shape").agg(F.min("trail_id").alias("trail_id"))
    parts = cut_lineage(plan.join(told_by, "trail_id").drop("trail_id"))
    lines = cut_lineage(stitched_lines(parts.withColumnRenamed("shape", "trail_id"), candidates).withColumnRenamed("trail_id", "shape"))
    lengths = lines.select("shape", geo.path_length_m(F.col("points")).alias("line_m"))
    longer = of_trail.join(lengths, "shape").join(asked.select("trail_id", "own_m"), "trail_id").filter(F.col("line_m") > F.col("own_m") + F.lit(LEAST_GAIN_M))
    return cut_lineage(longer.select("trail_id", "shape")), parts, lines


def surface_elements(final: DataFrame, plan: DataFrame, features: DataFrame) -> DataFrame:
    """Ways whose surface counts, as (trail_id, part_no, surface_tag, length_m); ``trail_id`` names a line.

    The matched way itself; tagged member ways of a relation; the ways of a
    stitched line.
    """
    tag = lambda tags: F.try_element_at(tags, F.lit("surface"))
    own = final.filter(F.col("osm_type") == "way").select(
        "trail_id", F.lit(0).alias("part_no"), tag(F.col("feature_tags")).alias("surface_tag"),
        geo.path_length_m(F.col("points")).alias("length_m"),
    )
    members = final.filter(F.col("osm_type") == "relation").select("trail_id", F.posexplode("members").alias("part_no", "m"))
    members = members.filter((F.col("m.type") == "way") & (F.size("m.tags") > 0)).select(
        "trail_id", "part_no", tag(F.col("m.tags")).alias("surface_tag"),
        geo.path_length_m(geo.way_points(F.col("m.geometry"))).alias("length_m"),
    )
    ways = features.filter(F.col("osm_type") == "way").select("osm_id", "tags", "points")
    used = plan.join(ways, "osm_id").select(
        "trail_id", "part_no", tag(F.col("tags")).alias("surface_tag"), geo.path_length_m(F.col("points")).alias("length_m")
    )
    return own.unionByName(members).unionByName(used)


def line_features(final: DataFrame, elevations: DataFrame | None, store_polyline: bool = True) -> DataFrame:
    """(trail_id, osm_distance_mi, max_grade_p95, derived_gain_ft, geometry_polyline) of matched lines."""
    lines = final.filter(F.size("points") > 0).withColumn("_walked", TR.with_distances("points"))
    lines = lines.withColumn("samples", TR.thin("_walked", V.EXPORT_STEP_M, V.EXPORT_MAX_POINTS))
    miles = geo.path_length_m(F.col("points")) / F.lit(V.METRES_PER_MILE)
    export = TR.encode_points("samples") if store_polyline else F.lit(None).cast("string")
    out = lines.select("trail_id", py_round(miles, 2).alias("osm_distance_mi"), export.alias("geometry_polyline"))
    if elevations is None:
        none = F.lit(None)
        return out.withColumns({"max_grade_p95": none.cast("double"), "derived_gain_ft": none.cast("int")})
    samples = lines.select(
        "trail_id", F.size("points").alias("n_seen"),
        TR.thin("_walked", V.GRADE_STEP_M, V.GRADE_MAX_POINTS).alias("samples"),
    )
    return out.join(TR.grade_features(samples, elevations, key="trail_id"), "trail_id", "left")


def enrich_trails(
    trails: DataFrame,
    features: DataFrame,
    elevations: DataFrame | None = None,
    method: str = "blocks",
    store_polyline: bool = True,
) -> DataFrame:
    """Enrichment columns per trail id for (id, name, latitude, longitude, distance) rows.

    Geometry stays with the lines: length, grade, polyline and surfaces are
    found once per line that some trail matched, and joined to the trails by
    the line's name, so no exchange carries points per trail.

    Confidence is NULL where no match was attempted and 0 where none was found.
    """
    asked = dedupe_first(
        trails.select(
            F.col("id").alias("trail_id"), "name", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"),
            F.col("distance").alias("distance_mi"),
        ),
        "trail_id",
        "name",
    )  # copies of an id: the least name, then the least content
    tried = matchable(asked)
    candidates = MT.candidate_features(features)
    best = cut_lineage(MT.match_trails(tried, candidates, method))
    matched = cut_lineage(matched_facts(best, tried, features))
    stitched, parts, lines = accepted_stitches(matched, candidates)
    final = matched.join(stitched.withColumnRenamed("shape", "_stitched"), "trail_id", "left")
    final = cut_lineage(final.select(
        "trail_id", "osm_id", "osm_name", F.when(F.col("_stitched").isNotNull(), F.lit("stitched")).otherwise(F.col("osm_type")).alias("osm_type"),
        "match_confidence", F.coalesce("_stitched", feature_shape()).alias("shape"),
    ))
    # each line that some trail ended up with, once
    used = final.select(F.col("shape").alias("trail_id")).distinct()
    own = features.select(feature_shape().alias("trail_id"), "osm_type", F.col("tags").alias("feature_tags"), "points", "members")
    laid = lines.withColumnRenamed("shape", "trail_id").select(
        "trail_id", F.lit("stitched").alias("osm_type"), F.create_map().cast("map<string,string>").alias("feature_tags"), "points",
        F.lit(None).cast(own.schema["members"].dataType).alias("members"),
    )
    shapes = cut_lineage(own.unionByName(laid).join(used, "trail_id", "left_semi"))
    told = parts.withColumnRenamed("shape", "trail_id").join(used, "trail_id", "left_semi")
    mix = MT.surface_mix(surface_elements(shapes, told, features))
    of_shape = line_features(shapes, elevations, store_polyline).join(mix, "trail_id", "left").withColumnRenamed("trail_id", "shape")
    out = tried.select("trail_id").join(final.join(of_shape, "shape", "left"), "trail_id", "left")
    out = out.withColumn("match_confidence", F.coalesce("match_confidence", F.lit(0.0)))
    return out.select(F.col("trail_id").alias("id"), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.ENRICHMENT])


def attach_enrichment(trails: DataFrame, enriched: DataFrame) -> DataFrame:
    """All trails with the enrichment columns; NULL where there are none."""
    columns = [c for c in V.ENRICHMENT_COLUMNS if c in enriched.columns]
    return trails.join(enriched.select("id", *columns), "id", "left")


def enrich_all(trails: DataFrame, features: DataFrame, elevations: DataFrame | None = None, **options) -> DataFrame:
    """As :func:`enrich_trails`, with a row for every id: trails without a position or a name, where no match is attempted, have NULLs."""
    ids = trails.select(F.col("id").alias("_id")).distinct()
    enriched = enrich_trails(trails, features, elevations, **options)
    made = ids.join(enriched, F.col("_id").eqNullSafe(F.col("id")), "left")
    return made.select(F.col("_id").alias("id"), *[c for c in enriched.columns if c != "id"])


def enrich_export(export: DataFrame, features: DataFrame, elevations: DataFrame | None = None, **options) -> DataFrame:
    """Stand-alone enrichment of a typed trail export; a row that cannot be enriched keeps its own columns."""
    trails = export.select(
        "id", "name", F.col("trailhead_lat").alias("latitude"), F.col("trailhead_lng").alias("longitude"),
        F.col("wta_distance_mi").alias("distance"),
    )
    return attach_enrichment(export, enrich_trails(trails, features, elevations, **options))


def enrich_file(
    spark: SparkSession, export: str, features: DataFrame, out: str, elevations: DataFrame | None = None, limit: int | None = None, **options
) -> DataFrame:
    """A trail export, from file to files: reads it, takes the first ``limit`` rows by id, enriches them, writes ``out``/csv and ``out``/json.

    Returns the written rows. Both outputs hold the same rows; a failure leaves no half of them behind as done,
    since the rows are landed before either is written.
    """
    trails = read_trails_csv(spark, export)
    asked = trails if limit is None else take_first(trails, limit, "id")
    made = cut_lineage(enrich_export(asked, features, elevations, **options))
    write_trails_csv(made, f"{out}/csv")
    write_trails_json(made, f"{out}/json")
    return made
