"""Declared record types; nothing is inferred from a batch."""

from __future__ import annotations

from pyspark.sql import types as T

from switchback import fixed_values as V


TEXT, INT, LONG, REAL, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
TEXTS, TEXT_MAP = T.ArrayType(TEXT), T.MapType(TEXT, TEXT)


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRAIL = record(
    id=TEXT, name=TEXT, rank=INT, difficulty=REAL, calculated_difficulty=TEXT, rating=REAL, num_votes=INT,
    distance=REAL, elevation=INT, highest_point=INT, latitude=REAL, longitude=REAL, surface=TEXT, route_type=TEXT,
    water_source=TEXT, image_url=TEXT, parking=TEXT, parking_tags=TEXTS, parking_status=TEXT, restrooms=TEXT,
    cell_coverage=TEXT, crowd_level=INT, description=TEXT, source_url=TEXT, raw_features=TEXT,
)
ENRICHMENT = record(
    osm_id=LONG, osm_name=TEXT, osm_type=TEXT, match_confidence=REAL, osm_distance_mi=REAL, max_grade_p95=REAL,
    derived_gain_ft=INT, surface_primary=TEXT, surface_breakdown=TEXT, geometry_polyline=TEXT,
)
SCORES = record(
    gain_ft=REAL, gain_per_mile_ft=REAL, difficulty_score_0_10=REAL, trail_runnable_pct=REAL, dataset_version=TEXT
)
EXPORT = record(
    id=TEXT, name=TEXT, source_url=TEXT, trailhead_lat=REAL, trailhead_lng=REAL, location=TEXT,
    wta_distance_mi=REAL, wta_gain_ft=INT,
)
PAGE = record(url=TEXT, html=TEXT, status=INT)
_GEOMETRY = T.ArrayType(record(lat=REAL, lon=REAL))
MEMBER = record(type=TEXT, ref=LONG, role=TEXT, tags=TEXT_MAP, geometry=_GEOMETRY)
MAP_ELEMENT = record(type=TEXT, id=LONG, tags=TEXT_MAP, geometry=_GEOMETRY, members=T.ArrayType(MEMBER))
ELEVATION = record(lat=REAL, lng=REAL, elevation_m=REAL)
CRAWL_STATE = record(url=TEXT, last_hash=TEXT, last_crawled_at=TIME, last_status=INT, last_error=TEXT)
DATASET_VERSIONS = record(dataset_version=TEXT, created_at=TIME, notes=TEXT)
PIPELINE_RUNS = record(
    run_id=TEXT, dataset_version=TEXT, schema_version=TEXT, status=TEXT, started_at=TIME, finished_at=TIME,
    row_count=INT, stats=TEXT_MAP, params=TEXT_MAP, notes=TEXT,
)


def store_schema() -> T.StructType:
    """The published trails table: page columns without the intermediate ones, enrichment, scores."""
    fields = []
    for f in [*TRAIL.fields, *ENRICHMENT.fields, *SCORES.fields]:
        if f.name not in V.INTERMEDIATE_COLUMNS:
            fields.append(T.StructField(V.STORE_RENAMES.get(f.name, f.name), f.dataType))
    return T.StructType(fields)
