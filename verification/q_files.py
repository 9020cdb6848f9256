"""Sources and sinks through files in the shared folder: written whole, read back, compared column by column."""

from __future__ import annotations

from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions import geo
from switchback.functions import text as X
from switchback.functions.values import py_round
from switchback.session import table_path
from switchback.sources import readers as RD
from switchback.sources import writers as W
from verification import sql_parts as Q
from verification.q_geo import LENGTHS, VERTICES, elements
from verification.registry import query

#: Answers cut off in transit.
BROKEN = 50


def landed_answers(t) -> str:
    """Map query answers as files: one way a line, some lines cut off, and one indented document of all relations."""
    path = table_path(t.spark)
    rows = elements(t.f_ways)
    answer = F.to_json(F.struct(F.array(F.struct("type", "id", "tags", "geometry", "members")).alias("elements")))
    cut = F.when(F.col("id") % BROKEN == 0, F.substring(answer, F.lit(1), F.length(answer) - 5)).otherwise(answer)
    rows.filter("type = 'way'").orderBy(F.col("id") % BROKEN == 0, "id").select(cut.alias("value")).coalesce(1).write.text(f"{path}/lines")
    whole = rows.filter("type = 'relation'").agg(F.collect_list(F.to_json(F.struct("type", "id", "tags", "geometry", "members"))).alias("e"))
    document = F.concat(F.lit('{\n "elements": [\n'), F.array_join("e", ",\n  "), F.lit("\n ]\n}"))
    whole.select(document.alias("value")).write.text(f"{path}/indented")
    return f"{path}/*"


@query(
    "answers_scan",
    f"""WITH {VERTICES}, {LENGTHS}
SELECT w.type AS osm_type, w.id AS osm_id, w.n AS n_points, {Q.rnd('ln.m', 2)} AS length_m, w.osm_name AS feature_name,
  {Q.lookup('lower(trim(w.surface))', V.SURFACE_TAG_LABELS)} AS surface
FROM {{f_ways}} w JOIN ln ON ln.type = w.type AND ln.id = w.id WHERE w.type = 'relation' OR w.id % {BROKEN} <> 0""",
)
def answers_scan(t):
    f = RD.read_osm(t.spark, landed_answers(t))
    return f.select(
        "osm_type", "osm_id", F.size("points").alias("n_points"), py_round(geo.path_length_m(F.col("points")), 2).alias("length_m"),
        X.feature_name(F.col("tags")).alias("feature_name"), X.surface_from_tag(F.try_element_at("tags", F.lit("surface"))).alias("surface"),
    )


@query("answers_unreadable", f"SELECT count(*) AS unreadable, 1::BIGINT AS files FROM {{f_ways}} WHERE type = 'way' AND id % {BROKEN} = 0")
def answers_unreadable(t):
    bad = RD.unreadable_answers(RD.read_answers(t.spark, landed_answers(t)))
    return bad.agg(F.sum("unreadable").alias("unreadable"), F.count("*").alias("files"))


def sink_rows(t):
    """Trails as they are published, with lists, quotes, commas, line breaks, empty and missing values."""
    awkward = F.concat_ws('"', F.lit("a, b"), "name", F.lit("\nc"))
    return t.f_trails.select(
        "id", "name", F.when(F.col("k") % 3 == 0, awkward).otherwise(F.col("description")).alias("description"),
        "distance", "elevation", F.split("features", ", ").alias("parking_tags"),
    )


SINK = """
WITH s AS (SELECT id, name, CASE WHEN k % 3 = 0 THEN concat_ws('"', 'a, b', name, chr(10) || 'c') ELSE description END AS description, distance, elevation,
  string_split(features, ', ') AS tags FROM {f_trails})"""


@query(
    "csv_sink",
    SINK + """
SELECT id, nullif(name, '') AS name, nullif(description, '') AS description, distance, elevation, nullif(array_to_string(tags, ','), '') AS parking_tags FROM s
""",
)
def csv_sink(t):
    """What a reader of the written text gets; text has no difference between empty and missing."""
    path = table_path(t.spark)
    W.write_trails_csv(sink_rows(t), path)
    back = t.spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    text = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    return back.select(
        "id", text("name"), text("description"), F.col("distance").try_cast("double").alias("distance"),
        F.col("elevation").try_cast("int").alias("elevation"), text("parking_tags"),
    )


@query("json_sink", SINK + " SELECT id, name, description, distance, elevation, array_to_string(tags, '|') AS parking_tags, 6::BIGINT AS n_fields FROM s")
def json_sink(t):
    """One record a line, missing fields written out."""
    path = table_path(t.spark)
    rows = sink_rows(t)
    W.write_trails_json(rows, path)
    lines = t.spark.read.text(path)
    back = lines.select("value", F.from_json("value", rows.schema).alias("r"))
    return back.select(
        "r.id", "r.name", "r.description", "r.distance", "r.elevation", F.array_join("r.parking_tags", "|").alias("parking_tags"),
        F.json_array_length(F.to_json(F.json_object_keys("value"))).cast("bigint").alias("n_fields"),
    )


@query("stage_table", "SELECT id, raw_length, raw_gain, distance FROM {f_trails} WHERE distance > 3")
def stage_table(t):
    """A stage written and read back is what the next stage filters and prunes."""
    stage = W.write_stage(t.f_trails.drop("k"), table_path(t.spark), "run_1", "01_crawled")
    return stage.filter("distance > 3").select("id", "raw_length", "raw_gain", "distance")
