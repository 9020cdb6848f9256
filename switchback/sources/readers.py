"""Landed inputs as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchback import schemas as S
from switchback.functions.values import blank_to_null, finite, parse_float, parse_int
from switchback.operators.matching import read_features


def read_trails_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trail export: every field is text, header names vary; see :func:`from_export`."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return from_export(raw)


def from_export(raw: DataFrame) -> DataFrame:
    """All-text columns under any of their names to typed columns.

    A coordinate falls through to its next name only when the text is missing; a
    distance or gain also when it is zero or not a number.
    """

    def text(*names: str) -> Column:
        return F.coalesce(*[blank_to_null(F.col(n)) for n in names if n in raw.columns], F.lit(None).cast("string"))

    def nonzero(parse, *names: str) -> Column:
        known = [parse(F.col(n)) for n in names if n in raw.columns] or [parse(F.lit(""))]
        return F.coalesce(*[F.when(v != 0, v) for v in known[:-1]], known[-1])

    return raw.select(
        F.coalesce(text("id"), F.lit("")).alias("id"),
        F.coalesce(text("name"), F.lit("")).alias("name"),
        F.coalesce(text("source_url", "url"), F.lit("")).alias("source_url"),
        finite(parse_float(text("trailhead_lat", "lat", "latitude"))).alias("trailhead_lat"),
        finite(parse_float(text("trailhead_lng", "lng", "longitude"))).alias("trailhead_lng"),
        F.coalesce(text("location"), F.lit("")).alias("location"),
        finite(nonzero(parse_float, "distance", "wta_distance_mi")).alias("wta_distance_mi"),
        nonzero(parse_int, "elevation", "wta_gain_ft").alias("wta_gain_ft"),
    )


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, url): every listed address in order, copies kept; gzip is read as is.

    A sitemap file is one row; the sitemap format limits it to 50 MB.
    """
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return text.select("file", F.posexplode(sitemap_urls(F.col("value"))).alias("pos", "url"))


def sitemap_urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("<loc>(.*?)</loc>"), F.lit(1))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PAGE).parquet(path)


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows of landed query answers, a JSON document with ``elements`` each; see :func:`read_answers`."""
    elements = from_answers(read_answers(spark, path)).select(F.explode("elements").alias("e")).select("e.*")
    return read_features(elements)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """(file, answer): documents of landed files as text, whether indented over many lines or one a line.

    A file has one document a line if its first line that is not blank is a whole
    JSON object or any line is an object with ``elements``; each of its lines is
    then an answer of its own, readable or not, and the file is split like any
    text. Other files are one document and one row each, so their lines are put
    together again. What kind a file is, is joined to its lines.
    """
    line = F.trim(F.col("value"))
    place = F.struct(F.col("block"), F.col("at"))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    ).filter(F.regexp_replace("value", r"\s", "") != "")
    closed = F.startswith(line, F.lit("{")) & F.endswith(line, F.lit("}"))
    found = lines.groupBy("file").agg(
        F.min_by(F.when(closed, line), place).alias("first"), F.max(closed & F.get_json_object(line, "$.elements").isNotNull()).alias("answer")
    )
    by_line = F.coalesce(F.get_json_object("first", "$").isNotNull(), F.lit(False)) | F.col("answer")
    kinds = found.select("file", by_line.alias("by_line"))
    told = lines.join(kinds, "file")
    one_each = told.filter(~F.col("by_line")).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("l"))
    one_each = one_each.select("file", F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("answer"))
    return told.filter("by_line").select("file", F.col("value").alias("answer")).unionByName(one_each)


def from_answers(answers: DataFrame) -> DataFrame:
    """``answers`` with their parsed ``elements``; NULL where the text is no valid document."""
    parsed = F.from_json("answer", S.record(elements=T.ArrayType(S.MAP_ELEMENT)), {"mode": "PERMISSIVE"})
    return answers.withColumn("elements", parsed["elements"])


def unreadable_answers(answers: DataFrame) -> DataFrame:
    """Number of documents without readable elements per file."""
    return from_answers(answers).filter(F.col("elements").isNull()).groupBy("file").agg(F.count(F.lit(1)).alias("unreadable"))


def read_elevation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ELEVATION).parquet(path)
