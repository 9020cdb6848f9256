"""Stand-alone listing crawl over landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.operators.pages import extract_pages, failed_urls
from switchback.operators.urls import dedupe_first, harvest_links
from switchback.session import cut_lineage


def extract_trails(pages: DataFrame, heading_class: str | None = V.HEADING_CLASS) -> tuple[DataFrame, DataFrame]:
    """(trails, failed addresses) of landed pages."""
    trails = extract_pages(pages, heading_class)
    return trails, failed_urls(pages, trails)


def list_crawl(
    list_pages: DataFrame, detail_pages: DataFrame, base: str, limit: int, heading_class: str | None = V.HEADING_CLASS
) -> DataFrame:
    """Trails behind the links of list pages, in the order the links appear, each id once, ``limit`` at most.

    Pages are read in that order: first those of the ``limit`` first links that
    landed, and, while some of them gave no trail or one twice, of four times
    as many. So a small ``limit`` never parses all pages.
    """
    links = harvest_links(list_pages, base)
    place = links.select("url", F.struct("page_no", "pos").alias("_place"))
    listed = cut_lineage(detail_pages.select("url").distinct().join(place, "url"))
    many, total = max(limit, 1), listed.count()
    while True:
        near = listed
        if many < total:
            first = listed.orderBy("_place").limit(many).agg(F.max("_place").alias("_place")).first()["_place"]
            end = F.struct(F.lit(first["page_no"]).alias("page_no"), F.lit(first["pos"]).alias("pos"))
            near = cut_lineage(listed.filter(F.col("_place") <= end.cast(listed.schema["_place"].dataType)))
        landed = detail_pages.join(near.select("url"), "url", "left_semi")
        trails = extract_pages(landed, heading_class).join(near.withColumnRenamed("url", "source_url"), "source_url")
        # every page up to there is in it, so these are the first rows of their ids
        found = cut_lineage(dedupe_first(trails, "id", "_place"))
        if many >= total or found.count() >= limit:
            return dedupe_first(found, "id", "_place", limit).drop("_place")
        many *= 4
