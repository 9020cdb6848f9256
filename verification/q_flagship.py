"""The flagship: links of landed pages, the frontier among them, and the state rows of that run."""

from __future__ import annotations

from pyspark.sql import functions as F

from switchback.operators import state as ST
from switchback.operators import urls as U
from verification.registry import query

BASE = "https://site.example"


@query(
    "crawl_plan",
    r"""
WITH h AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM {pages}),
l AS (SELECT page_id, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS i FROM h),
f AS (SELECT regexp_replace(split_part(split_part('https://site.example' || replace(h, '&amp;', '&'), '#', 1), '?', 1), '/+$', '') AS url, page_id, i
  FROM l WHERE h <> '' AND NOT suffix(h, '/')),
u AS (SELECT url, min(struct_pack(p := page_id, i := i)) AS pos FROM f GROUP BY url),
k AS (SELECT url, pos.p AS p, pos.i AS i FROM u WHERE NOT suffix(url, '.')),
s AS (SELECT DISTINCT 'https://site.example/' || p_type AS url FROM {part} UNION SELECT 'https://site.example/' || w FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM {documents})),
t AS (SELECT k.url, s.url IS NOT NULL AS known FROM k LEFT JOIN s ON s.url = k.url ORDER BY known, k.p, k.i LIMIT 300)
SELECT url, 'wta_' || list_extract(string_split(url, '/'), -1) AS id, known, CASE WHEN known THEN 'old' END AS last_hash, 0 AS last_status, 'parse_failed_or_unreachable' AS last_error FROM t
""",
)
def crawl_plan(t):
    pages = t.pages.select(F.col("page_id").alias("page_no"), "html")
    links = U.harvest_links(pages, BASE, marker="/")
    links = links.select("url", F.struct("page_no", "pos").alias("pos"))
    hikes = U.filter_urls(links, contains="/", not_suffix=".")
    words = t.documents.select(F.explode(F.array_distinct(F.split(F.lower("text"), " "))))
    known = t.part.select(F.col("p_type").alias("s")).union(words)
    state = known.select(F.concat(F.lit(BASE + "/"), F.col("s")).alias("url")).distinct().select(
        "url", F.lit("old").alias("last_hash"), F.lit(None).cast("timestamp").alias("last_crawled_at")
    )
    frontier = U.select_frontier(hikes, state, 300)
    nothing = frontier.select("url", F.lit("").alias("new_hash")).filter(F.lit(False))
    rows = ST.state_updates(nothing, frontier, state, F.lit(None).cast("timestamp")).drop("last_crawled_at")
    known_too = rows.withColumn("known", F.col("last_hash").isNotNull())
    return known_too.select("url", U.slug_id(F.col("url")).alias("id"), "known", "last_hash", "last_status", "last_error")
