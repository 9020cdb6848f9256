"""Inputs derived from the given tables.

Each text runs unchanged in Spark SQL and in DuckDB; ``{name}`` stands for a
given table or another fixture. Fixtures cover whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

FIXTURES = {
    "f_trails": """
SELECT p_partkey AS k,
  'wta_' || CAST(p_partkey AS STRING) AS id,
  CASE p_partkey % 6 WHEN 0 THEN '  Lake ' || p_name || ' Trail' WHEN 1 THEN p_name || '!! Loop' WHEN 2 THEN 'Trail'
    WHEN 3 THEN 'Mount ' || p_brand || '   Trail' WHEN 4 THEN upper(p_name) ELSE p_name END AS name,
  CASE p_partkey % 9 WHEN 0 THEN '4.3 miles, roundtrip' WHEN 1 THEN '5.4 miles, loop' WHEN 2 THEN '3.2 miles one-way'
    WHEN 3 THEN '1,200 miles, of trails' WHEN 4 THEN '' WHEN 5 THEN 'about 7 mile'
    WHEN 6 THEN CAST(p_size AS STRING) || '.5 miles, roundtrip' WHEN 7 THEN CAST(p_size AS STRING) || ' miles,' ELSE NULL END AS raw_length,
  CASE p_partkey % 5 WHEN 0 THEN '4,500 feet' WHEN 1 THEN '3200 ft' WHEN 2 THEN '1200.5 ft' WHEN 3 THEN CAST(p_size * 40 AS STRING) || ' feet' ELSE 'n/a' END AS raw_gain,
  CASE p_partkey % 11 WHEN 0 THEN 'Northwest Forest Pass required.' WHEN 1 THEN 'Discover Pass. Vault toilet.' WHEN 2 THEN 'Small parking lot, few feet away'
    WHEN 3 THEN 'Pay $5 fee' WHEN 4 THEN 'Street parking, no restroom' WHEN 5 THEN 'Sno-Park permit' WHEN 6 THEN '' WHEN 7 THEN 'Ample parking'
    WHEN 8 THEN 'Privy at lot' WHEN 9 THEN 'Pit toilet, limited parking' ELSE NULL END AS parking,
  CASE p_partkey % 13 WHEN 0 THEN 'A quiet walk on boardwalk to a lake.' WHEN 1 THEN 'Very popular and unpaved; no cell service anywhere here.'
    WHEN 2 THEN 'Rocky scramble over talus beside a creek.' WHEN 3 THEN 'Bring water: no water on this ridge, good cell reception.'
    WHEN 4 THEN 'Campground with a spigot; spotty signal; popular in July.' WHEN 5 THEN 'Short.' WHEN 6 THEN 'Moderate traffic on gravel. River crossing.'
    WHEN 7 THEN 'A walk through a meadow where the views go on and on to the far hills.' WHEN 8 THEN 'Unpopular thousand-step stair with refill tap.'
    WHEN 9 THEN 'Glacier views, snow into June, crowded.' WHEN 10 THEN '' WHEN 11 THEN 'Muddy roots and solitude.' ELSE NULL END AS description,
  CASE p_partkey % 7 WHEN 0 THEN 'Lakes, Dogs' WHEN 1 THEN 'Rivers, Old growth' WHEN 2 THEN 'Waterfalls' WHEN 3 THEN 'Summits' WHEN 4 THEN '' ELSE NULL END AS features,
  CASE p_partkey % 8 WHEN 0 THEN 'Easy' WHEN 1 THEN 'Easy/Moderate' WHEN 2 THEN 'Moderate' WHEN 3 THEN ' Moderate/Hard ' WHEN 4 THEN 'Hard' WHEN 5 THEN 'hard' ELSE NULL END AS calculated_difficulty,
  CASE p_partkey % 4 WHEN 0 THEN 'Gravel' WHEN 1 THEN 'Dirt/Soil' WHEN 2 THEN 'Pavement' ELSE NULL END AS surface_primary,
  CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / CAST(3 AS DOUBLE) END AS distance,
  CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 4000 AS INT) END AS elevation,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST((p_partkey * 53) % 120 AS DOUBLE) / CAST(10 AS DOUBLE) END AS osm_distance_mi,
  CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CAST((p_partkey * 17) % 350 AS DOUBLE) / CAST(10 AS DOUBLE) END AS max_grade_p95
FROM {part}
""",
    # a landed page per trail: definition list, stat block, badges, linked data, directions
    "f_trail_pages": """
SELECT k, id, 'https://trails.example.org/go-hiking/hikes/' || CAST(k AS STRING) || '/' AS url,
  '<html><head><meta property="og:image" content="/img/' || CAST(k AS STRING) || '.jpg">' ||
  CASE k % 5 WHEN 0 THEN '<meta name="geo.position" content="47.' || CAST(1000 + k % 9000 AS STRING) || ';-121.5">'
    WHEN 1 THEN '<script type="application/ld+json">[1, "geo": ]</script><script>var p = lat: 46.' || CAST(100 + k % 800 AS STRING) || ', lng: -120.25;</script>'
    ELSE '' END ||
  '</head><body><h1 class="documentFirstHeading"><b>' || name || '</b></h1>' ||
  CASE k % 2 WHEN 0 THEN '<dl><dt>Length</dt><dd>' || coalesce(raw_length, '') || '</dd><dt>Elevation <i>Gain</i></dt><dd>' || raw_gain ||
      '</dd><dt>Calculated Difficulty</dt><dd>' || coalesce(calculated_difficulty, 'http') || '</dd></dl>'
    ELSE '<ul class="hike-stats"><li>Length <span>' || coalesce(raw_length, '') || '</span></li><li>Gain <span>' || raw_gain || '</span></li></ul>' END ||
  CASE k % 3 WHEN 0 THEN '<span aria-label="' || CAST(k % 6 AS STRING) || ' out of 5 stars"></span><p>(' || CAST(k % 40 AS STRING) || ' votes)</p>'
    WHEN 1 THEN '<i data-rating="3.5"></i><em class="vote-count">12 votes</em>' ELSE '' END ||
  CASE WHEN parking IS NULL THEN '' ELSE '<div id="hike-getting-there"><h2>Way</h2>' || parking || ' Print</div>' END ||
  CASE WHEN features IS NULL THEN '' ELSE '<div class="hike-features"><span>' || features || '</span><span>Wild</span><span>wild</span></div>' END ||
  '<div id="content-core"><p>' || coalesce(description, '') || '<p>Email  the ranger before a long visit, since the gate beside the mill may stay shut all week.</div>' ||
  '</body></html>' AS html
FROM {f_trails}
""",
    # a page a step of a field's rules: what that step reads is the only thing on it, so the step decides
    "f_step_pages": """
SELECT k, s, 'https://trails.example.org/go-hiking/hikes/' || CAST(k AS STRING) || '/' AS url,
  '<html><head>' ||
  CASE s WHEN 12 THEN '<meta name="description" content="' || prose || '">'
    WHEN 30 THEN '<script type="application/ld+json">' || chr(123) || '"aggregateRating": ' || chr(123) || '"ratingValue": "4.5", "ratingCount": "' || CAST(k % 50 AS STRING) || '"' || chr(125) || chr(125) || '</script>'
    WHEN 35 THEN '<meta property="place:location:latitude" content="47.' || n || '"><meta property="place:location:longitude" content="-121.5">'
    WHEN 36 THEN '<meta name="ICBM" content="46.' || n || ', -120.25">'
    WHEN 38 THEN '<script type="application/ld+json">' || chr(123) || '"geo": ' || chr(123) || '"latitude": "45.' || n || '", "longitude": "-119.75"' || chr(125) || chr(125) || '</script>'
    ELSE '' END ||
  '</head><body><h1 class="documentFirstHeading">' || CASE s WHEN 14 THEN prose ELSE 'Path ' || n END || '</h1>' ||
  CASE s WHEN 0 THEN '<p>Length</p><p>' || CAST(1 + k % 20 AS STRING) || '.5 miles</p>'
    WHEN 1 THEN '<p>Gain</p><p>1,' || n || ' ft</p>'
    WHEN 2 THEN '<dl><dt>Highest Point</dt><dd>4,' || n || ' feet</dd></dl>'
    WHEN 3 THEN '<div class="hike-stat">High Point 5,' || n || ' ft</div>'
    WHEN 4 THEN '<p>Highpoint</p><p>6,' || n || ' ft</p>'
    WHEN 5 THEN '<img src="/p/' || n || '.jpg"><img src="/q.jpg">'
    WHEN 6 THEN '<div id="content-core"><p>' || prose || '</p></div>'
    WHEN 7 THEN '<p class="lead documentDescription">' || prose || '</p>'
    WHEN 8 THEN '<div class="hike-full-description">' || prose || '</div>'
    WHEN 9 THEN '<div class="hike-body">' || prose || '</div>'
    WHEN 10 THEN '<article>' || prose || '</article>'
    WHEN 11 THEN '<div class="documentByLine">' || prose || '</div>'
    WHEN 13 THEN '<div class="hike-body">' || prose || '</div><article>' || prose || ' Twice.</article>'
    WHEN 15 THEN '<span class="feature-tag">Gate ' || n || '</span>'
    WHEN 16 THEN '<ul class="feature-list"><li>Mill ' || n || '</li><li>Barn</li></ul>'
    WHEN 17 THEN '<div class="feature-badge">Barn ' || n || '</div>'
    WHEN 18 THEN '<div class="hike-feature">Fence ' || n || '</div>'
    WHEN 19 THEN '<dl><dt>Features</dt><dd>Dock ' || n || '</dd></dl>'
    WHEN 20 THEN '<div class="hike-features">Plain ' || n || '<br>Other</div>'
    WHEN 21 THEN '<div id="hike-features">Lone ' || n || '</div>'
    WHEN 22 THEN '<p>By the lake ' || n || '</p><p>No such word</p>'
    WHEN 23 THEN '<div class="stat">Calculated Difficulty: Hard ' || n || '</div>'
    WHEN 24 THEN '<ul class="hike-stats"><li>Calculated Difficulty <b>Moderate ' || n || '</b></li></ul>'
    WHEN 25 THEN '<button class="difficulty">Easy ' || n || '</button>'
    WHEN 26 THEN '<span class="difficulty-badge">Hard ' || n || '</span>'
    WHEN 27 THEN '<span aria-label="Difficulty level">Medium ' || n || '</span>'
    WHEN 28 THEN '<p>Calculated Difficulty: Steep ' || n || '</p>'
    WHEN 29 THEN '<p>Calculated Difficulty</p><p>Gentle ' || n || '</p>'
    WHEN 31 THEN '<i class="star filled"></i><i class="icon-star-full"></i><i class="star"></i>'
    WHEN 32 THEN '<b class="average-rating">2.5 of five</b>'
    WHEN 33 THEN '<p>Our rating: 4 stars so far</p>'
    WHEN 34 THEN '<i data-rating="1.5"></i><b class="num-votes">' || CAST(k % 90 AS STRING) || ' people</b>'
    WHEN 37 THEN '<div data-latitude="48.' || n || '" data-longitude="-120.5"></div>'
    WHEN 39 THEN '<p>Start at 47.' || n || ', -121.54321</p>'
    WHEN 40 THEN '<div><h2>Getting There</h2>Take road ' || n || ' to the gate.</div>'
    ELSE '' END || '</body></html>' AS html
FROM (SELECT p_partkey AS k, p_partkey % 41 AS s, CAST(100 + p_partkey % 900 AS STRING) AS n,
  'The gate beside the mill may stay shut all week, so visit ' || CAST(p_partkey AS STRING) || ' needs a call to the office first.' AS prose FROM {part}) p
""",
    "f_sitemap": "SELECT page_id AS pos, url FROM {pages}",
    # pages with a label are the known ones
    "f_state": """
SELECT url,
  CASE WHEN page_id % 5 = 0 THEN 'stale' ELSE 'h' || CAST(page_id AS STRING) END AS last_hash,
  CASE WHEN page_id % 7 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST((page_id * 37) % 20 AS INT) END AS last_crawled_at,
  CASE WHEN page_id % 11 = 0 THEN 0 ELSE 200 END AS last_status,
  CASE WHEN page_id % 11 = 0 THEN 'parse_failed_or_unreachable' ELSE NULL END AS last_error
FROM {pages} WHERE page_id IN (SELECT doc_id FROM {labels})
""",
    "f_crawled": """
SELECT 'wta_' || CAST(page_id AS STRING) AS id, url, 'h' || CAST(page_id AS STRING) AS new_hash, page_id % 13 = 0 AS parse_failed
FROM {pages}
""",
    "f_tracks": """
SELECT user_id AS feature_id, event_id AS pos,
  CAST(47 AS DOUBLE) + CAST(event_id % 97 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lat,
  CAST(-121 AS DOUBLE) + CAST(event_id % 89 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lng,
  CASE WHEN user_id % 10 = 3 AND event_id % 50 = 0 THEN NULL ELSE CAST(500 + (event_id * 31) % 240 AS DOUBLE) END AS elevation_m
FROM {events}
""",
    "f_ways": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN 'relation' ELSE 'way' END AS type, CAST(2 + c_custkey % 6 AS INT) AS n,
  CAST(45 AS DOUBLE) + CAST((c_custkey * 7919) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat0,
  CAST(-123 AS DOUBLE) + CAST((c_custkey * 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lng0,
  CAST(1 + c_custkey % 5 AS INT) AS rise,
  CASE c_custkey % 6 WHEN 0 THEN 'Customer ' || CAST(c_custkey AS STRING) || ' Trail' WHEN 1 THEN c_name WHEN 2 THEN 'Trail' ELSE NULL END AS osm_name,
  CASE c_custkey % 7 WHEN 0 THEN 'path' WHEN 1 THEN 'footway' WHEN 2 THEN 'track' WHEN 3 THEN 'bridleway' WHEN 4 THEN 'cycletrack' WHEN 5 THEN 'primary' ELSE 'path' END AS highway,
  CASE WHEN c_custkey % 11 = 0 THEN 'hiking' ELSE NULL END AS route,
  CASE WHEN c_custkey % 17 = 0 THEN 'private' WHEN c_custkey % 17 = 1 THEN 'yes' ELSE NULL END AS access,
  CASE c_custkey % 8 WHEN 0 THEN 'gravel' WHEN 1 THEN ' Dirt ' WHEN 2 THEN 'asphalt' WHEN 3 THEN 'wood' WHEN 4 THEN 'unknown' WHEN 5 THEN 'rock' ELSE NULL END AS surface,
  CASE WHEN c_custkey % 4 = 0 THEN 'hiking' ELSE NULL END AS sac_scale
FROM {customer}
""",
    "f_trailheads": """
SELECT p_partkey AS trail_id, CASE WHEN p_partkey % 3 = 2 THEN 'Trail' ELSE 'Customer ' || CAST(p_partkey AS STRING) END AS name,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(45 AS DOUBLE) + CAST((p_partkey * 7919) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE) - CAST(p_partkey % 30 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS lat,
  CAST(-123 AS DOUBLE) + CAST((p_partkey * 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lng,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / CAST(20 AS DOUBLE) END AS distance_mi
FROM {part}
""",
    # ways laid end to end, five a chain (its number the key of its first one): ends together, 2 m or 40 m apart, or a chain broken after the third; every third way backwards
    "f_chain_ways": """
SELECT c_custkey AS id, 'way' AS type, CAST(3 + (c_custkey - c_custkey % 5) % 3 AS INT) AS n,
  CAST(45 AS DOUBLE) + CAST(((c_custkey - c_custkey % 5) * 7919) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE)
    + CAST((c_custkey % 5) * (2 + (c_custkey - c_custkey % 5) % 3) * (1 + (c_custkey - c_custkey % 5) % 2) AS DOUBLE) / CAST(2500 AS DOUBLE)
    + CAST(c_custkey % 5 AS DOUBLE) * CASE (c_custkey - c_custkey % 5) % 4 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST(2 AS DOUBLE) WHEN 2 THEN CAST(36 AS DOUBLE)
      ELSE CASE WHEN c_custkey % 5 >= 3 THEN CAST(300 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END / CAST(100000 AS DOUBLE) AS lat0,
  CAST(-123 AS DOUBLE) + CAST(((c_custkey - c_custkey % 5) * 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)
    + CAST((c_custkey % 5) * (2 + (c_custkey - c_custkey % 5) % 3) AS DOUBLE) / CAST(4000 AS DOUBLE) AS lng0,
  CAST(1 + (c_custkey - c_custkey % 5) % 2 AS INT) AS rise, c_custkey % 3 = 1 AS back,
  CASE WHEN c_custkey % 5 = 0 THEN 'Chain ' || CAST(c_custkey - c_custkey % 5 AS STRING) || ' Trail' ELSE NULL END AS osm_name,
  CASE c_custkey % 4 WHEN 0 THEN 'footway' ELSE 'path' END AS highway, CAST(NULL AS STRING) AS route, CAST(NULL AS STRING) AS access,
  CASE c_custkey % 4 WHEN 0 THEN 'gravel' WHEN 1 THEN ' Dirt ' WHEN 2 THEN 'asphalt' ELSE NULL END AS surface,
  CASE WHEN c_custkey % 7 = 0 THEN 'hiking' ELSE NULL END AS sac_scale
FROM {customer}
""",
    "f_chain_heads": """
SELECT p_partkey AS trail_id, CASE WHEN p_partkey % 4 = 3 THEN 'Nowhere' ELSE 'Chain ' || CAST(p_partkey % 290 * 5 AS STRING) END AS name,
  CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST(45 AS DOUBLE) + CAST(((p_partkey % 290 * 5) * 7919) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE)
    - CAST(p_partkey % 5 AS DOUBLE) / CAST(3000 AS DOUBLE) END AS lat,
  CAST(-123 AS DOUBLE) + CAST(((p_partkey % 290 * 5) * 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lng,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / CAST(40 AS DOUBLE) END AS distance_mi
FROM {part}
""",
    "f_runs": """
SELECT 'run_' || CAST(CAST(ts AS DATE) AS STRING) AS run_id, CAST(ts AS DATE) AS started_at, CAST(count(*) AS INT) AS row_count,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS INT) AS failed_urls,
  CASE WHEN max(EXTRACT(DAY FROM CAST(ts AS DATE))) % 6 = 0 THEN 'failed' ELSE 'success' END AS status
FROM {events} GROUP BY CAST(ts AS DATE)
""",
    "f_target": """
SELECT o_orderkey AS id, o_orderstatus AS a, o_orderpriority AS kept,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'v2' ELSE 'v1' END AS dataset_version FROM {orders}
""",
    # finished orders are the changed ones; some arrive under new ids
    "f_updates": """
SELECT o_orderkey + CASE WHEN o_orderkey % 10 = 0 THEN 100000000000 ELSE 0 END AS id,
  CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE 'U' END AS a
FROM {orders} WHERE o_orderstatus = 'F'
""",
    # a trail export as text, names of the columns as in older exports for some rows
    "f_export": """
SELECT 'wta_' || CAST(p_partkey AS STRING) AS id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'u/' || CAST(p_partkey AS STRING) END AS source_url,
  'old/' || CAST(p_partkey AS STRING) AS url,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '0' WHEN 3 THEN 'abc' ELSE '47.25' END AS trailhead_lat,
  '46.5' AS lat, CASE p_partkey % 3 WHEN 0 THEN '-121.75' ELSE NULL END AS longitude,
  CASE p_partkey % 4 WHEN 0 THEN '0' WHEN 1 THEN 'n/a' WHEN 2 THEN CAST(p_size AS STRING) || '.5' ELSE '' END AS distance,
  CASE p_partkey % 7 WHEN 0 THEN NULL ELSE '3.25' END AS wta_distance_mi,
  CASE p_partkey % 6 WHEN 0 THEN '12.9' WHEN 1 THEN '-7.9' WHEN 2 THEN '' WHEN 3 THEN '0' ELSE CAST(p_size * 10 AS STRING) END AS elevation,
  '1500' AS wta_gain_ft
FROM {part}
""",
}


#: Fixtures whose rows are far wider, and dearer to read, than the rows they are made of.
PAGES_OF_ROWS = {"f_trail_pages", "f_step_pages"}
#: Fixtures whose rows become lines and digests of lines.
LINES_OF_ROWS = {"f_ways", "f_trailheads", "f_chain_ways", "f_chain_heads"}


def _names(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a fixture."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = FIXTURES[name]
    made_of = {n: load(spark, sf_dir, n) for n in _names(text)}
    if name in PAGES_OF_ROWS | LINES_OF_ROWS:
        # a file of narrow rows is one split; dealt out before pages or lines are made of them, since those are costlier to move
        count = 3 * spark.sparkContext.defaultParallelism
        made_of = {n: df.repartition(count) for n, df in made_of.items()}
    return spark.sql(text, **made_of)


def with_fixtures(sql: str) -> str:
    """DuckDB text of a check query: ``{fixture}`` names become common table expressions."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in _names(text):
            if n in FIXTURES and n not in order:
                need(FIXTURES[n])
                order.append(n)

    need(sql)
    known = "|".join([*FIXTURES, *TABLES])
    plain = lambda text: re.sub(rf"\{{({known})\}}", r"\1", text)
    head = ", ".join(f"{n} AS ({plain(FIXTURES[n])})" for n in order)
    body = plain(sql).strip()
    if not head:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {head}, {body[len('WITH'):]}"
    return f"WITH {head} {body}"
