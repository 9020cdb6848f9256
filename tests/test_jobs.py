import gzip
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from switchback import schemas as S
from switchback.operators import matching as MT
from switchback.operators import state as ST
from switchback.operators import urls as U
from switchback.plans.enrich import enrich_export, enrich_file
from switchback.plans.weekly import RunParams, weekly_job
from switchback.sources import readers as RD
from switchback.sources import writers as W
from switchback.streaming.landing import run_landed

BASE = "https://site.example/go-hiking/hikes/"
START = datetime(2024, 5, 1, 12, 0, 0, tzinfo=timezone.utc)


def page(name, note=""):
    return (
        f'<h1 class="documentFirstHeading">{name}</h1><dl><dt>Length</dt><dd>2 miles, loop</dd><dt>Gain</dt><dd>900 ft</dd>'
        f'<dt>Calculated Difficulty</dt><dd>Easy</dd></dl><i data-lat="46.0" data-lng="-121.0"></i><article>{"A rocky path. " * 8}{note}</article>'
    )


def inputs(spark, pages):
    sitemap = spark.createDataFrame([(i, BASE + n) for i, n in enumerate([*"abcde", "overview"])] + [(9, "https://site.example/x")], "pos bigint, url string")
    landed = spark.createDataFrame([(BASE + n, h, 200) for n, h in pages.items()], S.PAGE)
    line = [{"lat": 46.0 + i * 0.001, "lon": -121.0} for i in range(9)]
    features = MT.read_features(spark.createDataFrame([("way", 7, {"highway": "path", "name": "Alpha", "surface": "gravel"}, line, None)], S.MAP_ELEMENT))
    return sitemap, landed, features


def run(spark, store, pages, week, tag="x", **options):
    sitemap, landed, features = inputs(spark, pages)
    return weekly_job(spark, store, sitemap, landed, features, None, RunParams.at(START + timedelta(days=7 * week), tag, **options))


def test_weekly_runs(spark, tmp_path):
    store = str(tmp_path / "store")
    pages = {"a": page("Alpha"), "b": page("Beta"), "c": "<p>no title"}
    first = run(spark, store, pages, 0, max_pages=3)
    assert {k: first[k] for k in ("sitemap_hike_urls", "to_crawl", "crawled_rows", "failed_urls", "changed_rows", "remaining_uncrawled")} == {
        "sitemap_hike_urls": 5, "to_crawl": 3, "crawled_rows": 2, "failed_urls": 1, "changed_rows": 2, "remaining_uncrawled": 3,
    }
    # next week: d and e were never seen, then the one crawled longest ago
    second = run(spark, store, {**pages, "d": page("Delta"), "a": page("Alpha")}, 1, max_pages=3)
    assert (second["to_crawl"], second["crawled_rows"], second["failed_urls"], second["changed_rows"]) == (3, 2, 1, 1)
    # nothing new: only versions move
    third = run(spark, store, {**pages, "d": page("Delta")}, 2, max_pages=10)
    assert (third["changed_rows"], third["dataset_version_marked_rows"]) == (0, 3)
    fourth = run(spark, store, {**pages, "b": page("Beta", "closed"), "d": page("Delta")}, 3, max_pages=10)
    assert fourth["changed_rows"] == 1

    version = W.current_version(spark, store)
    assert version == "20240522T120000Z"
    trails = {r["id"]: r for r in W.read_current(spark, store, "trails", S.store_schema(), version).collect()}
    assert sorted(trails) == ["wta_a", "wta_b", "wta_d"] and {r["dataset_version"] for r in trails.values()} == {version}
    a = trails["wta_a"]
    assert (a["osm_id"], a["surface_primary"], a["trailhead_lat"], a["elevation"]) == (7, "Gravel", 46.0, 900)
    assert a["difficulty_score_0_10"] is not None and a["trail_runnable_pct"] is not None
    assert trails["wta_b"]["description"].endswith("closed")
    state = {r["url"]: r for r in W.read_current(spark, store, "crawl_state", S.CRAWL_STATE, version).collect()}
    assert len(state) == 5 and state[BASE + "c"]["last_error"] == "parse_failed_or_unreachable"
    log = {r["run_id"]: r for r in W.read_runs(spark, store).collect()}
    assert [log[k]["notes"] for k in sorted(log)] == ["", "", "no_changed_rows", ""]
    versions = W.read_current(spark, store, "dataset_versions", S.DATASET_VERSIONS, version)
    assert versions.count() == 4

    # a version that is not newer would overwrite what readers use
    with pytest.raises(ValueError):
        run(spark, store, pages, 3, tag="again")


def test_failed_run_leaves_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    run(spark, store, {"a": page("Alpha")}, 0)
    sitemap, landed, _ = inputs(spark, {"a": page("Alpha", "new")})
    with pytest.raises(Exception):
        weekly_job(spark, store, sitemap, landed, landed, None, RunParams.at(START + timedelta(days=7), "bad"))
    assert W.current_version(spark, store) == "20240501T120000Z"
    failed = W.read_runs(spark, store).filter("status = 'failed'").first()
    assert failed["notes"] == "exception" and "error" in failed["stats"]
    assert run(spark, store, {"a": page("Alpha", "new")}, 2)["changed_rows"] == 1


def test_landing_stream(spark, tmp_path):
    landing, store, mark = (str(tmp_path / n) for n in ("landing", "store", "mark"))
    _, _, features = inputs(spark, {"a": ""})

    def land(pages):
        spark.createDataFrame([(BASE + n, h, 200) for n, h in pages.items()], S.PAGE).coalesce(1).write.mode("append").parquet(landing)
        run_landed(spark, landing, store, mark, lambda: features, lambda: None).awaitTermination()

    land({"a": page("Alpha"), "c": page("Gamma")})
    trails = W.read_current(spark, store, "trails", S.store_schema(), W.current_version(spark, store))
    assert sorted(r["name"] for r in trails.collect()) == ["Alpha", "Gamma"]
    run_landed(spark, landing, store, mark, lambda: features, lambda: None).awaitTermination()  # nothing new
    assert W.read_runs(spark, store).count() == 1


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "k1"), (2, "b", "k2")], "id int, v string, kept string")
    source = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, v string, extra int")
    once = ST.upsert(target, source, ["id"])
    assert sorted(map(tuple, once.select("id", "v", "kept", "extra").collect()), key=lambda r: r[0]) == [(1, "a", "k1", None), (2, None, "k2", 5), (3, "c", None, 6)]
    assert sorted(ST.upsert(once, source, ["id"]).collect()) == sorted(once.collect())
    assert ST.upsert(target, source, ["id"], null_overwrites=False).filter("id = 2").first()["v"] == "b"
    with pytest.raises(ValueError):
        ST.upsert(target, source.union(source), ["id"])


def test_pages_that_share_an_address_all_get_state_rows(spark, tmp_path):
    pages = [(1, "https://a"), (2, "https://a"), (13, "https://a"), (4, "https://b"), (5, "https://c"), (6, None)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(1,), (2,), (5,)], "doc_id long").write.parquet(str(tmp_path / "labels.parquet"))
    got = entry.queries()["state_upsert"](spark, str(tmp_path)).collect()
    # the failed page 13 meets both state rows of its address
    assert sorted((r["url"] or "", r["last_hash"]) for r in got) == [
        ("", "h6"), ("https://a", "h1"), ("https://a", "h1"), ("https://a", "h2"), ("https://a", "h2"), ("https://b", "h4"), ("https://c", "h5"),
    ]


def test_replacing_keeps_the_other_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    source = spark.createDataFrame([(None, 2), ("c", 3)], "v string, id int")
    got = ST.replace_rows(target, source, ["id"])
    assert got.columns == ["id", "v"] and {tuple(r) for r in got.collect()} == {(1, "a"), (2, None), (3, "c"), (None, "n")}


def test_stamp_twice(spark):
    df = spark.createDataFrame([(1, None), (2, "old"), (3, "v")], "id int, dataset_version string")
    stamped, marked = ST.stamp_version(df, "v")
    assert marked.first()[0] == 2 and ST.stamp_version(stamped, "v")[1].first()[0] == 0


def test_frontier(spark):
    urls = spark.createDataFrame(list(enumerate(["s1", "n1", "s2", "s3", "n2", "n1"])), "pos bigint, url string")
    day = lambda d: datetime(2024, 1, d)
    state = spark.createDataFrame([("s1", day(3)), ("s2", None), ("s3", day(2))], "url string, last_crawled_at timestamp")
    order = ["n1", "n2", "n1", "s2", "s3", "s1"]
    for k in (2, 4, 6, 9):
        assert [r["url"] for r in U.select_frontier(urls, state, k).collect()] == order[:k]
    assert "TakeOrdered" in U.select_frontier(urls, state, 3)._jdf.queryExecution().executedPlan().toString()
    assert U.select_frontier(urls, state, None).count() == 6
    assert U.frontier_stats(urls, state).first().asDict() == {"listed": 6, "known_urls": 3, "never": 3}


def test_links_and_offsets(spark):
    html = '<a href="/go-hiking/hikes/">i</a><a href="/go-hiking/hikes/?x">i</a><a href=" https://o.example/go-hiking/hikes/z/#f">z</a>'
    got = U.harvest_links(spark.createDataFrame([(1, html)], "page_no int, html string"), "https://site.example").collect()
    assert {r["url"] for r in got} == {"https://site.example/go-hiking/hikes", "https://o.example/go-hiking/hikes/z"}
    assert [tuple(r) for r in U.page_offsets(spark, 0, 3).collect()] == [(1, 0), (2, 30), (3, 60)]
    views = spark.createDataFrame([(BASE + "lakeview",), (BASE + "lake/",), ("https://site.example/",)], "url string")
    assert [r["url"] for r in U.filter_urls(views).collect()] == [BASE + "lake/"]


def test_files(spark, tmp_path):
    text = "<urlset><url><loc>u1</loc></url>\n<url><loc>u2</loc></url><loc>u1</loc></urlset>"
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(text.encode()))
    got = RD.read_sitemap(spark, str(tmp_path / "s.xml.gz")).orderBy("pos").collect()
    assert [(r["pos"], r["url"]) for r in got] == [(0, "u1"), (1, "u2"), (2, "u1")]

    (tmp_path / "t.csv").write_text('id,name,lat,longitude,distance,wta_distance_mi,elevation\n1,"Two\nlines, ""q""",46.5,-121,0,3.5,12.9\n2,B,x,,n/a,,\n')
    rows = {r["id"]: r for r in RD.read_trails_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert (rows["1"]["name"], rows["1"]["trailhead_lat"], rows["1"]["trailhead_lng"], rows["1"]["wta_distance_mi"], rows["1"]["wta_gain_ft"]) == ('Two\nlines, "q"', 46.5, -121.0, 3.5, 12)
    assert (rows["2"]["trailhead_lat"], rows["2"]["wta_distance_mi"]) == (None, None)

    answer = {"elements": [{"type": "way", "id": 5000000000, "tags": {"name": "W"}, "geometry": [{"lat": 1.5, "lon": 2.5}, {"lat": 1.6}]}]}
    (tmp_path / "o.json").write_text(json.dumps(answer) + "\n{broken\n")
    feature = RD.read_osm(spark, str(tmp_path / "o.json")).collect()
    assert [(f["osm_id"], f["tags"]["name"], len(f["points"])) for f in feature] == [(5000000000, "W", 1)]

    df = spark.createDataFrame([(1, ["a", "b"], None, "é"), (2, [], 1.5, "x")], "id int, tags array<string>, v double, t string").coalesce(1)
    W.write_trails_csv(df, str(tmp_path / "out_csv"))
    lines = sorted(x for f in (tmp_path / "out_csv").glob("*.csv") for x in f.read_text().splitlines())
    assert lines == ['1,"a,b",,é', "2,,1.5,x", "id,tags,v,t"]
    W.write_trails_json(df, str(tmp_path / "out_json"))
    records = [json.loads(x) for f in (tmp_path / "out_json").glob("*.json") for x in f.read_text().splitlines()]
    assert records[0] == {"id": 1, "tags": ["a", "b"], "v": None, "t": "é"}


def test_export_enrichment_keeps_all_rows(spark):
    _, _, features = inputs(spark, {"a": ""})
    rows = [("1", "Alpha", "u", 46.0, -121.0, "", 1.0, 100), ("2", "", "u", 46.0, -121.0, "", 1.0, 100)]
    got = {r["id"]: r for r in enrich_export(spark.createDataFrame(rows, S.EXPORT), features).collect()}
    assert got["1"]["osm_id"] == 7 and got["1"]["match_confidence"] > 0.7 and got["2"]["match_confidence"] is None


def test_enrichment_from_file_to_files(spark, tmp_path):
    _, _, features = inputs(spark, {"a": ""})
    (tmp_path / "t.csv").write_text("id,name,lat,longitude,distance\n3,Later,46,-121,1\n1,Alpha,46,-121,1\n2, spaced ,x,,\n")
    made = enrich_file(spark, str(tmp_path / "t.csv"), features, str(tmp_path / "out"), limit=2)
    assert sorted(r["id"] for r in made.collect()) == ["1", "2"]
    back = {r["id"]: r for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "csv")).collect()}
    assert back["1"]["osm_id"] == "7" and back["2"]["osm_id"] is None
    records = {x["id"]: x for x in (json.loads(line) for f in (tmp_path / "out" / "json").glob("*.json") for line in f.read_text().splitlines())}
    assert records["1"]["osm_id"] == 7 and records["2"]["match_confidence"] is None and len(records) == 2


def test_sanitize_and_schema(spark):
    df = spark.createDataFrame([(1.9, 5e9, float("nan"), 1.0)], "rank double, osm_id double, x double, grade_p95 double")
    assert tuple(ST.sanitize(df).first())[:3] == (1, 5000000000, None)
    shaped = ST.conform_schema(df, S.record(id=S.TEXT, rank=S.INT))
    assert shaped.columns == ["id", "rank", "osm_id", "x"]
    assert "trailhead_lat" in S.store_schema().names and "parking" not in S.store_schema().names
    one = spark.createDataFrame([(1, None)], "b int, a string")
    assert one.select(ST.row_hash(one)).first()[0] == one.select(F.sha2(F.lit('{"a":null,"b":1}'), 256)).first()[0]
