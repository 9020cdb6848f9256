"""Nothing is lost: batches of several streams, addresses with one slug, failed pages, rows without an order."""

import json

import pytest
from pyspark.sql import functions as F

from switchback import schemas as S
from switchback.operators import state as ST
from switchback.operators import urls as U
from switchback.plans.weekly import RunParams, latest_pages, weekly_job
from switchback.sources import readers as RD
from switchback.sources import writers as W
from switchback.streaming.landing import run_landed
from tests.test_jobs import BASE, START, inputs, page


def test_two_streams_into_one_store(spark, tmp_path):
    store = str(tmp_path / "store")
    _, _, features = inputs(spark, {"a": ""})
    for name, title in (("one", "Alpha"), ("two", "Beta")):
        landing = str(tmp_path / name)
        spark.createDataFrame([(BASE + name, page(title), 200)], S.PAGE).write.parquet(landing)
        run_landed(spark, landing, store, str(tmp_path / f"mark-{name}"), lambda: features, lambda: None).awaitTermination()
    assert W.open_store(spark, store) is not None
    assert sorted(r["name"] for r in spark.table("trails").collect()) == ["Alpha", "Beta"]
    assert spark.table("pipeline_runs").count() == 2


def test_same_slug_and_failed_status(spark, tmp_path):
    store = str(tmp_path / "store")
    urls = [BASE + "x/lake", BASE + "y/lake", BASE + "gone"]
    sitemap = spark.createDataFrame(list(enumerate(urls)), "pos bigint, url string")
    rows = [(urls[0], page("First"), 200), (urls[1], page("Second"), 200), (urls[2], page("Not found"), 404)]
    _, _, features = inputs(spark, {"a": ""})
    stats = weekly_job(spark, store, sitemap, spark.createDataFrame(rows, S.PAGE), features, None, RunParams.at(START, "x"))
    assert (stats["crawled_rows"], stats["failed_urls"]) == (2, 1)
    version = W.open_store(spark, store)
    assert version and [r["name"] for r in spark.table("trails").collect()] == ["First"]
    state = {r["url"]: r["last_status"] for r in spark.table("crawl_state").collect()}
    assert state == {urls[0]: 200, urls[1]: 200, urls[2]: 0}


def test_last_landing_wins_and_missing_status_is_a_choice(spark):
    rows = [("u", "old", 200, 1), ("u", "new", 200, 2), ("u", "error", 500, 3), ("v", "x", None, 1)]
    pages = spark.createDataFrame(rows, "url string, html string, status int, landed_at int")
    assert {tuple(r) for r in latest_pages(pages).collect()} == {("u", "new"), ("v", "x")}
    assert {tuple(r) for r in latest_pages(pages, null_status_ok=False).collect()} == {("u", "new")}


def test_first_rows_with_missing_orders_and_ties(spark):
    rows = [("a", None, "only"), ("b", 1, "y"), ("b", 1, "x"), ("b", None, "z"), (None, 2, "w")]
    for order in (rows, rows[::-1]):
        got = U.dedupe_first(spark.createDataFrame(order, "k string, o int, v string"), "k", "o")
        assert {tuple(r) for r in got.collect()} == {("a", None, "only"), ("b", 1, "x"), (None, 2, "w")}


def test_answers_in_any_layout(spark, tmp_path):
    answer = {"elements": [{"type": "way", "id": 1, "tags": {"highway": "path"}, "geometry": [{"lat": 1.0, "lon": 2.0}]}]}
    (tmp_path / "many.json").write_text(json.dumps(answer, indent=2))
    (tmp_path / "lines.json").write_text(json.dumps(answer) + "\n" + json.dumps(answer) + "\n")
    (tmp_path / "broken.json").write_text('{"elements": [')
    assert RD.read_osm(spark, str(tmp_path)).count() == 3
    bad = RD.unreadable_answers(RD.read_answers(spark, str(tmp_path))).collect()
    assert len(bad) == 1 and bad[0]["file"].endswith("broken.json") and bad[0]["unreadable"] == 1


def test_a_bad_line_loses_no_other_line(spark, tmp_path):
    of = lambda i: json.dumps({"elements": [{"type": "way", "id": i, "tags": {"highway": "path"}, "geometry": [{"lat": 1.0, "lon": 2.0}]}]})
    (tmp_path / "cut last.json").write_text("\n" + of(1) + "\n" + of(2) + "\n" + of(3)[:40])
    (tmp_path / "cut_first.json").write_text(of(4)[:40] + "\r\n" + of(5) + "\r\n\r\n" + of(6) + "\r\n")
    (tmp_path / "indented.json").write_text(json.dumps(json.loads(of(7)), indent=1))
    assert sorted(f["osm_id"] for f in RD.read_osm(spark, str(tmp_path)).collect()) == [1, 2, 5, 6, 7]
    bad = {r["file"].rsplit("/", 1)[1]: r["unreadable"] for r in RD.unreadable_answers(RD.read_answers(spark, str(tmp_path))).collect()}
    assert sorted(bad.values()) == [1, 1] and "indented.json" not in bad


def test_merge_leaves_a_large_target_where_it_is(spark, tmp_path):
    target = spark.range(1000).select(F.col("id"), F.lit("a").alias("v"))
    spark.createDataFrame([(5, "b"), (2000, "c")], "id bigint, v string").write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    merged = ST.upsert(target, source, ["id"], check=False)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter, BuildRight" in plan and "LeftSemi, BuildRight" in plan
    assert merged.count() == 1001 and merged.filter("v = 'b'").first()["id"] == 5


@pytest.mark.parametrize("html, want", [
    ('<a href="/go-hiking/hikes/a">', 1), ("<link href='/go-hiking/hikes/a'>", 0), ("<a data-href='/go-hiking/hikes/a'>", 0),
    ("<!-- <a href='/go-hiking/hikes/a'> -->", 0), ("<A class=x HREF=/go-hiking/hikes/a>", 1), ("<a title='href=/go-hiking/hikes/b' >", 0),
])
def test_links_are_anchors(spark, html, want):
    assert U.harvest_links(spark.createDataFrame([(1, html)], "page_no int, html string"), "https://site.example").count() == want
