import pytest

from switchback.operators import pages as P
from switchback.plans.listing import extract_trails, list_crawl

TITLE = '<h1 class="documentFirstHeading"> Blue <b>Lake</b></h1>'
LONG = "A long walk beside the water, " * 4


@pytest.fixture
def parse(spark):
    def run(*bodies, head=""):
        rows = [(f"https://site.example/go-hiking/hikes/p{i}/", f"<html><head>{head}</head><body>{b}</body></html>") for i, b in enumerate(bodies)]
        out = P.extract_pages(spark.createDataFrame(rows, "url string, html string")).collect()
        return {int(r["id"].removeprefix("wta_p")): r for r in out}

    return run


def test_name_and_rejects(spark, parse):
    got = parse(TITLE, "<h1>Other</h1>", '<h1 class="documentFirstHeading"> </h1>')
    assert list(got) == [0] and got[0]["name"] == "BlueLake"
    pages = spark.createDataFrame([("u/0", TITLE), ("u/1", "<p>x"), ("u/2", None)], "url string, html string")
    trails, failed = extract_trails(pages)
    assert [r["source_url"] for r in trails.collect()] == ["u/0"]
    assert sorted(r["url"] for r in failed.collect()) == ["u/1", "u/2"]


def test_stats(parse):
    got = parse(
        TITLE + "<dl><dt>Length</dt><dd>4.3 miles, roundtrip<dt>Elevation <b>Gain</b></dt><dd>1,200 ft</dd><dt>Highest Point</dt><dd>5,000 feet</dl>",
        TITLE + '<ul class="hike-stats"><li>Length: 2 miles, loop<li><b>gain</b> 900 feet</ul>',
        TITLE + "<p>Length</p><p>3.2 miles one-way</p><div>High Point<br>700 ft</div>",
        TITLE + "<dl><dt>Length</dt><dd></dd></dl><p>Length</p><p>9 miles</p>",
    )
    assert [(got[i]["distance"], got[i]["elevation"], got[i]["highest_point"], got[i]["route_type"]) for i in range(4)] == [
        (4.3, 1200, 5000, "roundtrip"), (2.0, 900, None, "loop"), (3.2, None, 700, "one-way"), (None, None, None, None),
    ]


def test_images(parse):
    assert parse(TITLE, head='<meta property="og:image" content="a.jpg">')[0]["image_url"] == "a.jpg"
    assert parse(TITLE + '<img src="b.jpg"><img src="c.jpg">')[0]["image_url"] == "b.jpg"


def test_description(parse):
    got = parse(
        TITLE + f'<article>{LONG}</article><div id="content-core">Print {LONG} more&nbsp;text</div>',
        TITLE + f"<article>{LONG}<script>var x = '</p>';</script><style>p{{}}</style></article>",
        TITLE + "<article>short</article>",
        head='<meta name="description" content="Email  a note">',
    )
    assert got[0]["description"] == (LONG + " more text").replace("  ", " ").strip()
    assert got[1]["description"] == LONG.strip()
    assert got[2]["description"] == "a note"


def test_features(parse):
    got = parse(
        TITLE + '<div class="hike-features"><span>Lakes</span><span>lakes</span><span>ok</span><span>Dogs</span></div><ul class="feature-list"><li>Summits</ul>',
        TITLE + "<dl><dt>Features</dt><dd>Rivers, <i>old growth</i></dd></dl>",
        TITLE + '<div id="hike-features">Views<br>Wildlife</div>',
        TITLE + "<p>bring your dog</p><!-- a waterfall --><script>lake</script>",
        '<h1 class="documentFirstHeading">Plain</h1><p>nothing',
    )
    assert [got[i]["raw_features"] for i in range(5)] == ["Lakes, Dogs, Summits", "Rivers, old growth", "Views, Wildlife", "Lake, bring your dog, a waterfall", None]


def test_difficulty_label(parse):
    got = parse(
        TITLE + "<dl><dt>Calculated Difficulty</dt><dd>http://x</dd><dt>calculated  difficulty</dt><dd>Easy/Moderate</dd></dl>",
        TITLE + '<div class="stat">Calculated Difficulty: Hard</div>',
        TITLE + '<button class="difficulty">Moderate</button>',
        TITLE + '<span aria-label="Difficulty level">Easy</span>',
        TITLE + "<p>Calculated Difficulty</p><p>Hard</p>",
        TITLE + "<p>Calculated Difficulty: Moderate/Hard</p>",
        TITLE,
    )
    assert [got[i]["calculated_difficulty"] for i in range(7)] == ["Easy/Moderate", "Hard", "Moderate", "Easy", "Hard", "Moderate/Hard", None]


def test_ratings(parse):
    data = lambda text: f'<script type="application/ld+json">{text}</script>'
    got = parse(
        TITLE + data('{"aggregateRating": {"ratingValue": "4.2", "reviewCount": 31}}') + '<i aria-label="1 star"></i>',
        TITLE + data('[{"aggregateRating": {"ratingValue": 3}}]') + '<i aria-label="4 out of 5 stars"></i><i aria-label="4.5 stars"></i> (123 votes)',
        TITLE + '<i data-rating="2.5"></i><p class="vote-count">1,234 votes</p>',
        TITLE + '<i class="star filled"></i><i class="star"></i><i class="star-filled"></i>',
        TITLE + '<i class="rating-value">7</i><p>User rating 9 stars</p><p>Rating: 3.5 out of 5</p>',
        TITLE + "(5 ratings)",
        TITLE + data("{broken"),
    )
    assert [(got[i]["rating"], got[i]["num_votes"]) for i in range(7)] == [
        (4.2, 31), (4.5, 123), (2.5, 1), (2.0, 0), (3.5, 0), (None, 5), (None, None),
    ]


def test_coordinates(parse):
    data = lambda text: f'<script type="application/ld+json">{text}</script>'
    got = parse(
        TITLE + '<i data-lat="47.1" data-lng="-121.1"></i>' + data('{"geo": {"latitude": 1, "longitude": 2}}'),
        TITLE + '<i data-lat="x" data-lng="-121.1"></i>' + data('[{"a": 1}, {"geo": {"latitude": "47.2", "longitude": -121.2}}]'),
        TITLE + '<script>var a = {"lat": 47.3, lng = -121.3}</script>',
        TITLE + "<p>park at 47.4444, -121.4444 or 48.5, -121.5</p>",
        TITLE + "<p>47.44, -121.44</p>",
    )
    assert [(got[i]["latitude"], got[i]["longitude"]) for i in range(5)] == [(47.1, -121.1), (47.2, -121.2), (47.3, -121.3), (47.4444, -121.4444), (None, None)]
    place = '<meta property="place:location:latitude" content="46.5"><meta property="place:location:longitude" content="-120.5">'
    assert parse(TITLE, head=place)[0]["latitude"] == 46.5
    assert parse(TITLE, head='<meta name="geo.position" content="46.25;-120.5">')[0]["longitude"] == -120.5
    assert parse(TITLE, head='<meta name="ICBM" content="46, -120">')[0]["latitude"] is None
    assert parse(TITLE, head='<meta name="ICBM" content="46.125, -120.5">')[0]["latitude"] == 46.125


def test_parking(parse):
    got = parse(
        TITLE + '<div id="hike-getting-there"><h2>Getting There</h2>Small parking lot. Print Discover Pass required.</div>',
        TITLE + "<div><h3>Getting there</h3><p>Ample parking, no fee.</div><p>After",
        TITLE,
    )
    assert got[0]["parking"] == "Getting There Small parking lot. Discover Pass required."
    assert (got[0]["parking_tags"], got[0]["parking_status"]) == (["Limited", "Permit"], "Permit")
    assert (got[1]["parking"], got[1]["parking_tags"]) == ("Getting there Ample parking, no fee.", ["Easy", "Paid"])
    assert (got[2]["parking"], got[2]["parking_tags"], got[2]["parking_status"]) == (None, [], None)


def test_listing_order_and_limit(spark):
    link = lambda p: f'<a href="/go-hiking/hikes/{p}">x</a>'
    lists = [(1, link("b/?q=1") + link("") + link("a#top") + "<a href='/other'>"), (2, link("a") + link("c"))]
    pages = [(f"https://site.example/go-hiking/hikes/{p}", f'<h1 class="documentFirstHeading">{p}</h1>') for p in "abcd"]
    run = lambda n: list_crawl(
        spark.createDataFrame(lists, "page_no int, html string"), spark.createDataFrame(pages, "url string, html string"), "https://site.example", n
    )
    assert [r["name"] for r in run(2).collect()] == ["b", "a"]
    assert [r["id"] for r in run(9).collect()] == ["wta_b", "wta_a", "wta_c"]


def test_a_limited_list_crawl_parses_the_first_pages_only(spark, monkeypatch):
    from switchback.plans import listing

    link = lambda p: f'<a href="/go-hiking/hikes/{p}">x</a>'
    # the first pages give no trail, one id comes under two addresses, the later one first in the alphabet
    names = ["x/empty", "y/empty", "z/same", "a/same"] + [f"n{i:03d}" for i in range(200)]
    lists = [(1, "".join(map(link, names[:50]))), (2, "".join(map(link, names[50:])))]
    pages = [(f"https://site.example/go-hiking/hikes/{p}", "<p>none" if "empty" in p else f'<h1 class="documentFirstHeading">{p}</h1>') for p in names]
    read, extract = [], listing.extract_pages
    monkeypatch.setattr(listing, "extract_pages", lambda p, c: (read.append(p.count()), extract(p, c))[1])
    run = lambda n: [r["name"] for r in list_crawl(
        spark.createDataFrame(lists, "page_no int, html string"), spark.createDataFrame(pages, "url string, html string"), "https://site.example", n
    ).collect()]
    assert run(3) == ["z/same", "n000", "n001"] and read == [3, 12]
    assert run(500) == ["z/same"] + names[4:]
