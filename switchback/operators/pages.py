"""Landed pages to trail columns.

Each page is parsed once into arrays of its own row; every field below is an
expression over those arrays, so the whole extraction is one narrow stage.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions import markup as M
from switchback.functions import text as X
from switchback.functions.values import blank_to_null, falsy, strip
from switchback.operators.urls import slug_id

_LINKED_DATA = (
    "array<struct<geo:struct<latitude:string,longitude:string>,"
    "aggregateRating:struct<ratingValue:string,ratingCount:string,reviewCount:string>>>"
)
_PLACE = "struct<lat:double,lng:double>"


def heading(html: Column, heading_class: str | None = V.HEADING_CLASS) -> Column:
    """Title text by pattern, without parsing the page: tags removed, NULL when there is none."""
    mark = rf"""[^>]*\bclass\s*=\s*["'][^"']*\b{heading_class}\b[^"']*["']""" if heading_class else ""
    found = F.regexp_extract(html, rf"(?is)<h1\b{mark}[^>]*>(.*?)</h1>", 1)
    return blank_to_null(strip(F.regexp_replace(found, r"(?s)\s*<[^>]*>\s*", "")))


def split_pages(pages: DataFrame, named: Column) -> tuple[DataFrame, DataFrame]:
    """Pages that yield a trail, and the addresses of those that do not."""
    fine = F.col("html").isNotNull() & (F.col("html") != "") & F.coalesce(named, F.lit(False))
    return pages.filter(fine), pages.filter(~fine).select("url")


def failed_urls(pages: DataFrame, trails: DataFrame) -> DataFrame:
    """Requested addresses without an extracted trail."""
    done = trails.select(F.col("source_url").alias("url"))
    return pages.select("url").join(done, "url", "left_anti")


def feature_list(texts: Column, max_len: int = V.FEATURE_MAX_LEN, n: int = V.FEATURE_MAX_COUNT) -> Column:
    """First ``n`` short entries, letter case aside each once, as one text; NULL when there are none."""
    def listed(both: Column) -> Column:
        lowered = both["lowered"]
        keys = F.slice(F.array_distinct(lowered), 1, n)
        kept = F.transform(keys, lambda k: F.get(both["short"], (F.array_position(lowered, k) - 1).cast("int")))
        return F.array_join(kept, ", ")

    # each array is made once for a page, not once for each of its entries
    short = F.filter(texts, lambda t: F.length(t) < max_len)
    both = M.let(short, lambda s: F.struct(s.alias("short"), F.transform(s, lambda t: F.lower(t)).alias("lowered")))
    return blank_to_null(M.let(both, listed))


# ---- shared parts of a page ---------------------------------------------------


def with_outline(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds the parsed arrays and the page-wide texts the field expressions share."""
    parsed = pages.withColumn("_nodes", M.page_nodes(F.col(html))).select("*", "_nodes.elements", "_nodes.visible", "_nodes.texts").drop("_nodes")
    return parsed.withColumns(_shared_parts())


@cache
def _shared_parts() -> dict[str, Column]:
    """Built once per process; the expressions name columns, not a DataFrame."""
    elements, visible = F.col("elements"), F.col("visible")
    dts = F.filter(elements, lambda e: (e["tag"] == "dt") & e["dd_first"].isNotNull())

    def labelled(dt: Column) -> Column:
        value = F.slice(visible, dt["dd_first"] + 1, dt["dd_n"])
        return F.struct(
            F.lower(M.text_at(dt["first"], dt["n"], visible)).alias("label"),
            F.array_join(value, " ").alias("value"),
            F.array_join(value, "").alias("tight"),
        )

    def stat_texts(found: Column) -> Column:
        return F.transform(found, lambda e: M.text_at(e["first"], e["n"], visible))

    listed, single = M.under(elements, "hike-stats", "li"), F.filter(elements, lambda e: M.has_class(e, "hike-stat"))
    scripts = F.filter(elements, lambda e: (e["tag"] == "script") & e["text"].isNotNull())
    linked = F.filter(scripts, lambda e: F.coalesce(M.attr(e, "type") == "application/ld+json", F.lit(False)))
    return {
        "definitions": F.transform(dts, labelled),
        "stat_blocks": stat_texts(F.when(F.size(listed) > 0, listed).otherwise(single)),
        "page_text": F.array_join(visible, " "),
        "page_lines": F.split(F.array_join(visible, "\n"), "\n"),
        "scripts": F.transform(scripts, lambda e: e["text"]),
        "linked_data": F.transform(linked, lambda e: e["text"]),
    }


def _first_of(*choices: Column) -> Column:
    """First non-empty array."""
    out = choices[-1]
    for c in reversed(choices[:-1]):
        out = F.when(F.size(c) > 0, c).otherwise(out)
    return out


def _by_class(*names: str) -> Column:
    """First element of the first class that occurs at all."""
    def of(name: str) -> Column:
        return M.first(F.filter("elements", lambda e: M.has_class(e, name)))

    return F.coalesce(*[of(name) for name in names])


def _meta(key: str, value: str) -> Column:
    found = M.first(F.filter("elements", lambda e: (e["tag"] == "meta") & F.coalesce(M.attr(e, key) == value, F.lit(False))))
    return blank_to_null(M.attr(found, "content"))


# ---- fields -----------------------------------------------------------------------


def page_name(heading_class: str | None = V.HEADING_CLASS) -> Column:
    def is_title(e: Column) -> Column:
        h1 = e["tag"] == "h1"
        return h1 & M.has_class(e, heading_class) if heading_class else h1

    return blank_to_null(M.text_of(M.first(F.filter("elements", is_title)), F.col("visible"), ""))


def stat(*labels: str) -> Column:
    """Value next to a label: definition list, then stat blocks, then the line after the label.

    With several labels, the first that gives any text.
    """

    def one(label: str) -> Column:
        word = F.lit(label.lower())
        defined = F.filter("definitions", lambda p: F.contains(p["label"], word))
        block = F.filter("stat_blocks", lambda t: F.contains(F.lower(t), word))
        below = F.regexp_extract(F.array_join("page_lines", "\n"), rf"(?iU)\Q{label}\E\s*\n\s*([^\n]+)", 1)
        return (
            F.when(F.size(defined) > 0, M.first(defined)["value"])
            .when(F.size(block) > 0, strip(F.regexp_replace(M.first(block), rf"(?iU)^\Q{label}\E\s*", "")))
            .otherwise(strip(below))
        )

    return F.coalesce(*[blank_to_null(one(label)) for label in labels])


def image_url() -> Column:
    first_image = M.first(F.filter("elements", lambda e: e["tag"] == "img"))
    return F.coalesce(_meta("property", "og:image"), blank_to_null(M.attr(first_image, "src")))


def description(containers=V.DESCRIPTION_CONTAINERS, min_len: int = V.DESCRIPTION_MIN_LEN) -> Column:
    def box_of(kind: str, name: str) -> Column:
        tests = {
            "id": lambda e: M.has_id(e, name),
            "class": lambda e: M.has_class(e, name),
            "tag": lambda e: e["tag"] == name,
        }
        return M.first(F.filter("elements", tests[kind]))

    found = []
    for kind, name in containers:
        cleaned = X.clean_noise(M.text_of(box_of(kind, name), F.col("visible")))
        found.append(cleaned)
    ranked = F.transform(F.array(*found), lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("rank"), c.alias("text")))
    longest = F.array_max(F.filter(ranked, lambda c: c["n"] >= min_len))["text"]
    meta = _meta("name", "description")
    return F.coalesce(longest, F.when(meta.isNotNull(), X.clean_noise(meta)))


def raw_features() -> Column:
    elements, visible = F.col("elements"), F.col("visible")
    having = lambda tag, cls: F.filter(elements, lambda e: (e["tag"] == tag) & M.has_class(e, cls))
    badges = F.concat(
        having("span", "feature-tag"),
        M.under(elements, "hike-features", "span"),
        M.under(elements, "feature-list", "li"),
        having("div", "feature-badge"),
        having("div", "hike-feature"),
    )
    badge_texts = F.filter(F.transform(badges, lambda e: M.text_of(e, visible, "")), lambda t: F.length(t) > 2)
    defined = F.filter("definitions", lambda p: F.contains(p["label"], F.lit("feature")))
    section = F.coalesce(
        M.first(F.filter(elements, lambda e: M.has_class(e, "hike-features"))),
        M.first(F.filter(elements, lambda e: M.has_id(e, "hike-features"))),
    )
    lines = F.filter(
        F.transform(F.split(F.coalesce(M.text_of(section, visible, "\n"), F.lit("")), "\n"), strip), lambda t: t != ""
    )
    spoken = F.filter("texts", lambda t: t.rlike("(?iU)" + "|".join(V.FEATURE_KEYWORDS)))
    return (
        F.when(F.size(badge_texts) > 0, feature_list(badge_texts))
        .when(F.size(defined) > 0, blank_to_null(M.first(defined)["value"]))
        .otherwise(feature_list(_first_of(lines, spoken)))
    )


def _label_ok(c: Column) -> Column:
    return F.coalesce((c != "") & (F.length(c) < V.LABEL_MAX_LEN) & ~F.startswith(c, F.lit("http")), F.lit(False))


def difficulty_label() -> Column:
    elements, visible = F.col("elements"), F.col("visible")
    both = lambda t: F.contains(t, F.lit("difficulty")) & F.contains(t, F.lit("calculated"))
    caption = r"(?iU)calculated\s+difficulty\s*:?\s*"

    defined = F.filter("definitions", lambda p: both(p["label"]) & _label_ok(p["tight"]))
    spare = F.transform(F.filter(elements, lambda e: M.has_class(e, "stat")), lambda e: M.text_of(e, visible))
    blocks = F.transform(
        F.filter(_first_of(F.col("stat_blocks"), spare), lambda t: both(F.lower(t))),
        lambda t: strip(F.regexp_replace(t, caption, "")),
    )
    badge = F.coalesce(
        M.first(F.filter(elements, lambda e: (e["tag"] == "button") & M.has_class(e, "difficulty"))),
        M.first(F.filter(elements, lambda e: (e["tag"] == "span") & M.has_class(e, "difficulty-badge"))),
    )
    spoken = F.filter(
        elements,
        lambda e: e["tag"].isin("span", "div", "button")
        & F.coalesce(F.contains(F.lower(M.attr(e, "aria-label")), F.lit("difficulty")), F.lit(False)),
    )
    named = F.filter(F.transform(spoken, lambda e: M.text_of(e, visible, "")), _label_ok)

    def from_line(line: Column, i: Column) -> Column:
        rest = strip(F.regexp_replace(line, "(?iU).*" + caption[5:], ""))
        following = strip(F.get(F.col("page_lines"), i + 1))
        return F.when(
            F.contains(F.lower(line), F.lit("calculated difficulty")),
            F.coalesce(F.when(_label_ok(rest) & (rest != "?"), rest), F.when(_label_ok(following), following)),
        )

    badge_text = M.text_of(badge, visible, "")
    return F.coalesce(
        strip(F.regexp_replace(M.first(defined)["tight"], r"(?U)\s+", " ")),
        M.first(F.filter(blocks, _label_ok)),
        F.when(_label_ok(badge_text), badge_text),
        M.first(named),
        M.first(F.array_compact(F.transform("page_lines", from_line))),
    )


def vote_count(label: Column, page_text: Column) -> Column:
    """First whole number of the vote label, else the 'N votes' in brackets of the page text."""
    direct = F.regexp_extract(label, "([0-9]+)", 1)
    spoken = F.regexp_extract(page_text, r"(?U)\(([0-9]+)\s+(?:vote|rating)s?\)", 1)
    return F.coalesce(blank_to_null(direct).try_cast("int"), blank_to_null(spoken).try_cast("int"))


def rating() -> Column:
    """struct(rating, num_votes)."""
    elements, visible = F.col("elements"), F.col("visible")
    number = lambda c: blank_to_null(c).try_cast("double")

    def published(doc: Column) -> Column:
        r = M.first(F.from_json(doc, _LINKED_DATA))["aggregateRating"]
        given = lambda c: F.when(c.isin("", "0", "0.0", "false"), None).otherwise(c)
        count = F.coalesce(given(r["ratingCount"]), given(r["reviewCount"]))
        return F.struct(
            r["ratingValue"].try_cast("double").alias("rating"),
            F.when(count.isNull(), F.lit(0)).otherwise(count.try_cast("double").try_cast("int")).alias("num_votes"),
        )

    objects = F.filter("linked_data", lambda d: F.startswith(strip(d), F.lit("{")))
    structured = F.filter(F.transform(objects, published), lambda r: r["rating"].isNotNull())
    complete = M.first(F.filter(structured, lambda r: r["num_votes"].isNotNull()))

    def stars(e: Column) -> Column:
        return number(F.regexp_extract(F.lower(M.attr(e, "aria-label")), r"(?U)([0-9]+\.?[0-9]*)\s*(?:out of|/|stars?)", 1))

    starred = F.filter(elements, lambda e: F.coalesce(F.contains(F.lower(M.attr(e, "aria-label")), F.lit("star")), F.lit(False)))
    spoken = F.array_compact(F.transform(starred, stars))
    marked = M.first(F.filter(elements, lambda e: M.attr(e, "data-rating").isNotNull()))
    filled = F.size(
        F.filter(
            elements,
            lambda e: (M.has_class(e, "star") & M.has_class(e, "filled"))
            | M.has_class(e, "star-filled")
            | M.has_class(e, "icon-star-full"),
        )
    )
    shown = number(F.regexp_extract(M.text_of(_by_class("rating-value", "star-rating", "average-rating"), visible, ""), r"([0-9]+\.?[0-9]*)", 1))
    in_range = lambda c: F.when(c.between(0.0, 5.0), c)
    lines = F.transform(
        F.filter("page_lines", lambda t: F.contains(F.lower(t), F.lit("rating"))),
        lambda t: in_range(number(F.regexp_extract(t, r"(?iU)([0-9]+\.?[0-9]*)\s*(?:star|out of)", 1))),
    )
    value = F.coalesce(
        F.get(F.reverse(spoken), F.lit(0)),
        F.get(F.reverse(structured), F.lit(0))["rating"],
        M.attr(marked, "data-rating").try_cast("double"),
        F.when(filled > 0, filled.cast("double")),
        in_range(shown),
        M.first(F.array_compact(lines)),
    )
    votes = vote_count(M.text_of(_by_class("vote-count", "rating-count", "num-votes"), visible, ""), F.col("page_text"))
    votes = F.coalesce(votes, F.when(value.isNotNull(), F.lit(0)))
    return F.coalesce(complete, F.struct(value.alias("rating"), votes.alias("num_votes")))


def coords() -> Column:
    """struct(lat, lng), NULL when no source gives both numbers."""
    elements = F.col("elements")

    def place(lat: Column, lng: Column) -> Column:
        lat, lng = strip(lat).try_cast("double"), strip(lng).try_cast("double")
        return F.when(lat.isNotNull() & lng.isNotNull(), F.struct(lat.alias("lat"), lng.alias("lng")))

    def pattern(c: Column, regex: str) -> Column:
        return place(blank_to_null(F.regexp_extract(c, regex, 1)), blank_to_null(F.regexp_extract(c, regex, 2)))

    def meta_any(*keys: tuple[str, str]) -> Column:
        return F.coalesce(*[_meta(k, v) for k, v in keys])

    def with_both(a: str, b: str) -> Column:
        return M.first(F.filter(elements, lambda e: M.attr(e, a).isNotNull() & M.attr(e, b).isNotNull()))

    spot = F.coalesce(with_both("data-lat", "data-lng"), with_both("data-latitude", "data-longitude"))
    given = lambda a, b: F.coalesce(blank_to_null(M.attr(spot, a)), M.attr(spot, b))
    linked = F.flatten(F.array_compact(F.transform("linked_data", lambda d: F.from_json(d, _LINKED_DATA))))
    linked = F.array_compact(F.transform(linked, lambda o: place(o["geo"]["latitude"], o["geo"]["longitude"])))
    script = F.array_join("scripts", "\n")
    lat_key = r"""(?:"lat"|\blat(?:itude)?\b)\s*[:=]\s*(-?[0-9]{1,2}\.[0-9]+)"""
    lng_key = r"""(?:"lng"|\blng\b|\blon(?:gitude)?\b)\s*[:=]\s*(-?[0-9]{1,3}\.[0-9]+)"""
    return F.coalesce(
        place(
            meta_any(("property", "place:location:latitude"), ("name", "place:location:latitude")),
            meta_any(("property", "place:location:longitude"), ("name", "place:location:longitude")),
        ),
        pattern(
            meta_any(("name", "geo.position"), ("property", "geo.position")),
            r"(?U)(-?[0-9]{1,2}\.[0-9]+)\s*[;,]\s*(-?[0-9]{1,3}\.[0-9]+)",
        ),
        pattern(_meta("name", "ICBM"), r"(?U)(-?[0-9]{1,2}\.[0-9]+)\s*,\s*(-?[0-9]{1,3}\.[0-9]+)"),
        place(given("data-lat", "data-latitude"), given("data-lng", "data-longitude")),
        M.first(linked),
        place(blank_to_null(F.regexp_extract(script, lat_key, 1)), blank_to_null(F.regexp_extract(script, lng_key, 1))),
        pattern(F.col("page_text"), r"(?U)(-?[0-9]{1,2}\.[0-9]{3,})\s*,\s*(-?[0-9]{1,3}\.[0-9]{3,})"),
        F.lit(None).cast(_PLACE),
    )


def parking_text() -> Column:
    elements, visible = F.col("elements"), F.col("visible")
    section = M.first(F.filter(elements, lambda e: M.has_id(e, "hike-getting-there")))
    title = M.first(
        F.filter(
            elements,
            lambda e: e["tag"].isin("h2", "h3") & F.contains(F.lower(M.text_of(e, visible)), F.lit("getting there")),
        )
    )
    around = M.let(title["parent"], lambda up: M.first(F.filter(elements, lambda e: e["pre"] == up)))
    return blank_to_null(X.clean_noise(M.text_of(F.coalesce(section, around, title), visible)))


# ---- assembly ---------------------------------------------------------------------------


@cache
def _read_fields() -> list[Column]:
    return [
        stat("Length").alias("raw_length"),
        stat("Gain").alias("raw_gain"),
        stat("Highpoint", "High Point", "Highest Point").alias("raw_high"),
        coords().alias("place"),
        difficulty_label().alias("calculated_difficulty"),
        rating().alias("stars"),
        parking_text().alias("parking"),
        description().alias("description"),
        raw_features().alias("raw_features"),
        image_url().alias("image_url"),
    ]


def extract_pages(pages: DataFrame, heading_class: str | None = V.HEADING_CLASS) -> DataFrame:
    """(url, html) rows to trail rows; pages without a title give none.

    Pages that cannot hold the title element are dropped before parsing.
    """
    mark = heading_class or "<h1"
    outlined = with_outline(pages.filter(F.contains(F.lower("html"), F.lit(mark.lower()))))
    named = outlined.withColumn("name", page_name(heading_class)).filter(F.col("name").isNotNull())
    fields = named.select("url", "name", *_read_fields())
    trail = fields.select(
        slug_id(F.col("url")).alias("id"),
        "name",
        F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast("double").alias("difficulty"),
        "calculated_difficulty",
        F.col("stars.rating").alias("rating"),
        F.col("stars.num_votes").alias("num_votes"),
        X.parse_distance_miles(F.col("raw_length")).alias("distance"),
        X.parse_feet(F.col("raw_gain")).alias("elevation"),
        X.parse_feet(F.col("raw_high")).alias("highest_point"),
        F.col("place.lat").alias("latitude"),
        F.col("place.lng").alias("longitude"),
        F.lit(None).cast("string").alias("surface"),
        X.route_type(F.col("raw_length")).alias("route_type"),
        F.lit(None).cast("string").alias("water_source"),
        "image_url",
        "parking",
        X.page_parking_tags(F.col("parking")).alias("parking_tags"),
        F.lit(None).cast("string").alias("parking_status"),
        F.lit(None).cast("string").alias("restrooms"),
        F.lit(None).cast("string").alias("cell_coverage"),
        F.lit(None).cast("int").alias("crowd_level"),
        "description",
        F.col("url").alias("source_url"),
        "raw_features",
    )
    return fill_derived(trail)


def fill_derived(df: DataFrame) -> DataFrame:
    """Text-derived columns where the page gave none; the score uses the filled surface."""
    desc, feats, parking = (F.coalesce(c, F.lit("")) for c in ("description", "raw_features", "parking"))

    def fill(name: str, derived: Column, empty="") -> Column:
        return F.when(falsy(F.col(name), empty), derived).otherwise(F.col(name))

    no_tags = F.col("parking_tags").isNull() | (F.size("parking_tags") == 0)
    filled = df.withColumns(
        {
            "surface": fill("surface", X.detect_surface(F.concat(desc, F.lit(" "), feats))),
            "water_source": fill("water_source", X.detect_water(desc, feats)),
            "cell_coverage": fill("cell_coverage", X.cell_coverage(desc)),
            "crowd_level": fill("crowd_level", X.crowd_level(desc), 0),
            "parking_tags": F.when(no_tags, X.all_tags(parking)).otherwise(F.col("parking_tags")),
            "parking_status": fill("parking_status", X.parking_status(parking)),
            "restrooms": fill("restrooms", X.restrooms(parking, desc)),
        }
    )
    score = X.difficulty_placeholder(F.col("distance"), F.col("elevation"), F.col("surface"))
    return filled.withColumn("difficulty", F.coalesce("difficulty", score))
