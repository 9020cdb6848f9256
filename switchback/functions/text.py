"""Ordered text rules as column expressions.

Rules are tables of (needle, label). A rule hits when the lower-cased text
contains its needle, so short needles also hit inside longer words; that is
part of their meaning.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions.values import blank_to_null, finite, py_round, strip


def normalize_ws(c: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def lower0(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def first_rule(text: Column, rules: Iterable[tuple[str, object]]) -> Column:
    """Label of the first rule whose needle occurs in ``text`` (already lower-cased)."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(n)), F.lit(label)) for n, label in rules])


def classify(c: Column, rules=V.ROUTE_TYPE_RULES) -> Column:
    return first_rule(lower0(c), rules)


def all_tags(c: Column, rules=V.PARKING_TAG_RULES) -> Column:
    """Labels of every rule that hits, in rule order, each once."""
    text = lower0(c)
    hits = F.array(*[F.when(F.contains(text, F.lit(n)), F.lit(label)) for n, label in rules])
    return F.array_distinct(F.array_compact(hits))


def clean_noise(c: Column, words=V.NOISE_WORDS) -> Column:
    """Drop action words that leak into page text, then tidy white space."""
    pattern = "(?iU)" + "|".join(rf"\b{w}\b" for w in words)
    return normalize_ws(F.regexp_replace(c, pattern, ""))


def parse_distance_miles(c: Column) -> Column:
    found = F.regexp_extract(F.lower(c), r"(?U)([0-9]+(?:\.[0-9]+)?)\s*mile", 1)
    return blank_to_null(found).try_cast("double")


def parse_feet(c: Column) -> Column:
    found = F.regexp_extract(F.lower(c), r"(?U)([0-9][0-9,]*)\s*(?:feet|ft)\b", 1)
    return blank_to_null(F.replace(found, F.lit(","), F.lit(""))).try_cast("int")


def route_type(c: Column) -> Column:
    """What follows the first comma (possibly nothing), else what follows 'N miles'."""
    after_comma = strip(F.regexp_extract(c, r"(?s)^[^,]*,(.*)$", 1))
    after_miles = F.regexp_extract(strip(c), r"(?iU)^[0-9]+\.?[0-9]*\s*(?:mile|mi)s?\s+(.+)$", 1)
    return (
        F.when(c.isNull() | (c == ""), None)
        .when(F.contains(c, F.lit(",")), after_comma)
        .otherwise(blank_to_null(strip(after_miles)))
    )


def detect_surface(
    c: Column, rules=V.SURFACE_RULES, default=V.SURFACE_DEFAULT, min_len=V.SURFACE_DEFAULT_MIN_LEN
) -> Column:
    text = lower0(c)
    return F.coalesce(first_rule(text, rules), F.when(F.length(text) > min_len, F.lit(default)))


def detect_water(desc: Column, feats: Column) -> Column:
    desc, feats = lower0(desc), lower0(feats)
    both = F.concat(desc, F.lit(" "), feats)
    camp = F.contains(desc, F.lit("campground")) & contains_any(desc, V.WATER_CAMP_WORDS)
    return (
        F.when(both.rlike("(?U)" + V.NO_WATER_PATTERN), "None")
        .when(first_rule(feats, V.WATER_FEATURE_RULES).isNotNull(), first_rule(feats, V.WATER_FEATURE_RULES))
        .when(camp, "Campground")
        .when(desc.rlike("(?U)" + V.WATER_LAKE_PATTERN), "Natural Lake")
        .when(desc.rlike("(?U)" + V.WATER_STREAM_PATTERN), "Creek/River")
        .when(contains_any(desc, V.WATER_REFILL_WORDS), "Any water source")
    )


def parking_status(c: Column) -> Column:
    text = lower0(c)
    return F.when(text == "", None).otherwise(
        F.coalesce(first_rule(text, V.PARKING_STATUS_RULES), F.lit(V.PARKING_STATUS_DEFAULT))
    )


def page_parking_tags(c: Column) -> Column:
    """Coarse tags of the directions text, sorted."""
    text = lower0(c)
    parking = F.contains(text, F.lit("parking"))
    return F.array_sort(
        F.array_compact(
            F.array(
                F.when(contains_any(text, V.PAGE_PERMIT_WORDS), F.lit("Permit")),
                F.when(contains_any(text, V.PAGE_PAID_WORDS), F.lit("Paid")),
                F.when(parking & contains_any(text, V.PAGE_LIMITED_WORDS), F.lit("Limited")),
                F.when(parking & contains_any(text, V.PAGE_EASY_WORDS), F.lit("Easy")),
            )
        )
    )


def restrooms(parking: Column, desc: Column) -> Column:
    return first_rule(F.concat(lower0(parking), F.lit(" "), lower0(desc)), V.RESTROOM_RULES)


def cell_coverage(c: Column) -> Column:
    return first_rule(lower0(c), V.CELL_RULES)


def crowd_level(c: Column) -> Column:
    return first_rule(lower0(c), V.CROWD_RULES)


def difficulty_placeholder(mi: Column, ft: Column, surface: Column) -> Column:
    base = F.coalesce(mi, F.lit(0.0)) * F.lit(0.6) + F.coalesce(ft, F.lit(0)) / F.lit(1000.0) * F.lit(1.2)
    hard = F.coalesce(surface.isin(V.HARD_SURFACES), F.lit(False))
    return F.when(
        mi.isNotNull() | ft.isNotNull(), py_round(F.when(hard, base * F.lit(1.15)).otherwise(base), 2)
    )


def normalize_name(c: Column) -> Column:
    plain = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), r"(?U)\btrail\b", "")
    plain = F.regexp_replace(plain, r"(?U)[^a-z0-9\s\-]", "")
    return strip(F.regexp_replace(plain, r"(?U)\s+", " "))


def _lookup(c: Column, mapping: Mapping[str, object]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, c)


def label_level(c: Column, mapping=V.LABEL_LEVELS) -> Column:
    return _lookup(strip(c), mapping)


def surface_penalty(c: Column, default: float, mapping=V.SURFACE_PENALTIES) -> Column:
    return F.coalesce(_lookup(strip(c), mapping), F.lit(default))


def surface_from_tag(value: Column, mapping=V.SURFACE_TAG_LABELS) -> Column:
    return _lookup(F.lower(strip(value)), mapping)


def feature_name(tags: Column) -> Column:
    """Name of a map feature for scoring: the plain name, else the official, else the alternative one."""
    return F.coalesce(*[blank_to_null(F.try_element_at(tags, F.lit(k))) for k in ("name", "official_name", "alt_name")])


def numeric(c: Column) -> Column:
    """Any column as a finite double, NULL where it is not a number."""
    return finite(c.try_cast("double"))
