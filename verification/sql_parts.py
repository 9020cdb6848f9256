"""Fragments of check SQL in DuckDB's dialect."""

from __future__ import annotations

from switchback import fixed_values as V

SPACE = r"[\s\x{00A0}]"


def rules(text: str, table, default: str = "NULL") -> str:
    """CASE chain of (needle, label) rules over lower-cased text."""
    quote = lambda v: str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    whens = " ".join(f"WHEN contains({text}, {quote(n)}) THEN {quote(label)}" for n, label in table)
    return f"CASE {whens} ELSE {default} END"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def tag_list(text: str, table) -> str:
    """Distinct labels of all rules that hit, in rule order, comma-joined."""
    labels = list(dict.fromkeys(label for _, label in table))
    parts = [f"CASE WHEN {any_of(text, [n for n, v in table if v == label])} THEN '{label}' END" for label in labels]
    return f"coalesce(array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ','), '')"


def lookup(value: str, mapping, default: str = "NULL") -> str:
    quote = lambda v: str(v) if isinstance(v, float) else f"'{v}'"
    whens = " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in mapping.items())
    return f"CASE {value} {whens} ELSE {default} END"


def rnd(x: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {x}) AS DOUBLE)"


def even1(x: str) -> str:
    return f"round_even(({x}) * 10, 0) / 10"


def hav(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)"
    )
    return f"(2 * 6371000.0::DOUBLE * asin(sqrt(CASE WHEN {a} > 1 THEN 1 ELSE {a} END)))"


def trim(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def squeeze(x: str) -> str:
    return trim(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def name_norm(x: str) -> str:
    plain = rf"regexp_replace(lower({trim(f'coalesce({x}, {chr(39)}{chr(39)})')}), '\btrail\b', '', 'g')"
    return squeeze(rf"regexp_replace({plain}, '[^a-z0-9\s-]', '', 'g')")


def miles(x: str) -> str:
    return rf"try_cast(nullif(regexp_extract(lower({x}), '([0-9]+(?:\.[0-9]+)?)\s*mile', 1), '') AS DOUBLE)"


def feet(x: str) -> str:
    return rf"try_cast(nullif(replace(regexp_extract(lower({x}), '([0-9][0-9,]*)\s*(?:feet|ft)\b', 1), ',', ''), '') AS INTEGER)"


def route(x: str) -> str:
    after = trim(f"substr({x}, instr({x}, ',') + 1)")
    found = rf"nullif({trim(rf'regexp_extract({trim(x)}, {chr(39)}(?i)^[0-9]+\.?[0-9]*\s*(?:mile|mi)s?\s+(.+)${chr(39)}, 1)')}, '')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL WHEN contains({x}, ',') THEN {after} ELSE {found} END"


def surface(text: str) -> str:
    """``text`` already lower-cased and not NULL."""
    return rules(text, V.SURFACE_RULES, f"CASE WHEN length({text}) > 50 THEN 'Dirt/Soil' END")


def water(desc: str, feats: str) -> str:
    """Both lower-cased and not NULL."""
    return rf"""CASE
      WHEN regexp_matches({desc} || ' ' || {feats}, '{V.NO_WATER_PATTERN}') THEN 'None'
      WHEN contains({feats}, 'lake') THEN 'Natural Lake'
      WHEN {any_of(feats, ['river', 'creek', 'stream', 'waterfall'])} THEN 'Creek/River'
      WHEN contains({desc}, 'campground') AND {any_of(desc, V.WATER_CAMP_WORDS)} THEN 'Campground'
      WHEN regexp_matches({desc}, '\blake\b') THEN 'Natural Lake'
      WHEN regexp_matches({desc}, '\briver\b|\bcreek\b|\bstream\b') THEN 'Creek/River'
      WHEN {any_of(desc, V.WATER_REFILL_WORDS)} THEN 'Any water source' END"""


def status(text: str) -> str:
    return f"CASE WHEN {text} = '' THEN NULL ELSE {rules(text, V.PARKING_STATUS_RULES, chr(39) + 'Free' + chr(39))} END"


def page_tags(text: str) -> str:
    parking = f"contains({text}, 'parking')"
    return f"""array_to_string(list_sort(list_filter([
      CASE WHEN {any_of(text, V.PAGE_PERMIT_WORDS)} THEN 'Permit' END,
      CASE WHEN {any_of(text, V.PAGE_PAID_WORDS)} THEN 'Paid' END,
      CASE WHEN {parking} AND {any_of(text, V.PAGE_LIMITED_WORDS)} THEN 'Limited' END,
      CASE WHEN {parking} AND {any_of(text, V.PAGE_EASY_WORDS)} THEN 'Easy' END], lambda x: x IS NOT NULL)), ',')"""


def difficulty(mi: str, ft: str, surf: str) -> str:
    base = f"(coalesce({mi}, 0) * 0.6::DOUBLE + coalesce({ft}, 0) / 1000.0::DOUBLE * 1.2::DOUBLE)"
    hard = ", ".join(f"'{s}'" for s in V.HARD_SURFACES)
    scaled = f"CASE WHEN {surf} IN ({hard}) THEN {base} * 1.15::DOUBLE ELSE {base} END"
    return f"CASE WHEN {mi} IS NULL AND {ft} IS NULL THEN NULL ELSE {rnd(scaled, 2)} END"
