from pyspark.sql import functions as F

from switchback.functions import text as X
from switchback.functions import values as N


def test_numbers(values):
    assert values(X.parse_distance_miles, ["4.3 miles, roundtrip", "1,200 miles", "about 7 Mile", "", None, "x"]) == [4.3, 200.0, 7.0, None, None, None]
    assert values(X.parse_feet, ["4,500 feet", "3200 ft", "1200.5 ft", "12 ftx", None]) == [4500, 3200, 5, None, None]
    assert values(N.parse_int, ["12.9", "-7.9", "", "abc", "nan", None]) == [12, -7, None, None, None, None]


def test_route_type(values):
    given = ["4.3 miles, roundtrip", "5.4 miles, loop", "3.2 miles one-way", "5 miles,", "12", "", None]
    assert values(X.route_type, given) == ["roundtrip", "loop", "one-way", "", None, None, None]
    assert values(X.classify, ["A Loop", "one way out", "x"]) == ["Loop", "Point-to-point", None]


def test_surface_traps(values):
    long = "a meadow walk that goes on and on with nothing of note to see at all"
    assert values(X.detect_surface, ["unpaved road", "guard service", "a thousand", "short", long, ""]) == [
        "Pavement", "Snow / Ice", "Sand", None, "Dirt/Soil", None,
    ]


def test_water(values):
    water = lambda c: X.detect_water(c, F.lit(""))
    given = ["bring water, lake", "campground with tap", "a lake.", "lakeside", "upstream creek", "refill here", ""]
    assert values(water, given) == ["None", "Campground", "Natural Lake", None, "Creek/River", "Any water source", None]
    tags = lambda c: X.detect_water(F.lit("nothing"), c)
    assert values(tags, ["Lakes", "Waterfalls", "Rivers", "Dogs"]) == ["Natural Lake", "Creek/River", "Creek/River", None]


def test_parking(values):
    assert values(X.all_tags, ["Northwest Forest Pass, few feet", "coffee", "", None]) == [
        ["NW Forest Pass", "Forest Pass", "Paid"], ["Paid"], [], [],
    ]
    assert values(X.parking_status, ["permit", "a fee", "$5", "lot", "", None]) == ["Permit", "Paid", "Paid", "Free", None, None]
    assert values(X.page_parking_tags, ["small parking, fee", "few", "ample parking permit"]) == [["Limited", "Paid"], [], ["Easy", "Permit"]]


def test_labels(values):
    room = lambda c: X.restrooms(c, F.lit(None).cast("string"))
    assert values(room, ["no toilet", "pit toilet", "Privy", "bathroom", "no restroom", ""]) == ["Yes", "Pit Toilet", "Outhouse", "Yes", "Restrooms", None]
    assert values(X.crowd_level, ["unpopular", "very popular", "quiet", ""]) == [2, 3, 1, None]
    assert values(X.cell_coverage, ["no cell", "spotty", "good cell", "cell"]) == ["None", "Partial", "Good", None]
    assert values(X.label_level, ["Easy", " Hard ", "hard", None]) == [0.0, 2.0, None, None]


def test_names_and_space(values):
    assert values(X.normalize_name, ["  Lake!! Trail ", "Trail", "Trailing Edge", None]) == ["lake", "", "trailing edge", ""]
    assert values(X.clean_noise, ["Print  a b EMAIL", "Printing"]) == ["a b", "Printing"]


def test_rounding(values):
    numbers = [0.125, 2.675, 1.005, 0.5, 1.5, -0.125, None]
    assert values(lambda c: N.py_round(c, 2), numbers, "double") == [None if x is None else round(x, 2) for x in numbers]
    assert values(lambda c: N.py_round(c, 0), numbers, "double") == [None if x is None else float(round(x)) for x in numbers]
    assert values(N.finite, [float("nan"), float("inf"), 1.0, None], "double") == [None, None, 1.0, None]


def test_difficulty(values):
    mild = lambda c: X.difficulty_placeholder(c, F.lit(1000), F.lit("Gravel"))
    hard = lambda c: X.difficulty_placeholder(c, F.lit(None).cast("int"), F.lit("Snow / Ice"))
    assert values(mild, [5.0, None], "double") == [4.2, 1.2]
    assert values(hard, [5.0, None], "double") == [3.45, None]
