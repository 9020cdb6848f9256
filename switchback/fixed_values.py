"""Fixed values.

Word lists, labels, thresholds and formats below define the results, so they
are plain data and every operator takes them as (default) parameters.
"""

# ---- fixed values: addresses and ids -------------------------------------
HIKE_PATH = "/go-hiking/hikes/"
VIEW_SUFFIX = "view"
ID_PREFIX = "wta_"
LIST_PAGE_SIZE = 30

# ---- fixed values: text rules (needle, label), first hit wins -------------
ROUTE_TYPE_RULES = [
    ("out-and-back", "Out-and-back"),
    ("out and back", "Out-and-back"),
    ("loop", "Loop"),
    ("point-to-point", "Point-to-point"),
    ("point to point", "Point-to-point"),
    ("one way", "Point-to-point"),
    ("one-way", "Point-to-point"),
]

SURFACE_RULES = [
    ("boardwalk", "Boardwalk / Wood"),
    ("wooden bridge", "Boardwalk / Wood"),
    ("paved", "Pavement"),
    ("asphalt", "Pavement"),
    ("concrete", "Pavement"),
    ("scree", "Scree / Talus"),
    ("talus", "Scree / Talus"),
    ("gravel", "Gravel"),
    ("rocky", "Rocky / Technical"),
    ("boulder", "Rocky / Technical"),
    ("boulders", "Rocky / Technical"),
    ("scramble", "Rocky / Technical"),
    ("technical", "Rocky / Technical"),
    ("root", "Rooty"),
    ("rooty", "Rooty"),
    ("sand", "Sand"),
    ("sandy", "Sand"),
    ("mud", "Mud"),
    ("muddy", "Mud"),
    ("snow", "Snow / Ice"),
    ("ice", "Snow / Ice"),
    ("glacier", "Snow / Ice"),
    ("well-maintained", "Maintained Trail"),
    ("groomed", "Maintained Trail"),
]
SURFACE_DEFAULT = "Dirt/Soil"
SURFACE_DEFAULT_MIN_LEN = 50
HARD_SURFACES = ["Rocky / Technical", "Scree / Talus", "Snow / Ice"]

NO_WATER_PATTERN = r"\bno water\b|\bwithout water\b|\bno (?:re)?fill\b|\bbring (?:all )?water\b"
WATER_FEATURE_RULES = [
    ("lake", "Natural Lake"),
    ("river", "Creek/River"),
    ("creek", "Creek/River"),
    ("stream", "Creek/River"),
    ("waterfall", "Creek/River"),
]
WATER_CAMP_WORDS = ["water", "spigot", "tap"]
WATER_LAKE_PATTERN = r"\blake\b"
WATER_STREAM_PATTERN = r"\briver\b|\bcreek\b|\bstream\b"
WATER_REFILL_WORDS = ["water available", "refill", "spigot"]

PARKING_TAG_RULES = [
    ("northwest forest pass", "NW Forest Pass"),
    ("discover pass", "Discover Pass"),
    ("sno-park", "Sno-Park"),
    ("forest pass", "Forest Pass"),
    ("vault toilet", "Restrooms"),
    ("restroom", "Restrooms"),
    ("toilet", "Restrooms"),
    ("trailhead parking", "Trailhead Lot"),
    ("parking lot", "Trailhead Lot"),
    ("street parking", "Street Parking"),
    ("permit", "Permit"),
    ("pass required", "Permit"),
    ("fee", "Paid"),
    ("paid", "Paid"),
]
PARKING_STATUS_RULES = [
    ("discover pass", "Permit"),
    ("forest pass", "Permit"),
    ("permit", "Permit"),
    ("sno-park", "Permit"),
    ("pass required", "Permit"),
    ("fee", "Paid"),
    ("paid", "Paid"),
    ("$", "Paid"),
]
PARKING_STATUS_DEFAULT = "Free"
PAGE_PERMIT_WORDS = ["discover pass", "northwest forest pass", "permit", "pass required", "sno-park"]
PAGE_PAID_WORDS = ["fee", "paid", "$", "payment"]
PAGE_LIMITED_WORDS = ["limited", "small", "few"]
PAGE_EASY_WORDS = ["large", "plenty", "ample"]

RESTROOM_RULES = [
    ("vault toilet", "Vault Toilet"),
    ("pit toilet", "Pit Toilet"),
    ("flush toilet", "Restrooms"),
    ("restroom", "Restrooms"),
    ("privy", "Outhouse"),
    ("outhouse", "Outhouse"),
    ("toilet", "Yes"),
    ("bathroom", "Yes"),
]
CELL_RULES = [
    ("no cell", "None"),
    ("no service", "None"),
    ("spotty", "Partial"),
    ("intermittent", "Partial"),
    ("limited cell", "Partial"),
    ("good cell", "Good"),
    ("reliable cell", "Good"),
]
CROWD_RULES = [
    ("very popular", 3),
    ("crowded", 3),
    ("busy", 3),
    ("popular", 2),
    ("moderate traffic", 2),
    ("quiet", 1),
    ("solitude", 1),
]
FEATURE_KEYWORDS = [
    "lake", "river", "waterfall", "old growth", "wildflower",
    "mountain view", "dog", "summit", "wildlife",
]
NOISE_WORDS = ["Print", "Email"]

# ---- fixed values: page markup --------------------------------------------
HEADING_CLASS = "documentFirstHeading"
DESCRIPTION_CONTAINERS = [
    ("id", "content-core"),
    ("class", "documentDescription"),
    ("class", "documentFirstHeading"),
    ("class", "hike-full-description"),
    ("class", "hike-body"),
    ("tag", "article"),
    ("class", "documentByLine"),
]
DESCRIPTION_MIN_LEN = 80
FEATURE_MAX_LEN = 100
FEATURE_MAX_COUNT = 10
LABEL_MAX_LEN = 30

# ---- fixed values: difficulty labels and penalties ------------------------
LABEL_LEVELS = {
    "Easy": 0.0,
    "Easy/Moderate": 0.5,
    "Moderate": 1.0,
    "Moderate/Hard": 1.5,
    "Hard": 2.0,
}
SURFACE_PENALTIES = {"Paved": 0.0, "Gravel": 0.2, "Dirt/Soil": 0.4}
DIFFICULTY_PENALTY_DEFAULT = 0.5
RUNNABLE_PENALTY_DEFAULT = 0.6

# ---- fixed values: map tags -----------------------------------------------
SURFACE_TAG_LABELS = {
    "asphalt": "Pavement",
    "paved": "Pavement",
    "concrete": "Pavement",
    "concrete:plates": "Pavement",
    "gravel": "Gravel",
    "fine_gravel": "Gravel",
    "compacted": "Gravel",
    "dirt": "Dirt/Soil",
    "earth": "Dirt/Soil",
    "ground": "Dirt/Soil",
    "mud": "Mud",
    "sand": "Sand",
    "rock": "Rocky/Technical",
    "stone": "Rocky/Technical",
    "pebblestone": "Rocky/Technical",
    "grass": "Dirt/Soil",
    "wood": "Boardwalk/Wood",
    "boardwalk": "Boardwalk/Wood",
}
HIGHWAY_PATTERN = "path|footway|track"
TRAIL_HIGHWAYS = ["path", "track", "footway", "bridleway"]

# ---- fixed values: geometry and matching ----------------------------------
EARTH_RADIUS_M = 6371000.0
METRES_PER_MILE = 1609.344
FEET_PER_METRE = 3.28084
SEARCH_RADII_M = [800.0, 1200.0, 1800.0, 2600.0]
STOP_SCORE = 0.72
MATCH_WEIGHTS = {
    "name": 0.50,
    "proximity": 0.20,
    "length": 0.15,
    "relation": 0.20,
    "way": 0.05,
    "highway": 0.10,
    "sac_scale": 0.05,
    "unnamed": 0.1,
}
PROXIMITY_SCALE_M = 800.0
STITCH_RATIO = 0.4
STITCH_MAX_ROUNDS = 50
STITCH_GAP_M = 80.0
STITCH_TARGET_SHARE = 0.9
STITCH_DEFAULT_MILES = 5.0
JOINT_TOLERANCE_M = 5.0
GRADE_STEP_M, GRADE_MAX_POINTS = 45.0, 220
EXPORT_STEP_M, EXPORT_MAX_POINTS = 60.0, 160
GRADE_MIN_SEGMENT_M = 1.0
GRADE_MAX_PCT = 60.0
GRADE_QUANTILE = 0.95

# ---- fixed values: store --------------------------------------------------
ENRICHMENT_COLUMNS = [
    "osm_id", "osm_name", "osm_type", "match_confidence", "osm_distance_mi",
    "max_grade_p95", "derived_gain_ft", "surface_primary", "surface_breakdown",
    "geometry_polyline",
]
INTEGER_COLUMNS = [
    "rank", "num_votes", "elevation", "highest_point", "crowd_level",
    "derived_gain_ft", "osm_id",
]
INTERMEDIATE_COLUMNS = ["parking", "distance_mi", "surface_penalty", "wta_diff_level"]
STORE_RENAMES = {"latitude": "trailhead_lat", "longitude": "trailhead_lng"}
RETIRED_COLUMNS = ["grade_p95", "log_distance"]
SNAPSHOT_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
FAILURE_STATUS, FAILURE_ERROR, SUCCESS_STATUS = 0, "parse_failed_or_unreachable", 200
NOTE_NO_CHANGE, NOTE_EXCEPTION = "no_changed_rows", "exception"

# score weights: column, unit (None: taken as it is), weight
HEURISTIC_WEIGHTS = [
    ("gain_per_mile_ft", 1000.0, 0.45), ("max_grade_p95", 20.0, 0.35), ("surface_penalty", None, 0.10), ("distance_mi", 15.0, 0.10),
]
RUNNABLE_WEIGHTS = [("max_grade_p95", 25.0, 0.55), ("gain_per_mile_ft", 1500.0, 0.25), ("surface_penalty", None, 0.20)]
