"""Names, limits and word lists that results depend on."""

# Entities of the landing zone.
ENTITIES = ("sessions", "drivers", "laps", "locations")

# Session category, first match wins (label, any of these words).
SESSION_CATEGORIES = (
    ("Race", ("race",), ()),
    ("Qualifying", ("quali",), ()),
    ("Practice", ("practice", "fp"), ()),
    ("Sprint", ("sprint",), ()),
)

# Team category, first match wins (label, any of these words, none of these words).
TEAM_CATEGORIES = (
    ("Red Bull Racing", ("red bull",), ("rb", "racing bulls")),
    ("Ferrari", ("ferrari",), ()),
    ("Mercedes", ("mercedes",), ()),
    ("McLaren", ("mclaren",), ()),
    ("Alpine", ("alpine",), ()),
    ("Aston Martin", ("aston martin",), ()),
    ("Williams", ("williams",), ()),
    ("AlphaTauri", ("alphatauri",), ()),
    ("RB", ("rb", "racing bulls"), ()),
    ("Alfa Romeo", ("alfa romeo",), ()),
    ("Sauber", ("sauber", "kick sauber"), ()),
    ("Haas F1 Team", ("haas",), ()),
)
OTHER = "Other"

# Defaults for missing text and numbers.
UNKNOWN = "Unknown"
UNKNOWN_TEAM = "Unknown Team"
NO_COLOUR = "000000"
UNKNOWN_DAY = "unknown"

# Limits of a valid lap, in seconds.
VALID_LAP_MIN = 10
VALID_LAP_MAX = 300

# Sector completeness labels.
COMPLETE, PARTIAL, NO_SECTORS = "Complete", "Partial", "No Sectors"

# Minimum minutes a session of each category should last.
MIN_SESSION_MINUTES = (("Race", 120), ("Qualifying", 60), ("Practice", 60))

# Lap speed classes.
VERY_FAST = "VERY FAST (check if valid)"
VERY_SLOW = "VERY SLOW (likely invalid)"
NORMAL = "NORMAL"

# Report status labels.
COUNT_PASS, COUNT_EMPTY, COUNT_LOW = "✅ PASS", "❌ EMPTY", "⚠️  LOW"
EQUAL_PASS, EQUAL_FAIL = "PASS ✓", "FAIL ✗"
STATUS_OK, STATUS_CHECK = "OK", "CHECK"

# Surrogate keys join the parts with this mark and replace NULL by this text.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"

# The mask keeps this many characters and adds this tail.
MASK_KEEP, MASK_TAIL = 3, "***@***.com"

# Location chunks of a session.
CHUNK_MINUTES, CHUNK_COUNT, CHUNK_LEAD_MINUTES, CHUNK_STOP_AFTER = 15, 12, 30, 3

# Days of the manual selection mode.
MANUAL_DAYS = (
    "2025-10-26", "2025-10-25", "2025-10-19", "2025-10-05",
    "2025-09-21", "2025-09-07", "2025-08-31", "2025-08-03",
)

# File pattern, layout columns and comment per entity.
FILE_PATTERNS = {
    "sessions": "sessions*.json",
    "drivers": "drivers*.json",
    "laps": "laps*.json",
    "locations": "locations*.json",
}
LAYOUT_COLUMNS = {
    "sessions": ("session_key", "date_start"),
    "drivers": ("session_key", "driver_number"),
    "laps": ("session_key", "driver_number", "lap_number"),
    "locations": ("session_key", "driver_number", "date"),
}
TABLE_COMMENTS = {
    "sessions": "Raw sessions data",
    "drivers": "Raw drivers data",
    "laps": "Raw lap timing data",
    "locations": "Raw location telemetry data",
}

# Expected rows of a full bronze load, and the row ranges per load.
EXPECTED_COUNTS = {"bronze_sessions": 123, "bronze_drivers": 2460, "bronze_laps": 110000}
ROW_RANGES = {
    "bronze_sessions": (1, 100),
    "bronze_drivers": (18, 24),
    "bronze_laps": (400, 800),
}
STALE_AFTER_HOURS = 48
