"""Column roles, filter settings and the fixed domains every operator shares.

Operators never hard-code column names: they take a :class:`ColumnRoles`
naming the category, coordinate, hour, optional day and key columns of the
table at hand.  The key must be unique and stable; keyed draws, splits and
tie-breaks hash it, so results do not depend on partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference application's values for the
# results to agree; they are stated here once, in natural order.
# ---------------------------------------------------------------------------

# Day names in code order (Monday = 0).
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Time-of-day bands in code order (Night = 0).
TIME_BANDS = ("Night", "Morning", "Afternoon", "Evening")

# Band edges: [5, 12) Morning, [12, 17) Afternoon, [17, 21) Evening, else Night.
MORNING_START, AFTERNOON_START, EVENING_START, NIGHT_START = 5, 12, 17, 21

# Accepted day spellings after trim + lower-case, mapped to the day name.
DAY_ALIASES = {
    "mon": "Monday",
    "monday": "Monday",
    "tue": "Tuesday",
    "tues": "Tuesday",
    "tuesday": "Tuesday",
    "wed": "Wednesday",
    "weds": "Wednesday",
    "wednesday": "Wednesday",
    "thu": "Thursday",
    "thur": "Thursday",
    "thurs": "Thursday",
    "thursday": "Thursday",
    "fri": "Friday",
    "friday": "Friday",
    "sat": "Saturday",
    "saturday": "Saturday",
    "sun": "Sunday",
    "sunday": "Sunday",
}

# Column names searched (case-insensitively, in this order) for a day column.
DAY_COLUMN_ALIASES = ("Day of Week", "DayOfWeek", "weekday", "week day", "day_name")

# Substrings that mark a column as the place column (first match wins).
LOCATION_KEYWORDS = ("state", "ut", "city", "district", "region", "location", "place", "area")

# Hour intensity bins, right-closed: (-1, 8] Low, (8, 16] Medium, (16, 23] High.
INTENSITY_LABELS = ("Low", "Medium", "High")
INTENSITY_EDGES = (-1, 8, 16, 23)
INTENSITY_LEGEND = ("Low (0-8)", "Medium (9-16)", "High (17-23)")

# Category slots cycle through ten palette entries; legends show 12 rows.
PALETTE_SLOTS = 10
LEGEND_ROWS = 12
ALL_LEGEND_LABEL = "All Crimes"

# Map modes.
MAP_ALL, MAP_INTENSITY, MAP_TYPE = "All Crimes", "By Hour Intensity", "By Crime Type"

# Sort modes; any other string sorts by category frequency.
SORT_HOUR_ASC = "Hour Ascending"
SORT_HOUR_DESC = "Hour Descending"
SORT_CATEGORY = "Crime A-Z"
SORT_FREQUENCY = "Crime Frequency Descending"

# Summary metric names, in output order.
SUMMARY_METRICS = ("Total Crimes", "Unique Crime Types", "Peak Crime Hour", "Least Crime Hour")

# Simulated coordinates: latitude in [28.4, 28.9), longitude in [77.0, 77.5).
LAT_LOW, LAT_WIDTH = 28.4, 0.5
LON_LOW, LON_WIDTH = 77.0, 0.5

# Cluster-count rule: k = min(6, max(2, n // 250 + 2)), at most n.
CLUSTER_MIN, CLUSTER_MAX, CLUSTER_ROWS_PER_STEP = 2, 6, 250

# Training gates: at least 20 rows and 2 classes.
MIN_TRAIN_ROWS, MIN_CLASSES = 20, 2

# Tokens pandas reads as missing by default (public pandas behaviour).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Text of a missing category: that of a field missing from a CSV file.
MISSING_CATEGORY = "nan"


@dataclass(frozen=True)
class ColumnRoles:
    """Names of the columns an operator reads."""

    category: str = "category"
    lat: str = "lat"
    lon: str = "lon"
    hour: str = "hour"
    day: str | None = None
    key: str = "key"

    def required(self) -> list[str]:
        return [self.category, self.lat, self.lon, self.hour]

    def with_day(self, day: str | None) -> ColumnRoles:
        return replace(self, day=day)


@dataclass(frozen=True)
class FilterSpec:
    """Dashboard-style filter settings, applied lazily by ``apply_filters``.

    ``categories=None`` keeps every category; an empty tuple keeps none.
    ``search`` is a case-insensitive regular expression unless ``literal``.
    """

    categories: tuple[str, ...] | None = None
    hour_range: tuple[int, int] = (0, 23)
    search: str = ""
    literal: bool = False
    sort_mode: str | None = None
    columns: tuple[str, ...] = field(default_factory=tuple)
