"""User settings.

The defaults below are fixed values: the column names of the weather source,
the thresholds and the station codes must equal those of the data producers.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values.
ROLLING_PARAMS = (
    "Air temperature",
    "Wind speed",
    "Relative humidity",
    "Precipitation intensity",
    "Snow depth",
    "Pressure (msl)",
    "Horizontal visibility",
    "Cloud amount",
    "Precipitation amount",
)
FALLBACK_FEATURES = (
    "Snow depth",
    "Precipitation amount",
    "Precipitation intensity",
    "Horizontal visibility",
    "Wind speed",
    "Gust speed",
)
MANDATORY_STATIONS = ("HKI", "OL", "ROI")

DELAY = "differenceInMinutes"
DELAY_FROM_ORIGIN = "differenceInMinutes_offset"
DELAY_FROM_PREVIOUS = "differenceInMinutes_eachStation_offset"
DELAY_COLUMNS = (DELAY, DELAY_FROM_ORIGIN, DELAY_FROM_PREVIOUS)

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


@dataclass(frozen=True)
class Settings:
    """What to keep, what to compute and where the limits lie."""

    delay_threshold: int = 5
    filter_by_category: bool = True
    train_category: str = "Long-distance"
    filter_by_route: bool = False
    mandatory_stations: tuple[str, ...] = MANDATORY_STATIONS
    # west, south, east, north in degrees
    bounding_box: tuple[float, float, float, float] = (18.0, 55.0, 35.0, 75.0)
    rolling_hours: tuple[int, ...] = (12, 24, 72)
    rolling_params: tuple[str, ...] = ROLLING_PARAMS
    # parameters that are already sums: only mean and cumulative make sense
    rolling_without_extremes: tuple[str, ...] = ("Precipitation amount",)
    fallback_features: tuple[str, ...] = FALLBACK_FEATURES
    nearest_stations: int = 5
    common_delays: int = 10
    # a stop only sees weather of the month its train departed in
    match_within_month: bool = True
