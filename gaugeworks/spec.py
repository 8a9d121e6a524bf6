"""The series contract shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

# They define the published result tables.
EXCEEDANCE_THRESHOLDS = (0.0, 0.2, 1.0, 5.0, 10.0)
LABEL_THRESHOLDS = (0.0, 1.0, 5.0, 10.0)
HISTOGRAM_EDGES = (0.0, 0.2, 0.4, 0.6, 1.0, 2.0, 3.0, 5.0, 10.0, 20.0)
TAIL_PERCENTILES = (0.5, 0.9, 0.95, 0.99, 0.999)
STUDY_YEARS = tuple(range(2017, 2025))
SPATIAL_YEARS = (2021, 2022, 2023, 2024)
PAST_SLOTS = 12
FUTURE_SLOTS = 6
SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class SeriesSpec:
    """Column roles and the slot length, in seconds, of one observation series."""

    entity: str = "station_id"
    time: str = "timestamp"
    value: str = "rainfall"
    slot_seconds: int = 300
    name: str = "station_name"
    latitude: str = "location_latitude"
    longitude: str = "location_longitude"

    def __post_init__(self) -> None:
        if self.slot_seconds < 1:
            raise ValueError("slot_seconds must be a positive whole number of seconds")

    @property
    def key(self) -> list[str]:
        return [self.entity, self.time]


@dataclass(frozen=True)
class SplitCuts:
    """First instants of the validation and the test split (ISO wall-clock text)."""

    validation: str = "2023-01-01 00:00:00"
    test: str = "2024-01-01 00:00:00"
    end: str = "2025-01-01 00:00:00"
