"""Job parameters as frozen dataclasses (defaults are the published ones)."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


@dataclass(frozen=True)
class IngestSettings:
    fleets: tuple[str, ...] = ("yellow", "green")
    months: tuple[str, ...] = ("2022-01", "2022-02")
    sample_rows: int | None = None  # about so many rows per raw file, by seeded hash; None keeps all


@dataclass(frozen=True)
class WindowSettings:
    start: str = "2022-01-01"  # inclusive
    end: str = "2022-03-01"    # exclusive


@dataclass(frozen=True)
class CleaningSettings:
    min_fare: float = 0.0
    max_fare: float = 500.0
    min_distance: float = 0.0
    max_distance: float = 100.0
    min_duration_min: float = 1.0
    max_duration_min: float = 180.0
    max_passengers: int = 6


@dataclass(frozen=True)
class ForecastSettings:
    test_days: int = 7
    fleets: tuple[str, ...] = ("yellow", "green")
    horizon: int = 24        # backtest fold length in hours
    folds: int = 3
    # Gradient-boosted trees, see ridemart.operators.boosting.
    max_iter: int = 500
    max_depth: int = 7
    max_leaves: int = 31
    step_size: float = 0.06
    max_bins: int = 255
    min_leaf: int = 20
    l2: float = 1.0


@dataclass(frozen=True)
class AnomalySettings:
    contamination: float = 0.01
    sample_rows: int | None = None   # None scores the whole fact table
    trees: int = 200
    max_samples: int = 256
    seed: int = 7


@dataclass(frozen=True)
class QualitySettings:
    sample_rows: int | None = None   # None validates the whole table


@dataclass(frozen=True)
class ExportSettings:
    # Tables written as CSV next to parquet: all that are summaries by design.
    csv_tables: tuple[str, ...] = (
        "dim_date", "dim_fleet", "dim_time", "dim_zone", "mart_zone_demand", "mart_hourly_volume",
        "mart_daily_volume", "mart_route_flows", "mart_forecast", "mart_forecast_metrics",
        "mart_forecast_backtest", "mart_anomaly_summary")


@dataclass(frozen=True)
class Settings:
    ingest: IngestSettings = field(default_factory=IngestSettings)
    window: WindowSettings = field(default_factory=WindowSettings)
    cleaning: CleaningSettings = field(default_factory=CleaningSettings)
    forecast: ForecastSettings = field(default_factory=ForecastSettings)
    anomaly: AnomalySettings = field(default_factory=AnomalySettings)
    quality: QualitySettings = field(default_factory=QualitySettings)
    export: ExportSettings = field(default_factory=ExportSettings)
    # Fact id numbering: "scan" (storage order, no shuffle) or "sorted" (range
    # sort on the fact columns, reproducible order).
    fact_ids: str = "scan"
    # Partitions for the "sorted" numbering; None sizes them from the row count.
    id_partitions: int | None = None

    def replace(self, **sections) -> Settings:
        """Copy with whole sections or nested fields replaced.

        ``s.replace(window={"start": "2024-01-01"})`` or
        ``s.replace(window=WindowSettings(...))``.
        """
        out = {}
        for name, value in sections.items():
            if isinstance(value, dict):
                value = dataclasses.replace(getattr(self, name), **value)
            out[name] = value
        return dataclasses.replace(self, **out)


def settings_from_dict(data: dict) -> Settings:
    """Settings from nested sections, e.g. parsed from a JSON file.

    ``{"window": {"start": "2022-01-01"}, "forecast": {"fleets": ["yellow"]}}``;
    unknown keys are an error, lists become tuples, missing keys keep
    their defaults.
    """
    sections, top = {}, {}
    for key, value in data.items():
        if isinstance(value, dict):
            sections[key] = {k: tuple(v) if isinstance(v, list) else v for k, v in value.items()}
        else:
            top[key] = value
    s = Settings().replace(**sections)
    return dataclasses.replace(s, **top) if top else s


def fixture_settings() -> Settings:
    """Settings for the trips derived from the driver tables (FIXTURES.md B); the window covers the table."""
    return Settings().replace(window={"start": "2024-01-01", "end": "2024-02-01"})
