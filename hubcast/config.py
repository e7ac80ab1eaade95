"""Hub settings.

The settings document of a hub is tiny (a list of quantile levels, a list of
horizons and two weekday names), so it lives on the driver as a frozen
dataclass and enters plans as literals. ``HubConfig.from_json`` reads the
same nested JSON layout a hub keeps next to its data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# The 23 quantile levels a forecast hub asks for.
HUB_QUANTILES = (
    0.01, 0.025, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5,
    0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99,
)

# Weekday names, Monday = 1 ... Sunday = 7.
WEEKDAYS = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)

# Defaults for the name of the baseline and the pattern of the hub's own ensembles.
BASELINE_MODEL = "hub-baseline"
HUB_ENSEMBLE_PATTERN = "^hub-.*ensemble"


def weekday_number(name: str) -> int:
    """Monday=1 .. Sunday=7; unknown names raise instead of matching nothing."""
    try:
        return WEEKDAYS.index(name) + 1
    except ValueError:
        raise ValueError(f"unknown weekday name {name!r}; expected one of {WEEKDAYS}") from None


@dataclass(frozen=True)
class HubConfig:
    quantiles: tuple[float, ...] = HUB_QUANTILES
    horizons: tuple[int, ...] = (1, 2, 3, 4)
    ensemble_horizons: tuple[int, ...] | None = None
    week_end_day: str = "Saturday"
    forecast_week_day: str = "Monday"
    baseline_model: str = BASELINE_MODEL
    ensemble_pattern: str = HUB_ENSEMBLE_PATTERN
    temporal_resolution: str = "wk"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def required_horizons(self) -> tuple[int, ...]:
        """``ensemble_horizon`` when set, else ``horizon.values``."""
        return tuple(self.ensemble_horizons) if self.ensemble_horizons else tuple(self.horizons)

    @property
    def n_quantiles(self) -> int:
        return len(self.quantiles)

    def with_(self, **kw) -> "HubConfig":
        return replace(self, **kw)

    @classmethod
    def from_dict(cls, doc: dict) -> "HubConfig":
        base = cls()
        ft = doc.get("forecast_type") or {}
        hz = doc.get("horizon") or {}
        ens = doc.get("ensemble_horizon")
        return cls(
            quantiles=tuple(float(q) for q in ft.get("quantiles", base.quantiles)),
            horizons=tuple(int(h) for h in hz.get("values", base.horizons)),
            ensemble_horizons=tuple(int(h) for h in ens) if ens else None,
            week_end_day=doc.get("week_end_day", base.week_end_day),
            forecast_week_day=doc.get("forecast_week_day", base.forecast_week_day),
            extra={k: v for k, v in doc.items()
                   if k not in ("forecast_type", "horizon", "ensemble_horizon",
                                "week_end_day", "forecast_week_day")},
        )

    @classmethod
    def from_json(cls, path: str) -> "HubConfig":
        """Read the settings document (a few hundred bytes) on the driver."""
        with open(path) as fh:
            return cls.from_dict(json.load(fh))
