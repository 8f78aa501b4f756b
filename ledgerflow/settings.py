"""Run parameters, passed to the operators as one frozen value."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date
from pathlib import Path
from types import MappingProxyType

# Default review weights, in report order.
DEFAULT_WEIGHTS = MappingProxyType(
    {
        "high_value_transaction": 2,
        "spending_deviation": 3,
        "rapid_repeat_transaction": 2,
        "geographic_inconsistency": 3,
        "unusual_international_activity": 2,
        "unusual_transaction_time": 1,
        "repeated_declines": 2,
        "balance_issue": 2,
    }
)


@dataclass(frozen=True)
class Settings:
    start_date: date = date(2024, 1, 1)
    end_date: date = date(2025, 12, 31)
    supported_currency: tuple[str, ...] = ("USD",)
    high_value_transaction: float = 5000
    rapid_transaction_minutes: int = 10
    negative_balance_warning: float = -500
    unusual_hour_start: int = 0
    unusual_hour_end: int = 5
    minimum_valid_rows: int = 50000
    weights: Mapping[str, int] = field(default_factory=lambda: DEFAULT_WEIGHTS)
    detected_timestamp: str | None = None
    #: Raw files have quoted line breaks inside fields; each file is then read by one task.
    multi_line_csv: bool = False


def read_settings(path: str) -> Settings:
    """Settings from a JSON file; names that are not there keep their defaults. Dates are ISO text."""
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    known = {part.name for part in fields(Settings)}
    if unknown := sorted(set(given) - known):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    for name in ("start_date", "end_date"):
        if name in given:
            given[name] = date.fromisoformat(given[name])
    if "supported_currency" in given:
        given["supported_currency"] = tuple(given["supported_currency"])
    if "weights" in given:
        given["weights"] = MappingProxyType(dict(DEFAULT_WEIGHTS) | given["weights"])
    return Settings(**given)
