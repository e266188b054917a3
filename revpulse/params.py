"""Run parameters and the scoring policy, the two things a user tunes."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    """The observation date and the length of the inclusive usage window."""

    as_of_date: dt.date = dt.date(2025, 12, 31)
    usage_window_days: int = 90

    def __post_init__(self):
        if self.usage_window_days < 1:
            raise ValueError("usage_window_days must be at least 1")

    def to_json(self) -> str:
        return json.dumps({"as_of_date": self.as_of_date.isoformat(), "usage_window_days": self.usage_window_days})

    @classmethod
    def from_json(cls, text: str) -> Params:
        found = json.loads(text)
        return cls(dt.date.fromisoformat(found["as_of_date"]), found["usage_window_days"])

    @property
    def window_start(self) -> dt.date:
        return self.as_of_date - dt.timedelta(days=self.usage_window_days - 1)


# A band is (lower bound, result); the highest bound reached wins.
@dataclass(frozen=True)
class Policy:
    usage_bands: tuple = ((500, "high_usage"), (150, "medium_usage"), (1, "low_usage"))
    no_usage: str = "no_usage"
    low_usage: str = "low_usage"

    burden_tickets: tuple = ((8, "high_burden"), (4, "medium_burden"), (1, "low_burden"))
    burden_priority: tuple = ((3, "high_burden"), (1, "medium_burden"))
    no_burden: str = "no_burden"

    collection_risk_below: Decimal = Decimal("0.90")
    priority_ticket_risk: int = 3
    open_ticket_risk: int = 3

    usage_points: tuple = (("high_usage", 35), ("medium_usage", 25), ("low_usage", 8))
    adoption_points: tuple = ((5, 20), (3, 12), (1, 5))
    collection_points: tuple = (
        (Decimal("0.98"), 25),
        (Decimal("0.90"), 18),
        (Decimal("0.75"), 10),
    )
    partial_collection_points: int = 5
    uninvoiced_points: int = 18
    past_due_points: int = 5
    support_points: tuple = (("priority", 3), ("open", 6), ("high_burden", 8), ("medium_burden", 11))
    support_clear_points: int = 15
    relationship_points: tuple = (("both", 5), ("either", 3), ("any", 1))

    churned_cap: int = 20
    severe_cap: int = 49
    flagged_cap: int = 64

    segment_bands: tuple = ((80, "healthy"), (60, "watch"), (35, "at_risk"))

    mid_value_mrr: int = 5000
    high_value_mrr: int = 10000

    def to_json(self) -> str:
        """Decimals are written as ``{"decimal": text}``, so they come back exactly."""
        return json.dumps(asdict(self), default=lambda d: {"decimal": str(d)})

    @classmethod
    def from_json(cls, text: str) -> Policy:
        def frozen(value):
            return tuple(map(frozen, value)) if isinstance(value, list) else value

        found = json.loads(text, object_hook=lambda d: Decimal(d["decimal"]) if set(d) == {"decimal"} else d)
        return cls(**{name: frozen(value) for name, value in found.items()})
