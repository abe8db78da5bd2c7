"""Default parameters. Every operator takes them as arguments; nothing reads them implicitly."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta


@dataclass(frozen=True)
class Cutoffs:
    """Dates that split a purchase history; truth windows are ``(cutoff, cutoff + window_days]``."""

    train: date
    val: date
    test: date
    window_days: int = 7

    def truth_window(self, which: str = "val") -> tuple[date, date]:
        start = {"val": self.val, "test": self.test}[which]
        return start, start + timedelta(days=self.window_days)


# The published evaluation dates and model parameters.
DEFAULT_CUTOFFS = Cutoffs(date(2020, 9, 1), date(2020, 9, 15), date(2020, 9, 22))
TOP_K = 12
SECOND_K = 5
RECENT_DAYS = 7
DECAY = 0.5


@dataclass(frozen=True)
class BlendWeights:
    """Model order matters: it is the order in which equal scores are broken."""

    popularity: float = 0.2
    age_rules: float = 0.3
    next_item: float = 0.5

    def as_pairs(self) -> list[tuple[str, float]]:
        return [
            ("popularity", self.popularity),
            ("age_rules", self.age_rules),
            ("next_item", self.next_item),
        ]


@dataclass(frozen=True)
class PairSampling:
    """``max_samples`` bounds the positives a model is fitted on; None, for checking it, takes all."""

    negative_ratio: float = 2.0
    max_samples: int | None = 100_000
    seed: int = 42
    customer_fraction: float = 0.3
    article_fraction: float = 0.3


@dataclass(frozen=True)
class ServingTable:
    source: str
    target: str
    primary_key: list[str] = field(default_factory=lambda: ["id"])
    policy: str | None = None
