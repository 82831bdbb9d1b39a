"""Thresholds and paths, passed as plain arguments."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """What a row must satisfy to be valid."""

    timestamp_length: int = 14
    min_age: int = 16
    max_age: int = 100
    min_rating: float = 1.0
    max_rating: float = 5.0
    min_commission: float = 0.0
    max_commission: float = 1.0


@dataclass(frozen=True)
class Scoring:
    """Sliding-window length and the conditions that make a transaction suspicious."""

    window_days: int = 7
    active_days: int = 5
    amount_pct: float = 300.0
    delay_minutes: float = 5.0
    min_conditions: int = 2

    def __post_init__(self) -> None:
        if self.window_days < 1:
            raise ValueError("window_days must be 1 or more")


@dataclass(frozen=True)
class InputPaths:
    """Where the four tables are; any path Spark can read."""

    transactions: str
    users: str
    products: str
    merchants: str

    @classmethod
    def under(cls, folder: str) -> "InputPaths":
        root = folder.rstrip("/")
        return cls(
            transactions=f"{root}/transactions.csv",
            users=f"{root}/users.json",
            products=f"{root}/products.parquet",
            merchants=f"{root}/merchants.csv",
        )
