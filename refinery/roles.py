"""Which column plays which part, and the thresholds the gold layer uses."""

from __future__ import annotations

from dataclasses import dataclass

# The price tiers are half-open, [lower, upper); the last label
# also takes prices that are NULL.
TIER_BOUNDS = (25, 75, 200)
TIER_LABELS = ("0-25", "25-75", "75-200", "200+")


@dataclass(frozen=True)
class Roles:
    """Column names of the raw records and the parameters of the gold layer."""

    key: str = "id"
    title: str = "title"
    price: str = "price"
    description: str = "description"
    category: str = "category"
    rating: str = "rating"
    rate_field: str = "rate"
    count_field: str = "count"
    ingested_at: str = "_ingested_at"

    # A table with more than 2**31 keys sets "bigint".
    key_type: str = "int"
    price_type: str = "decimal(10,2)"

    # Fixed values, like the tiers above.
    min_reviews: int = 50
    top_n: int = 10
    tier_bounds: tuple = TIER_BOUNDS
    tier_labels: tuple = TIER_LABELS

    def __post_init__(self):
        if len(self.tier_labels) != len(self.tier_bounds) + 1:
            raise ValueError("tier_labels needs exactly one entry more than tier_bounds")
        if list(self.tier_bounds) != sorted(set(self.tier_bounds)):
            raise ValueError("tier_bounds must be strictly increasing")

    @property
    def required(self) -> tuple:
        return (self.key, self.title, self.price, self.category)


DEFAULT_ROLES = Roles()
