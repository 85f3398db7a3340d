"""The reports, one plan each. Importing this package fills the registry.

Reports come sorted. Where rows may be many, the id ends the sort key, so rows
that tie on the leading columns can still spread over the range partitions.
"""

from tallyhouse.plans import (  # noqa: F401
    baskets, customers, efficiency, products, regions, returns, sales, stored, trends,
)
from tallyhouse.plans.registry import PLANS

__all__ = ["PLANS"]
