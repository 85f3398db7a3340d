"""Name -> plan. A plan takes the logical tables and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from tallyhouse.sources.tables import Tables

Plan = Callable[[Tables], DataFrame]
PLANS: dict[str, Plan] = {}


def plan(name: str, **scaled):
    """Register a plan; with keyword arguments also ``<name>_scaled`` with them applied.

    Default thresholds suit small shops. The scaled variant runs the same operator
    with limits that separate large orders and large spends as well.
    """

    def register(function: Plan) -> Plan:
        PLANS[name] = function
        if scaled:
            PLANS[f"{name}_scaled"] = partial(function, **scaled)
        return function

    return register
