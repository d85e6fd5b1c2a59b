"""Business rules of the shipment tables as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Promised hours per service tier; any other tier, NULL
# included, counts as STANDARD.
SLA_HOURS = {"STANDARD": 48, "EXPRESS": 24, "OVERNIGHT": 12}

# Minutes a delay of the class stays below, and the longitude a
# region lies west of.
DELAY_BELOW = {"LOW": 60, "MEDIUM": 240}
WEST_OF = {"West": -115, "Mountain": -100, "Central": -85}


def sla_minutes(tier: Column, hours: dict[str, int] | None = None) -> Column:
    """Allowed delay in minutes for a service tier."""
    limits = {**SLA_HOURS, **(hours or {})}
    result = F
    for name, value in limits.items():
        if name != "STANDARD":
            result = result.when(tier == name, value * 60)
    return result.otherwise(limits["STANDARD"] * 60)


def _band(value: Column, limits: dict[str, int], rest: str) -> Column:
    """Name of the first limit a value is below; the rest has no upper limit
    and also takes unknown values."""
    result = F
    for name, limit in limits.items():
        result = result.when(value < limit, name)
    return result.otherwise(rest)


def severity(delay: Column, strict_nulls: bool = False) -> Column:
    """Delay class. An unknown delay is HIGH, or UNKNOWN with ``strict_nulls``."""
    known = F.when(delay == 0, "NONE").otherwise(_band(delay, DELAY_BELOW, "HIGH"))
    return F.when(delay.isNull(), "UNKNOWN").otherwise(known) if strict_nulls else known


def geo_region(longitude: Column) -> Column:
    """Longitude band; an unknown longitude counts as East."""
    return _band(longitude, WEST_OF, "East")
