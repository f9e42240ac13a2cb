"""Code lookups and range buckets as literal maps (no join, constant-size)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.functions._util import to_col

# ---------------------------------------------------------------------------
# Fixed values (public classifications).  Kept as data, in natural order.
# ---------------------------------------------------------------------------

# NAICS two-digit sector prefix -> sector title.
NAICS_SECTORS: dict[str, str] = {
    "11": "Agriculture, Forestry, Fishing and Hunting",
    "21": "Mining, Quarrying, and Oil and Gas Extraction",
    "22": "Utilities",
    "23": "Construction",
    "31": "Manufacturing",
    "32": "Manufacturing",
    "33": "Manufacturing",
    "42": "Wholesale Trade",
    "44": "Retail Trade",
    "45": "Retail Trade",
    "48": "Transportation and Warehousing",
    "49": "Transportation and Warehousing",
    "51": "Information",
    "52": "Finance and Insurance",
    "53": "Real Estate and Rental and Leasing",
    "54": "Professional, Scientific, and Technical Services",
    "55": "Management of Companies and Enterprises",
    "56": "Administrative, Support, and Waste Management Services",
    "61": "Educational Services",
    "62": "Health Care and Social Assistance",
    "71": "Arts, Entertainment, and Recreation",
    "72": "Accommodation and Food Services",
    "81": "Other Services (except Public Administration)",
    "92": "Public Administration",
}
NAICS_DEFAULT = "Unknown"

# US Census Bureau regions (50 states + DC), by region.
CENSUS_REGION_STATES: dict[str, tuple[str, ...]] = {
    "Northeast": ("CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"),
    "Midwest": ("IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"),
    "South": ("DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS",
              "TN", "AR", "LA", "OK", "TX"),
    "West": ("AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"),
}
CENSUS_REGIONS: dict[str, str] = {s: r for r, states in CENSUS_REGION_STATES.items() for s in states}
REGION_DEFAULT = "Other"

# Classifier event category -> coarse event bucket (two contact categories
# collapse because the official division does not tell them apart).
COARSE_FROM_CATEGORY: dict[str, str] = {
    "struck_by_or_against": "contact_or_struck",
    "contact_with_equipment": "contact_or_struck",
    "fall_slip_trip": "fall_slip_trip",
    "overexertion_bodily_reaction": "overexertion",
    "exposure_harmful_substance": "exposure",
    "transportation": "transportation",
    "fire_explosion": "fire_explosion",
    "violence": "violence",
}
# Official event code, first digit of its text (the division) -> coarse bucket.
COARSE_FROM_DIVISION: dict[str, str] = {
    "1": "violence",
    "2": "transportation",
    "3": "fire_explosion",
    "4": "fall_slip_trip",
    "5": "exposure",
    "6": "contact_or_struck",
    "7": "overexertion",
}
COARSE_DEFAULT = "other"

OUTCOME_LABELS: dict[int, str] = {
    1: "Death",
    2: "Days away from work",
    3: "Job transfer or restriction",
    4: "Other recordable",
}
OWNERSHIP_LABELS: dict[int, str] = {
    1: "Private",
    2: "State government",
    3: "Local government",
}
LABEL_DEFAULT = "Unknown"

# Employee headcount buckets: upper bounds (exclusive) and labels.
EMPLOYEE_BOUNDS = (50, 250, 1000)
EMPLOYEE_LABELS = ("Small (under 50)", "Medium (50 to 249)", "Large (250 to 999)",
                   "Very large (1000 or more)")
EMPLOYEE_NULL_LABEL = "Unknown"


# ---------------------------------------------------------------------------
def map_code(c, mapping: Mapping, default=None, prefix: int | None = None,
             null_value=None, null_passes: bool = False) -> Column:
    """Look ``c`` (or its first ``prefix`` characters) up in a literal map.

    Missing keys give ``default``; a null input gives ``null_value`` when
    ``null_passes`` is set, else it is treated like a missing key.
    """
    key = to_col(c)
    if prefix is not None:
        key = F.substring(key.cast("string"), 1, prefix)
    lit_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    looked = F.try_element_at(lit_map, key)
    out = F.coalesce(looked, F.lit(default)) if default is not None else looked
    if null_passes:
        out = F.when(to_col(c).isNull(), F.lit(null_value)).otherwise(out)
    return out


def bucketize(c, bounds: Sequence, labels: Sequence[str], null_label: str) -> Column:
    """Range bucket: ``labels[i]`` for ``c < bounds[i]``, last label above."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    col = to_col(c)
    expr = F.when(col.isNull(), F.lit(null_label))
    for b, lab in zip(bounds, labels):
        expr = expr.when(col < F.lit(b), F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def naics_sector(c) -> Column:
    return map_code(c, NAICS_SECTORS, NAICS_DEFAULT, prefix=2)


def census_region(c) -> Column:
    return map_code(F.upper(to_col(c)), CENSUS_REGIONS, REGION_DEFAULT)


def coarse_event_from_category(c) -> Column:
    """Null or unknown categories fall into 'other'."""
    return map_code(c, COARSE_FROM_CATEGORY, COARSE_DEFAULT)


def coarse_event_from_code(c) -> Column:
    """Null code stays null; else the division digit's bucket, else 'other'."""
    return map_code(c, COARSE_FROM_DIVISION, COARSE_DEFAULT, prefix=1,
                    null_value=None, null_passes=True)


def outcome_label(c) -> Column:
    return map_code(c, OUTCOME_LABELS, LABEL_DEFAULT)


def ownership_label(c) -> Column:
    return map_code(c, OWNERSHIP_LABELS, LABEL_DEFAULT)


def employee_size_bucket(c) -> Column:
    return bucketize(c, EMPLOYEE_BOUNDS, EMPLOYEE_LABELS, EMPLOYEE_NULL_LABEL)
