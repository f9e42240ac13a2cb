"""Dimension builds.  Null members are kept on purpose: the fact derives its
foreign keys by hashing, so a null member needs its own (non-null) key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions.keys import surrogate_key
from casegrid.functions.lookup import (
    census_region,
    employee_size_bucket,
    naics_sector,
    outcome_label,
    ownership_label,
)

INJURY_KEY = ("outcome_code", "oiics_nature_code", "oiics_body_part_code", "oiics_event_code")
GEOGRAPHY_KEY = ("city", "state", "zip_code")


def dim_date(joined: DataFrame, date_col: str = "incident_date") -> DataFrame:
    dates = joined.select(F.col(date_col).alias("full_date")).distinct()
    return dates.select(
        surrogate_key("full_date").alias("date_id"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
    )


def dim_geography(joined: DataFrame) -> DataFrame:
    geos = joined.select(*GEOGRAPHY_KEY).distinct()
    return geos.select(
        surrogate_key(*GEOGRAPHY_KEY).alias("geography_id"),
        *GEOGRAPHY_KEY,
        census_region("state").alias("region"),
    )


def dim_industry(joined: DataFrame) -> DataFrame:
    inds = joined.groupBy("naics_code").agg(F.max("industry_description").alias("naics_title"))
    return inds.select(
        surrogate_key("naics_code").alias("industry_id"),
        "naics_code",
        "naics_title",
        naics_sector("naics_code").alias("sector"),
    )


def dim_injury_type(joined: DataFrame) -> DataFrame:
    types = joined.groupBy(*INJURY_KEY).agg(
        F.max("oiics_nature_label").alias("oiics_nature_label"),
        F.max("oiics_body_part_label").alias("oiics_body_part_label"),
        F.max("oiics_event_label").alias("oiics_event_label"),
    )
    return types.select(
        surrogate_key(*INJURY_KEY).alias("injury_type_id"),
        outcome_label("outcome_code").alias("outcome"),
        "outcome_code",
        "oiics_nature_code", "oiics_nature_label",
        "oiics_body_part_code", "oiics_body_part_label",
        "oiics_event_code", "oiics_event_label",
    )


def dim_establishment(establishments: DataFrame) -> DataFrame:
    """Already one row per establishment: a map-only projection."""
    return establishments.select(
        "establishment_id", "establishment_name", "company_name", "ein",
        employee_size_bucket("annual_average_employees").alias("employee_size_bucket"),
        ownership_label("ownership_type_code").alias("ownership_type"),
    )
