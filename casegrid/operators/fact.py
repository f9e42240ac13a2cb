"""Fact build: foreign keys are hashed from the row itself (no dimension
join), so building the fact is map-only after the two left joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions.keys import surrogate_key
from casegrid.functions.prompt import NARRATIVE_FIELDS
from casegrid.operators.dims import GEOGRAPHY_KEY, INJURY_KEY

FACT_COLUMNS = (
    "incident_id", "establishment_id", "industry_id", "geography_id", "injury_type_id",
    "date_id", "days_away_from_work", "days_restricted", "is_death", "is_dafw",
    "outcome_code", "oiics_event_code", "oiics_event_label", "incident_date",
    "llm_contributing_factor", "llm_severity_tier", "llm_recurrence_action",
    "llm_event_category", "llm_confidence", *NARRATIVE_FIELDS,
)


def foreign_keys() -> dict:
    return {
        "industry_id": surrogate_key("naics_code"),
        "geography_id": surrogate_key(*GEOGRAPHY_KEY),
        "injury_type_id": surrogate_key(*INJURY_KEY),
        "date_id": surrogate_key("incident_date"),
    }


def build_fact(enriched: DataFrame) -> DataFrame:
    """The fact; without the texts where ``enriched`` has none."""
    fks = foreign_keys()
    wanted = [c for c in FACT_COLUMNS if c in fks or c in enriched.columns or c not in NARRATIVE_FIELDS]
    return enriched.select(*[fks[c].alias(c) if c in fks else F.col(c) for c in wanted])
