"""Staging and intermediate models: typed, renamed, one row per entity."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions.clean import cast_int, cast_round, trim_to_null
from casegrid.functions.keys import surrogate_key
from casegrid.functions.parse import sas_date, sas_timestamp
from casegrid.functions.prompt import NARRATIVE_FIELDS
from casegrid.operators.dedupe import latest_per_key
from casegrid.operators.filters import any_present
from casegrid.operators.joins import hot_keys, key_counts, salted_join
from casegrid.session import materialise

# raw narrative header -> staged name (same order as NARRATIVE_FIELDS)
NARRATIVE_SOURCES = {
    "new_incident_location": "narrative_location",
    "new_incident_description": "narrative_description",
    "new_nar_before_incident": "narrative_activity",
    "new_nar_what_happened": "narrative_event",
    "new_nar_injury_illness": "narrative_injury",
    "new_nar_object_substance": "narrative_source",
}
# raw official-code headers -> staged (code, label) names
OFFICIAL_CODES = {
    "nature": "oiics_nature",
    "part": "oiics_body_part",
    "event": "oiics_event",
    "source": "oiics_source",
    "sec_source": "oiics_sec_source",
}

ESTABLISHMENT_RAW = (
    "establishment_id", "establishment_name", "company_name", "ein", "street_address",
    "city", "state", "zip_code", "naics_code", "naics_year", "industry_description",
    "establishment_type", "size", "annual_average_employees", "total_hours_worked",
)


def t(c: str):
    return trim_to_null(F.col(c))


def outcome_flag(outcome, code) -> "F.Column":
    """True where the outcome is ``code``; a missing outcome gives null."""
    return outcome == F.lit(code)


def stage_cases(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed case detail: keys, SAS dates, rounded measures, flags, renamed
    narratives and official codes; rows without any narrative are dropped."""
    outcome = cast_int(t("incident_outcome"), "int", strict)
    cols = [
        surrogate_key("id").alias("incident_id"),
        cast_int(F.col("id"), "bigint", strict).alias("osha_case_id"),
        t("case_number").alias("case_number"),
        surrogate_key("establishment_id").alias("establishment_id"),
        sas_date(t("date_of_incident"), strict).alias("incident_date"),
        sas_date(t("date_of_death"), strict).alias("death_date"),
        sas_timestamp(t("created_timestamp"), strict).alias("created_at"),
        cast_int(t("year_of_filing"), "int", strict).alias("filing_year"),
        outcome.alias("outcome_code"),
        cast_int(t("type_of_incident"), "int", strict).alias("incident_type_code"),
        cast_round(t("dafw_num_away"), "int", strict).alias("days_away_from_work"),
        cast_round(t("djtr_num_tr"), "int", strict).alias("days_restricted"),
        outcome_flag(outcome, 1).alias("is_death"),
        outcome_flag(outcome, 2).alias("is_dafw"),
        t("soc_code").alias("soc_code"),
        t("soc_description").alias("soc_description"),
        t("job_description").alias("job_description"),
        t("naics_code").alias("naics_code"),
        t("industry_description").alias("industry_description"),
        t("city").alias("city"),
        t("state").alias("state"),
        t("zip_code").alias("zip_code"),
        t("establishment_name").alias("establishment_name"),
        t("company_name").alias("company_name"),
        *[t(src).alias(dst) for src, dst in NARRATIVE_SOURCES.items()],
    ]
    for raw_name, staged in OFFICIAL_CODES.items():
        cols.append(cast_round(t(f"{raw_name}_code_pred"), "int", strict).alias(f"{staged}_code"))
        cols.append(t(f"{raw_name}_title_pred").alias(f"{staged}_label"))
    return any_present(raw.select(*cols), list(NARRATIVE_FIELDS))


def stage_establishments(raw: DataFrame, order: str = "text", strict: bool = True) -> DataFrame:
    """One row per source establishment id: its latest case's attributes.

    ``order='text'`` ranks by the raw ``created_timestamp`` text (the parity
    behaviour: '28FEB..' sorts after '04MAR..'); ``order='parsed'`` ranks by
    the parsed time.  Nulls rank last; ties break on the case id (desc).
    """
    if order == "text":
        rank = F.col("created_timestamp")
    elif order == "parsed":
        rank = sas_timestamp(t("created_timestamp"), strict=False)
    else:
        raise ValueError("order must be 'text' or 'parsed'")
    src = (raw.where(F.col("establishment_id").isNotNull())
           .select(*ESTABLISHMENT_RAW, rank.alias("_rank"), F.col("id").alias("_tie")))
    latest = latest_per_key(src, ["establishment_id"], [F.col("_rank")], [F.col("_tie")])
    return latest.select(
        surrogate_key("establishment_id").alias("establishment_id"),
        # ids need not be numeric; nothing downstream reads this column
        cast_int(F.col("establishment_id"), "bigint", strict=False).alias("osha_establishment_id"),
        t("establishment_name").alias("establishment_name"),
        t("company_name").alias("company_name"),
        t("ein").alias("ein"),
        t("street_address").alias("street_address"),
        t("city").alias("city"),
        t("state").alias("state"),
        t("zip_code").alias("zip_code"),
        t("naics_code").alias("naics_code"),
        cast_int(t("naics_year"), "int", strict).alias("naics_year"),
        t("industry_description").alias("industry_description"),
        cast_round(t("establishment_type"), "int", strict).alias("ownership_type_code"),
        cast_round(t("size"), "int", strict).alias("employee_size_code"),
        cast_round(t("annual_average_employees"), "int", strict).alias("annual_average_employees"),
        cast_round(t("total_hours_worked"), "bigint", strict).alias("total_hours_worked"),
    )


def rejects(raw: DataFrame) -> DataFrame:
    """One row: for every typed column how many raw values are present but do
    not parse.  Lenient typing turns those into nulls; this counts them."""
    typed = {
        "id": cast_int(F.col("id"), "bigint", strict=False),
        "date_of_incident": sas_date(t("date_of_incident"), False),
        "date_of_death": sas_date(t("date_of_death"), False),
        "created_timestamp": sas_timestamp(t("created_timestamp"), False),
        **{c: cast_int(t(c), "int", strict=False)
           for c in ("year_of_filing", "incident_outcome", "type_of_incident", "naics_year")},
        **{c: cast_round(t(c), "bigint", strict=False)
           for c in ("dafw_num_away", "djtr_num_tr", "establishment_type", "size", "annual_average_employees",
                     "total_hours_worked", *(f"{o}_code_pred" for o in OFFICIAL_CODES))},
    }
    return raw.agg(*[F.count_if(t(c).isNotNull() & v.isNull()).alias(c) for c, v in typed.items()])


ENRICHMENT_RENAMES = {
    "contributing_factor": "llm_contributing_factor",
    "severity_tier": "llm_severity_tier",
    "event_category": "llm_event_category",
    "recurrence_prevention": "llm_recurrence_action",
}


def stage_enrichment(enrichment: DataFrame) -> DataFrame:
    """Rename classifier output to the mart names; trim text to null."""
    return enrichment.select(
        "incident_id",
        *[t(src).alias(dst) for src, dst in ENRICHMENT_RENAMES.items()],
        F.col("confidence").alias("llm_confidence"),
        "prompt_version", "model_name", "enriched_at",
    )


CASE_COLUMNS = (
    "incident_id", "osha_case_id", "case_number", "establishment_id", "incident_date",
    "death_date", "created_at", "filing_year", "outcome_code", "incident_type_code",
    "days_away_from_work", "days_restricted", "is_death", "is_dafw", "soc_code",
    "soc_description", "job_description",
)
ESTABLISHMENT_COLUMNS = (
    "establishment_name", "company_name", "ein", "street_address", "city", "state",
    "zip_code", "naics_code", "naics_year", "industry_description", "ownership_type_code",
    "employee_size_code", "annual_average_employees", "total_hours_worked",
)
CODE_COLUMNS = tuple(f"{s}_{k}" for s in OFFICIAL_CODES.values() for k in ("code", "label"))
#: Numbers the rows of stored cases (ids may repeat).
CASE_ROW = "case_row"


def hot_establishments(cases: DataFrame, partitions: int | None = None) -> dict:
    """Establishment keys of the staged cases that need salting, with their
    number of salts.  A missing id is one shared key and counts as such."""
    return hot_keys(key_counts(cases.select("establishment_id"), ["establishment_id"]), "establishment_id",
                    partitions=partitions)


def join_establishment(cases: DataFrame, establishments: DataFrame,
                       hot: dict | None = None, columns: Collection[str] | None = None,
                       row: str | None = None) -> DataFrame:
    """Many-to-one left join: one row per incident, establishment context
    taken from the deduplicated establishment model.  With ``hot`` (see
    ``hot_establishments``) the cases of a very large establishment, or of
    none, are salted over many tasks instead of landing in one.
    ``columns``: those that the consumers read (both ids are always there);
    the others are not joined.

    ``row`` names a column of ``cases`` that numbers their rows.  Then the
    establishments are joined to the row numbers and ids alone, and stored; the
    cases, texts included, are dealt out by row number, as ``join_enrichment``
    needs them, and not by establishment before.  The result has the column
    ``row`` too."""
    def read(names):
        return [c for c in names if columns is None or c in columns or c in ("incident_id", "establishment_id")]

    rows = [] if row is None else [row]
    e = establishments.select("establishment_id", *read(ESTABLISHMENT_COLUMNS))
    i = cases.select(*rows, *read(CASE_COLUMNS), *read(NARRATIVE_FIELDS), *read(CODE_COLUMNS))
    if row is None:
        joined = salted_join(i, e, "establishment_id", hot or {}, F.col("incident_id"), "left")
    else:
        found = salted_join(i.select(row, "establishment_id"), e, "establishment_id", hot or {}, F.col(row), "left")
        joined = i.join(materialise(found.drop("establishment_id"), "case-establishments", "zstd"), row, "left")
    return joined.select(*rows, *read((*CASE_COLUMNS, *ESTABLISHMENT_COLUMNS, *NARRATIVE_FIELDS, *CODE_COLUMNS)))


ENRICHED_EXTRA = (
    "llm_contributing_factor", "llm_severity_tier", "llm_event_category",
    "llm_recurrence_action", "llm_confidence",
)


def join_enrichment(joined: DataFrame, staged_enrichment: DataFrame, ids: DataFrame | None = None,
                    row: str | None = None) -> DataFrame:
    """Left join: un-enriched incidents flow through with null columns.

    ``row`` names the column that numbers the rows of ``joined`` (see
    ``join_establishment``) and ``ids`` holds it with their incident ids.  Then
    the classifier's columns are joined to these, stored, and meet the wide rows
    by row number."""
    e = staged_enrichment.select(
        "incident_id", *ENRICHED_EXTRA,
        F.col("prompt_version").alias("llm_prompt_version"),
        F.col("model_name").alias("llm_model_name"),
        F.col("enriched_at").alias("llm_enriched_at"))
    if row is None:
        return joined.join(e, "incident_id", "left")
    found = ids.select(row, "incident_id").join(e, "incident_id", "left").drop("incident_id")
    return joined.join(materialise(found, "case-answers", "zstd"), row, "left")
