"""The warehouse: staging -> enrichment -> intermediate -> marts -> checks.

``build_models`` declares every model as a lazy DataFrame (one plan each, for
inspection and tests).  ``run_warehouse`` materialises it the way it should
run at scale: the joined layer (read by four dimensions and the enriched
layer) is written once as Parquet, marts are written as tables, and the
incremental state (enrichment and cache) is appended to, never rewritten.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.clean import trim_to_null
from casegrid.functions.parse import sas_timestamp
from casegrid.functions.prompt import PROMPT_VERSION
from casegrid.functions.reply import EVENT_CATEGORIES, SEVERITY_TIERS
from casegrid.functions.lookup import EMPLOYEE_LABELS, EMPLOYEE_NULL_LABEL, LABEL_DEFAULT, OUTCOME_LABELS, OWNERSHIP_LABELS
from casegrid.operators import dims as D
from casegrid.operators import quality as Q
from casegrid.operators.enrich import (
    CACHE_SCHEMA,
    ENRICHMENT_SCHEMA,
    Classifier,
    enrich,
    rule_classifier,
)
from casegrid.operators.evaluation import eval_mart, run_summary
from casegrid.operators.fact import FACT_COLUMNS, build_fact
from casegrid.operators.dedupe import latest_per_key
from casegrid.operators.staging import (
    hot_establishments,
    join_enrichment,
    join_establishment,
    rejects,
    stage_cases,
    stage_enrichment,
    stage_establishments,
)
from casegrid.session import scratch_scope
from casegrid.sources.tables import reload_table
from casegrid.sources.versions import merge_into, read_table

MART_NAMES = ("dim_date", "dim_establishment", "dim_geography", "dim_industry",
              "dim_injury_type", "fct_incidents", "mart_llm_eval")


def build_models(raw: DataFrame, enrichment: DataFrame, strict: bool = True,
                 establishment_order: str = "text") -> dict[str, DataFrame]:
    cases = stage_cases(raw, strict)
    establishments = stage_establishments(raw, establishment_order, strict)
    joined = join_establishment(cases, establishments, hot_establishments(cases))
    return models_from(cases, establishments, joined, enrichment)


def models_from(cases, establishments, joined, enrichment, row: str | None = None) -> dict[str, DataFrame]:
    """``row``: the column that numbers the rows of ``cases`` and ``joined``,
    if they were joined by it; no model has it."""
    staged = stage_enrichment(enrichment)
    enriched = join_enrichment(joined, staged, cases, row)
    if row is not None:
        cases, joined, enriched = (df.drop(row) for df in (cases, joined, enriched))
    fact = build_fact(enriched)
    industry = D.dim_industry(joined)
    return {
        "stg_cases": cases,
        "stg_establishments": establishments,
        "stg_enrichment": staged,
        "int_joined": joined,
        "int_enriched": enriched,
        "dim_date": D.dim_date(joined),
        "dim_establishment": D.dim_establishment(establishments),
        "dim_geography": D.dim_geography(joined),
        "dim_industry": industry,
        "dim_injury_type": D.dim_injury_type(joined),
        "fct_incidents": fact,
        "mart_llm_eval": eval_mart(fact, industry),
    }


#: Columns of the joined layer that the marts read (those of the classifier
#: come from the enrichment table).
MART_READS = {*FACT_COLUMNS, *D.GEOGRAPHY_KEY, *D.INJURY_KEY, "naics_code", "industry_description",
              "oiics_nature_label", "oiics_body_part_label"}

#: Layer suites as data: (model, column) that must not be null, be unique,
#: point to a parent, or hold listed values.
SOURCE_NOT_NULL = (("raw_cases", "id"), ("raw_cases", "establishment_id"), ("llm_enrichment", "incident_id"))
SOURCE_UNIQUE = (("raw_cases", "id"), ("llm_enrichment", "incident_id"))
STAGING_NOT_NULL = (("stg_cases", "incident_id"), ("stg_cases", "establishment_id"),
                    ("stg_establishments", "establishment_id"), ("stg_enrichment", "incident_id"))
STAGING_UNIQUE = (("stg_cases", "incident_id"), ("stg_establishments", "establishment_id"),
                  ("stg_enrichment", "incident_id"))
INTERMEDIATE_NOT_NULL = (("int_joined", "incident_id"), ("int_joined", "establishment_id"),
                         ("int_enriched", "incident_id"))
INTERMEDIATE_UNIQUE = (("int_joined", "incident_id"), ("int_enriched", "incident_id"))
MART_KEYS = (("dim_establishment", "establishment_id"), ("dim_industry", "industry_id"),
             ("dim_geography", "geography_id"), ("dim_injury_type", "injury_type_id"),
             ("dim_date", "date_id"), ("fct_incidents", "incident_id"), ("mart_llm_eval", "eval_id"))
MART_NOT_NULL = (*MART_KEYS, ("mart_llm_eval", "sector"), ("mart_llm_eval", "severity_tier"),
                 ("mart_llm_eval", "agreement_rate"))
FOREIGN_KEYS = (("establishment_id", "dim_establishment"), ("industry_id", "dim_industry"),
                ("geography_id", "dim_geography"), ("injury_type_id", "dim_injury_type"),
                ("date_id", "dim_date"))
ACCEPTED = (
    ("stg_cases", "outcome_code", list(OUTCOME_LABELS)),
    ("dim_establishment", "employee_size_bucket", [*EMPLOYEE_LABELS, EMPLOYEE_NULL_LABEL]),
    ("dim_establishment", "ownership_type", [*OWNERSHIP_LABELS.values(), LABEL_DEFAULT]),
    ("dim_injury_type", "outcome", [*OUTCOME_LABELS.values(), LABEL_DEFAULT]),
    ("fct_incidents", "outcome_code", list(OUTCOME_LABELS)),
    ("fct_incidents", "llm_severity_tier", list(SEVERITY_TIERS)),
    ("fct_incidents", "llm_event_category", list(EVENT_CATEGORIES)),
)
ALL_NOT_NULL = (*SOURCE_NOT_NULL, *STAGING_NOT_NULL, *INTERMEDIATE_NOT_NULL, *MART_NOT_NULL)
ALL_UNIQUE = (*SOURCE_UNIQUE, *STAGING_UNIQUE, *INTERMEDIATE_UNIQUE, *MART_KEYS)
FRESH_DAYS = 90


def warehouse_checks(m: dict[str, DataFrame], min_coverage: float = 0.90,
                     as_of: datetime | None = None) -> list[Q.Check | Q.ScanCheck | Q.KeyCheck]:
    """The suites of the layers that ``m`` holds: source, staging,
    intermediate and marts.  Source freshness is checked where ``as_of`` is
    given."""
    fact = m["fct_incidents"]
    checks: list[Q.Check | Q.ScanCheck] = []
    for name, col in ALL_NOT_NULL:
        if name in m:
            checks.append(Q.scan_not_null(f"{name}.{col}.not_null", m[name], col))
    for name, col in ALL_UNIQUE:
        if name in m:
            checks.append(Q.KeyCheck(f"{name}.{col}.unique", m[name], col))
    for fk, dim in FOREIGN_KEYS:
        checks.append(Q.Check(f"fct_incidents.{fk}.relationships", lambda fk=fk, dim=dim: Q.relationships(
            fact.select("incident_id", fk), fk, m[dim], fk)))
    for name, col, vals in ACCEPTED:
        if name in m:
            checks.append(Q.scan_accepted(f"{name}.{col}.accepted_values", m[name], col, vals))
    checks += [
        Q.scan_between("fct_incidents.days_away_from_work.between", fact, "days_away_from_work", 0, 365,
                       "days_away_from_work is not null"),
        Q.scan_between("mart_llm_eval.agreement_rate.between", m["mart_llm_eval"], "agreement_rate", 0, 1),
        Q.scan_row_count("fct_incidents.row_count", fact),
        Q.scan_coverage("int_enriched.coverage", m["int_enriched"], "llm_event_category", min_coverage),
    ]
    if as_of is not None and "raw_cases" in m:
        loaded = sas_timestamp(trim_to_null(F.col("created_timestamp")), strict=False)
        checks.append(Q.scan_freshness("raw_cases.created_timestamp.freshness", m["raw_cases"], loaded, as_of,
                                       FRESH_DAYS))
    return checks


@dataclass
class RunOutput:
    out_dir: str
    raw_rows: int
    counters: dict
    report: list
    summary: dict
    rejects: dict


def run_warehouse(spark: SparkSession, raw: DataFrame, out_dir: str, state_dir: str | None = None,
                  classify: Classifier | None = None, run_ts: datetime | None = None,
                  model_name: str = "keyword-rules", prompt_version: str = PROMPT_VERSION,
                  strict: bool = True, gate: bool = True, min_coverage: float = 0.90,
                  as_of: datetime | None = None, limit: int | None = None, calls: int | None = None,
                  batches: int = 1, answers_path: str | None = None) -> RunOutput:
    """Run every layer, writing to ``out_dir``.

    Incremental state (the enrichment table and the answer cache) lies in
    ``state_dir``, a folder that runs share (by default ``out_dir``): a run
    replaces the parts that hold keys of its own; absent state is empty.  All
    tables are read with ``versions.read_table``; a run that fails leaves those
    of the run before.

    A failed check of error severity ends the run (``gate=False`` only
    reports).  Lenient typing (``strict=False``) counts what it could not
    parse in ``RunOutput.rejects``.  ``limit``, ``calls``, ``batches`` and
    ``answers_path`` are those of ``enrich``."""
    with scratch_scope():  # everything that is read later is stored in out_dir and state_dir
        return _run(spark, raw, out_dir, state_dir or out_dir, classify or rule_classifier(),
                    run_ts or datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None), model_name,
                    prompt_version, strict, gate, min_coverage, as_of, limit, calls, batches, answers_path)


def _run(spark, raw, out_dir, state_dir, classify, run_ts, model_name, prompt_version, strict, gate, min_coverage,
         as_of, limit, calls, batches, answers_path) -> RunOutput:
    p = lambda name: os.path.join(out_dir, name)

    raw_rows = reload_table(raw, p("raw_case_detail"))
    raw_t = read_table(spark, p("raw_case_detail"))

    cases = stage_cases(raw_t, strict)
    cache_path, target_path = os.path.join(state_dir, "llm_cache"), os.path.join(state_dir, "llm_enrichment")
    cache = read_table(spark, cache_path, CACHE_SCHEMA)
    target = read_table(spark, target_path, ENRICHMENT_SCHEMA)
    rejected = {k: v for k, v in rejects(raw_t).first().asDict().items() if v} if not strict else {}
    result = enrich(cases, cache, target, classify, run_ts, model_name, prompt_version, limit=limit, calls=calls,
                    batches=batches, answers_path=answers_path)
    counters = result.counters.first().asDict()

    # types every column of the cases: what does not parse ends the run before the state changes
    establishments = stage_establishments(raw_t, "text", strict)
    joined_path = p("int_incidents__joined")
    reload_table(join_establishment(cases, establishments, hot_establishments(cases)), joined_path)
    joined = read_table(spark, joined_path)

    rest = [c for c in result.updates.columns if c != "incident_id"]
    merge_into(latest_per_key(result.updates, ["incident_id"], ["enriched_at"], rest), target_path, ["incident_id"])
    merge_into(result.new_answers, cache_path, ["content_hash", "prompt_version"], replace=False)
    enrichment = read_table(spark, target_path, ENRICHMENT_SCHEMA)
    marts = models_from(cases, establishments, joined, enrichment)
    stored = dict(marts)
    for name in MART_NAMES:
        if name == "fct_incidents":  # date queries read the years they need
            fact = marts[name].withColumn("incident_year", F.year("incident_date"))
            reload_table(fact, p(name), ["incident_year"])
        elif name == "mart_llm_eval":
            reload_table(eval_mart(stored["fct_incidents"], stored["dim_industry"]), p(name))
        else:
            reload_table(marts[name], p(name))
        stored[name] = read_table(spark, p(name))
    stored |= {"raw_cases": raw_t, "llm_enrichment": enrichment}

    report_df = Q.report(warehouse_checks(stored, min_coverage, as_of))
    report = Q.gate(report_df) if gate else report_df.collect()
    summary = run_summary(stored["fct_incidents"], stored["mart_llm_eval"]).first().asDict()
    return RunOutput(out_dir, raw_rows, counters, [r.asDict() for r in report], summary, rejected)
