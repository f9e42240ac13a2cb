"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables (or data Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.prompt import NARRATIVE_FIELDS
from casegrid.operators.enrich import empty_cache, empty_enrichment, enrich, rule_classifier
from casegrid.operators.joins import balanced_join
from casegrid.operators.staging import (
    CASE_COLUMNS,
    CASE_ROW,
    CODE_COLUMNS,
    hot_establishments,
    join_establishment,
    stage_cases,
    stage_establishments,
)
from casegrid.session import materialise as materialise_table, scratch_path
from casegrid.sources.tables import reload_table
from casegrid.sources.versions import read_table
from casegrid.plans.analogues import MODEL_NAME, RUN_TS, raw_cases
from casegrid.operators.evaluation import eval_mart
from casegrid.plans.warehouse import MART_NAMES, MART_READS, models_from

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query and, when it has one, its DuckDB oracle SQL."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def run_ts() -> datetime:
    return datetime.fromisoformat(RUN_TS)


# ---------------------------------------------------------------------------
# Warehouse on the rendered case export
# ---------------------------------------------------------------------------

NEEDS_ENRICHMENT = {"int_enriched", "fct_incidents", "mart_llm_eval"}
NEEDS_NO_JOIN = {"stg_cases", "stg_establishments", "dim_establishment"}
WITH_TEXTS = {"int_enriched", "fct_incidents"}


def warehouse(spark: SparkSession, sf_dir: str, enriched: bool = True, joins: bool = True,
              store: bool = False, narratives: bool = True, whole: bool = False,
              by_row: bool = False) -> dict[str, DataFrame]:
    """All models of one build.  ``enriched=False`` skips the classification
    and ``joins=False`` the count of hot establishments, for models that read
    neither.

    ``store`` writes the typed cases, the establishments and the joined layer
    once as Parquet in the shared checkpoint folder, for queries that read
    several models: each consumer then scans the columns it needs instead of
    rendering, typing and joining the export again.  A build with
    classification reads the cases several times and always stores them.
    Establishments are the latest rows of the export without its documents,
    which they do not read.  What is stored are the columns that the marts and the
    classification read, with ``whole`` all that the joined layer has;
    ``narratives=False`` keeps the texts out of the joined layer and the fact.

    ``by_row``, for a build with classification of which one model with its texts
    is read: the stored cases are numbered, establishments and answers are joined
    to the numbers, and the wide rows move once to meet both.
    """
    raw = raw_cases(spark, sf_dir)
    cases, establishments = stage_cases(raw), stage_establishments(raw_cases(spark, sf_dir, texts=False))
    reads = None if whole or not (store or enriched) else (
        MART_READS if narratives else MART_READS - set(NARRATIVE_FIELDS))
    if store or enriched:
        texts = {*NARRATIVE_FIELDS, "industry_description"} if enriched else set()
        numbers = [F.monotonically_increasing_id().alias(CASE_ROW)] if by_row else []
        cases = materialise_table(cases.select(*numbers, *[
            c for c in cases.columns if c in (*CASE_COLUMNS, *CODE_COLUMNS, *texts)
            and (reads is None or c in reads | texts)]), "stg-cases", "zstd")
    if store:
        establishments = materialise_table(establishments, "stg-establishments", "zstd")
    if enriched:  # the rows of a run are stored, and there is no earlier state
        target = enrich(cases, empty_cache(spark), empty_enrichment(spark),
                        rule_classifier(), run_ts(), MODEL_NAME).target
    else:
        target = empty_enrichment(spark)
    row = CASE_ROW if by_row else None
    joined = join_establishment(cases, establishments, hot_establishments(cases) if joins else None, reads, row)
    if store:
        joined = materialise_table(joined, "int-joined", "zstd")
    return models_from(cases, establishments, joined, target, row) | {"raw_cases": raw, "llm_enrichment": target}


def _model(name: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir, name in NEEDS_ENRICHMENT, name not in NEEDS_NO_JOIN,
                                           whole=name == "int_enriched", by_row=name in WITH_TEXTS)[name]


for _key, _model_name in (
    ("stage_cases", "stg_cases"),
    ("stage_establishments", "stg_establishments"),
    ("join_establishment", "int_joined"),
    ("join_enrichment", "int_enriched"),
    ("fact_foreign_keys", "fct_incidents"),
    ("dim_date", "dim_date"),
    ("dim_geography", "dim_geography"),
    ("dim_industry", "dim_industry"),
    ("dim_injury_type", "dim_injury_type"),
    ("dim_establishment", "dim_establishment"),
    ("eval_mart", "mart_llm_eval"),
):
    QUERIES[_key] = _model(_model_name)


def star_rollup_of(m: dict[str, DataFrame]) -> DataFrame:
    """Fact to its five dimensions, rolled up by year x region x sector x
    outcome x size bucket.

    The fact is first joined to the establishments, reduced to the size bucket,
    then to the date, geography and industry dimensions.  Each join takes one
    column of a dimension in place of its key, so the rows get narrower, and
    AQE turns it into a broadcast when the dimension is small at run time.
    Before it meets the injury types, which can be as many as the incidents,
    the rows are aggregated: those of one injury type are at most one per
    combination of the other labels, however popular it is.
    No classifier column is read, so the build needs no enrichment.
    """
    fact = m["fct_incidents"].select(
        "incident_id", "establishment_id", "date_id", "geography_id", "industry_id", "injury_type_id",
        "days_away_from_work", "is_death")
    est = m["dim_establishment"].select("establishment_id", "employee_size_bucket")
    rows = balanced_join(fact, est, "establishment_id", F.col("incident_id"), "left").drop("establishment_id")
    for dim, key, label in (("dim_date", "date_id", "year"), ("dim_geography", "geography_id", "region"),
                            ("dim_industry", "industry_id", "sector")):
        rows = rows.join(m[dim].select(key, label), key, "left").drop(key)
    pre = (rows
           .groupBy("injury_type_id", "year", "region", "sector", "employee_size_bucket")
           .agg(F.count(F.lit(1)).alias("n"),
                F.sum("days_away_from_work").alias("days"),
                F.count_if(F.col("is_death")).alias("deaths")))
    joined = pre.join(m["dim_injury_type"].select("injury_type_id", "outcome"), "injury_type_id", "left")
    return joined.groupBy("year", "region", "sector", "outcome", "employee_size_bucket").agg(
        F.sum("n").alias("incidents"),
        F.sum("days").alias("days_away_from_work"),
        F.sum("deaths").alias("deaths"))


@register("star_rollup")
def q_star_rollup(spark, sf_dir):
    m = warehouse(spark, sf_dir, enriched=False, store=True, narratives=False)
    # stored, their sizes are known before the fact is dealt out for a join
    small = {name: materialise_table(m[name].select(*columns), name, "zstd") for name, *columns in (
        ("dim_date", "date_id", "year"), ("dim_geography", "geography_id", "region"),
        ("dim_industry", "industry_id", "sector"))}
    return star_rollup_of(m | small)


def year_rollup(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Incidents, days away and deaths per year, for the years that ``dates``
    (rows of the date dimension) holds.  ``fact`` is stored by incident year:
    the dates are reduced to their years first, and the scan of the fact is
    pruned to these at run time."""
    years = dates.select("year").distinct()
    return (fact.join(years, F.col("incident_year") == F.col("year"))
            .groupBy("year").agg(F.count(F.lit(1)).alias("incidents"),
                                 F.sum("days_away_from_work").alias("days_away_from_work"),
                                 F.count_if(F.col("is_death")).alias("deaths")))


@register("fact_by_year")
def q_fact_by_year(spark, sf_dir):
    """The stored fact, read for the years that have a case on a 29 February."""
    m = warehouse(spark, sf_dir, enriched=False, store=True, narratives=False)
    path = scratch_path(spark, "fact-by-year")
    reload_table(m["fct_incidents"].withColumn("incident_year", F.year("incident_date")), path, ["incident_year"])
    dates = materialise_table(m["dim_date"], "dim-date")
    return year_rollup(read_table(spark, path), dates.where("month = 2 AND day(full_date) = 29"))


KEY_OF = {"dim_date": "date_id", "dim_establishment": "establishment_id",
          "dim_geography": "geography_id", "dim_industry": "industry_id",
          "dim_injury_type": "injury_type_id", "fct_incidents": "incident_id",
          "mart_llm_eval": "eval_id"}


@register("marts_row_counts")
def q_marts_row_counts(spark, sf_dir):
    """Every mart of one full build stored as a table, then rows and distinct
    keys of what was stored (grain check)."""
    m = warehouse(spark, sf_dir, store=True)
    base = scratch_path(spark, "marts")
    parts = []
    for n in MART_NAMES:
        mart = m[n]
        if n == "mart_llm_eval":  # the stored fact holds the join of the layers
            mart = eval_mart(*[read_table(spark, f"{base}/{x}") for x in ("fct_incidents", "dim_industry")])
        rows = reload_table(mart, f"{base}/{n}")
        parts.append(read_table(spark, f"{base}/{n}").agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct(KEY_OF[n]).alias("distinct_keys"))
            .select(F.lit(n).alias("mart"), "row_count", "distinct_keys"))
        if rows != read_table(spark, f"{base}/{n}").count():
            raise AssertionError(f"{n}: {rows} rows written")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
