"""Agreement, coverage and the run summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.functions._util import to_col
from casegrid.functions.keys import surrogate_key
from casegrid.functions.lookup import coarse_event_from_category, coarse_event_from_code


def agreement(scored: DataFrame, by: Sequence[str], flag: str = "is_agreement",
              id_name: str = "eval_id") -> DataFrame:
    """Per group: rows evaluated, rows agreeing, and the rounded rate."""
    by = list(by)
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("incidents_evaluated"),
        F.sum(F.col(flag).cast("bigint")).alias("incidents_in_agreement"),
        F.round(F.avg(F.col(flag).cast("double")), 4).alias("agreement_rate"),
    ).select(surrogate_key(*by).alias(id_name), *by,
             "incidents_evaluated", "incidents_in_agreement", "agreement_rate")


def agreement_flag(predicted: Column, truth: Column) -> Column:
    """1 when both sides are equal (null never agrees), else 0."""
    return F.when(predicted == truth, F.lit(1)).otherwise(F.lit(0))


def join_with_default(rows: DataFrame, dim: DataFrame, key: str, label: str, default: str) -> DataFrame:
    """Left join to a dimension's label; rows without a match take ``default``."""
    named = rows.join(dim.select(key, label), key, "left")
    return named.withColumn(label, F.coalesce(label, F.lit(default)))


def eval_mart(fact: DataFrame, industry: DataFrame) -> DataFrame:
    """Classifier category vs official event code on the coarse taxonomy,
    per sector x severity tier, for incidents that have both."""
    # reduced to one row per industry, tier and outcome before the join: the
    # sums are additive, so only the small result meets the dimension
    rows = fact.where(F.col("llm_event_category").isNotNull() & F.col("oiics_event_code").isNotNull())
    flag = agreement_flag(coarse_event_from_category(F.col("llm_event_category")),
                          coarse_event_from_code(F.col("oiics_event_code")))
    part = rows.groupBy("industry_id", F.coalesce("llm_severity_tier", F.lit("unknown")).alias("severity_tier")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(flag.cast("bigint")).alias("agreeing"))
    named = join_with_default(part, industry, "industry_id", "sector", "Unknown")
    by = ["sector", "severity_tier"]
    return named.groupBy(*by).agg(
        F.sum("n").alias("incidents_evaluated"),
        F.sum("agreeing").alias("incidents_in_agreement"),
    ).select(surrogate_key(*by).alias("eval_id"), *by, "incidents_evaluated", "incidents_in_agreement",
             F.round(F.col("incidents_in_agreement") / F.col("incidents_evaluated"), 4).alias("agreement_rate"))


def coverage(df: DataFrame, col, total_name: str = "narrated_incidents",
             covered_name: str = "classified_incidents") -> DataFrame:
    """One row: total rows, rows with ``col`` set, and the ratio (4 dp);
    the ratio is null for an empty input instead of a division error."""
    c = to_col(col)
    agg = df.agg(F.count(F.lit(1)).alias(total_name), F.count(c).alias(covered_name))
    return agg.withColumn(
        "coverage",
        F.round(F.col(covered_name).cast("double") / F.nullif(F.col(total_name), F.lit(0)), 4))


def coverage_below(df: DataFrame, col, threshold: float = 0.90) -> DataFrame:
    """The coverage row only when it is below ``threshold`` (0 or 1 row)."""
    cov = coverage(df, col)
    return cov.where(
        (F.col("narrated_incidents") > 0)
        & (F.col("classified_incidents").cast("double") / F.col("narrated_incidents") < threshold))


def run_summary(fact: DataFrame, mart: DataFrame, covered_col: str = "llm_event_category",
                evaluated: str = "incidents_evaluated", agreeing: str = "incidents_in_agreement") -> DataFrame:
    """One row: fact rows, coverage percent (1 dp), pooled agreement percent
    (sum over sum, 1 dp).  Both aggregates are global; they are combined by a
    union + max, not a cross join, and nulls survive an empty input."""
    f = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.round(F.lit(100.0) * F.count(to_col(covered_col)) / F.nullif(F.count(F.lit(1)), F.lit(0)), 1)
        .alias("enrichment_coverage_pct"),
    ).select("fact_rows", "enrichment_coverage_pct", F.lit(None).cast("double").alias("agreement_rate_pct"))
    m = mart.agg(
        F.round(F.lit(100.0) * F.sum(agreeing) / F.nullif(F.sum(evaluated), F.lit(0)), 1)
        .alias("agreement_rate_pct"),
    ).select(F.lit(None).cast("bigint").alias("fact_rows"),
             F.lit(None).cast("double").alias("enrichment_coverage_pct"), "agreement_rate_pct")
    return f.unionByName(m).agg(
        F.max("fact_rows").alias("fact_rows"),
        F.max("enrichment_coverage_pct").alias("enrichment_coverage_pct"),
        F.max("agreement_rate_pct").alias("agreement_rate_pct"),
    )
