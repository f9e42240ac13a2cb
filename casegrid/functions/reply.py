"""Classifier reply (JSON text) -> typed, validated classification.

Lax validation: a numeric string is accepted for the confidence, and so is a
boolean (1 or 0); extra fields
are ignored, an unknown or missing event category is coerced to 'other', and
any other failure (broken JSON, not an object, missing or non-string text
field, over-long text, unknown severity, confidence outside [0, 1]) rejects
the reply.  Everything runs as native variant expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.functions._util import to_col

# The classification contract.
SEVERITY_TIERS = ("minor", "moderate", "serious", "severe")
EVENT_CATEGORIES = (
    "struck_by_or_against",
    "fall_slip_trip",
    "overexertion_bodily_reaction",
    "exposure_harmful_substance",
    "contact_with_equipment",
    "transportation",
    "fire_explosion",
    "violence",
    "other",
)
FACTOR_MAX_LEN = 200
PREVENTION_MAX_LEN = 300
CATEGORY_FALLBACK = "other"

CLASSIFICATION_FIELDS = ("contributing_factor", "severity_tier", "event_category",
                         "recurrence_prevention", "confidence")

REPLY_SCHEMA = T.StructType([
    T.StructField("contributing_factor", T.StringType()),
    T.StructField("severity_tier", T.StringType()),
    T.StructField("event_category", T.StringType()),
    T.StructField("recurrence_prevention", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("reject_reason", T.StringType()),
])


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


def with_validated(df: DataFrame, reply: str = "reply", out: str = "v") -> DataFrame:
    """Add ``out``: a struct of the five fields plus ``is_valid`` and
    ``reject_reason``; field values are null when the reply is rejected.

    Staged as three projections (parse once, extract once, then decide), so
    the parsed value and each field are computed once per row instead of
    being inlined into every rule of the decision.  Filter on
    ``out.is_valid`` only after materialising (e.g. a checkpoint): a filter
    is pushed down through these projections and would inline them all.
    """
    tmp = [f"_rv_{n}" for n in ("json", "obj", "factor", "severity", "category", "prevention", "confidence")]
    parsed = df.withColumn(tmp[0], F.try_parse_json(F.col(reply)))
    v = F.col(tmp[0])

    def text(name: str) -> Column:
        return F.when(_kind(v, f"$.{name}") == "STRING", F.try_variant_get(v, f"$.{name}", "string"))

    conf_kind = _kind(v, "$.confidence")
    fields = parsed.select(
        "*",
        F.schema_of_variant(v).startswith("OBJECT").alias(tmp[1]),
        text("contributing_factor").alias(tmp[2]),
        text("severity_tier").alias(tmp[3]),
        text("event_category").alias(tmp[4]),
        text("recurrence_prevention").alias(tmp[5]),
        F.when(conf_kind.startswith("DECIMAL") | conf_kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT",
                                                                "DOUBLE", "FLOAT", "STRING"),
               F.try_variant_get(v, "$.confidence", "double"))
        .when(conf_kind == "BOOLEAN", F.when(F.try_variant_get(v, "$.confidence", "boolean"), 1.0).otherwise(0.0))
        .alias(tmp[6]),
    )
    is_obj, factor, severity, raw_category, prevention, confidence = [F.col(c) for c in tmp[1:]]
    category = F.when(raw_category.isin(*EVENT_CATEGORIES), raw_category).otherwise(F.lit(CATEGORY_FALLBACK))
    reason = (
        F.when(F.col(reply).isNull(), F.lit("no_reply"))
        .when(v.isNull(), F.lit("invalid_json"))
        .when(~is_obj, F.lit("not_an_object"))
        .when(factor.isNull(), F.lit("contributing_factor_missing"))
        .when(F.length(factor) > FACTOR_MAX_LEN, F.lit("contributing_factor_too_long"))
        .when(severity.isNull() | ~severity.isin(*SEVERITY_TIERS), F.lit("severity_tier_invalid"))
        .when(prevention.isNull(), F.lit("recurrence_prevention_missing"))
        .when(F.length(prevention) > PREVENTION_MAX_LEN, F.lit("recurrence_prevention_too_long"))
        .when(confidence.isNull(), F.lit("confidence_missing"))
        .when(~confidence.between(0.0, 1.0), F.lit("confidence_out_of_range"))
    )
    decided = fields.withColumn("_rv_reason", reason)
    r = F.col("_rv_reason")
    ok = r.isNull()
    return decided.withColumn(out, F.struct(
        F.when(ok, factor).alias("contributing_factor"),
        F.when(ok, severity).alias("severity_tier"),
        F.when(ok, category).alias("event_category"),
        F.when(ok, prevention).alias("recurrence_prevention"),
        F.when(ok, confidence).alias("confidence"),
        ok.alias("is_valid"),
        r.alias("reject_reason"),
    )).drop(*tmp, "_rv_reason")


def reply_json(contributing_factor, severity_tier, event_category, recurrence_prevention,
               confidence) -> Column:
    """Build a reply JSON object natively (used by the rule classifier)."""
    return F.to_json(F.struct(
        to_col(contributing_factor).alias("contributing_factor"),
        to_col(severity_tier).alias("severity_tier"),
        to_col(event_category).alias("event_category"),
        to_col(recurrence_prevention).alias("recurrence_prevention"),
        to_col(confidence).cast("double").alias("confidence"),
    ))
