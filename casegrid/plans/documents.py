"""Registered queries for classification, reply validation, the response
cache, incremental enrichment and agreement, on ``documents``/``labels``/``events``.

Documents stand in for incident narratives: the text is the "what happened"
field and the language is the industry context.  The pre-existing cache holds
the answers for English texts (from an older model), and an older enrichment
table holds rows for one source, so a run exercises hits, misses, in-run
duplicates, failures (broken and missing replies, by the number of the text's
first document) and the keyed upsert.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.keys import CONTENT_SEP
from casegrid.functions.prompt import NARRATIVE_FIELDS, PROMPT_VERSION
from casegrid.functions.reply import (
    CLASSIFICATION_FIELDS,
    EVENT_CATEGORIES,
    FACTOR_MAX_LEN,
    PREVENTION_MAX_LEN,
    SEVERITY_TIERS,
    with_validated,
)
from casegrid.operators.enrich import (
    CACHE_SCHEMA,
    ENRICHMENT_SCHEMA,
    enrich,
    lookup_cached,
    prepare_rows,
    category_of,
    rule_classifier,
    rule_words,
    severity_of,
    uncached,
    with_rule_reply,
)
from casegrid.operators.evaluation import agreement, agreement_flag, coverage, coverage_below, run_summary
from casegrid.plans.analogues import MODEL_NAME, RUN_TS, table
from casegrid.plans.catalogue import register
from casegrid.plans.oracle import clean, q, rule_answer_cols, rule_text_sql, sk

OLD_MODEL = "keyword-rules-v0"
OLD_TS = "2024-12-01 00:00:00"
CACHED_CONFIDENCE = 0.55
CACHED_LANG = "en"
OLD_TARGET_SOURCE = "src1"


def staged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    cols = {f: F.lit(None).cast("string") for f in NARRATIVE_FIELDS}
    cols["narrative_event"] = F.col("text")
    return d.select(F.col("doc_id").cast("string").alias("incident_id"),
                    *[v.alias(k) for k, v in cols.items()],
                    F.col("lang").alias("industry_description"),
                    "lang", "source")


def prior_cache(spark: SparkSession, staged: DataFrame) -> DataFrame:
    """Answers for the English texts, stored earlier by an older model."""
    rows = prepare_rows(staged.where(F.col("lang") == CACHED_LANG))
    # one text per hash first, so each distinct text is classified once
    texts = rows.groupBy("content_hash").agg(
        F.min_by(F.concat_ws("\n", *[F.col(f) for f in NARRATIVE_FIELDS]), F.col("incident_id"))
        .alias("narrative_text"))
    replied = with_rule_reply(texts, "narrative_text")
    answered = with_validated(replied, "reply", "v")
    return answered.select(
        "content_hash", F.lit(PROMPT_VERSION).alias("prompt_version"),
        *[F.col(f"v.{c}").alias(c) for c in CLASSIFICATION_FIELDS if c != "confidence"],
        F.lit(CACHED_CONFIDENCE).alias("confidence"),
        F.lit(OLD_MODEL).alias("model_name"),
        F.lit(OLD_TS).cast("timestamp_ntz").alias("cached_at"),
    ).select(*CACHE_SCHEMA.fieldNames())


def prior_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where(F.col("source") == OLD_TARGET_SOURCE)
    return d.select(
        F.col("doc_id").cast("string").alias("incident_id"),
        F.lit("old").alias("contributing_factor"), F.lit("minor").alias("severity_tier"),
        F.lit("other").alias("event_category"), F.lit("old").alias("recurrence_prevention"),
        F.lit(0.1).alias("confidence"), F.lit(PROMPT_VERSION).alias("prompt_version"),
        F.lit(OLD_MODEL).alias("model_name"), F.lit(OLD_TS).cast("timestamp_ntz").alias("enriched_at"),
    ).select(*ENRICHMENT_SCHEMA.fieldNames())


# Every so many documents one reply is missing and one is cut off.
FAIL_EVERY, MISSING_AT, BROKEN_AT = 23, 5, 9
BROKEN_REPLY = '{"contributing_factor": "cut off'


def unreliable_classifier():
    """The rules, but some replies are missing or broken, by document number."""
    rules = rule_classifier()

    def classify(requests: DataFrame) -> DataFrame:
        at = F.col("rep_id").cast("bigint") % FAIL_EVERY
        return rules(requests).withColumn(
            "reply", F.when(at == MISSING_AT, F.lit(None)).when(at == BROKEN_AT, F.lit(BROKEN_REPLY))
            .otherwise(F.col("reply")))
    return classify


def document_run(spark: SparkSession, sf_dir: str):
    staged = staged_documents(spark, sf_dir)
    return enrich(staged, prior_cache(spark, staged), prior_target(spark, sf_dir), unreliable_classifier(),
                  datetime.fromisoformat(RUN_TS), MODEL_NAME)


# SQL pieces shared by the enrichment oracles
_hash_sql = ("sha256(concat_ws('" + CONTENT_SEP + "', '', '', '', coalesce(ev, ''), '', ''))")
_rows_sql = f"""
doc_rows AS (
  SELECT incident_id, lang, source, coalesce(ev, '') AS txt, {_hash_sql} AS h,
         min(incident_id) OVER (PARTITION BY {_hash_sql}) AS rep_id
  FROM (SELECT cast(doc_id as varchar) AS incident_id, lang, source, {clean('text')} AS ev FROM documents) d
),
doc_cache AS (SELECT DISTINCT h FROM doc_rows WHERE lang = '{CACHED_LANG}'),
doc_failed AS (SELECT incident_id, h, cast(rep_id as bigint) % {FAIL_EVERY} AS nth FROM doc_rows
  WHERE h NOT IN (SELECT h FROM doc_cache) AND cast(rep_id as bigint) % {FAIL_EVERY} IN ({MISSING_AT}, {BROKEN_AT}))"""
_r = rule_text_sql("r.txt")
_answered_sql = f"""
doc_answered AS (
  SELECT r.incident_id, r.h,
    {rule_answer_cols(_r['category'], _r['severity']).replace(' AS confidence', ' AS rule_confidence')},
    r.h IN (SELECT h FROM doc_cache) AS hit, r.rep_id
  FROM doc_rows r WHERE r.incident_id NOT IN (SELECT incident_id FROM doc_failed)
)"""


@register("enrich_incremental", f"""
WITH {_rows_sql}, {_answered_sql}
SELECT incident_id, contributing_factor, severity_tier, event_category, recurrence_prevention,
  CASE WHEN hit THEN {CACHED_CONFIDENCE} ELSE rule_confidence END AS confidence,
  '{PROMPT_VERSION}' AS prompt_version, {q(MODEL_NAME)} AS model_name, TIMESTAMP {q(RUN_TS)} AS enriched_at
FROM doc_answered
UNION ALL
SELECT cast(doc_id as varchar), 'old', 'minor', 'other', 'old', 0.1, '{PROMPT_VERSION}', {q(OLD_MODEL)}, TIMESTAMP {q(OLD_TS)}
FROM documents WHERE source = '{OLD_TARGET_SOURCE}'
  AND cast(doc_id as varchar) NOT IN (SELECT incident_id FROM doc_answered)""")
def q_enrich_incremental(spark, sf_dir):
    return document_run(spark, sf_dir).target


@register("enrich_failures", f"""
WITH {_rows_sql}
SELECT incident_id, h AS content_hash,
  CASE WHEN nth = {MISSING_AT} THEN 'no_reply' ELSE 'invalid_json' END AS reject_reason FROM doc_failed""")
def q_enrich_failures(spark, sf_dir):
    rows = document_run(spark, sf_dir).rows
    return rows.where(F.col("status") == "failed").select("incident_id", "content_hash", "reject_reason")


@register("enrich_counters", f"""
WITH {_rows_sql}, {_answered_sql}
SELECT (SELECT count(*) FROM doc_rows) AS rows_processed,
  count(*) AS rows_succeeded,
  (SELECT count(*) FROM doc_failed) AS rows_failed,
  count(*) FILTER (WHERE hit OR incident_id <> rep_id) AS rows_from_cache,
  count(*) FILTER (WHERE NOT hit AND incident_id = rep_id) AS texts_classified
FROM doc_answered""")
def q_enrich_counters(spark, sf_dir):
    return document_run(spark, sf_dir).counters


@register("cache_lookup", f"""
WITH {_rows_sql}, {_answered_sql}
SELECT r.incident_id, r.h AS content_hash, a.event_category,
  CASE WHEN a.incident_id IS NOT NULL THEN {CACHED_CONFIDENCE} END AS confidence
FROM doc_rows r LEFT JOIN (SELECT DISTINCT h, event_category, incident_id FROM doc_answered WHERE hit) a
  ON r.incident_id = a.incident_id""")
def q_cache_lookup(spark, sf_dir):
    staged = staged_documents(spark, sf_dir)
    rows = prepare_rows(staged)
    return lookup_cached(rows.select("incident_id", "content_hash"), prior_cache(spark, staged), PROMPT_VERSION,
                         ["event_category", "confidence"])


@register("cache_misses", f"""
WITH {_rows_sql}
SELECT incident_id, h AS content_hash FROM doc_rows WHERE h NOT IN (SELECT h FROM doc_cache)""")
def q_cache_misses(spark, sf_dir):
    staged = staged_documents(spark, sf_dir)
    rows = prepare_rows(staged)
    return uncached(rows.select("incident_id", "content_hash"), prior_cache(spark, staged), PROMPT_VERSION)


# ------------------------------------------------------ rule classifier ----
_rt = rule_text_sql("text")


@register("classify_rules", f"""
SELECT doc_id, {rule_answer_cols(_rt['category'], _rt['severity'])}, true AS is_valid FROM documents d""")
def q_classify_rules(spark, sf_dir):
    d = with_rule_reply(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return with_validated(d, "reply", "v").select(
        "doc_id", *[F.col(f"v.{c}").alias(c) for c in CLASSIFICATION_FIELDS], F.col("v.is_valid").alias("is_valid"))


# ----------------------------------------------------- reply validation ----
_EV_CATEGORY = {"click": "fall_slip_trip", "view": "violence", "purchase": "cut_laceration"}


def _replies(e: DataFrame) -> DataFrame:
    n = F.round(F.col("value") * 100).cast("bigint")
    conf = F.concat(F.floor(n / 10000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad(F.pmod(n, F.lit(10000)).cast("string"), 4, "0"))
    et = F.col("event_type")
    cat = (F.when(et == "click", _EV_CATEGORY["click"]).when(et == "view", _EV_CATEGORY["view"])
           .when(et == "purchase", _EV_CATEGORY["purchase"]).otherwise(F.lit("transportation")))
    v = F.col("value")
    sev = (F.when(v < 10, "minor").when(v < 40, "serious").when(v < 100, "severe").otherwise(F.lit("catastrophic")))
    factor = F.when(v > 300, F.repeat(F.lit("x"), FACTOR_MAX_LEN + 1)).otherwise(F.concat(F.lit("factor "), et))
    full = lambda conf_json, extra, prev: F.concat(
        F.lit('{"contributing_factor": "'), factor, F.lit('", "severity_tier": "'), sev,
        F.lit('", "event_category": "'), cat, F.lit('", "recurrence_prevention": "'), prev,
        F.lit('", "confidence": '), conf_json, F.lit(extra + "}"))
    reply = (F.when(v < 1, F.lit("[1, 2]"))
             .when(v < 2, full(F.when(et == "click", "true").otherwise("false"), "", F.lit("stop")))
             .when(et == "error", F.lit('{"contributing_factor": "broken'))
             .when(et == "signup", F.concat(F.lit('{"severity_tier": "'), sev, F.lit('", "confidence": '), conf, F.lit("}")))
             .when(et == "purchase", full(F.concat(F.lit('"'), conf, F.lit('"')), ', "extra": [1]', F.lit("check")))
             .otherwise(full(conf, "", F.concat(F.lit("check "), et))))
    return e.select("event_id", reply.alias("reply"))


def _replies_sql() -> str:
    n = "cast(round(value * 100) as bigint)"
    conf = f"cast({n} // 10000 as varchar) || '.' || lpad(cast({n} % 10000 as varchar), 4, '0')"
    cat = ("CASE event_type WHEN 'click' THEN 'fall_slip_trip' WHEN 'view' THEN 'violence' "
           "WHEN 'purchase' THEN 'cut_laceration' ELSE 'transportation' END")
    sev = ("CASE WHEN value < 10 THEN 'minor' WHEN value < 40 THEN 'serious' WHEN value < 100 THEN 'severe' "
           "ELSE 'catastrophic' END")
    factor = f"CASE WHEN value > 300 THEN repeat('x', {FACTOR_MAX_LEN + 1}) ELSE 'factor ' || event_type END"

    def full(conf_json, extra, prev):
        return (f"""'{{"contributing_factor": "' || {factor} || '", "severity_tier": "' || {sev} || """
                f"""'", "event_category": "' || {cat} || '", "recurrence_prevention": "' || {prev} || """
                f"""'", "confidence": ' || {conf_json} || '{extra}}}'""")
    return f"""SELECT event_id, CASE WHEN value < 1 THEN '[1, 2]'
  WHEN value < 2 THEN {full("CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END", '', "'stop'")}
  WHEN event_type = 'error' THEN '{{"contributing_factor": "broken'
  WHEN event_type = 'signup' THEN '{{"severity_tier": "' || {sev} || '", "confidence": ' || {conf} || '}}'
  WHEN event_type = 'purchase' THEN {full("'\"' || " + conf + " || '\"'", ', "extra": [1]', "'check'")}
  ELSE {full(conf, '', "'check ' || event_type")} END AS reply FROM events"""


def _validate_sql(src: str) -> str:
    def txt(name):
        return f"CASE WHEN json_type(j, '$.{name}') = 'VARCHAR' THEN json_extract_string(j, '$.{name}') END"
    cats = ", ".join(q(c) for c in EVENT_CATEGORIES)
    sevs = ", ".join(q(s) for s in SEVERITY_TIERS)
    return f"""
SELECT event_id, {', '.join(f'CASE WHEN reason IS NULL THEN {c} END AS {c}' for c in CLASSIFICATION_FIELDS)},
  reason IS NULL AS is_valid, reason AS reject_reason
FROM (
  SELECT *, CASE WHEN reply IS NULL THEN 'no_reply' WHEN j IS NULL THEN 'invalid_json'
    WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object'
    WHEN contributing_factor IS NULL THEN 'contributing_factor_missing'
    WHEN length(contributing_factor) > {FACTOR_MAX_LEN} THEN 'contributing_factor_too_long'
    WHEN severity_tier IS NULL OR severity_tier NOT IN ({sevs}) THEN 'severity_tier_invalid'
    WHEN recurrence_prevention IS NULL THEN 'recurrence_prevention_missing'
    WHEN length(recurrence_prevention) > {PREVENTION_MAX_LEN} THEN 'recurrence_prevention_too_long'
    WHEN confidence IS NULL THEN 'confidence_missing'
    WHEN NOT (confidence BETWEEN 0 AND 1) THEN 'confidence_out_of_range' END AS reason
  FROM (
    SELECT event_id, reply, j, {txt('contributing_factor')} AS contributing_factor,
      {txt('severity_tier')} AS severity_tier,
      CASE WHEN {txt('event_category')} IN ({cats}) THEN {txt('event_category')} ELSE 'other' END AS event_category,
      {txt('recurrence_prevention')} AS recurrence_prevention,
      CASE WHEN json_type(j, '$.confidence') IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'VARCHAR')
           THEN try_cast(json_extract_string(j, '$.confidence') as double)
           WHEN json_type(j, '$.confidence') = 'BOOLEAN'
           THEN CASE json_extract_string(j, '$.confidence') WHEN 'true' THEN 1.0 ELSE 0.0 END END AS confidence
    FROM (SELECT event_id, reply, CASE WHEN json_valid(reply) THEN reply END AS j FROM ({src}) r) x) y) z"""


@register("validate_reply", _validate_sql(_replies_sql()))
def q_validate_reply(spark, sf_dir):
    r = _replies(table(spark, sf_dir, "events"))
    return with_validated(r, "reply", "v").select(
        "event_id", *[F.col(f"v.{c}").alias(c) for c in CLASSIFICATION_FIELDS],
        F.col("v.is_valid").alias("is_valid"), F.col("v.reject_reason").alias("reject_reason"))


# ------------------------------------------------------------ agreement ----
def labelled_documents(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


def document_agreement(spark, sf_dir) -> DataFrame:
    """Classifier abstention vs the quality label: a text the rules can
    place in a category should be a good-quality text (label 1)."""
    ld = labelled_documents(spark, sf_dir).where(F.col("quality").isNotNull())
    words = ld.select("lang", "quality", rule_words(F.col("text")).alias("words"))  # one pass over a text
    pred = F.when(category_of(F.col("words")) != "other", F.lit(1)).otherwise(F.lit(0))
    scored = words.select("lang", severity_of(F.col("words")).alias("severity_tier"),
                          agreement_flag(pred, F.col("quality")).alias("is_agreement"))
    return agreement(scored, ["lang", "severity_tier"])


_ra = rule_text_sql("d.text")
_agreement_sql = f"""
SELECT {sk('lang', 'severity_tier')} AS eval_id, lang, severity_tier, count(*) AS incidents_evaluated,
  cast(sum(is_agreement) as bigint) AS incidents_in_agreement,
  round(avg(cast(is_agreement as double)), 4) AS agreement_rate
FROM (SELECT d.lang, {_ra['severity']} AS severity_tier,
        CASE WHEN (CASE WHEN {_ra['category']} <> 'other' THEN 1 ELSE 0 END) = l.quality THEN 1 ELSE 0 END AS is_agreement
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL) s
GROUP BY lang, severity_tier"""


@register("agreement_mart", _agreement_sql)
def q_agreement_mart(spark, sf_dir):
    return document_agreement(spark, sf_dir)


_cov_sql = """
SELECT count(*) AS narrated_incidents, count(l.quality) AS classified_incidents,
  round(cast(count(l.quality) as double) / nullif(count(*), 0), 4) AS coverage
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@register("coverage", _cov_sql)
def q_coverage(spark, sf_dir):
    return coverage(labelled_documents(spark, sf_dir), "quality")


@register("dq_coverage", f"SELECT * FROM ({_cov_sql}) c WHERE narrated_incidents > 0 AND "
          "cast(classified_incidents as double) / narrated_incidents < 0.9")
def q_dq_coverage(spark, sf_dir):
    return coverage_below(labelled_documents(spark, sf_dir), "quality", 0.90)


@register("run_summary", f"""
SELECT count(*) AS fact_rows,
  round(cast(100 as double) * count(l.quality) / nullif(count(*), 0), 1) AS enrichment_coverage_pct,
  (SELECT round(cast(100 as double) * sum(incidents_in_agreement) / nullif(sum(incidents_evaluated), 0), 1)
   FROM ({_agreement_sql}) a) AS agreement_rate_pct
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_run_summary(spark, sf_dir):
    return run_summary(labelled_documents(spark, sf_dir), document_agreement(spark, sf_dir),
                       covered_col="quality")
