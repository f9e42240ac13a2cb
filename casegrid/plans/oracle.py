"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is assembled from the same fixed lookup data as the Spark code, so a
mapping lives in one place; the logic is written independently in SQL.
"""

from __future__ import annotations

from casegrid.functions.clean import PY_WHITESPACE_CLASS
from casegrid.functions.keys import SURROGATE_NULL
from casegrid.functions.lookup import (
    CENSUS_REGIONS,
    COARSE_FROM_CATEGORY,
    COARSE_FROM_DIVISION,
    EMPLOYEE_BOUNDS,
    EMPLOYEE_LABELS,
    EMPLOYEE_NULL_LABEL,
    NAICS_SECTORS,
    OUTCOME_LABELS,
    OWNERSHIP_LABELS,
)
from casegrid.functions.prompt import NARRATIVE_FIELDS, PROMPT_VERSION
from casegrid.operators.enrich import (
    ABSTAIN_CONFIDENCE,
    MATCH_CONFIDENCE,
    OTHER_ACTION,
    OTHER_FACTOR,
    RULES,
    keyword_pattern,
    SEVERITY_DEFAULT,
    SEVERITY_WORDS,
)
from casegrid.plans.analogues import EVENT_SENTENCES, MODEL_NAME, RUN_TS, STATE_CODES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sk(*cols: str) -> str:
    return "md5(" + " || '-' || ".join(
        f"coalesce(cast({c} as varchar), {q(SURROGATE_NULL)})" for c in cols) + ")"


def t(c: str) -> str:
    return f"nullif(trim({c}), '')"


def pm(x: str, m: int) -> str:
    return f"((({x}) % {m}) + {m}) % {m}"


def case_map(expr: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(
        f"WHEN {q(k) if isinstance(k, str) else k} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {q(default) if default is not None else 'NULL'} END"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def clean(c: str) -> str:
    cls = PY_WHITESPACE_CLASS
    return f"nullif(regexp_replace({c}, '^{cls}+|{cls}+$', '', 'g'), '')"


def rule_text_sql(txt: str) -> dict[str, str]:
    """Keyword-rule classifier in SQL over a text expression."""
    low = f"lower({txt})"
    cat = "CASE " + " ".join(f"WHEN regexp_matches({low}, {q(keyword_pattern(w))}) THEN {q(c)}" for c, w, _, _ in RULES) \
        + " ELSE 'other' END"
    sev = "CASE " + " ".join(f"WHEN regexp_matches({low}, {q(keyword_pattern(w))}) THEN {q(tier)}"
                             for tier, w in SEVERITY_WORDS) + f" ELSE {q(SEVERITY_DEFAULT)} END"
    return {"category": cat, "severity": sev}


def rule_answer_cols(cat: str, sev: str) -> str:
    factor = case_map(cat, {r[0]: r[2] for r in RULES}, OTHER_FACTOR)
    action = case_map(cat, {r[0]: r[3] for r in RULES}, OTHER_ACTION)
    conf = f"CASE WHEN {cat} = 'other' THEN {ABSTAIN_CONFIDENCE} ELSE {MATCH_CONFIDENCE} END"
    return (f"{factor} AS contributing_factor, {sev} AS severity_tier, {cat} AS event_category, "
            f"{action} AS recurrence_prevention, cast({conf} as double) AS confidence")


# ---------------------------------------------------------------------------
# Warehouse chain on the rendered case export
# ---------------------------------------------------------------------------

def _raw_cases() -> str:
    sas = "upper(strftime(o.o_orderdate, '%d%b%Y'))"
    created = f"o.o_orderdate + to_seconds({pm('o.o_orderkey * 37', 86400)})"
    ev = f"lpad(cast({pm('o.o_orderkey * 13', 8000)} as varchar), 4, '0')"
    st = f"{lst(STATE_CODES)}[{pm('c.c_custkey', 53)} + 1]"
    sent = f"{lst(EVENT_SENTENCES)}[{pm('o.o_orderkey', len(EVENT_SENTENCES))} + 1]"
    return f"""
raw_cases AS (
  SELECT
    cast(o.o_orderkey as varchar) AS id,
    cast(o.o_custkey as varchar) AS establishment_id,
    c.c_name AS establishment_name,
    lpad(cast(o.o_custkey as varchar), 9, '0') AS ein,
    c.c_name || ' Co' AS company_name,
    cast({pm('o.o_custkey', 1000)} as varchar) || ' Main St' AS street_address,
    n.n_name AS city,
    CASE WHEN {pm('c.c_custkey', 5)} = 0 THEN lower({st}) ELSE {st} END AS state,
    lpad(cast(c.c_nationkey as varchar), 5, '0') AS zip_code,
    cast({pm('c.c_custkey * 7', 89)} + 11 as varchar) || lpad(cast({pm('c.c_custkey', 10000)} as varchar), 4, '0') AS naics_code,
    '2022' AS naics_year,
    c.c_mktsegment AS industry_description,
    cast({pm('c.c_custkey', 4)} as varchar) AS establishment_type,
    cast({pm('c.c_custkey', 3)} + 1 as varchar) AS size,
    cast(cast(c.c_acctbal as decimal(12,2)) as varchar) AS annual_average_employees,
    cast(cast(o.o_totalprice as decimal(14,2)) as varchar) AS total_hours_worked,
    'C-' || cast(o.o_orderkey as varchar) AS case_number,
    o.o_orderpriority AS job_description,
    substr(o.o_orderpriority, 1, 1) AS soc_code,
    substr(o.o_orderpriority, 3) AS soc_description,
    CASE WHEN o.o_orderstatus = 'P' THEN regexp_replace({sas}, '^0', '') ELSE {sas} END AS date_of_incident,
    CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT' THEN {sas} END AS date_of_death,
    CASE WHEN o.o_orderpriority <> '5-LOW' THEN upper(strftime({created}, '%d%b%Y:%H:%M:%S')) END AS created_timestamp,
    cast(year(o.o_orderdate) as varchar) AS year_of_filing,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN '4' WHEN o.o_orderstatus = 'F' THEN '1'
         WHEN o.o_orderstatus = 'O' THEN ' 2 ' WHEN o.o_orderpriority = '2-HIGH' THEN '9' ELSE '3' END AS incident_outcome,
    cast({pm('o.o_orderkey', 5)} + 1 as varchar) AS type_of_incident,
    CASE WHEN o.o_orderstatus <> 'P' THEN cast({pm('o.o_orderkey', 400)} as varchar) || '.' || cast({pm('o.o_custkey', 10)} as varchar) END AS dafw_num_away,
    cast({pm('o.o_orderkey', 30)} as varchar) AS djtr_num_tr,
    CASE WHEN o.o_orderstatus <> 'P' THEN '  ' || n.n_name || ' yard ' END AS new_incident_location,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Order ' || o.o_orderpriority END AS new_incident_description,
    CASE WHEN o.o_orderstatus = 'F' THEN lower(c.c_mktsegment) END AS new_nar_before_incident,
    CASE WHEN o.o_orderstatus <> 'P' OR o.o_orderpriority IN ('1-URGENT', '2-HIGH') OR d.text IS NOT NULL
         THEN {sent} || coalesce(' ' || d.text, '') END AS new_nar_what_happened,
    CASE WHEN o.o_orderstatus = 'O' THEN '   ' WHEN o.o_orderstatus = 'F' THEN 'Bruised left hand' END AS new_nar_injury_illness,
    cast(NULL as varchar) AS new_nar_object_substance,
    cast({pm('o.o_custkey', 50)} + 100 as varchar) AS nature_code_pred,
    'Nature ' || cast({pm('o.o_custkey', 50)} + 100 as varchar) AS nature_title_pred,
    cast(c.c_nationkey as varchar) AS part_code_pred,
    n.n_name AS part_title_pred,
    CASE WHEN o.o_orderpriority <> '3-MEDIUM' THEN {ev} END AS event_code_pred,
    CASE WHEN o.o_orderpriority <> '3-MEDIUM' THEN 'Event ' || substr({ev}, 1, 2) END AS event_title_pred,
    cast({pm('o.o_orderkey', 7)} as varchar) AS source_code_pred,
    'Source ' || cast({pm('o.o_orderkey', 7)} as varchar) AS source_title_pred,
    CASE WHEN {pm('o.o_orderkey', 2)} = 1 THEN '9' END AS sec_source_code_pred,
    CASE WHEN {pm('o.o_orderkey', 2)} = 1 THEN 'Secondary 9' END AS sec_source_title_pred
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN documents d ON o.o_orderkey = d.doc_id
)"""


def rint(c: str, typ: str = "integer") -> str:
    return f"cast(round(cast({c} as decimal(38,10)), 0) as {typ})"


NARR_SRC = {
    "new_incident_location": "narrative_location",
    "new_incident_description": "narrative_description",
    "new_nar_before_incident": "narrative_activity",
    "new_nar_what_happened": "narrative_event",
    "new_nar_injury_illness": "narrative_injury",
    "new_nar_object_substance": "narrative_source",
}
CODES = {"nature": "oiics_nature", "part": "oiics_body_part", "event": "oiics_event",
         "source": "oiics_source", "sec_source": "oiics_sec_source"}


def _stg_cases() -> str:
    narr = ",\n    ".join(f"{t(s)} AS {d}" for s, d in NARR_SRC.items())
    codes = ",\n    ".join(
        f"{rint(t(f'{r}_code_pred'))} AS {s}_code, {t(f'{r}_title_pred')} AS {s}_label"
        for r, s in CODES.items())
    return f"""
stg_cases AS (
  SELECT * FROM (
  SELECT
    {sk('id')} AS incident_id,
    cast(id as bigint) AS osha_case_id,
    {t('case_number')} AS case_number,
    {sk('establishment_id')} AS establishment_id,
    cast(strptime({t('date_of_incident')}, '%d%b%Y') as date) AS incident_date,
    cast(strptime({t('date_of_death')}, '%d%b%Y') as date) AS death_date,
    strptime({t('created_timestamp')}, '%d%b%Y:%H:%M:%S') AS created_at,
    cast({t('year_of_filing')} as integer) AS filing_year,
    cast({t('incident_outcome')} as integer) AS outcome_code,
    cast({t('type_of_incident')} as integer) AS incident_type_code,
    {rint(t('dafw_num_away'))} AS days_away_from_work,
    {rint(t('djtr_num_tr'))} AS days_restricted,
    (cast({t('incident_outcome')} as integer) = 1) AS is_death,
    (cast({t('incident_outcome')} as integer) = 2) AS is_dafw,
    {t('soc_code')} AS soc_code,
    {t('soc_description')} AS soc_description,
    {t('job_description')} AS job_description,
    {t('naics_code')} AS naics_code,
    {t('industry_description')} AS industry_description,
    {t('city')} AS city,
    {t('state')} AS state,
    {t('zip_code')} AS zip_code,
    {t('establishment_name')} AS establishment_name,
    {t('company_name')} AS company_name,
    {narr},
    {codes}
  FROM raw_cases) s
  WHERE coalesce({', '.join(NARRATIVE_FIELDS)}) IS NOT NULL
)"""


EST_RAW = ("establishment_id", "establishment_name", "company_name", "ein", "street_address",
           "city", "state", "zip_code", "naics_code", "naics_year", "industry_description",
           "establishment_type", "size", "annual_average_employees", "total_hours_worked")


def _stg_establishments() -> str:
    return f"""
stg_establishments AS (
  SELECT
    {sk('establishment_id')} AS establishment_id,
    try_cast(establishment_id as bigint) AS osha_establishment_id,
    {t('establishment_name')} AS establishment_name,
    {t('company_name')} AS company_name,
    {t('ein')} AS ein,
    {t('street_address')} AS street_address,
    {t('city')} AS city,
    {t('state')} AS state,
    {t('zip_code')} AS zip_code,
    {t('naics_code')} AS naics_code,
    cast({t('naics_year')} as integer) AS naics_year,
    {t('industry_description')} AS industry_description,
    {rint(t('establishment_type'))} AS ownership_type_code,
    {rint(t('size'))} AS employee_size_code,
    {rint(t('annual_average_employees'))} AS annual_average_employees,
    {rint(t('total_hours_worked'), 'bigint')} AS total_hours_worked
  FROM (
    SELECT {', '.join(EST_RAW)},
      row_number() OVER (PARTITION BY establishment_id
                         ORDER BY created_timestamp DESC NULLS LAST, id DESC) AS row_num
    FROM raw_cases WHERE establishment_id IS NOT NULL) d
  WHERE row_num = 1
)"""


CASE_COLS = ("incident_id", "osha_case_id", "case_number", "establishment_id", "incident_date",
             "death_date", "created_at", "filing_year", "outcome_code", "incident_type_code",
             "days_away_from_work", "days_restricted", "is_death", "is_dafw", "soc_code",
             "soc_description", "job_description")
EST_COLS = ("establishment_name", "company_name", "ein", "street_address", "city", "state",
            "zip_code", "naics_code", "naics_year", "industry_description", "ownership_type_code",
            "employee_size_code", "annual_average_employees", "total_hours_worked")
CODE_COLS = tuple(f"{s}_{k}" for s in CODES.values() for k in ("code", "label"))


def _joined() -> str:
    sel = ", ".join([*(f"i.{c}" for c in CASE_COLS), *(f"e.{c}" for c in EST_COLS),
                     *(f"i.{c}" for c in NARRATIVE_FIELDS), *(f"i.{c}" for c in CODE_COLS)])
    return f"""
int_joined AS (
  SELECT {sel}
  FROM stg_cases i LEFT JOIN stg_establishments e ON i.establishment_id = e.establishment_id
)"""


def _enrichment() -> str:
    txt = "concat_ws(chr(10), " + ", ".join(clean(f) for f in NARRATIVE_FIELDS) + ")"
    r = rule_text_sql("txt")
    return f"""
llm_enrichment AS (
  SELECT incident_id, {rule_answer_cols(r['category'], r['severity'])},
    {q(PROMPT_VERSION)} AS prompt_version, {q(MODEL_NAME)} AS model_name,
    TIMESTAMP {q(RUN_TS)} AS enriched_at
  FROM (SELECT incident_id, {txt} AS txt FROM stg_cases) x
),
stg_enrichment AS (
  SELECT incident_id,
    {t('contributing_factor')} AS llm_contributing_factor,
    {t('severity_tier')} AS llm_severity_tier,
    {t('event_category')} AS llm_event_category,
    {t('recurrence_prevention')} AS llm_recurrence_action,
    confidence AS llm_confidence, prompt_version, model_name, enriched_at
  FROM llm_enrichment
),
int_enriched AS (
  SELECT j.*, e.llm_contributing_factor, e.llm_severity_tier, e.llm_event_category,
    e.llm_recurrence_action, e.llm_confidence, e.prompt_version AS llm_prompt_version,
    e.model_name AS llm_model_name, e.enriched_at AS llm_enriched_at
  FROM int_joined j LEFT JOIN stg_enrichment e ON j.incident_id = e.incident_id
)"""


INJ = ("outcome_code", "oiics_nature_code", "oiics_body_part_code", "oiics_event_code")


def _marts() -> str:
    fact_cols = ", ".join([
        "incident_id", "establishment_id", f"{sk('naics_code')} AS industry_id",
        f"{sk('city', 'state', 'zip_code')} AS geography_id", f"{sk(*INJ)} AS injury_type_id",
        f"{sk('incident_date')} AS date_id", "days_away_from_work", "days_restricted", "is_death",
        "is_dafw", "outcome_code", "oiics_event_code", "oiics_event_label", "incident_date",
        "llm_contributing_factor", "llm_severity_tier", "llm_recurrence_action",
        "llm_event_category", "llm_confidence", *NARRATIVE_FIELDS])
    bucket = ("CASE WHEN annual_average_employees IS NULL THEN " + q(EMPLOYEE_NULL_LABEL) + " "
              + " ".join(f"WHEN annual_average_employees < {b} THEN {q(lab)}"
                         for b, lab in zip(EMPLOYEE_BOUNDS, EMPLOYEE_LABELS))
              + f" ELSE {q(EMPLOYEE_LABELS[-1])} END")
    coarse_pred = case_map("f.llm_event_category", COARSE_FROM_CATEGORY, "other")
    coarse_truth = ("CASE WHEN f.oiics_event_code IS NULL THEN NULL ELSE "
                    + case_map("left(cast(f.oiics_event_code as varchar), 1)", COARSE_FROM_DIVISION, "other")
                    + " END")
    return f"""
fct_incidents AS (SELECT {fact_cols} FROM int_enriched),
dim_date AS (
  SELECT {sk('incident_date')} AS date_id, incident_date AS full_date,
    cast(year(incident_date) as integer) AS year, cast(quarter(incident_date) as integer) AS quarter,
    cast(month(incident_date) as integer) AS month
  FROM (SELECT DISTINCT incident_date FROM int_joined) d
),
dim_geography AS (
  SELECT {sk('city', 'state', 'zip_code')} AS geography_id, city, state, zip_code,
    {case_map('upper(state)', CENSUS_REGIONS, 'Other')} AS region
  FROM (SELECT DISTINCT city, state, zip_code FROM int_joined) g
),
dim_industry AS (
  SELECT {sk('naics_code')} AS industry_id, naics_code, naics_title,
    {case_map('left(naics_code, 2)', NAICS_SECTORS, 'Unknown')} AS sector
  FROM (SELECT naics_code, max(industry_description) AS naics_title FROM int_joined GROUP BY naics_code) i
),
dim_injury_type AS (
  SELECT {sk(*INJ)} AS injury_type_id,
    {case_map('outcome_code', OUTCOME_LABELS, 'Unknown')} AS outcome,
    outcome_code, oiics_nature_code, oiics_nature_label, oiics_body_part_code,
    oiics_body_part_label, oiics_event_code, oiics_event_label
  FROM (SELECT {', '.join(INJ)}, max(oiics_nature_label) AS oiics_nature_label,
          max(oiics_body_part_label) AS oiics_body_part_label, max(oiics_event_label) AS oiics_event_label
        FROM int_joined GROUP BY {', '.join(INJ)}) x
),
dim_establishment AS (
  SELECT establishment_id, establishment_name, company_name, ein, {bucket} AS employee_size_bucket,
    {case_map('ownership_type_code', OWNERSHIP_LABELS, 'Unknown')} AS ownership_type
  FROM stg_establishments
),
mart_llm_eval AS (
  SELECT {sk('sector', 'severity_tier')} AS eval_id, sector, severity_tier,
    count(*) AS incidents_evaluated, cast(sum(is_agreement) as bigint) AS incidents_in_agreement,
    round(avg(cast(is_agreement as double)), 4) AS agreement_rate
  FROM (
    SELECT coalesce(i.sector, 'Unknown') AS sector,
      coalesce(f.llm_severity_tier, 'unknown') AS severity_tier,
      CASE WHEN {coarse_pred} = {coarse_truth} THEN 1 ELSE 0 END AS is_agreement
    FROM fct_incidents f LEFT JOIN dim_industry i ON f.industry_id = i.industry_id
    WHERE f.llm_event_category IS NOT NULL AND f.oiics_event_code IS NOT NULL) s
  GROUP BY sector, severity_tier
)"""


def warehouse_with() -> str:
    return "WITH " + ",".join([_raw_cases(), _stg_cases(), _stg_establishments(), _joined(),
                               _enrichment(), _marts()])


def on_warehouse(select: str) -> str:
    return warehouse_with() + "\n" + select


# ---------------------------------------------------------------------------
# Oracle SQL per registered key
# ---------------------------------------------------------------------------
ORACLE: dict[str, str] = {}

for _key, _model in (
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
    ORACLE[_key] = on_warehouse(f"SELECT * FROM {_model}")

ORACLE["fact_by_year"] = on_warehouse("""
SELECT y.year, count(*) AS incidents, cast(sum(f.days_away_from_work) as bigint) AS days_away_from_work,
  count(*) FILTER (WHERE f.is_death) AS deaths
FROM fct_incidents f JOIN (SELECT DISTINCT year FROM dim_date WHERE month = 2 AND day(full_date) = 29) y
  ON year(f.incident_date) = y.year
GROUP BY y.year""")

ORACLE["star_rollup"] = on_warehouse("""
SELECT d.year, g.region, i.sector, it.outcome, e.employee_size_bucket,
  count(*) AS incidents, cast(sum(f.days_away_from_work) as bigint) AS days_away_from_work,
  cast(count(*) FILTER (WHERE f.is_death) as bigint) AS deaths
FROM fct_incidents f
LEFT JOIN dim_establishment e ON f.establishment_id = e.establishment_id
LEFT JOIN dim_date d ON f.date_id = d.date_id
LEFT JOIN dim_geography g ON f.geography_id = g.geography_id
LEFT JOIN dim_industry i ON f.industry_id = i.industry_id
LEFT JOIN dim_injury_type it ON f.injury_type_id = it.injury_type_id
GROUP BY d.year, g.region, i.sector, it.outcome, e.employee_size_bucket""")

ORACLE["marts_row_counts"] = on_warehouse(" UNION ALL ".join(
    f"SELECT '{n}' AS mart, count(*) AS row_count, count(DISTINCT {k}) AS distinct_keys FROM {n}"
    for n, k in (("dim_date", "date_id"), ("dim_establishment", "establishment_id"),
                 ("dim_geography", "geography_id"), ("dim_industry", "industry_id"),
                 ("dim_injury_type", "injury_type_id"), ("fct_incidents", "incident_id"),
                 ("mart_llm_eval", "eval_id"))))
