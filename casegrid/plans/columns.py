"""Registered queries for column functions, lookups, filters and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegrid.functions.clean import PANDAS_NULL_TOKENS, cast_int, cast_round, clean_text, null_tokens, trim_to_null
from casegrid.functions.keys import CONTENT_SEP, content_hash, surrogate_key
from casegrid.functions.lookup import (
    CENSUS_REGIONS,
    COARSE_FROM_CATEGORY,
    COARSE_FROM_DIVISION,
    NAICS_SECTORS,
    OUTCOME_LABELS,
    OWNERSHIP_LABELS,
    bucketize,
    census_region,
    coarse_event_from_category,
    coarse_event_from_code,
    naics_sector,
    outcome_label,
    ownership_label,
)
from casegrid.functions.parse import render_sas_date, render_sas_timestamp, sas_date, sas_timestamp
from casegrid.functions.prompt import (
    CLOSING_LINE,
    FIELD_DEFAULT,
    NARRATIVE_FIELDS,
    NARRATIVE_LABELS,
    SECTOR_DEFAULT,
    render_prompt,
)
from casegrid.operators.filters import all_present, any_present, limit_ordered, sample_n
from casegrid.operators.evaluation import join_with_default
from casegrid.operators.staging import outcome_flag, stage_cases, stage_enrichment
from casegrid.plans.analogues import MODEL_NAME, RUN_TS, STATE_CODES, raw_cases, table
from casegrid.plans.catalogue import register
from casegrid.plans.oracle import case_map, clean, lst, on_warehouse, pm, q, sk
from casegrid.sources.text_csv import resolve_columns, snake_case_columns

SAMPLE_SEED = 42
SAMPLE_SIZE = 200

# ----------------------------------------------------------------- text ----
_blank_src = ("src0", "src1")


@register("trim_to_null", f"""
SELECT doc_id, raw, nullif(trim(raw), '') AS lang_clean FROM (
  SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN '   '
                      ELSE '  ' || lang || ' ' END AS raw FROM documents) d""")
def q_trim_to_null(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    raw = F.when(F.col("source").isin(*_blank_src), F.lit("   ")).otherwise(
        F.concat(F.lit("  "), F.col("lang"), F.lit(" ")))
    return d.select("doc_id", raw.alias("raw")).select("doc_id", "raw", trim_to_null("raw").alias("lang_clean"))


_token_of = {"src0": "N/A", "src1": "None", "src2": "", "src3": "nan", "src4": "NULL ", "src5": "#N/A"}


@register("null_tokens", f"""
SELECT doc_id, CASE WHEN v IN ({', '.join(q(x) for x in PANDAS_NULL_TOKENS)}) THEN NULL ELSE v END AS source_text
FROM (SELECT doc_id, {case_map('source', _token_of, None).replace("ELSE NULL", "ELSE source")} AS v FROM documents) d""")
def q_null_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    v = None
    for src, tok in _token_of.items():
        v = F.when(F.col("source") == src, F.lit(tok)) if v is None else v.when(F.col("source") == src, F.lit(tok))
    v = v.otherwise(F.col("source"))
    return null_tokens(d.select("doc_id", v.alias("source_text")), ["source_text"])


@register("clean_text", f"""
SELECT conv_id, turn, {clean('padded')} AS text_clean FROM (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN chr(9) || ' ' || text || chr(160) || chr(12288) || ' '
                             ELSE text END AS padded FROM conversations) c""")
def q_clean_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    padded = F.when(F.col("role") == "user",
                    F.concat(F.lit("\t "), F.col("text"), F.lit(" 　 "))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", clean_text(padded).alias("text_clean"))


# ----------------------------------------------------------------- keys ----
@register("surrogate_key", f"""
SELECT doc_id, {sk('lang_n', 'source_n')} AS doc_key FROM (
  SELECT doc_id, CASE WHEN source = 'src0' THEN NULL ELSE lang END AS lang_n,
         CASE WHEN lang = 'de' THEN NULL ELSE source END AS source_n FROM documents) d""")
def q_surrogate_key(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lang_n = F.when(F.col("source") == "src0", F.lit(None)).otherwise(F.col("lang"))
    source_n = F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.col("source"))
    return d.select("doc_id", surrogate_key(lang_n, source_n).alias("doc_key"))


@register("content_hash", f"""
SELECT conv_id, turn, sha256(coalesce(role, '') || '{CONTENT_SEP}' || coalesce(text, '')) AS content_hash
FROM conversations""")
def q_content_hash(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", content_hash("role", "text").alias("content_hash"))


# ---------------------------------------------------------------- parse ----
@register("parse_sas_date", """
SELECT o_orderkey, upper(strftime(o_orderdate, '%d%b%Y')) AS sas_text, cast(o_orderdate as date) AS order_date
FROM orders""")
def q_parse_sas_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = render_sas_date("o_orderdate")
    return o.select("o_orderkey", txt.alias("sas_text")).withColumn("order_date", sas_date("sas_text"))


@register("parse_sas_timestamp", """
SELECT event_id, upper(strftime(ts, '%d%b%Y:%H:%M:%S')) AS sas_text, date_trunc('second', ts) AS event_ts
FROM events""")
def q_parse_sas_timestamp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    txt = render_sas_timestamp("ts")
    return e.select("event_id", txt.alias("sas_text")).withColumn("event_ts", sas_timestamp("sas_text"))


# ---------------------------------------------------------------- casts ----
@register("cast_int_strict", """
SELECT o_orderkey, cast(o_orderkey as varchar) AS key_text, cast(cast(o_orderkey as varchar) as bigint) AS key_int,
       CASE WHEN regexp_matches(cast(o_orderkey as varchar) || '.0', '^ *[+-]?[0-9]+ *$')
            THEN try_cast(cast(o_orderkey as varchar) || '.0' as bigint) END AS key_decimal_text
FROM orders""")
def q_cast_int_strict(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = F.col("o_orderkey").cast("string")
    return o.select("o_orderkey", txt.alias("key_text"), cast_int(txt, "bigint").alias("key_int"),
                    # '1.0' is not an integer: the lenient form yields null
                    cast_int(F.concat(txt, F.lit(".0")), "bigint", strict=False).alias("key_decimal_text"))


@register("cast_round_int", """
SELECT l_orderkey, l_linenumber, price_text,
       cast(round(cast(price_text as decimal(38,10)), 0) as integer) AS price_int,
       cast(round(cast('-' || price_text as decimal(38,10)), 0) as integer) AS neg_price_int
FROM (SELECT l_orderkey, l_linenumber, cast(cast(l_extendedprice as decimal(14,2)) as varchar) AS price_text
      FROM lineitem) l""")
def q_cast_round_int(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    txt = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    return li.select("l_orderkey", "l_linenumber", txt.alias("price_text")).select(
        "l_orderkey", "l_linenumber", "price_text",
        cast_round("price_text", "int").alias("price_int"),
        cast_round(F.concat(F.lit("-"), F.col("price_text")), "int").alias("neg_price_int"))


@register("flag_columns", """
SELECT o_orderkey, (nullif(o_orderstatus, 'P') = 'F') AS is_final, (nullif(o_orderstatus, 'P') = 'O') AS is_open
FROM orders""")
def q_flag_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    st = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return o.select("o_orderkey", outcome_flag(st, "F").alias("is_final"),
                    outcome_flag(st, "O").alias("is_open"))


# ------------------------------------------------------------ rename -------
_label_enrichment_sql = f"""
SELECT cast(doc_id as varchar) AS incident_id,
  CASE WHEN quality = 1 THEN ' clear text ' ELSE '   ' END AS contributing_factor,
  CASE WHEN toxic = 1 THEN 'severe' ELSE ' minor' END AS severity_tier,
  CASE WHEN toxic = 1 THEN 'violence' ELSE 'other' END AS event_category,
  'review the source' AS recurrence_prevention,
  cast(quality as double) * 0.5 + 0.25 AS confidence,
  'v1' AS prompt_version, {q(MODEL_NAME)} AS model_name, TIMESTAMP {q(RUN_TS)} AS enriched_at
FROM labels"""


@register("rename_projection", f"""
SELECT incident_id, nullif(trim(contributing_factor), '') AS llm_contributing_factor,
  nullif(trim(severity_tier), '') AS llm_severity_tier, nullif(trim(event_category), '') AS llm_event_category,
  nullif(trim(recurrence_prevention), '') AS llm_recurrence_action, confidence AS llm_confidence,
  prompt_version, model_name, enriched_at
FROM ({_label_enrichment_sql}) e""")
def q_rename_projection(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    enr = lab.select(
        F.col("doc_id").cast("string").alias("incident_id"),
        F.when(F.col("quality") == 1, F.lit(" clear text ")).otherwise(F.lit("   ")).alias("contributing_factor"),
        F.when(F.col("toxic") == 1, F.lit("severe")).otherwise(F.lit(" minor")).alias("severity_tier"),
        F.when(F.col("toxic") == 1, F.lit("violence")).otherwise(F.lit("other")).alias("event_category"),
        F.lit("review the source").alias("recurrence_prevention"),
        (F.col("quality").cast("double") * 0.5 + 0.25).alias("confidence"),
        F.lit("v1").alias("prompt_version"), F.lit(MODEL_NAME).alias("model_name"),
        F.lit(RUN_TS).cast("timestamp_ntz").alias("enriched_at"))
    return stage_enrichment(enr)


# ------------------------------------------------------------- filters -----
@register("filter_any_present", """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE coalesce(cast(l.quality as varchar), CASE WHEN d.lang = 'en' THEN d.text END) IS NOT NULL""")
def q_filter_any_present(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left").select(
        "doc_id", "lang", "quality",
        F.col("quality").cast("string").alias("_q"),
        F.when(F.col("lang") == "en", F.col("text")).alias("_t"))
    return any_present(j, ["_q", "_t"]).select("doc_id", "lang", "quality")


@register("filter_not_null", """
SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""")
def q_filter_not_null(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels")
    return all_present(d.join(lab, "doc_id", "left"), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@register("sample_n", f"""
SELECT doc_id, lang, source FROM documents
ORDER BY md5('{SAMPLE_SEED}-' || cast(doc_id as varchar)), doc_id LIMIT {SAMPLE_SIZE}""")
def q_sample_n(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return sample_n(d, SAMPLE_SIZE, SAMPLE_SEED, "doc_id")


@register("limit_ordered", """
SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 100""")
def q_limit_ordered(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return limit_ordered(c, 100, ["conv_id", "turn"])


@register("staged_projection", on_warehouse(
    f"SELECT incident_id, {', '.join(NARRATIVE_FIELDS)}, industry_description FROM stg_cases"))
def q_staged_projection(spark, sf_dir):
    return stage_cases(raw_cases(spark, sf_dir)).select("incident_id", *NARRATIVE_FIELDS, "industry_description")


@register("resolve_columns", "SELECT doc_id, lang, text FROM documents")
def q_resolve_columns(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", *resolve_columns(d, ["LANG", "Text", "missing_column"]))


_MESSY = {"o_orderkey": "O OrderKey", "o_custkey": "Cust-Key", "o_orderstatus": "Order Status ",
          "o_totalprice": "TOTAL  PRICE($)", "o_orderdate": "Order.Date", "o_orderpriority": "__Priority__"}


@register("snake_case_columns", """
SELECT o_orderkey AS o_orderkey, o_custkey AS cust_key, o_orderstatus AS order_status,
  o_totalprice AS total_price, o_orderdate AS order_date, o_orderpriority AS priority FROM orders""")
def q_snake_case_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(*_MESSY)
    messy = o.toDF(*[_MESSY[c] for c in o.columns])
    return messy.toDF(*snake_case_columns(messy.columns))


# -------------------------------------------------------------- lookups ----
def _state_of(key):
    st = F.try_element_at(F.array(*[F.lit(s) for s in STATE_CODES]), (F.pmod(key, F.lit(53)) + 1).cast("int"))
    return F.when(F.pmod(key, F.lit(5)) == 0, F.lower(st)).otherwise(st)


_state_sql = f"{lst(STATE_CODES)}[{pm('c_custkey', 53)} + 1]"


@register("map_region", f"""
SELECT c_custkey, state, {case_map('upper(state)', CENSUS_REGIONS, 'Other')} AS region FROM (
  SELECT c_custkey, CASE WHEN {pm('c_custkey', 5)} = 0 THEN lower({_state_sql}) ELSE {_state_sql} END AS state
  FROM customer) c""")
def q_map_region(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", _state_of(F.col("c_custkey")).alias("state")).withColumn(
        "region", census_region("state"))


@register("map_prefix", f"""
SELECT p_partkey, code, {case_map('left(code, 2)', NAICS_SECTORS, 'Unknown')} AS sector FROM (
  SELECT p_partkey, cast(p_size + 10 as varchar) || lpad(cast({pm('p_partkey', 10000)} as varchar), 4, '0') AS code
  FROM part) p""")
def q_map_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    code = F.concat((F.col("p_size") + 10).cast("string"),
                    F.lpad(F.pmod("p_partkey", F.lit(10000)).cast("string"), 4, "0"))
    return p.select("p_partkey", code.alias("code")).withColumn("sector", naics_sector("code"))


_event_category = {"click": "struck_by_or_against", "view": "fall_slip_trip",
                   "purchase": "transportation", "signup": "cut_laceration"}


@register("map_coarse_pred", f"""
SELECT event_id, category, {case_map('category', COARSE_FROM_CATEGORY, 'other')} AS coarse_event FROM (
  SELECT event_id, {case_map('event_type', _event_category, None)} AS category FROM events) e""")
def q_map_coarse_pred(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cat = None
    for k, v in _event_category.items():
        cat = F.when(F.col("event_type") == k, F.lit(v)) if cat is None else cat.when(F.col("event_type") == k, F.lit(v))
    return e.select("event_id", cat.alias("category")).withColumn(
        "coarse_event", coarse_event_from_category("category"))


@register("map_coarse_truth", f"""
SELECT p_partkey, code, CASE WHEN code IS NULL THEN NULL ELSE
  {case_map('left(cast(code as varchar), 1)', COARSE_FROM_DIVISION, 'other')} END AS coarse_event
FROM (SELECT p_partkey, CASE WHEN p_size > 45 THEN NULL ELSE p_size * 37 END AS code FROM part) p""")
def q_map_coarse_truth(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    code = F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_size") * 37)
    return p.select("p_partkey", code.alias("code")).withColumn("coarse_event", coarse_event_from_code("code"))


_outcome_sql = ("CASE WHEN o_orderpriority = '1-URGENT' THEN 4 WHEN o_orderpriority = '5-LOW' THEN 7 "
                "WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END")


@register("map_outcome", f"""
SELECT o_orderkey, outcome_code, {case_map('outcome_code', OUTCOME_LABELS, 'Unknown')} AS outcome
FROM (SELECT o_orderkey, {_outcome_sql} AS outcome_code FROM orders) o""")
def q_map_outcome(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    code = (F.when(F.col("o_orderpriority") == "1-URGENT", 4).when(F.col("o_orderpriority") == "5-LOW", 7)
            .when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3))
    return o.select("o_orderkey", code.alias("outcome_code")).withColumn("outcome", outcome_label("outcome_code"))


@register("map_ownership", f"""
SELECT n_nationkey, n_regionkey AS ownership_type_code,
  {case_map('n_regionkey', OWNERSHIP_LABELS, 'Unknown')} AS ownership_type FROM nation""")
def q_map_ownership(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", F.col("n_regionkey").alias("ownership_type_code"),
                    ownership_label("n_regionkey").alias("ownership_type"))


_PRICE_BOUNDS = (1000, 1500, 2000)
_PRICE_LABELS = ("budget", "standard", "premium", "luxury")


@register("bucketize", f"""
SELECT p_partkey, CASE WHEN price IS NULL THEN 'unpriced' """ + " ".join(
    f"WHEN price < {b} THEN '{lab}'" for b, lab in zip(_PRICE_BOUNDS, _PRICE_LABELS)) + f"""
  ELSE '{_PRICE_LABELS[-1]}' END AS price_bucket
FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL ELSE p_retailprice END AS price FROM part) p""")
def q_bucketize(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    price = F.when(F.col("p_size") == 1, F.lit(None)).otherwise(F.col("p_retailprice"))
    return p.select("p_partkey", bucketize(price, _PRICE_BOUNDS, _PRICE_LABELS, "unpriced").alias("price_bucket"))


# --------------------------------------------------------------- prompt ----
def _prompt_sql() -> str:
    src = {"narrative_location": "lang", "narrative_description": "source",
           "narrative_activity": "NULL", "narrative_event": "text", "narrative_injury": "''",
           "narrative_source": "cast(n_chars as varchar)"}
    lines = [f"'Industry: ' || coalesce(nullif(CASE WHEN lang = 'en' THEN 'Manufacturing' END, ''), {q(SECTOR_DEFAULT)})",
             "''", "'Incident narrative:'"]
    lines += [f"{q('- ' + NARRATIVE_LABELS[f] + ': ')} || coalesce(nullif({src[f]}, ''), {q(FIELD_DEFAULT)})"
              for f in NARRATIVE_FIELDS]
    lines += ["''", q(CLOSING_LINE)]
    return f"SELECT doc_id, concat_ws(chr(10), {', '.join(lines)}) AS prompt FROM documents"


@register("render_prompt", _prompt_sql())
def q_render_prompt(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    fields = {"narrative_location": F.col("lang"), "narrative_description": F.col("source"),
              "narrative_activity": F.lit(None).cast("string"), "narrative_event": F.col("text"),
              "narrative_injury": F.lit(""), "narrative_source": F.col("n_chars").cast("string")}
    sector = F.when(F.col("lang") == "en", F.lit("Manufacturing"))
    return d.select("doc_id", render_prompt(fields, sector).alias("prompt"))


# ------------------------------------------------------- dedupe / joins ----
@register("dedupe_latest", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT user_id, event_id, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) e WHERE rn = 1""")
def q_dedupe_latest(spark, sf_dir):
    """Latest event per user (ts desc nulls last, ties by event id desc)."""
    from casegrid.operators.dedupe import latest_per_key
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(e, ["user_id"], [F.col("ts")], [F.col("event_id")])


@register("join_dim_default", """
SELECT c.c_custkey, coalesce(n.n_name, 'Unknown') AS nation_name
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c.c_nationkey = n.n_nationkey""")
def q_join_dim_default(spark, sf_dir):
    """Left join to a dimension with a default label for unmatched rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return join_with_default(c, n, "c_nationkey", "n_name", "Unknown").select(
        "c_custkey", F.col("n_name").alias("nation_name"))
