"""Registered data-quality queries: each check's violating rows, and
reports that fold a suite into one (check_name, severity, violations, passed)
table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from casegrid.functions.keys import content_hash
from casegrid.operators import quality as Q
from casegrid.operators.evaluation import eval_mart
from casegrid.plans.analogues import FRESHNESS_AS_OF, table
from casegrid.plans.catalogue import register, warehouse
from casegrid.plans.oracle import on_warehouse, q
from casegrid.plans.warehouse import ACCEPTED, ALL_NOT_NULL, ALL_UNIQUE, FOREIGN_KEYS, MART_NAMES, warehouse_checks
from casegrid.session import materialise, scratch_path
from casegrid.sources.versions import read_table, replace_table

ACCEPTED_EVENTS = ("view", "click", "purchase", "signup")
PARENT_EXCLUDED_SEGMENT = "MACHINERY"
QTY_MIN, QTY_MAX = 1, 40
ORDERS_MAX = 10000
FRESH_DAYS = 90


def _docs_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


def _events_typed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("event_type"))
                    .alias("event_type_n"), "ts")


def _parents(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != PARENT_EXCLUDED_SEGMENT)


SQL_NOT_NULL = "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL"
SQL_UNIQUE = ("SELECT content_hash, count(*) AS n_records FROM (SELECT sha256(coalesce(text, '')) AS content_hash "
              "FROM documents) d GROUP BY content_hash HAVING count(*) > 1")
SQL_ACCEPTED = (f"SELECT event_id, event_type_n FROM (SELECT event_id, CASE WHEN value < 5 THEN NULL ELSE event_type END "
                f"AS event_type_n FROM events) e WHERE event_type_n NOT IN ({', '.join(q(v) for v in ACCEPTED_EVENTS)})")
SQL_REL = (f"SELECT o_orderkey, o_custkey FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS "
           f"(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> '{PARENT_EXCLUDED_SEGMENT}')")
SQL_BETWEEN = (f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE "
               f"coalesce(l_returnflag = 'R' AND NOT (l_quantity >= {QTY_MIN} AND l_quantity <= {QTY_MAX}), false)")
SQL_ROWCOUNT = (f"SELECT row_count FROM (SELECT count(*) AS row_count FROM orders) o "
                f"WHERE row_count < 1 OR row_count > {ORDERS_MAX}")
SQL_FRESH = (f"SELECT max_loaded_at, age_days FROM (SELECT max(ts) AS max_loaded_at, "
             f"cast(datediff('day', cast(max(ts) as date), DATE '{FRESHNESS_AS_OF}') as integer) AS age_days "
             f"FROM events) e WHERE age_days > {FRESH_DAYS}")
SQL_COVERAGE = ("SELECT * FROM (SELECT count(*) AS narrated_incidents, count(l.quality) AS classified_incidents "
                "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) c "
                "WHERE narrated_incidents > 0 AND cast(classified_incidents as double) / narrated_incidents < 0.9")


@register("dq_not_null", SQL_NOT_NULL)
def q_dq_not_null(spark, sf_dir):
    return Q.not_null(_docs_labels(spark, sf_dir), "quality").select("doc_id")


@register("dq_unique", SQL_UNIQUE)
def q_dq_unique(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(content_hash("text").alias("content_hash"))
    return Q.unique(d, "content_hash")


@register("dq_accepted_values", SQL_ACCEPTED)
def q_dq_accepted_values(spark, sf_dir):
    return Q.accepted_values(_events_typed(spark, sf_dir), "event_type_n", ACCEPTED_EVENTS).select(
        "event_id", "event_type_n")


@register("dq_relationships", SQL_REL)
def q_dq_relationships(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return Q.relationships(o, "o_custkey", _parents(spark, sf_dir), "c_custkey")


@register("dq_between", SQL_BETWEEN)
def q_dq_between(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return Q.between(li, "l_quantity", QTY_MIN, QTY_MAX, "l_returnflag = 'R'").drop("l_returnflag")


@register("dq_row_count", SQL_ROWCOUNT)
def q_dq_row_count(spark, sf_dir):
    return Q.row_count(table(spark, sf_dir, "orders"), 1, ORDERS_MAX)


def _as_of():
    return datetime.fromisoformat(FRESHNESS_AS_OF)


@register("dq_freshness", SQL_FRESH)
def q_dq_freshness(spark, sf_dir):
    return Q.freshness(table(spark, sf_dir, "events"), "ts", _as_of(), FRESH_DAYS)


def driver_checks(spark, sf_dir) -> list[Q.Check | Q.ScanCheck]:
    labelled, events = _docs_labels(spark, sf_dir), _events_typed(spark, sf_dir)
    return [
        Q.scan_not_null("labels.quality.not_null", labelled, "quality"),
        Q.Check("documents.text.unique", lambda: q_dq_unique(spark, sf_dir)),
        Q.scan_accepted("events.event_type.accepted_values", events, "event_type_n", ACCEPTED_EVENTS),
        Q.Check("orders.o_custkey.relationships", lambda: q_dq_relationships(spark, sf_dir)),
        Q.scan_between("lineitem.l_quantity.between", table(spark, sf_dir, "lineitem"), "l_quantity", QTY_MIN,
                       QTY_MAX, "l_returnflag = 'R'"),
        Q.Check("orders.row_count", lambda: q_dq_row_count(spark, sf_dir)),
        Q.scan_freshness("events.ts.freshness", events, F.col("ts"), _as_of(), FRESH_DAYS),
        Q.scan_coverage("labels.coverage", labelled, "quality", 0.90),
    ]


VALUE_MAX = 60


def event_row_checks() -> list[Q.RowCheck]:
    return [Q.row_not_null("events.event_type.not_null", "event_type_n"),
            Q.row_accepted("events.event_type.accepted_values", "event_type_n", ACCEPTED_EVENTS[:3]),
            Q.row_between("events.value.between", "value", 0, VALUE_MAX, "event_type_n is not null")]


@register("dq_violating_rows", f"""
SELECT * FROM (SELECT event_id, event_type_n, value, cast(
    CASE WHEN event_type_n IS NULL THEN 1 ELSE 0 END
    + CASE WHEN event_type_n NOT IN ({', '.join(q(v) for v in ACCEPTED_EVENTS[:3])}) THEN 2 ELSE 0 END
    + CASE WHEN event_type_n IS NOT NULL AND NOT (value >= 0 AND value <= {VALUE_MAX}) THEN 4 ELSE 0 END as bigint) AS dq_mask
  FROM (SELECT event_id, value, CASE WHEN value < 5 THEN NULL ELSE event_type END AS event_type_n FROM events) e) m
WHERE dq_mask <> 0""")
def q_dq_violating_rows(spark, sf_dir):
    """The events that fail a check, stored with a mask of the checks they fail."""
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("event_type"))
                    .alias("event_type_n"), "value")
    path = scratch_path(spark, "violations")
    replace_table(Q.violating_rows(rows, event_row_checks()), path)
    return read_table(spark, path)


def _report_sql(parts) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{sev}' AS severity, n AS violations, n = 0 AS passed "
        f"FROM (SELECT count(*) AS n FROM ({sql}) v) c" for name, sev, sql in parts)


@register("dq_report", _report_sql([
    ("labels.quality.not_null", "error", SQL_NOT_NULL),
    ("documents.text.unique", "error", SQL_UNIQUE),
    ("events.event_type.accepted_values", "error", SQL_ACCEPTED),
    ("orders.o_custkey.relationships", "error", SQL_REL),
    ("lineitem.l_quantity.between", "error", SQL_BETWEEN),
    ("orders.row_count", "error", SQL_ROWCOUNT),
    ("events.ts.freshness", "warn", SQL_FRESH),
    ("labels.coverage", "error", SQL_COVERAGE),
]))
def q_dq_report(spark, sf_dir):
    return Q.report(driver_checks(spark, sf_dir))


# ------------------------------------------------- the layer suites ----
def _warehouse_report_sql() -> str:
    parts = [(f"{name}.{col}.not_null", "error", f"SELECT 1 FROM {name} WHERE {col} IS NULL")
             for name, col in ALL_NOT_NULL]
    parts += [(f"{name}.{col}.unique", "error",
               f"SELECT {col} FROM {name} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")
              for name, col in ALL_UNIQUE]
    for fk, dim in FOREIGN_KEYS:
        parts.append((f"fct_incidents.{fk}.relationships", "error",
                      f"SELECT 1 FROM fct_incidents f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
                      f"(SELECT 1 FROM {dim} d WHERE d.{fk} = f.{fk})"))
    for name, col, vals in ACCEPTED:
        lits = ", ".join(q(v) if isinstance(v, str) else str(v) for v in vals)
        parts.append((f"{name}.{col}.accepted_values", "error", f"SELECT 1 FROM {name} WHERE {col} NOT IN ({lits})"))
    parts += [
        ("fct_incidents.days_away_from_work.between", "error",
         "SELECT 1 FROM fct_incidents WHERE coalesce(days_away_from_work IS NOT NULL AND NOT "
         "(days_away_from_work >= 0 AND days_away_from_work <= 365), false)"),
        ("mart_llm_eval.agreement_rate.between", "error",
         "SELECT 1 FROM mart_llm_eval WHERE coalesce(NOT (agreement_rate >= 0 AND agreement_rate <= 1), false)"),
        ("fct_incidents.row_count", "error",
         "SELECT n FROM (SELECT count(*) AS n FROM fct_incidents) c WHERE n < 1"),
        ("int_enriched.coverage", "error",
         "SELECT 1 FROM (SELECT count(*) AS n, count(llm_event_category) AS k FROM int_enriched) c "
         "WHERE n > 0 AND cast(k as double) / n < 0.9"),
        ("raw_cases.created_timestamp.freshness", "warn",
         "SELECT 1 FROM (SELECT max(strptime(nullif(trim(created_timestamp), ''), '%d%b%Y:%H:%M:%S')) AS t FROM raw_cases) c "
         f"WHERE datediff('day', cast(t as date), DATE '{FRESHNESS_AS_OF}') > {FRESH_DAYS}"),
    ]
    return on_warehouse(_report_sql(parts))


@register("warehouse_dq_report", _warehouse_report_sql())
def q_warehouse_dq_report(spark, sf_dir):
    """The suites of all layers on stored tables: what the checks read of the
    raw export, the cases, the establishments, the joined layer, the enrichment
    and every mart are written once, without the texts, which no check reads;
    the checks on rows of a table then share one pruned scan of it."""
    m = warehouse(spark, sf_dir, store=True, narratives=False)
    m["raw_cases"] = materialise(m["raw_cases"].select("id", "establishment_id", "created_timestamp"), "raw-cases", "zstd")
    m |= {name: materialise(m[name], name, "zstd") for name in MART_NAMES if name != "mart_llm_eval"}
    m["mart_llm_eval"] = materialise(eval_mart(m["fct_incidents"], m["dim_industry"]), "mart")
    return Q.report(warehouse_checks(m, as_of=_as_of()))
