"""What queries of the warehouse store, scan and join: each text once, and of
stored layers what is read."""

import datetime
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casegrid import session
from casegrid.functions.prompt import NARRATIVE_FIELDS
from casegrid.operators import enrich as E
from casegrid.operators import staging
from casegrid.operators.merge import upsert_by_key
from casegrid.plans import catalogue, checks


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    day = datetime.datetime(2021, 3, 4)
    keys = [*range(40), 7, 7]  # a case that comes three times
    n = len(keys)
    prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    for name, columns in {
        "orders": {"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([k % 5 for k in keys], pa.int64()),
                   "o_orderstatus": ["FOP"[k % 3] for k in keys], "o_totalprice": [10.5 * k for k in keys],
                   "o_orderdate": pa.array([day + datetime.timedelta(days=30 * k) for k in keys], pa.timestamp("us")),
                   "o_orderpriority": [prios[k % 5] for k in keys]},
        "customer": {"c_custkey": pa.array([0, 1, 2, 3], pa.int64()), "c_name": ["a", "b", "c", "d"],
                     "c_nationkey": pa.array([0, 1, 0, 1], pa.int32()), "c_acctbal": [5.0, 30.0, 300.0, None],
                     "c_mktsegment": ["X", "Y", "Z", None]},
        "nation": {"n_nationkey": pa.array([0, 1], pa.int32()), "n_name": ["N", "M"],
                   "n_regionkey": pa.array([0, 0], pa.int32())},
        "documents": {"doc_id": pa.array([1, 2, 2, None], pa.int64()),
                      "text": ["he fell", "a fire", "a flame", "none"]},
    }.items():
        pq.write_table(pa.table(columns), str(d / f"{name}.parquet"))
    assert n == 42
    return str(d)


def reads(df, table):
    return any(f"/{table}.parquet" in f for f in df.inputFiles())


@pytest.mark.parametrize("query", ["eval_mart", "fact_foreign_keys", "join_enrichment"])
def test_texts_are_joined_and_typed_once(spark, tables, query):
    out = catalogue.QUERIES[query](spark, tables)
    assert not reads(out, "documents")  # the cases are stored: no later step renders them again
    assert out.count()


def test_establishments_read_no_document(spark, tables):
    m = catalogue.warehouse(spark, tables, enriched=False, joins=False)
    assert not reads(m["stg_establishments"], "documents") and reads(m["stg_cases"], "documents")
    from casegrid.operators.staging import stage_establishments
    assert sorted(map(str, m["stg_establishments"].collect())) == sorted(
        map(str, stage_establishments(m["raw_cases"]).collect()))


def test_the_stored_layer_holds_what_marts_read(spark, tables):
    m = catalogue.warehouse(spark, tables, enriched=False, store=True, narratives=False)
    assert "street_address" not in m["int_joined"].columns and "naics_code" in m["int_joined"].columns
    assert not set(NARRATIVE_FIELDS) & set(m["int_joined"].columns)


def test_star_rollup_joins_stored_dimensions(spark, tables):
    out = catalogue.q_star_rollup(spark, tables)
    assert any("casegrid-dim_industry" in f for f in out.inputFiles())
    cases = catalogue.warehouse(spark, tables, enriched=False, joins=False)["stg_cases"]
    assert out.agg(F.sum("incidents")).first()[0] == cases.count()


def test_the_mart_of_labels_is_built_from_the_stored_fact(spark, tables, monkeypatch):
    seen = {}
    real = catalogue.reload_table

    def spy(df, path, *more):
        seen[path.rsplit("/", 1)[1]] = df.inputFiles()
        return real(df, path, *more)

    monkeypatch.setattr(catalogue, "reload_table", spy)
    rows = {r["mart"]: r for r in catalogue.q_marts_row_counts(spark, tables).collect()}
    assert all("/fct_incidents/" in f or "/dim_industry/" in f for f in seen["mart_llm_eval"])
    assert rows["fct_incidents"]["row_count"] > rows["fct_incidents"]["distinct_keys"]


def test_the_report_stores_what_checks_read_of_the_export(spark, tables, monkeypatch):
    stored = {}
    real = checks.materialise

    def spy(df, name, *more):
        stored[name] = df.columns
        return real(df, name, *more)

    monkeypatch.setattr(checks, "materialise", spy)
    report = {r["check_name"]: r["violations"] for r in checks.q_warehouse_dq_report(spark, tables).collect()}
    assert stored["raw-cases"] == ["id", "establishment_id", "created_timestamp"]
    assert report["raw_cases.id.unique"] == 2  # order 7 comes three times, document 2 twice


@pytest.mark.parametrize("most", [True, False])
def test_texts_of_misses(spark, most):
    rows = spark.createDataFrame(
        [("b", "t1", "h1", "s"), ("a", "t1", "h1", "r"), ("a", "t1", "h1", "r"), ("c", "t2", "h2", None),
         (None, "t3", "h3", "s"), ("d", "t4", "h4", "s")],
        "incident_id string, f string, content_hash string, sector string")
    misses = spark.createDataFrame([("h1", "a"), ("h2", "c"), ("h3", None)], "content_hash string, rep_id string")
    out = E.miss_texts(rows, misses, ["f"], most)
    assert sorted(map(tuple, out.select("content_hash", "incident_id", "f", "sector").collect())) == [
        ("h1", "a", "t1", "r"), ("h2", "c", "t2", None)]


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("query", ["fact_foreign_keys", "join_enrichment"])
def test_texts_are_dealt_out_once_behind_the_stored_cases(spark, tables, no_broadcast, query):
    out = catalogue.QUERIES[query](spark, tables)
    nodes = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n\n")
    dealt = [n for n in nodes if "Exchange" in n.split("\n")[0] and "hashpartitioning" in n]
    assert len(dealt) == 3 and all("hashpartitioning(case_row" in n for n in dealt)
    assert sum("narrative_event" in n for n in dealt) == 1


@pytest.mark.parametrize("query, model", [("fact_foreign_keys", "fct_incidents"), ("join_enrichment", "int_enriched")])
def test_joins_by_row_number_give_the_rows_of_plain_joins(spark, tables, query, model):
    # a case, a document that come several times; an establishment that is not there
    plain = catalogue.warehouse(spark, tables, whole=True)[model]
    out = catalogue.QUERIES[query](spark, tables)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert out.count() > out.select("incident_id").distinct().count()


def test_numbers_of_rows_stay_inside(spark, tables):
    m = catalogue.warehouse(spark, tables, by_row=True)
    assert not [n for n, df in m.items() if staging.CASE_ROW in df.columns]


def test_popular_establishments_are_salted_by_row(spark):
    cases = spark.createDataFrame(
        [(k, f"i{k % 3}", "e1" if k % 2 else None, "t") for k in range(12)] + [(12, "i9", "e2", None)],
        "case_row long, incident_id string, establishment_id string, narrative_event string")
    missing = [c for c in (*staging.CASE_COLUMNS, *staging.CODE_COLUMNS, *NARRATIVE_FIELDS) if c not in cases.columns]
    cases = cases.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    est = spark.createDataFrame([("e1", "A"), ("e3", "C")], "establishment_id string, establishment_name string")
    est = est.select("*", *[F.lit(None).cast("string").alias(c) for c in staging.ESTABLISHMENT_COLUMNS
                            if c not in est.columns])
    hot = {"e1": 4, None: 2}
    plain = staging.join_establishment(cases, est, hot)
    out = staging.join_establishment(cases, est, hot, row="case_row")
    assert out.columns == ["case_row", *plain.columns]
    assert sorted(map(str, out.drop("case_row").collect())) == sorted(map(str, plain.collect()))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffles_go_when_a_table_is_stored(spark):
    before = shuffle_files(spark)
    conf = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    stored = session.materialise(df, "freed")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == conf
    assert sorted(df.collect()) == sorted(stored.collect())  # its plan can run again


def test_empty_state_takes_no_shuffle(spark):
    rows = spark.createDataFrame([("a", 1)], "incident_id string, n int").select(
        "incident_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in E.ENRICHMENT_SCHEMA.fields[1:]])
    out = upsert_by_key(E.empty_enrichment(spark), rows, ["incident_id"])
    assert out.columns == E.ENRICHMENT_SCHEMA.names and out.count() == 1
    assert E.empty_enrichment(spark).schema == E.ENRICHMENT_SCHEMA and E.empty_cache(spark).schema == E.CACHE_SCHEMA
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
