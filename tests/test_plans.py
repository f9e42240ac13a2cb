"""Plan properties that matter at scale (checked on the sf0.001 tables)."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_latest_per_key_combines_before_the_shuffle(spark):
    p = plan(E.queries()["dedupe_latest"](spark, SF))
    assert "partial_max_by" in p
    tree = p.split("\n\n")[0]
    # the partial aggregate sits below the only exchange
    assert tree.index("Exchange") < tree.rindex("SortAggregate")
    assert "Window" not in tree


def test_scans_prune_columns_and_push_filters(spark):
    p = plan(E.queries()["dq_between"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>\n" in p
    p = plan(E.queries()["dq_relationships"](spark, SF))
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(c_mktsegment,MACHINERY\)\)", p)


def test_native_paths_run_no_python(spark):
    for key in ("fact_foreign_keys", "classify_rules", "validate_reply", "render_prompt", "star_rollup"):
        p = plan(E.queries()[key](spark, SF))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF", p), key


def test_star_rollup_aggregates_before_dimension_joins(spark):
    tree = plan(E.queries()["star_rollup"](spark, SF)).split("\n\n")[0]
    top = tree.split("\n")[:40]
    # the final aggregate sits above the dimension joins, and a grouping on the
    # foreign keys (partial + final) sits below them
    joins = [i for i, ln in enumerate(top) if "Join" in ln]
    aggs = [i for i, ln in enumerate(top) if "HashAggregate" in ln]
    assert aggs and joins and min(aggs) < min(joins) and max(aggs) > min(joins)


def test_sample_is_a_bounded_top_n(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["sample_n"](spark, SF))


def test_check_suite_scans_a_table_once_for_its_row_checks(spark):
    from casegrid.operators import quality as Q
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    checks = [Q.scan_not_null("a", li, "l_orderkey"), Q.scan_between("b", li, "l_quantity", 1, 40),
              Q.scan_accepted("c", li, "l_returnflag", ["R"]), Q.scan_row_count("d", li, 1),
              Q.scan_coverage("e", li, "l_quantity", 0.9)]
    report = Q.report(checks)
    tree = plan(report).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    rows = {r.check_name: r.violations for r in report.collect()}
    assert rows["a"] == 0 and rows["d"] == 0 and rows["e"] == 0
    assert rows["b"] == Q.between(li, "l_quantity", 1, 40).count()
    assert rows["c"] == Q.accepted_values(li, "l_returnflag", ["R"]).count()
    empty = {r.check_name: r.passed for r in Q.report(
        [Q.scan_row_count("d", li.limit(0), 1), Q.scan_coverage("e", li.limit(0), "l_quantity")]).collect()}
    assert empty == {"d": False, "e": True}


def test_eval_mart_aggregates_before_the_industry_join(spark):
    tree = plan(E.queries()["eval_mart"](spark, SF)).split("\n\n")[0].split("\n")
    join = next(i for i, ln in enumerate(tree) if "Join" in ln)
    below = [ln for ln in tree[join:] if "HashAggregate" in ln]
    assert any("HashAggregate" in ln for ln in tree[:join]) and below


def test_no_text_below_the_cache_anti_join(spark):
    """Misses are found on ids and hashes; the text is fetched afterwards."""
    from pyspark.sql import functions as F

    from casegrid.operators.enrich import empty_enrichment, enrich
    from casegrid.plans.documents import prior_cache, staged_documents
    from datetime import datetime
    staged = staged_documents(spark, SF)
    plans = []

    def classify(requests):
        plans.append(plan(requests))
        return requests.withColumn("reply", F.lit(None).cast("string"))

    enrich(staged, prior_cache(spark, staged), empty_enrichment(spark), classify, datetime(2025, 1, 1), "m")
    tree = plans[0].split("\n\n")[0]
    assert "LeftAnti" not in tree  # the misses come from a stored narrow table
    assert any("content_hash:string,rep_id:string" in ln for ln in plans[0].split("\n") if "ReadSchema" in ln)


def test_stored_fact_is_pruned_to_the_years_of_the_dates(spark, tmp_dir):
    """The years come from the date dimension at run time; other years' files are not read."""
    from casegrid.plans.catalogue import year_rollup
    from casegrid.sources.versions import read_table, replace_table
    fact = spark.range(0, 8000, 1, 4).select(
        (F.col("id") % 20 + 2000).cast("int").alias("incident_year"), F.col("id").alias("days_away_from_work"),
        (F.col("id") % 3 == 0).alias("is_death"))
    replace_table(fact, f"{tmp_dir}/fact", ["incident_year"])
    dates = spark.createDataFrame([(2000 + k, k % 12 + 1) for k in range(20)] * 3, "year int, month int")
    replace_table(dates, f"{tmp_dir}/dates")
    out = year_rollup(read_table(spark, f"{tmp_dir}/fact"), read_table(spark, f"{tmp_dir}/dates").where("month = 5"))
    assert sorted((r["year"], r["incidents"]) for r in out.collect()) == [(2004, 400), (2016, 400)]
    tree = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in tree
    scans = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node)
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        for name in ("executedPlan", "plan"):  # adaptive plans and their stages hold the plan as a field
            if any(x in node.nodeName() for x in ("AdaptiveSparkPlan", "QueryStage")) and hasattr(node, name):
                try:
                    walk(getattr(node, name)())
                except Exception:  # noqa: BLE001 - not a field of this node
                    pass

    walk(out._jdf.queryExecution().executedPlan())
    read = [s.metrics().apply("numPartitions").value() for s in scans if s.metrics().contains("numPartitions")]
    assert read and read[0] == 2
