"""Registered queries for sources and sinks: text CSV landing, idempotent
reload, keyed upsert, insert-if-absent and absent-table reads.  Files are
written under the session's shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from casegrid.functions.clean import PANDAS_NULL_TOKENS
from casegrid.operators.enrich import ENRICHMENT_SCHEMA
from casegrid.operators.merge import insert_if_absent, upsert_by_key
from casegrid.plans.analogues import table
from casegrid.plans.catalogue import register
from casegrid.plans.oracle import q
from casegrid.session import scratch_path
from casegrid.sources.tables import read_or_empty, reload_table
from casegrid.sources.versions import read_table
from casegrid.sources.text_csv import read_text_csv, sample_as_csv, write_text_csv

# Characters written as raw bytes 0x80 and 0x81 (latin-1 code points), which
# a cp1252 reader must decode to the euro sign and the replacement character.
_B80, _B81 = "\x80", "\x81"


@register("scan_text_csv", f"""
SELECT cast(p_partkey as varchar) AS part_key,
  p_name || ' "' || p_brand || '"' || chr(10) || 'size ' || cast(p_size as varchar) AS description,
  CASE WHEN p_size % 10 = 0 THEN NULL ELSE cast(cast(p_retailprice as decimal(12,2)) as varchar) || ' €' END AS list_price,
  CASE WHEN p_size % 7 = 0 THEN '{chr(0xFFFD)}' || p_type ELSE p_type END AS part_type,
  lpad(cast(p_size as varchar), 4, '0') AS size_code
FROM part""")
def q_scan_text_csv(spark, sf_dir):
    """Render ``part`` as a messy CSV export (quoted newlines, doubled quotes,
    cp1252 bytes, null tokens, leading zeros, mixed-case headers), land it
    with the text-only reader, and return what was read back."""
    p = table(spark, sf_dir, "part")
    export = p.select(
        F.col("p_partkey").cast("string").alias("Part Key"),
        F.concat(F.col("p_name"), F.lit(' "'), F.col("p_brand"), F.lit('"\nsize '),
                 F.col("p_size").cast("string")).alias("Description"),
        F.when(F.col("p_size") % 10 == 0, F.lit("N/A")).otherwise(
            F.concat(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit(" " + _B80)))
        .alias("List-Price"),
        F.when(F.col("p_size") % 7 == 0, F.concat(F.lit(_B81), F.col("p_type"))).otherwise(F.col("p_type"))
        .alias("PART TYPE"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("Size_Code"),
    )
    path = scratch_path(spark, "csv")
    write_text_csv(export, path, encoding="ISO-8859-1")
    return read_text_csv(spark, path, encoding="cp1252", tokens=PANDAS_NULL_TOKENS)


_RAGGED_EVERY = 50


@register("land_ragged_csv", f"""
SELECT CASE WHEN p_partkey % {_RAGGED_EVERY} <> 0 THEN cast(p_partkey as varchar) END AS part_key,
  CASE WHEN p_partkey % {_RAGGED_EVERY} <> 0 THEN p_name END AS description,
  CASE WHEN p_partkey % {_RAGGED_EVERY} <> 0 THEN lpad(cast(p_size as varchar), 4, '0') END AS size_code,
  CASE WHEN p_partkey % {_RAGGED_EVERY} = 0 THEN p_name || ',' || cast(p_partkey as varchar) || ',' ||
    lpad(cast(p_size as varchar), 4, '0') || ',one too many' END AS malformed_row
FROM part""")
def q_land_ragged_csv(spark, sf_dir):
    """An export in files whose columns stand in different orders, one of them
    with a field too many in each row: no field is misplaced or lost."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Part Key"), F.col("p_name").alias("Description"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("Size_Code"), (F.col("p_partkey") % 4).alias("k"),
        (F.col("p_partkey") % _RAGGED_EVERY == 0).alias("bad"))
    base = scratch_path(spark, "ragged")
    good = p.where(~F.col("bad"))
    write_text_csv(good.where("k < 2").select("Part Key", "Description", "Size_Code"), f"{base}/a", "ISO-8859-1")
    write_text_csv(good.where("k >= 2").select("Size_Code", "Part Key", "Description"), f"{base}/b", "ISO-8859-1")
    line = F.concat_ws(",", "Description", "`Part Key`", "Size_Code", F.lit("one too many"))
    head = spark.range(1).select(F.lit("Description,Part Key,Size_Code").alias("value"), F.lit(0).alias("o"))
    (head.unionByName(p.where("bad").select(line.alias("value"), F.lit(1).alias("o")))
     .repartition(1, F.lit(0)).sortWithinPartitions("o").select("value").write.text(f"{base}/c"))
    return read_text_csv(spark, [f"{base}/a", f"{base}/b", f"{base}/c"], tokens=PANDAS_NULL_TOKENS,
                         malformed="keep")


_SAMPLE_SEED, _SAMPLE_SIZE = 7, 150


@register("sample_as_csv", f"""
SELECT cast(page_id as varchar) AS page_id, url FROM pages WHERE url IS NOT NULL
ORDER BY md5('{_SAMPLE_SEED}-' || cast(page_id as varchar)), page_id LIMIT {_SAMPLE_SIZE}""")
def q_sample_as_csv(spark, sf_dir):
    """A repeatable sample written as a text export and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return sample_as_csv(pages, ["url"], _SAMPLE_SIZE, _SAMPLE_SEED, "page_id", scratch_path(spark, "sample"))


@register("reload_idempotent", "SELECT * FROM customer")
def q_reload_idempotent(spark, sf_dir):
    """Load the same input twice: the table holds it once."""
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "reload")
    first = reload_table(c, path)
    second = reload_table(c, path)
    if first != second:
        raise AssertionError(f"reload counts differ: {first} vs {second}")
    return read_table(spark, path)


_TARGET_SEGMENT_EXCLUDED = "BUILDING"
_UPDATE_SEGMENTS = ("BUILDING", "MACHINERY")


def _target_updates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    target = c.where(F.col("c_mktsegment") != _TARGET_SEGMENT_EXCLUDED)
    updates = c.where(F.col("c_mktsegment").isin(*_UPDATE_SEGMENTS)).withColumn(
        "c_acctbal", F.col("c_acctbal") + F.lit(100.0))
    return target, updates


_upd_sql = ("SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment FROM customer "
            f"WHERE c_mktsegment IN ({', '.join(q(s) for s in _UPDATE_SEGMENTS)})")
_tgt_sql = f"SELECT * FROM customer WHERE c_mktsegment <> '{_TARGET_SEGMENT_EXCLUDED}'"


@register("upsert_by_key", f"""
SELECT * FROM ({_tgt_sql}) t WHERE c_custkey NOT IN (SELECT c_custkey FROM ({_upd_sql}) u)
UNION ALL {_upd_sql}""")
def q_upsert_by_key(spark, sf_dir):
    target, updates = _target_updates(spark, sf_dir)
    return upsert_by_key(target, updates, ["c_custkey"])


@register("insert_if_absent", f"""
{_tgt_sql}
UNION ALL SELECT * FROM ({_upd_sql}) u WHERE c_custkey NOT IN (SELECT c_custkey FROM ({_tgt_sql}) t)""")
def q_insert_if_absent(spark, sf_dir):
    target, updates = _target_updates(spark, sf_dir)
    return insert_if_absent(target, updates, ["c_custkey"])


@register("missing_as_empty", """
SELECT cast(o_orderkey as varchar) AS incident_id, o_orderstatus, cast(NULL as varchar) AS contributing_factor,
  cast(NULL as varchar) AS severity_tier, cast(NULL as varchar) AS event_category,
  cast(NULL as varchar) AS recurrence_prevention, cast(NULL as double) AS confidence,
  cast(NULL as varchar) AS prompt_version, cast(NULL as varchar) AS model_name,
  cast(NULL as timestamp) AS enriched_at
FROM orders""")
def q_missing_as_empty(spark, sf_dir):
    """An enrichment table that was never written reads as empty, so the
    left join still yields every order (first-run behaviour)."""
    absent = read_or_empty(spark, scratch_path(spark, "never-written"), ENRICHMENT_SCHEMA)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("incident_id"),
                                              "o_orderstatus")
    return o.join(absent, "incident_id", "left")
