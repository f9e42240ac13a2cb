"""Raw-text case exports rendered from the driver's tables.

No incident data ships with the test tables, so the case export is rendered
from them: an order is a case, its customer the establishment, the nation the
city, and a document (by id) the free-text narrative.  All 44 columns are
text, dates are SAS-style, and the rendering deliberately carries the edge
cases the typing rules exist for (padding, blanks, one-digit days, decimal
counts, leading zeros, null and out-of-range codes, rows with no narrative).
The same rendering is written in SQL for the oracle (``plans/oracle.py``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.lookup import CENSUS_REGIONS
from casegrid.functions.parse import render_sas_date, render_sas_timestamp

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Fixed values of the rendering: state codes in census-map order, the event
# sentences that open each "what happened" narrative, and the run constants.
STATE_CODES: tuple[str, ...] = tuple(CENSUS_REGIONS)
EVENT_SENTENCES: tuple[str, ...] = (
    "A picker slipped near the dock and was bruised",
    "A pallet hit the foot of a loader, who had a fracture",
    "The glove of an operator was caught by the saw, a finger was amputated",
    "A clerk twisted an ankle while carrying files",
    "Cleaning fumes made two people dizzy",
    "A truck rolled back against the gate",
    "Rags ignited beside the kiln and an arm was burned",
    "A visitor attacked the guard, who needed surgery",
    "The shift ended without further notes",
)
RUN_TS = "2025-01-15 08:00:00"
MODEL_NAME = "keyword-rules"
FRESHNESS_AS_OF = "2025-06-30"


def _s(c) -> Column:
    return c.cast("string")


def raw_cases(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """The export.  ``texts=False`` leaves the documents out, for models that
    read no narrative and to which a row that repeats makes no difference."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    src = (o.join(c, o.o_custkey == c.c_custkey, "left")
           .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    src = (src.join(d, o.o_orderkey == d.doc_id, "left") if texts
           else src.withColumn("text", F.lit(None).cast("string")))
    status, prio, key, cust = (F.col("o_orderstatus"), F.col("o_orderpriority"),
                               F.col("o_orderkey"), F.col("o_custkey"))
    ck = F.col("c_custkey")
    sas_day = render_sas_date(F.col("o_orderdate"))
    state = F.try_element_at(F.array(*[F.lit(s) for s in STATE_CODES]), (F.pmod(ck, F.lit(53)) + 1).cast("int"))
    created = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.pmod(key * 37, F.lit(86400)).cast("decimal(18,6)"))
    event_code = F.lpad(_s(F.pmod(key * 13, F.lit(8000))), 4, "0")
    sentence = F.try_element_at(F.array(*[F.lit(s) for s in EVENT_SENTENCES]),
                                (F.pmod(key, F.lit(len(EVENT_SENTENCES))) + 1).cast("int"))
    cols = {
        "id": _s(key),
        "establishment_id": _s(cust),
        "establishment_name": F.col("c_name"),
        "ein": F.lpad(_s(cust), 9, "0"),
        "company_name": F.concat(F.col("c_name"), F.lit(" Co")),
        "street_address": F.concat(_s(F.pmod(cust, F.lit(1000))), F.lit(" Main St")),
        "city": F.col("n_name"),
        "state": F.when(F.pmod(ck, F.lit(5)) == 0, F.lower(state)).otherwise(state),
        "zip_code": F.lpad(_s(F.col("c_nationkey")), 5, "0"),
        "naics_code": F.concat(_s(F.pmod(ck * 7, F.lit(89)) + 11), F.lpad(_s(F.pmod(ck, F.lit(10000))), 4, "0")),
        "naics_year": F.lit("2022"),
        "industry_description": F.col("c_mktsegment"),
        "establishment_type": _s(F.pmod(ck, F.lit(4))),
        "size": _s(F.pmod(ck, F.lit(3)) + 1),
        "annual_average_employees": _s(F.col("c_acctbal").cast("decimal(12,2)")),
        "total_hours_worked": _s(F.col("o_totalprice").cast("decimal(14,2)")),
        "case_number": F.concat(F.lit("C-"), _s(key)),
        "job_description": prio,
        "soc_code": F.substring(prio, 1, 1),
        "soc_description": F.expr("substring(o_orderpriority, 3)"),
        "date_of_incident": F.when(status == "P", F.regexp_replace(sas_day, "^0", "")).otherwise(sas_day),
        "date_of_death": F.when((status == "F") & (prio == "1-URGENT"), sas_day),
        "created_timestamp": F.when(prio != "5-LOW", render_sas_timestamp(created)),
        "year_of_filing": _s(F.year("o_orderdate")),
        "incident_outcome": (F.when(prio == "1-URGENT", F.lit("4"))
                             .when(status == "F", F.lit("1"))
                             .when(status == "O", F.lit(" 2 "))
                             .when(prio == "2-HIGH", F.lit("9"))
                             .otherwise(F.lit("3"))),
        "type_of_incident": _s(F.pmod(key, F.lit(5)) + 1),
        "dafw_num_away": F.when(status != "P", F.concat(_s(F.pmod(key, F.lit(400))), F.lit("."),
                                                        _s(F.pmod(cust, F.lit(10))))),
        "djtr_num_tr": _s(F.pmod(key, F.lit(30))),
        "new_incident_location": F.when(status != "P", F.concat(F.lit("  "), F.col("n_name"), F.lit(" yard "))),
        "new_incident_description": F.when(prio.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("Order "), prio)),
        "new_nar_before_incident": F.when(status == "F", F.lower(F.col("c_mktsegment"))),
        "new_nar_what_happened": F.when(
            (status != "P") | prio.isin("1-URGENT", "2-HIGH") | F.col("text").isNotNull(),
            F.concat(sentence, F.coalesce(F.concat(F.lit(" "), F.col("text")), F.lit("")))),
        "new_nar_injury_illness": F.when(status == "O", F.lit("   ")).when(status == "F", F.lit("Bruised left hand")),
        "new_nar_object_substance": F.lit(None).cast("string"),
        "nature_code_pred": _s(F.pmod(cust, F.lit(50)) + 100),
        "nature_title_pred": F.concat(F.lit("Nature "), _s(F.pmod(cust, F.lit(50)) + 100)),
        "part_code_pred": _s(F.col("c_nationkey")),
        "part_title_pred": F.col("n_name"),
        "event_code_pred": F.when(prio != "3-MEDIUM", event_code),
        "event_title_pred": F.when(prio != "3-MEDIUM", F.concat(F.lit("Event "), F.substring(event_code, 1, 2))),
        "source_code_pred": _s(F.pmod(key, F.lit(7))),
        "source_title_pred": F.concat(F.lit("Source "), _s(F.pmod(key, F.lit(7)))),
        "sec_source_code_pred": F.when(F.pmod(key, F.lit(2)) == 1, F.lit("9")),
        "sec_source_title_pred": F.when(F.pmod(key, F.lit(2)) == 1, F.lit("Secondary 9")),
    }
    return src.select(*[v.alias(k) for k, v in cols.items()])
