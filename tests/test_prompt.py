from pyspark.sql import functions as F

from casegrid.functions.prompt import NARRATIVE_FIELDS, NARRATIVE_LABELS, render_prompt


def prompt(spark, values, sector):
    cols = ", ".join(f"{f} string" for f in NARRATIVE_FIELDS) + ", sector string"
    row = tuple(values.get(f) for f in NARRATIVE_FIELDS) + (sector,)
    return spark.createDataFrame([row], cols).select(render_prompt(NARRATIVE_FIELDS, F.col("sector"))).first()[0]


def test_prompt_contains_fields_and_industry(spark):
    p = prompt(spark, {"narrative_event": "slipped on ice"}, "Warehousing")
    assert p.startswith("Industry: Warehousing\n\nIncident narrative:\n")
    assert "- What happened: slipped on ice" in p


def test_prompt_defaults(spark):
    p = prompt(spark, {"narrative_location": ""}, None)
    assert "Industry: unknown" in p
    for f in NARRATIVE_FIELDS:
        assert f"- {NARRATIVE_LABELS[f]}: (not provided)" in p
    assert p.endswith("every field populated.")


def test_prompt_line_order(spark):
    lines = prompt(spark, {}, "X").split("\n")
    assert [ln.split(":")[0] for ln in lines[3:9]] == [f"- {NARRATIVE_LABELS[f]}" for f in NARRATIVE_FIELDS]
