from pyspark.sql import functions as F

from casegrid.operators.joins import balanced_join, hot_keys, key_counts, salted_join
from casegrid.operators.staging import hot_establishments, join_establishment, stage_cases, stage_establishments


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_salted_join_equals_plain_join_with_a_hot_key(spark):
    # one key holds a third of all rows, one key is absent from the small side
    big = spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(49).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(key_counts(big, ["k"]), "k", partitions=20)
    assert hot == {7: 8, None: 2}
    for how in ("left", "inner", "left_anti"):
        cols = ["row_id", "k"] + ["v"] * (how != "left_anti")
        plain = rows(big.join(small, "k", how), *cols)
        assert rows(salted_join(big, small, "k", hot, F.col("row_id"), how), *cols) == plain
        assert rows(balanced_join(big, small, "k", F.col("row_id"), how), *cols) == plain


def test_salts_follow_the_share(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    # every key holds a tenth: hot where a partition holds less than that
    assert hot_keys(key_counts(df, ["k"]), "k", partitions=10) == {}
    assert hot_keys(key_counts(df, ["k"]), "k", partitions=40) == dict.fromkeys(range(10), 4)
    assert hot_keys(key_counts(df, ["k"]), "k", partitions=1) == {}
    assert hot_keys(key_counts(df.limit(0), ["k"]), "k", partitions=40) == {}


def test_missing_establishment_is_split(spark):
    """Half of the ids are null: that key is hot, and no partition of the join
    holds more than its share."""
    from tests.test_warehouse import raw_fixture
    raw = raw_fixture(spark).crossJoin(spark.range(200).withColumnRenamed("id", "copy"))
    raw = raw.withColumn("id", F.concat("id", F.col("copy").cast("string"))).withColumn(
        "establishment_id", F.when(F.col("copy") % 2 == 0, F.lit(None)).otherwise(
            F.concat("establishment_id", F.lit("-"), F.col("copy").cast("string")))).drop("copy")
    cases, est = stage_cases(raw), stage_establishments(raw)
    hot = hot_establishments(cases, partitions=16)
    missing = cases.where("establishment_name is not null").join(est, "establishment_id", "left_anti").select(
        "establishment_id").distinct().collect()
    assert [r[0] for r in missing] == list(hot) and list(hot.values()) == [8]
    plain, salted = join_establishment(cases, est), join_establishment(cases, est, hot)
    assert rows(plain, *plain.columns) == rows(salted, *plain.columns)
    before = dict(spark.sparkContext.getConf().getAll()).get("spark.sql.autoBroadcastJoinThreshold", "10m")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["n"] for r in join_establishment(cases, est, hot).groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(sizes) < 0.35 * sum(sizes)
