"""One key with a third of all rows: its work is split, and the result stays whole."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import joins, logs, measures, stats, visitors

ROWS = 60_000
# Sizes at which a local test has partitions worth splitting; nothing is broadcast.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(autouse=True)
def small_sizes(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(name):
    """Key 0 for every third row."""
    return F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias(name)


def final_plan(df):
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def test_interval_join(spark):
    time = F.timestamp_seconds(F.lit(0)).alias("create_ts")
    orders = spark.range(ROWS).select("id", time)
    details = spark.range(ROWS).select(F.col("id").alias("detail"), hot("order_id"), time)
    joined = joins.interval_join(orders, details, "id", "order_id", "create_ts", "create_ts", -5, 5)
    plan, rows = final_plan(joined.select("l.id", "r.detail"))
    assert "skew=true" in plan and len(rows) == ROWS


def test_dimension_join(spark):
    facts = spark.range(ROWS).select(F.col("id").alias("fact"), hot("sku_id"))
    dim = spark.range(ROWS).withColumn("name", F.lit("x"))
    plan, rows = final_plan(joins.dim_join(facts, dim, "sku_id", {"name": "name"}))
    assert "skew=true" in plan and len(rows) == ROWS


@pytest.mark.parametrize("dtype", ["long", "int", "string"])
def test_dimension_grouped_by_its_key(spark, dtype):
    """It is partitioned by the key already, which must not keep AQE from splitting."""
    facts = spark.range(ROWS).select(F.col("id").alias("fact"), hot("sku_id").cast(dtype).alias("sku_id"))
    dim = facts.groupBy(F.col("sku_id").alias("id")).agg(F.min("fact").alias("name"))
    plan, rows = final_plan(joins.dim_join(facts, dim, "sku_id", {"name": "name"}))
    assert "skew=true" in plan and len(rows) == ROWS


def test_missing_keys_are_split_too(spark):
    facts = spark.range(ROWS).select(F.col("id").alias("fact"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("sku_id"))
    dim = spark.range(ROWS).withColumn("name", F.lit("x"))
    plan, rows = final_plan(joins.dim_join(facts, dim, "sku_id", {"name": "name"}))
    assert "skew=true" in plan and len(rows) == ROWS


def page_rows(spark):
    """Page views of a visitor every two seconds, a third of them by one visitor."""
    ms = (F.col("id") * 2000).alias("ts")
    return spark.range(ROWS).select(
        F.struct(hot("mid").cast("string").alias("mid"), F.lit("1").alias("is_new"), F.lit("v").alias("vc"), F.lit("c").alias("ch"), F.lit("a").alias("ar")).alias("common"),
        F.struct(F.lit("home").alias("page_id"), F.lit(None).cast("string").alias("last_page_id"), F.lit(1).alias("during_time")).alias("page"),
        ms,
        F.col("id").alias("event_id"),
        F.timestamp_millis(ms).alias("event_time"),
    )


def test_new_visitor_repair(spark):
    plan, rows = final_plan(logs.repair_new_visitors(page_rows(spark)))
    assert "skew=true" in plan and len(rows) == ROWS


def test_bounces_and_unique_visitors_reach_the_shuffle_reduced(spark):
    """The hot visitor's 20,000 rows leave each task as one row per slice and one per day."""
    pages = page_rows(spark).coalesce(4)
    found = visitors.bounces(pages, 10)
    # It opens a page every 6 s, so only its last one is a bounce; everybody else bounces.
    assert found.where("common.mid = '0'").count() == 1
    assert found.count() == ROWS - ROWS // 3 + 1
    days = 2 * ROWS // 86_400 + 1
    assert visitors.unique_visitors(pages).where("common.mid = '0'").count() == days


def test_distinct_orders_of_a_hot_sku(spark):
    facts = spark.range(ROWS).select(
        hot("sku_id"), F.lit(1).alias("sku_num"), F.lit(1).alias("split_total_amount"),
        (F.col("id") % 1000).alias("order_id"), F.timestamp_seconds(F.lit(0)).alias("create_ts"),
    )
    out = stats.product_stats(measures.ordered(facts))
    row = out.where("sku_id = 0").first()
    assert (row.order_ct, row.order_sku_num) == (1000, ROWS // 3)
    assert out.count() == ROWS - ROWS // 3 + 1
