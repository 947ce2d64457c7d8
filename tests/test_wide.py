import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import joins, wide
from sparkmart.sources.topics import literal_topic


def at(seconds):
    return (datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def facts(spark, schema, *messages, time="create_time"):
    import json

    return wide.parse_facts(literal_topic(spark, [json.dumps(m) for m in messages]), schema, time).drop("_corrupt_record")


def order(id=1, **more):
    return {"id": id, "user_id": 5, "province_id": 3, "total_amount": "10.50", "create_time": at(0), **more}


def detail(id, seconds, order_id=1, **more):
    return {"id": id, "order_id": order_id, "sku_id": 8, "sku_num": 2, "create_time": at(seconds), **more}


@pytest.mark.parametrize("salts", [1, 3])
def test_order_detail_bounds_are_inclusive(spark, salts):
    orders = facts(spark, schemas.ORDER_INFO, order())
    details = facts(spark, schemas.ORDER_DETAIL, *[detail(i, s) for i, s in enumerate([-6, -5, 0, 5, 6])], detail(9, 0, order_id=2))
    out = wide.order_detail_join(orders, details, salts=salts)
    assert sorted(r.detail_id for r in out.collect()) == [1, 2, 3]
    row = out.first()
    assert (row.order_id, float(row.total_amount), row.create_time) == (1, 10.5, at(0))
    assert [row[c] for c in wide.UNFILLED_COLUMNS] == [None] * 4


@pytest.mark.parametrize("salts", [1, 3])
def test_payment_bounds_and_override(spark, salts):
    orders = [{"detail_id": i, "order_id": 1, "user_id": 5, "total_amount": "10", "create_time": at(s)} for i, s in enumerate([-1801, -1800, 0, 1])]
    payment = {"id": 4, "order_id": 1, "total_amount": "11", "create_time": at(-3), "callback_time": at(0)}
    out = wide.payment_wide(
        facts(spark, schemas.PAYMENT_INFO, payment, time="callback_time"), facts(spark, schemas.ORDER_WIDE, *orders), salts=salts
    )
    rows = {r.detail_id: r for r in out.collect()}
    assert sorted(rows) == [1, 2]
    row = rows[1]
    # Columns of both sides come from the payment, also where it has none.
    assert (float(row.total_amount), row.user_id) == (11.0, None)
    assert (row.payment_create_time, row.order_create_time, row.payment_id) == (at(-3), at(-1800), 4)
    assert out.columns == [*schemas.PAYMENT_WIDE.names, "callback_ts"]


def test_dim_join_keeps_misses_and_null_keys(spark):
    df = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id long, sku_id long")
    dim = spark.createDataFrame([(7, "seven")], "id long, name string")
    out = joins.dim_join(df, dim, "sku_id", {"name": F.upper("name")})
    assert sorted(map(tuple, out.collect())) == [(1, 7, "SEVEN"), (2, 8, None), (3, None, None)]


def test_full_sku_equals_joining_one_by_one(spark):
    from sparkmart.plans.fixtures import Fixtures

    from conftest import SF_DIR

    fx = Fixtures(spark, SF_DIR)
    dims = fx.dimensions()
    lines = fx.details().select("id", "sku_id")
    step = wide.with_spu(wide.with_sku(lines, dims.sku), dims.spu)
    step = wide.with_trademark(wide.with_category3(step, dims.category3), dims.trademark)
    at_once = wide.with_full_sku(lines, dims).select(*step.columns)
    assert at_once.exceptAll(step).isEmpty() and step.exceptAll(at_once).isEmpty()


def test_large_dimension_is_not_broadcast(spark):
    """Above the size limit the join shuffles; nothing forces a broadcast."""
    df = spark.range(100).withColumnRenamed("id", "sku_id")
    dim = spark.range(100).withColumn("name", F.lit("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.dim_join(df, dim, "sku_id", {"name": "name"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_merge_partial_rows(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, 5)], "k int, name string, n int")
    b = spark.createDataFrame([(1, "y", 7), (3, "z", 8)], "k int, name string, n int")
    out = joins.merge_partial_rows([a, b], ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "x", 7), (2, None, 5), (3, "z", 8)]


def test_bounded_broadcast(spark):
    assert joins.bounded_broadcast(spark.range(5), 5)[1]
    assert not joins.bounded_broadcast(spark.range(6), 5)[1]
    assert not joins.bounded_broadcast(spark.range(6), 10, max_bytes=20)[1]
    assert joins.bounded_broadcast(spark.range(0), 5)[1]
