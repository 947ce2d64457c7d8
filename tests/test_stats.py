import datetime

from conftest import log
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import measures, stats
from sparkmart.sinks.writers import stats_rows

T0 = datetime.datetime(2024, 1, 1, 12, 0, 1)


def ordered(spark, rows):
    df = spark.createDataFrame(rows, "sku_id long, sku_num long, split_total_amount decimal(16,2), order_id long, create_ts timestamp")
    return measures.ordered(df)


def test_one_row_window_counts_its_order(spark):
    from decimal import Decimal

    out = stats.product_stats(ordered(spark, [(1, 2, Decimal("3.50"), 9, T0)])).first()
    assert (out.stt, out.edt) == ("2024-01-01 12:00:00", "2024-01-01 12:00:10")
    assert (out.order_ct, out.order_sku_num, float(out.order_amount), out.paid_order_ct) == (1, 2, 3.5, 0)


def test_distinct_orders_and_null_amounts(spark):
    rows = [(1, 1, None, 9, T0), (1, 1, None, 9, T0), (1, 1, None, 10, T0), (1, 1, None, None, T0)]
    out = stats.product_stats(ordered(spark, rows)).first()
    assert (out.order_ct, out.order_sku_num, float(out.order_amount)) == (2, 4, 0.0)


def test_visitor_measures(logs_of):
    df = logs_of(
        log("a", 0, during_time=5),
        log("a", 1, "list", "home", during_time=7),
        log("a", 2, "list", ""),
    )
    out = stats.visitor_stats(measures.visitor_union(df, df.limit(1), df.limit(1))).first()
    assert (out.pv_ct, out.sv_ct, out.dur_sum, out.uv_ct, out.uj_ct) == (3, 2, 12, 1, 1)


def test_page_actions_equal_clicks_and_displays(logs_of):
    shown = [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "promotion"}, {"item": "3", "item_type": "sku_id"}]
    df = logs_of(
        log("a", 0, "good_detail", item="7", displays=shown),
        log("a", 1, "good_detail", item="x"),
        log("a", 2, "home", displays=[]),
        '{"common":{"mid":"a"},"page":{"page_id":"home"},"ts":1}',
    )
    both = measures.clicks(df).unionByName(measures.displays(df))
    at_once = measures.page_actions(df)
    assert sorted(map(str, both.collect())) == sorted(map(str, at_once.collect()))
    assert at_once.count() == 4


def test_comments(spark):
    df = spark.createDataFrame([(1, "1201", T0), (1, "1203", T0)], "sku_id long, appraise string, create_ts timestamp")
    out = stats.product_stats(measures.comments(df)).first()
    assert (out.comment_ct, out.good_comment_ct) == (2, 1)


def test_windows_are_aligned_to_the_epoch(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, 0, s),) for s in (0, 9, 10)], "event_time timestamp")
    out = stats.tumbling(df, [], [F.count(F.lit(1)).alias("n")]).orderBy("stt")
    assert [(r.stt[-8:], r.edt[-8:], r.n) for r in out.collect()] == [("00:00:00", "00:00:10", 2), ("00:00:10", "00:00:20", 1)]


def test_sink_columns_by_position(spark):
    from sparkmart.operators.wide import Dimensions

    sku = spark.createDataFrame([], "id long, sku_name string, price decimal(16,2), spu_id long, tm_id long, category3_id long")
    names = spark.createDataFrame([], "id long, spu_name string, name string, tm_name string")
    dims = Dimensions(names, names, sku, names, names, names)
    wide = stats.product_stats_wide(stats.product_stats(ordered(spark, [(1, 2, None, 9, T0)])), dims)
    rows = stats_rows(wide, schemas.PRODUCT_STATS_COLUMNS)
    assert rows.columns == schemas.PRODUCT_STATS_COLUMNS and len(rows.columns) == 25
    assert rows.first().sku_name is None and rows.first().ts > 0


def test_distinct_count_spreads_a_hot_key(spark):
    """The first exchange is keyed by the ids too, the second has one row per task, window and sku."""
    plan = stats.product_stats(ordered(spark, [(1, 2, None, 9, T0)]))._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange hashpartitioning") :].splitlines()[0]
    assert "order_id" in first and "Expand" not in plan
