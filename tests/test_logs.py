import json

from conftest import log
from pyspark.sql import functions as F

from sparkmart.functions.jsonutil import CORRUPT
from sparkmart.operators import logs
from sparkmart.sources.topics import literal_topic

DAY = 86_400_000


def flags(df):
    return [r.is_new for r in logs.repair_new_visitors(df).orderBy("event_id").select("common.is_new").collect()]


def test_flag_is_kept_on_the_first_day_only(logs_of):
    rows = [log("a", 0, is_new="1", event_id=1), log("a", 10, is_new="1", event_id=2)]
    rows += [log("a", DAY, is_new="1", event_id=3), log("a", DAY, is_new="0", event_id=4)]
    assert flags(logs_of(*rows)) == ["1", "1", "0", "0"]


def test_other_flags_fix_no_day(logs_of):
    rows = [log("a", 0, is_new="0", event_id=1), log("a", DAY, is_new="1", event_id=2), log("a", DAY + 5, is_new="1", event_id=3)]
    assert flags(logs_of(*rows)) == ["0", "1", "1"]


def test_either_spelling_of_the_flag(spark):
    text = ['{"common":{"mid":"a","isNew":"1"},"ts":1}', '{"common":{"mid":"a","is_new":"0"},"ts":2}']
    rows = logs.decode_logs(literal_topic(spark, text)).orderBy("ts").select("common.is_new").collect()
    assert [r.is_new for r in rows] == ["1", "0"]


def test_log_without_id_gets_a_stable_one(spark):
    raw = literal_topic(spark, [log("a", 1), log("a", 1), log("b", 1)])
    ids = [r.event_id for r in logs.decode_logs(raw).select("event_id").collect()]
    assert None not in ids and len(set(ids)) == 2


def test_broken_text_is_kept(spark):
    rows = logs.decode_logs(literal_topic(spark, ["{no json", log("a", 1)]))
    assert [r[CORRUPT] for r in rows.where(F.col(CORRUPT).isNotNull()).collect()] == ["{no json"]


def test_split(logs_of):
    shown = [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "promotion"}]
    df = logs_of(
        log("a", 1, event_id=1, displays=shown, start={"entry": "icon"}),
        log("a", 2, event_id=2, displays=shown, start={}),
        log("a", 3, event_id=3, displays=[]),
    )
    split = logs.split_logs(df)
    assert [r.event_id for r in split.start.collect()] == [1]
    assert [r.event_id for r in split.page.orderBy("event_id").collect()] == [2, 3]
    assert sorted((r.item, r.page_id, r.ts) for r in split.display.collect()) == [("1", "home", 2), ("2", "home", 2)]

    outputs = [(r.topic, json.loads(r.value)) for r in logs.log_outputs(df).collect()]
    topics = sorted(t for t, _ in outputs)
    assert topics == [logs.DISPLAY_TOPIC] * 2 + [logs.PAGE_TOPIC] * 2 + [logs.START_TOPIC]
    display = [v for t, v in outputs if t == logs.DISPLAY_TOPIC]
    assert {"item": "1", "item_type": "sku_id", "page_id": "home", "ts": 2} in display


def test_missing_displays_and_start(spark, logs_of):
    df = logs_of('{"common":{"mid":"a"},"page":{"page_id":"home"},"ts":1}')
    assert [r.topic for r in logs.log_outputs(df).collect()] == [logs.PAGE_TOPIC]


def test_messages_read_back_as_they_were(logs_of):
    df = logs_of(log("a", 5, event_id=9, is_new="1", displays=[{"item": "1", "item_type": "sku_id"}]))
    again = logs.decode_logs(logs.encode_logs(df)).drop(CORRUPT)
    assert again.drop("start").collect() == df.drop("start").collect()


def test_repair_splits_a_hot_visitor(spark):
    """The join behind the repair is one AQE may split; no window gathers a visitor."""
    df = spark.range(10).select(
        F.struct(F.lit("a").alias("mid"), F.lit("1").alias("is_new")).alias("common"), F.col("id").alias("ts")
    )
    plan = logs.repair_new_visitors(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
