"""Progress of event time: idle topics hold nobody up, and no row comes late because of it."""

import json

import pytest
from conftest import log
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import logs
from sparkmart.sources import progress
from sparkmart.sources.topics import literal_topic
from sparkmart.streaming import jobs

T0 = 19_000 * 86_400  # some day, in seconds; state of the first day of all is never kept

RULES = [(t, "insert", "kafka", topic, None, None, None) for t, topic in (
    ("orders", jobs.ORDER_INFO), ("details", jobs.ORDER_DETAIL), ("payments", jobs.PAYMENT_INFO), ("favors", jobs.FAVOR_INFO),
)]


@pytest.fixture
def wh(spark, folder):
    return jobs.Warehouse(spark, folder, trigger={"availableNow": True}, salts=2)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def put(wh, topic, messages, batch_id):
    producer = wh.topics.producers.get(topic, topic)
    wh.topics.publish(literal_topic(wh.spark, messages).select(F.lit(topic).alias("topic"), "value"), producer, batch_id)


def told(wh, topic, start=0):
    """Keys and times (in seconds after ``start``) of the progress in a topic."""
    rows = wh.topics.read(wh.spark, topic, progress=True).collect()
    found = [json.loads(r["value"]) for r in rows if r["value"].startswith('{"_progress"')]
    return sorted((m["_progress"] // 1000 - start, m["ts"] // 1000 - start) for m in found)


def test_messages(spark):
    rows = spark.sql("SELECT timestamp_millis(v) AS t FROM VALUES (1500), (99000), (NULL) AS x(v)")
    got = progress.messages(rows, F.col("t"), ["a", "b"])
    assert sorted(r["topic"] for r in got.collect()) == ["a", "b"]
    message = json.loads(got.first()["value"])
    assert (message["_progress"], message["ts"], message["create_time"]) == (99000, 99000, "1970-01-01 00:01:39")
    assert progress.without(got).isEmpty() and progress.messages(rows.where("t IS NULL"), F.col("t"), ["a"]).isEmpty()
    other = literal_topic(spark, ['{"a":1}', "", '{"x":{"_progress":1}}']).unionByName(spark.createDataFrame([(None,)], "value string"))
    assert progress.without(other).count() == 4
    keys = logs.decode_logs(got).select(progress.key_of_mid(F.col("common.mid")).alias("k"))
    assert {r["k"] for r in keys.collect()} == {99000}
    ids = spark.createDataFrame([(-(2**63) + 5,), (-1,), (7,), (None,)], "id long").select(progress.key_of_id(F.col("id")).alias("k"))
    assert [r["k"] for r in ids.collect()] == [5, None, None, None]


def test_visitor_statistics_do_not_wait_for_bounces(spark, wh):
    """No visitor ever bounces, so the topic of bounces has progress only."""
    def messages(second):
        ts = (T0 + second) * 1000
        return [log("a", ts, event_id=second), log("a", ts + 500, "good_detail", "home", event_id=second + 1)]

    for i, second in enumerate((5, 100, 200)):
        put(wh, jobs.RAW_LOG, messages(second), i)
        for job in (jobs.base_log, jobs.unique_visitor, jobs.user_jump, jobs.visitor_stats):
            run(job(wh))
    assert wh.topics.read(spark, jobs.USER_JUMP).isEmpty()
    # Batches told 5, 100 and 200 s; the watermark of bounces passed the first two.
    assert told(wh, logs.PAGE_TOPIC, T0) == told(wh, jobs.UNIQUE_VISIT, T0) == [(5, 5), (100, 100), (200, 200)]
    assert told(wh, jobs.USER_JUMP, T0) == [(5, -15), (100, 80)]
    stats = spark.read.parquet(f"{wh.root}/stats/visitor_stats").collect()
    assert {r.stt[-8:]: (r.pv_ct, r.uj_ct) for r in stats} == {"00:00:00": (2, 0)}


def test_a_bounce_after_its_progress_is_counted(spark, wh):
    """What a bounce's producer told before does not make it late."""
    for i, seconds in enumerate(([5, 21], [60], [90], [400], [900])):
        put(wh, jobs.RAW_LOG, [log(f"v{s}", (T0 + s) * 1000, event_id=s) for s in seconds], i)
        for job in (jobs.base_log, jobs.unique_visitor, jobs.user_jump, jobs.visitor_stats):
            run(job(wh))
    stats = spark.read.parquet(f"{wh.root}/stats/visitor_stats").groupBy().sum("uj_ct", "uv_ct", "pv_ct").first()
    assert tuple(stats) == (4, 4, 4)  # the last two are still open


def change(table, **data):
    return json.dumps({"database": "d", "table": table, "type": "insert", "data": data, "ts": 1})


def at(second):
    return f"1970-01-01 00:{second // 60:02}:{second % 60:02}"


def test_wide_facts_go_on_while_topics_are_idle(spark, wh):
    rules = spark.createDataFrame(RULES, schemas.RULE)

    def batch(i, *messages):
        put(wh, jobs.RAW_DB, messages, i)
        run(jobs.base_db(wh, lambda: rules))
        run(jobs.order_wide(wh))
        run(jobs.payment_wide(wh))

    batch(0, change("orders", id=1, user_id=1, create_time=at(10)), change("details", id=1, order_id=1, sku_id=7, create_time=at(12)))
    batch(1, change("payments", id=1, order_id=1, callback_time=at(300)))
    batch(2, change("favors", sku_id=7, create_time=at(1000)))
    assert told(wh, jobs.FAVOR_INFO) == told(wh, jobs.PAYMENT_INFO) == [(12, 12), (300, 300), (1000, 1000)]
    # Wide orders trail by the interval and the watermark, wide payments by the watermark once more.
    assert told(wh, jobs.ORDER_WIDE) == [(12, 4), (300, 292), (1000, 992)]
    assert told(wh, jobs.PAYMENT_WIDE) == [(12, 1), (300, 289), (1000, 989)]
    assert wh.topics.read(spark, jobs.ORDER_WIDE).count() == wh.topics.read(spark, jobs.PAYMENT_WIDE).count() == 1


def test_a_batch_without_times_tells_nothing(wh):
    put(wh, jobs.RAW_LOG, ["{broken", json.dumps({"common": {"mid": "a"}})], 0)
    run(jobs.base_log(wh))
    assert told(wh, logs.PAGE_TOPIC) == []
