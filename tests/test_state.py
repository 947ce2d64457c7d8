"""What the streaming state holds, and for how long; whole messages in the topics of visits and bounces."""

import json

import pytest
from conftest import log
from pyspark.sql import functions as F

from sparkmart.operators import logs
from sparkmart.sources.topics import literal_topic
from sparkmart.streaming import jobs

DAY = 86_400_000
T0 = 19_000 * DAY


@pytest.fixture
def wh(spark, folder):
    return jobs.Warehouse(spark, folder, trigger={"availableNow": True}, salts=2)


def put(wh, messages, batch_id):
    rows = literal_topic(wh.spark, messages).select(F.lit(logs.PAGE_TOPIC).alias("topic"), "value")
    wh.topics.publish(rows, jobs.LOG_JOB, batch_id)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def days_in_state(wh):
    state = wh.spark.read.format("statestore").load(wh.checkpoint("unique_visitor"))
    return state, sorted((r[0], r[1].day) for r in state.select("key._mid", "key._day").collect())


def test_visits_leave_the_state_after_two_days(spark, wh):
    put(wh, [log("a", T0 + 5, event_id=1), log("b", T0 + 6, event_id=2)], 0)
    run(jobs.unique_visitor(wh))
    state, held = days_in_state(wh)
    assert [m for m, _ in held] == ["a", "b"]
    # The rows are the text and what orders it, nothing else of the log
    page = state.schema["value"].dataType
    assert "displays" not in page.simpleString() and "raw" in page.simpleString() and "during_time" not in page.simpleString()
    put(wh, [log("a", T0 + DAY, event_id=3)], 1)
    run(jobs.unique_visitor(wh))
    assert [m for m, _ in days_in_state(wh)[1]] == ["a", "a", "b"]
    put(wh, [log("c", T0 + 3 * DAY, event_id=4)], 2)
    run(jobs.unique_visitor(wh))
    assert [m for m, _ in days_in_state(wh)[1]][-1] == "c"
    put(wh, [log("c", T0 + 8 * DAY, event_id=5)], 3)
    run(jobs.unique_visitor(wh))
    assert [m for m, _ in days_in_state(wh)[1]] == ["c"]


def test_visits_and_bounces_are_whole_messages(spark, wh):
    whole = json.loads(log("a", T0 + 5_000, event_id=1, source_type="query")) | {"err": {"code": 7}, "actions": [{"action_id": "x"}]}
    whole["common"]["uid"] = "u1"
    put(wh, [json.dumps(whole)], 0)
    put(wh, [log("z", T0 + 90_000, "list", "home", event_id=2)], 1)
    put(wh, [log("z", T0 + 190_000, "list", "home", event_id=3)], 2)
    run(jobs.unique_visitor(wh))
    run(jobs.user_jump(wh))
    for topic in (jobs.UNIQUE_VISIT, jobs.USER_JUMP):
        assert [json.loads(r.value) for r in wh.topics.read(spark, topic).collect()] == [whole]


def test_unusable_messages_are_kept(spark, wh):
    put(wh, [log("a", T0, event_id=1), "{broken", json.dumps({"common": {"mid": "a"}})], 0)
    run(jobs.keep_unusable(wh, logs.PAGE_TOPIC))
    facts = ['{"sku_id":1,"create_time":"2024-01-01 00:00:00"}', '{"sku_id":1,"create_time":"soon"}', '{"sku_id":1}', "[1]"]
    rows = literal_topic(spark, facts).select(F.lit(jobs.FAVOR_INFO).alias("topic"), "value")
    wh.topics.publish(rows, jobs.DB_JOB, 0)
    run(jobs.keep_unusable(wh, jobs.FAVOR_INFO))

    def kept(topic):
        return sorted((r.value, r.reason) for r in spark.read.parquet(f"{wh.root}/unusable/{topic}").collect())

    assert [r for _, r in kept(logs.PAGE_TOPIC)] == [jobs.NO_TIME, jobs.NO_JSON]
    assert kept(jobs.FAVOR_INFO) == sorted([(facts[1], jobs.NO_TIME), (facts[2], jobs.NO_TIME), (facts[3], jobs.NO_JSON)])
