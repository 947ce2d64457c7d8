"""Streaming jobs: the same rows as in batch, over several micro-batches and restarts."""

import json
import os

import pytest
from conftest import SF_DIR, log
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.functions.jsonutil import CORRUPT
from sparkmart.operators import logs, stats, visitors
from sparkmart.plans import queries
from sparkmart.plans.fixtures import AS_OF, Fixtures
from sparkmart.sources.topics import literal_topic
from sparkmart.streaming import jobs

FAR = 4_102_444_800_000  # far after all data; rows there move the watermark and are then ignored
DAY = 86_400_000


@pytest.fixture
def wh(spark, folder):
    return jobs.Warehouse(spark, folder, trigger={"availableNow": True}, salts=2)


def put(wh, topic, df, batch_id):
    producer = wh.topics.producers.get(topic, topic)
    wh.topics.publish(df.select(F.lit(topic).alias("topic"), "value"), producer, batch_id)


def put_text(wh, topic, messages, batch_id):
    put(wh, topic, literal_topic(wh.spark, messages), batch_id)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def same(got, want):
    got = got.select(*want.columns)
    missing, extra = want.exceptAll(got), got.exceptAll(want)
    assert (missing.take(3), extra.take(3)) == ([], [])


def bounce_ids(wh):
    return sorted(r.event_id for r in logs.decode_logs(wh.topics.read(wh.spark, jobs.USER_JUMP)).collect())


def test_log_chain_equals_batch(spark, wh):
    fx = Fixtures(spark, SF_DIR)
    raw = logs.encode_logs(fx.logs(), "ts")
    middle = 1_705_276_800_000  # half of the month
    rounds = [raw.where(F.col("ts") < middle), raw.where(F.col("ts") >= middle)]
    # The first late row bounces once the second is there, which flushes every branch.
    rounds.append(literal_topic(spark, [log("end", FAR, event_id=-1), log("end2", FAR + DAY, event_id=-2), "{broken"]))
    for i, rows in enumerate(rounds):
        put(wh, jobs.RAW_LOG, rows, i)
        run(jobs.base_log(wh))
        run(jobs.unique_visitor(wh))
        run(jobs.user_jump(wh, queries.BOUNCE_SECONDS))
        run(jobs.visitor_stats(wh, queries.EVENT_WINDOW))
    # A restart without new data adds nothing.
    run(jobs.base_log(wh))
    run(jobs.visitor_stats(wh, queries.EVENT_WINDOW))

    def events(topic):
        rows = logs.decode_logs(wh.topics.read(spark, topic)).where(F.col("event_id") >= 0)
        return rows.select("event_id", "common.mid", "common.is_new")

    batch = queries.QUERIES
    split = batch["log_split"](spark, SF_DIR).where(F.col("topic") == logs.PAGE_TOPIC)
    same(events(logs.PAGE_TOPIC).drop("mid"), split.select("event_id", "is_new"))
    assert wh.topics.read(spark, logs.DISPLAY_TOPIC).count() == batch["display_explode"](spark, SF_DIR).count()
    same(events(jobs.UNIQUE_VISIT), batch["unique_visitors"](spark, SF_DIR).select("event_id", "mid", "is_new"))
    same(events(jobs.USER_JUMP), batch["user_bounce"](spark, SF_DIR).select("event_id", "mid"))
    written = spark.read.parquet(f"{wh.root}/stats/visitor_stats")
    same(written.where(F.col("stt") < "2030"), batch["visitor_stats"](spark, SF_DIR))
    bad = spark.read.parquet(f"{wh.root}/corrupt/base_log")
    assert [r["_corrupt_record"] for r in bad.collect()] == ["{broken"]


def change(table, data, kind="insert"):
    """Change record text about one row, given as a struct column."""
    fields = [F.lit("d").alias("database"), F.lit(table).alias("table"), F.lit(kind).alias("type")]
    return F.to_json(F.struct(*fields, data.alias("data"), F.lit(1).alias("ts"))).alias("value")


def rule_text(table, sink_type, sink_table, columns, kind="insert"):
    data = dict(zip(schemas.RULE_FIELDS.values(), [table, kind, sink_type, sink_table, ",".join(columns), "id", None]))
    return json.dumps({"op": "r", "source": {"db": "d", "table": "table_process"}, "after": data, "ts_ms": 1})


def test_database_chain_equals_batch(spark, wh):
    fx = Fixtures(spark, SF_DIR)
    text = F.date_format("create_ts", "yyyy-MM-dd HH:mm:ss").alias("create_time")
    facts = {
        "order_info": (jobs.ORDER_INFO, fx.orders().drop("create_ts")),
        "order_detail": (jobs.ORDER_DETAIL, fx.details().drop("create_ts")),
        "payment_info": (jobs.PAYMENT_INFO, fx.payments().drop("callback_ts")),
        "favor_info": (jobs.FAVOR_INFO, fx.favors().select("sku_id", text)),
        "cart_info": (jobs.CART_INFO, fx.carts().select("sku_id", text)),
        "order_refund_info": (jobs.REFUND_INFO, fx.refunds().select("sku_id", "order_id", "refund_amount", text)),
        "comment_info": (jobs.COMMENT_INFO, fx.comments().select("sku_id", "appraise", text)),
    }
    dims = fx.dimensions()._asdict()
    rules = [rule_text(t, "kafka", topic, df.columns) for t, (topic, df) in facts.items()]
    rules += [rule_text(n, "hbase", jobs.DIM_TABLES[n], df.columns) for n, df in dims.items()]
    put_text(wh, "ods_rules", rules, 0)

    changes = [df.select(change(t, F.struct("*"))) for t, (_, df) in facts.items()]
    changes += [df.select(change(n, F.struct("*"))) for n, df in dims.items()]
    changes.append(spark.range(1).select(change("unruled", F.struct(F.lit(1).alias("id")))))
    union = changes[0]
    for frame in changes[1:]:
        union = union.unionByName(frame)
    put(wh, jobs.RAW_DB, union, 0)
    put(wh, logs.PAGE_TOPIC, logs.encode_logs(logs.page_logs(fx.logs())), 0)

    # Rows of every stream far after the data close all windows.
    late = {"create_time": "2100-01-01 00:00:00", "callback_time": "2100-01-01 00:00:00", "sku_id": -1, "order_id": -1, "id": -1}
    closing = [{"database": "d", "table": t, "type": "insert", "data": late, "ts": 2} for t in facts]

    def rounds(batch_id):
        run(jobs.base_db(wh, jobs.rules_from_topic(wh, "ods_rules")))
        run(jobs.order_wide(wh, -queries.ORDER_DETAIL_SECONDS, queries.ORDER_DETAIL_SECONDS, F.lit(AS_OF).cast("timestamp")))
        run(jobs.payment_wide(wh))
        run(jobs.product_stats(wh, queries.ORDER_WINDOW))

    rounds(0)
    put_text(wh, jobs.RAW_DB, [json.dumps(c) for c in closing], 1)
    put_text(wh, logs.PAGE_TOPIC, [log("end", FAR, "good_detail", item="-1")], 1)
    rounds(1)

    def written(topic, schema, time="create_time"):
        from sparkmart.operators.wide import parse_facts

        rows = parse_facts(wh.topics.read(spark, topic), schema, time).where("order_id >= 0").select(*schema.names)
        return queries.comparable(rows)

    batch = queries.QUERIES
    same(written(jobs.ORDER_WIDE, schemas.ORDER_WIDE), batch["order_wide"](spark, SF_DIR))
    same(written(jobs.PAYMENT_WIDE, schemas.PAYMENT_WIDE, "callback_time"), batch["payment_wide"](spark, SF_DIR))
    stored = queries.comparable(spark.read.parquet(f"{wh.root}/stats/product_stats"))
    same(stored.where("sku_id >= 0"), batch["product_stats_wide"](spark, SF_DIR))
    rejected = spark.read.parquet(f"{wh.root}/rejected/base_db").collect()
    assert [(r.table, r.reason) for r in rejected] == [("unruled", "no rule")]


def test_bounce_times_out_with_the_watermark(wh):
    put_text(wh, logs.PAGE_TOPIC, [log("101", 10000, event_id=1), log("102", 12000, event_id=2)], 0)
    run(jobs.user_jump(wh))
    assert bounce_ids(wh) == []
    follow = [log("102", 15000, "list", "home", event_id=3), log("102", 30000, "list", "detail", event_id=4)]
    put_text(wh, logs.PAGE_TOPIC, follow, 1)
    run(jobs.user_jump(wh))
    assert bounce_ids(wh) == []  # the watermark is at 27 s, the window of 101 ends at 30 s
    put_text(wh, logs.PAGE_TOPIC, [log("103", 33000, "list", "home", event_id=5)], 2)
    run(jobs.user_jump(wh))
    assert bounce_ids(wh) == [1]


def test_rows_out_of_order_within_the_watermark(wh):
    put_text(wh, logs.PAGE_TOPIC, [log("a", 12_000, "list", "home", event_id=2)], 0)
    run(jobs.user_jump(wh))
    put_text(wh, logs.PAGE_TOPIC, [log("a", 10_500, event_id=1), log("z", 60_000, "list", "home", event_id=3)], 1)
    run(jobs.user_jump(wh))
    assert bounce_ids(wh) == []


def test_late_rows_are_dropped(spark, wh):
    def write(batch, batch_id):
        wh.stats.write(batch, "counts", ["stt", "edt", "n", "ts"], batch_id)

    def count():
        rows = wh.logs(logs.PAGE_TOPIC, "count").withWatermark("event_time", wh.watermark)
        run(wh.start("count", stats.tumbling(rows, [], [F.count(F.lit(1)).alias("n")]), write))

    for i, times in enumerate([[1_000, 9_000, 12_999], [8_000], [13_000], [9_999, 40_000], [80_000]]):
        put_text(wh, logs.PAGE_TOPIC, [log("a", t, event_id=i) for t in times], i)
        count()
    counts = {r.stt[-2:]: r.n for r in spark.read.parquet(f"{wh.root}/stats/counts").collect()}
    # 8.000 came while the watermark was at 9.999, so its window was still open; 9.999 came too late.
    assert counts == {"00": 3, "10": 2, "40": 1}


def test_repair_remembers_visitors_across_batches(spark, wh):
    for i, ts in enumerate([5, 10, DAY]):
        put_text(wh, jobs.RAW_LOG, [log("a", ts, event_id=i, is_new="1"), log(f"b{i}", ts, event_id=10 + i, is_new="1")], i)
        run(jobs.base_log(wh))
        if i == 1:
            assert jobs.first_visits_table(wh).compact()
    assert jobs.first_visits_table(wh).read().count() == 4
    rows = logs.decode_logs(wh.topics.read(spark, logs.PAGE_TOPIC)).collect()
    flags = {r.event_id: r.common.is_new for r in rows}
    assert flags == {0: "1", 1: "1", 2: "0", 10: "1", 11: "1", 12: "1"}


def test_a_new_checkpoint_publishes_after_the_old_one(spark, wh):
    class Fresh(jobs.Warehouse):
        def checkpoint(self, job):
            return f"{self.root}/other_checkpoints/{job}"

    def pages():
        return sorted(r.event_id for r in logs.decode_logs(wh.topics.read(spark, logs.PAGE_TOPIC)).collect())

    put_text(wh, jobs.RAW_LOG, [log("a", 5, event_id=1)], 0)
    run(jobs.base_log(wh))
    put_text(wh, jobs.RAW_LOG, [log("a", 6, event_id=2)], 1)
    fresh = Fresh(spark, wh.root, trigger={"availableNow": True}, salts=2)
    run(jobs.base_log(fresh))
    assert pages() == [1, 1, 2]  # it has read the topic from its beginning, and lost nothing
    run(jobs.base_log(fresh))
    run(jobs.base_log(wh))
    assert pages().count(1) == 2 and fresh.first_batch(jobs.LOG_JOB) == 2 * jobs.BATCHES_PER_EPOCH


def test_a_batch_run_again_changes_nothing(spark, wh, logs_of):
    batch = logs_of(log("a", 5, event_id=1, is_new="1"))
    later = logs_of(log("a", DAY, event_id=2, is_new="1"))
    for _ in range(2):
        assert [r.common.is_new for r in jobs.repair_batch(wh, batch, 0).collect()] == ["1"]
    for _ in range(2):
        assert [r.common.is_new for r in jobs.repair_batch(wh, later, 1).collect()] == ["0"]


def test_unique_visitor_is_emitted_at_once_and_once(spark, wh):
    def ids():
        rows = logs.decode_logs(wh.topics.read(spark, jobs.UNIQUE_VISIT)).collect()
        return sorted(r.event_id for r in rows)

    t = 19_000 * DAY
    first = [log("a", t + 20, event_id=1), log("a", t + 10, event_id=2), log("a", t + 5, "x", "home", event_id=3)]
    put_text(wh, logs.PAGE_TOPIC, first, 0)
    run(jobs.unique_visitor(wh))
    assert ids() == [2]
    more = [log("a", t + 7, event_id=4), log("b", t + 7, event_id=5), log("a", t + DAY, event_id=6)]
    put_text(wh, logs.PAGE_TOPIC, more, 1)
    run(jobs.unique_visitor(wh))
    assert ids() == [2, 5, 6]


def test_rule_changes_take_effect_before_the_next_batch(spark, wh):
    rules = jobs.rules_from_topic(wh, "ods_rules")
    put_text(wh, "ods_rules", [rule_text("t", "kafka", "old", ["id"])], 0)
    put_text(wh, jobs.RAW_DB, [json.dumps({"table": "t", "type": "insert", "data": {"id": 1}}), "{broken"], 0)
    run(jobs.base_db(wh, rules))
    newer = json.loads(rule_text("t", "kafka", jobs.CART_INFO, ["id", "n"])) | {"op": "u", "ts_ms": 2}
    put_text(wh, "ods_rules", [json.dumps(newer)], 1)
    put_text(wh, jobs.RAW_DB, [json.dumps({"table": "t", "type": "insert", "data": {"id": 2, "n": 3}})], 1)
    run(jobs.base_db(wh, rules))
    stored = spark.read.parquet(f"{wh.root}/topics/base_db")
    assert sorted((r.topic, r.value) for r in stored.collect()) == [(jobs.CART_INFO, '{"id":2,"n":3}'), ("old", '{"id":1}')]
    assert [r[0] for r in spark.read.parquet(f"{wh.root}/corrupt/base_db").select(CORRUPT).collect()] == ["{broken"]


def test_captured_table(spark, wh):
    from sparkmart.sinks.dims import DimTables

    def envelope(op, id, name, ts, before=False):
        row = {"id": id, "name": name}
        images = {"before": row} if op == "d" else {"after": row}
        return json.dumps({"op": op, "source": {"db": "d", "table": "student"}, "ts_ms": ts, **images})

    put_text(wh, "ods_students", [envelope("r", 1, "a", 0), envelope("r", 2, "b", 0), "{broken"], 0)
    run(jobs.capture_table(wh, "ods_students", "student"))
    put_text(wh, "ods_students", [envelope("u", 1, "c", 5), envelope("d", 2, "b", 6), envelope("c", 3, "d", 7)], 1)
    run(jobs.capture_table(wh, "ods_students", "student"))
    table = DimTables(spark, f"{wh.root}/captured/student")
    rows = table.read("student", columns=["id", "name"], apply_deletes=True)
    assert sorted(map(tuple, rows.collect())) == [("1", "c"), ("3", "d")]
    assert [r[0] for r in spark.read.parquet(f"{wh.root}/corrupt/capture_student").select(CORRUPT).collect()] == ["{broken"]


def test_raw_logs_are_collected_and_land_by_day(spark, wh):
    os.makedirs(f"{wh.root}/files")
    with open(f"{wh.root}/files/app.log", "w") as f:
        f.write("\n".join([log("a", 5), log("a", DAY), "{broken"]))
    run(jobs.collect_logs(wh, f"{wh.root}/files"))
    run(jobs.land_raw_logs(wh, f"{wh.root}/landed"))
    landed = spark.read.text(f"{wh.root}/landed")
    assert landed.count() == 3
    assert {"1970-01-01", "1970-01-02"} < {str(r.day) for r in landed.select("day").collect()}
    assert not os.path.exists(f"{wh.root}/landed/value")
