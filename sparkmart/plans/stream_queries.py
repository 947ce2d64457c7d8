"""Registered queries that replay the benchmark tables through the streaming jobs.

Messages are made from the tables, published to topics in the shared folder, run
through the jobs until the topics are read up, and the published result is read
back.  It must equal the batch query of the same name without ``stream_``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import to_json_text
from sparkmart.operators import logs, measures, visitors, wide
from sparkmart.plans.fixtures import AS_OF, SPREAD_BY, Fixtures
from sparkmart.plans.queries import (
    message_fields,
    BOUNCE_SECONDS,
    EVENT_WINDOW,
    ORDER_DETAIL_SECONDS,
    ORDER_WINDOW,
    comparable,
    query,
)
from sparkmart.session import shared_dir, streaming_session
from sparkmart.sinks.dims import DimTables
from sparkmart.sources.tables import tasks_for
from sparkmart.sources.topics import literal_topic
from sparkmart.streaming import jobs

# Messages far after all data move every watermark past it; they are left out of the results.
FAR = 4_102_444_800_000
DAY = 86_400_000


# Bytes of tables at rest whose messages are replayed as one batch, and which the state of a join therefore holds.
SLICE_BYTES = 64 * 2**20
# Wide facts of a replay are out of order by the interval between order and detail, and that of a payment.
WIDE_LATE_SECONDS = 2 * ORDER_DETAIL_SECONDS + 2 * 3600


def _warehouse(fx: Fixtures, in_slices: bool = False) -> jobs.Warehouse:
    """Its state has as many partitions as a batch asks for: all events, or a slice of all tables, whose state fits the heap."""
    size = SLICE_BYTES if in_slices else fx.bytes_of("events")
    session = streaming_session(fx.spark, tasks_for(fx.spark, size), heap_state=in_slices)
    return jobs.Warehouse(session, f"{shared_dir(fx.spark)}/{uuid.uuid4().hex}", trigger={"availableNow": True})


def _publish(wh: jobs.Warehouse, producer: str, batch_id: int = 0, **messages: DataFrame) -> None:
    """One batch of messages, by topic."""
    named = [df.select(F.lit(topic).alias("topic"), "value") for topic, df in messages.items()]
    union = named[0]
    for frame in named[1:]:
        union = union.unionByName(frame)
    wh.topics.publish(union, producer, batch_id)


def _cuts(fx: Fixtures, *times: DataFrame) -> list[int]:
    """Times, in microseconds, that cut the rows with these times into slices of `SLICE_BYTES`, each after the other."""
    slices = -(-fx.bytes_of(*SPREAD_BY) // SLICE_BYTES)
    if slices < 2:
        return []
    shares = [i / slices for i in range(1, slices)]
    found = _all([df.toDF("at") for df in times]).agg(F.percentile_approx(F.unix_micros("at"), shares)).first()[0]
    return sorted(set(found or []))


def _sliced(rows: DataFrame, value: Column, time: Column, cuts: list[int]) -> DataFrame:
    """value, and in ``batch`` the slice that its time is in."""
    passed = F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.unix_micros(time)) if cuts else None
    place = F.lit(0) if passed is None else F.coalesce(F.size(passed), F.lit(0))
    return rows.select(value.alias("value"), place.cast("long").alias("batch"))


def _json(df: DataFrame, *without: str) -> Column:
    return to_json_text(*[c for c in df.columns if c not in without])


def _stage(wh: jobs.Warehouse, producer: str, **messages: DataFrame) -> None:
    """All slices of messages, by topic; `_replay` lets them appear."""
    wh.topics.stage(_all([df.withColumn("topic", F.lit(topic)) for topic, df in messages.items()]), producer)


def _replay(wh: jobs.Warehouse, cuts: list[int], producers: list[str], *starts: Callable[[], StreamingQuery]) -> None:
    """Slice by slice: publish it, and run the jobs over it."""
    for i in range(len(cuts) + 1):
        for producer in producers:
            wh.topics.publish_staged(wh.spark, producer, i)
        for start in starts:
            _run(start())


def _run(*queries: StreamingQuery) -> None:
    for started in queries:
        started.awaitTermination()


def _closing_logs(wh: jobs.Warehouse) -> DataFrame:
    def message(mid: str, ts: int, event_id: int) -> str:
        page = {"page_id": "end"}
        return json.dumps({"common": {"mid": mid}, "page": page, "displays": [], "ts": ts, "event_id": event_id})

    # The first bounces because of the second, which closes that branch as well.
    return literal_topic(wh.spark, [message("end", FAR, -1), message("end2", FAR + DAY, -2)])


def _page_messages(fx: Fixtures) -> DataFrame:
    return logs.encode_logs(logs.page_logs(logs.repair_new_visitors(fx.logs())))


def _published_logs(fx: Fixtures, wh: jobs.Warehouse, topic: str) -> DataFrame:
    return logs.decode_logs(wh.topics.read(fx.spark, topic)).where(F.col("event_id") >= 0)


@query
def stream_log_split(fx: Fixtures) -> DataFrame:
    """New-visitor repair and the three-way split, as messages of the three topics."""
    wh = _warehouse(fx)
    _publish(wh, jobs.RAW_LOG, **{jobs.RAW_LOG: fx.whole_logs()})
    _run(jobs.base_log(wh))
    topics = (logs.START_TOPIC, logs.PAGE_TOPIC, logs.DISPLAY_TOPIC)
    published = [wh.topics.read(fx.spark, t).withColumn("topic", F.lit(t)) for t in topics]
    return message_fields(published[0].union(published[1]).union(published[2]), "topic")


@query
def stream_unique_visitors(fx: Fixtures) -> DataFrame:
    wh = _warehouse(fx)
    _publish(wh, jobs.LOG_JOB, **{logs.PAGE_TOPIC: _page_messages(fx).unionByName(_closing_logs(wh))})
    _run(jobs.unique_visitor(wh))
    first = _published_logs(fx, wh, jobs.UNIQUE_VISIT)
    return first.select("common.mid", tu.ms_to_day("ts").alias("day"), "event_id", "common.is_new")


@query
def stream_user_bounce(fx: Fixtures) -> DataFrame:
    """Bounces timed out by the watermark."""
    wh = _warehouse(fx)
    _publish(wh, jobs.LOG_JOB, **{logs.PAGE_TOPIC: _page_messages(fx).unionByName(_closing_logs(wh))})
    _run(jobs.user_jump(wh, BOUNCE_SECONDS))
    return _published_logs(fx, wh, jobs.USER_JUMP).select("event_id", "common.mid", "page.page_id", "ts")


@query
def stream_visitor_stats(fx: Fixtures) -> DataFrame:
    """Raw logs through all four jobs of the log chain."""
    wh = _warehouse(fx)
    _publish(wh, jobs.RAW_LOG, **{jobs.RAW_LOG: logs.encode_logs(fx.logs()).unionByName(_closing_logs(wh))})
    _run(jobs.base_log(wh))
    _run(jobs.unique_visitor(wh), jobs.user_jump(wh, BOUNCE_SECONDS))
    _run(jobs.visitor_stats(wh, EVENT_WINDOW))
    stats = fx.spark.read.parquet(f"{wh.root}/stats/visitor_stats")
    return stats.where(F.col("vc").isNotNull()).drop("ts", "batch")


def _facts(fx: Fixtures) -> dict[str, tuple[DataFrame, str]]:
    """The fact topics, with the time of their rows."""
    return {
        jobs.ORDER_INFO: (fx.orders(), "create_ts"),
        jobs.ORDER_DETAIL: (fx.details(), "create_ts"),
        jobs.PAYMENT_INFO: (fx.payments(), "callback_ts"),
        jobs.FAVOR_INFO: (fx.favors(), "create_ts"),
        jobs.CART_INFO: (fx.carts(), "create_ts"),
        jobs.REFUND_INFO: (fx.refunds(), "create_ts"),
        jobs.COMMENT_INFO: (fx.comments(), "create_ts"),
    }


# Topics whose messages say the time of an action as text only.
ACTIONS = [jobs.FAVOR_INFO, jobs.CART_INFO, jobs.REFUND_INFO, jobs.COMMENT_INFO]


def _order_cuts(fx: Fixtures) -> list[int]:
    return _cuts(fx, fx.orders().select("create_ts"), fx.details().select("create_ts"))


def _order_messages(fx: Fixtures, cuts: list[int]) -> dict[str, DataFrame]:
    facts = _facts(fx)
    topics = (jobs.ORDER_INFO, jobs.ORDER_DETAIL, jobs.PAYMENT_INFO)
    return {t: _sliced(facts[t][0], _json(*facts[t]), F.col(facts[t][1]), cuts) for t in topics}


def _order_wide(wh: jobs.Warehouse) -> StreamingQuery:
    return jobs.order_wide(wh, -ORDER_DETAIL_SECONDS, ORDER_DETAIL_SECONDS, F.lit(AS_OF).cast("timestamp"))


def _payment_wide(wh: jobs.Warehouse, order_upper_seconds: int = 5) -> StreamingQuery:
    return jobs.payment_wide(wh, order_upper_seconds=order_upper_seconds, wide_late_seconds=WIDE_LATE_SECONDS)


def _store_dimensions(fx: Fixtures, wh: jobs.Warehouse) -> None:
    """The dimensions as the change router would have stored them, as text."""
    stored = None
    for name, dim in fx.dimensions()._asdict().items():
        entries = [x for c in dim.columns for x in (F.lit(c), F.col(c).cast("string"))]
        rows = dim.select(
            F.lit(0).cast("long").alias("seq"),
            F.lit(jobs.DIM_TABLES[name]).alias("sink_table"),
            F.col("id").cast("string").alias("pk"),
            F.lit("insert").alias("type"),
            F.create_map(*entries).alias("data"),
        )
        stored = rows if stored is None else stored.unionByName(rows)
    wh.dims.upsert(stored, 0)


@query
def stream_order_wide(fx: Fixtures) -> DataFrame:
    """Orders and details joined by interval, with dimensions from the dimension tables."""
    wh, cuts = _warehouse(fx, in_slices=True), _order_cuts(fx)
    _stage(wh, jobs.DB_JOB, **_order_messages(fx, cuts))
    _store_dimensions(fx, wh)
    _replay(wh, cuts, [jobs.DB_JOB], lambda: _order_wide(wh))
    rows = wide.parse_facts(wh.topics.read(fx.spark, jobs.ORDER_WIDE), schemas.ORDER_WIDE)
    return comparable(rows.select(*schemas.ORDER_WIDE.names))


@query
def stream_payment_wide(fx: Fixtures) -> DataFrame:
    """Payments joined to the wide orders that the order job published."""
    wh, cuts = _warehouse(fx, in_slices=True), _order_cuts(fx)
    _stage(wh, jobs.DB_JOB, **_order_messages(fx, cuts))
    _store_dimensions(fx, wh)
    _replay(wh, cuts, [jobs.DB_JOB], lambda: _order_wide(wh), lambda: _payment_wide(wh))
    rows = wide.parse_facts(wh.topics.read(fx.spark, jobs.PAYMENT_WIDE), schemas.PAYMENT_WIDE, "callback_time")
    return comparable(rows.select(*schemas.PAYMENT_WIDE.names))


@query
def stream_product_stats_wide(fx: Fixtures) -> DataFrame:
    """All seven fact streams through the order, payment and statistics jobs.

    Events are of other years than orders.  Each slice has its share of both, so that every topic moves the time on.
    """
    wh, cuts = _warehouse(fx, in_slices=True), _order_cuts(fx)
    pages = logs.page_logs(logs.repair_new_visitors(fx.logs()))
    event_cuts = _cuts(fx, fx.raw_events().select("event_time"))
    last = max(len(cuts), len(event_cuts))
    far = "2100-01-01 00:00:00"
    closing = {"create_time": far, "callback_time": far, "sku_id": -1, "order_id": -1, "id": -1}

    def closed(messages: DataFrame, closing: DataFrame) -> DataFrame:
        return messages.unionByName(closing.withColumn("batch", F.lit(last).cast("long")))

    facts = _order_messages(fx, cuts)
    for topic in ACTIONS:
        rows, time = _facts(fx)[topic]
        rows = rows.withColumn("create_time", tu.timestamp_to_text(time))
        facts[topic] = _sliced(rows, _json(rows, time), F.col(time), event_cuts if topic in (jobs.FAVOR_INFO, jobs.CART_INFO) else cuts)
    end = literal_topic(fx.spark, [json.dumps(closing)])
    _stage(wh, jobs.DB_JOB, **{t: closed(df, end) for t, df in facts.items()})
    texts = logs.encode_logs(pages, "event_time")
    shown = _sliced(texts, F.col("value"), F.col("event_time"), event_cuts)
    _stage(wh, jobs.LOG_JOB, **{logs.PAGE_TOPIC: closed(shown, _closing_logs(wh))})
    _store_dimensions(fx, wh)
    _replay(
        wh, max(cuts, event_cuts, key=len), [jobs.DB_JOB, jobs.LOG_JOB],
        lambda: _order_wide(wh), lambda: _payment_wide(wh), lambda: jobs.product_stats(wh, ORDER_WINDOW, WIDE_LATE_SECONDS),
    )
    stats = fx.spark.read.parquet(f"{wh.root}/stats/product_stats")
    return stats.where(F.col("sku_id") >= 0).drop("ts", "batch")


def _change(table: str, rows: DataFrame, *without: str) -> Column:
    """The change record about a new row of a table, as text."""
    fields = [F.lit("shop").alias("database"), F.lit(table).alias("table"), F.lit("insert").alias("type")]
    data = F.struct(*[c for c in rows.columns if c not in without]).alias("data")
    return to_json_text(*fields, data, F.lit(1).alias("ts"))


def _all(frames: list[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _rules(fx: Fixtures, rows: list[tuple]) -> DataFrame:
    literals = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(schemas.RULE.names, r)]) for r in rows]
    return fx.spark.range(1).select(F.inline(F.array(*literals)))


@query
def stream_product_stats_idle(fx: Fixtures) -> DataFrame:
    """Raw logs and change records through all jobs to product statistics, without a refund or a comment.

    Those topics have no row at all, and only favors have one after the data: what closes the last
    windows everywhere else is the progress that the jobs publish.  As it says how far all topics have come, the
    slices are those of one time for all: orders first, events of later years last.
    """
    wh = _warehouse(fx, in_slices=True)
    cuts = _cuts(fx, fx.orders().select("create_ts"), fx.details().select("create_ts"), fx.raw_events().select("event_time"))
    text = tu.timestamp_to_text("create_ts")
    last = fx.spark.range(1).select(F.lit(-1).cast("long").alias("sku_id"), F.lit("2100-01-01 00:00:00").cast("timestamp").alias("create_ts"))
    found = _facts(fx)
    facts = {
        "order_info": (jobs.ORDER_INFO, *found[jobs.ORDER_INFO]),
        "order_detail": (jobs.ORDER_DETAIL, *found[jobs.ORDER_DETAIL]),
        "payment_info": (jobs.PAYMENT_INFO, *found[jobs.PAYMENT_INFO]),
        "favor_info": (jobs.FAVOR_INFO, fx.favors().unionByName(last).withColumn("create_time", text), "create_ts"),
        "cart_info": (jobs.CART_INFO, fx.carts().withColumn("create_time", text), "create_ts"),
    }
    rules = _rules(
        fx,
        [(t, "insert", "kafka", topic, ",".join(c for c in df.columns if c != time), None, None) for t, (topic, df, time) in facts.items()],
    )
    changes = [_sliced(df, _change(t, df, time), F.col(time), cuts) for t, (_, df, time) in facts.items()]
    _stage(wh, jobs.RAW_DB, **{jobs.RAW_DB: _all(changes)})
    texts = logs.encode_logs(fx.logs(), "event_time")
    closing = _closing_logs(wh).withColumn("batch", F.lit(len(cuts)).cast("long"))
    shown = _sliced(texts, F.col("value"), F.col("event_time"), cuts).unionByName(closing)
    _stage(wh, jobs.RAW_LOG, **{jobs.RAW_LOG: shown})
    _store_dimensions(fx, wh)
    _replay(
        wh, cuts, [jobs.RAW_DB, jobs.RAW_LOG],
        lambda: jobs.base_log(wh), lambda: jobs.base_db(wh, lambda: rules), lambda: _order_wide(wh),
        lambda: _payment_wide(wh, ORDER_DETAIL_SECONDS), lambda: jobs.product_stats(wh, ORDER_WINDOW, WIDE_LATE_SECONDS),
    )
    stats = fx.spark.read.parquet(f"{wh.root}/stats/product_stats")
    return stats.where(F.col("sku_id") >= 0).drop("ts", "batch")


def _thirds(fx: Fixtures, df: DataFrame) -> list[DataFrame]:
    """Messages by order key, in three batches, each in the order of its keys."""
    last = fx.table("orders").agg(F.max("o_orderkey")).first()[0]
    place = F.least(F.lit(2), F.call_function("div", 3 * F.col("o_orderkey"), F.lit(last + 1)))
    return [df.where(place == i).orderBy("o_orderkey") for i in range(3)]


def _tied(envelopes: DataFrame) -> DataFrame:
    """The same envelopes, all of one time: only the order in which they come tells which is the last."""
    return envelopes.withColumn("value", F.regexp_replace("value", r'"ts_ms":\d+', '"ts_ms":1'))


@query
def stream_captured_table(fx: Fixtures) -> DataFrame:
    """Envelopes of one time, over three batches with a compaction, as a stored table."""
    wh = _warehouse(fx)
    store = DimTables(fx.spark, f"{wh.root}/captured/user_info")
    for i, messages in enumerate(_thirds(fx, _tied(fx.envelopes()))):
        _publish(wh, "ods_users", i, ods_users=messages)
        _run(jobs.capture_table(wh, "ods_users", "user_info"))
        if i == 1:
            store.compact("user_info")
    rows = store.read("user_info", columns=["id", "name", "age"], apply_deletes=True)
    return rows.select(F.col("id").cast("int").alias("id"), "name", F.col("age").cast("int").alias("age"))


@query
def stream_base_db(fx: Fixtures) -> DataFrame:
    """Change records over three batches while rules change: facts, dimension rows and rejected records.

    In the second batch inserts go to another topic, and in the third updates have no rule any more.
    """
    wh = _warehouse(fx)

    def rule(op: str, kind: str, ts: int, sink_type: str = "", sink_table: str = "", columns: str = "", pk: str | None = None) -> str:
        data = dict(zip(schemas.RULE_FIELDS.values(), ["orders", kind, sink_type, sink_table, columns, pk, None]))
        image = "before" if op == "d" else "after"
        return json.dumps({"op": op, "source": {"db": "shop", "table": "table_process"}, image: data, "ts_ms": ts})

    changes = [
        [rule("r", "insert", 1, "kafka", "dwd_orders", "id,total"), rule("r", "update", 1, "hbase", "dim_orders", "id,status", "id")],
        # Both of one time: the second one counts
        [rule("u", "insert", 2, "kafka", "dwd_nowhere", "id"), rule("u", "insert", 2, "kafka", "dwd_later", "id,note")],
        [rule("d", "update", 3)],
    ]
    rules = jobs.rules_from_topic(wh, "ods_rules")
    for i, (records, rule_changes) in enumerate(zip(_thirds(fx, fx.change_records()), changes)):
        _publish(wh, "ods_rules", i, ods_rules=literal_topic(fx.spark, rule_changes))
        _publish(wh, jobs.RAW_DB, i, **{jobs.RAW_DB: records})
        _run(jobs.base_db(wh, rules))
    stored = fx.spark.read.schema("value string, topic string").parquet(f"{wh.root}/topics/{jobs.DB_JOB}")
    facts = stored.where(F.col("topic").startswith("dwd_") & F.col("topic").isin("dwd_orders", "dwd_nowhere", "dwd_later"))
    facts = facts.select(F.col("topic").alias("target"), F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.total").alias("detail"))
    dims = wh.dims.read("dim_orders").select(F.lit("dim_orders").alias("target"), "id", F.col("status").alias("detail"))
    rejected = fx.spark.read.parquet(f"{wh.root}/rejected/{jobs.DB_JOB}")
    rejected = rejected.select(F.lit("rejected").alias("target"), F.get_json_object("data", "$.id").alias("id"), F.col("reason").alias("detail"))
    return facts.unionByName(dims).unionByName(rejected)


@query
def stream_pattern_match(fx: Fixtures) -> DataFrame:
    """Entry pages and the product page right after each, over three batches in the order of time."""
    wh = _warehouse(fx)
    pages = logs.page_logs(logs.repair_new_visitors(fx.logs()))
    start, end = pages.agg(F.min("ts"), F.max("ts")).first()
    third = F.least(F.lit(2), F.call_function("div", 3 * (F.col("ts") - start), F.lit(end - start + 1)))
    opened = F.col("page.page_id") == measures.PRODUCT_PAGE
    for i in range(3):
        messages = logs.encode_logs(pages.where(third == i))
        if i == 2:
            messages = messages.unionByName(_closing_logs(wh))
        _publish(wh, jobs.LOG_JOB, i, **{logs.PAGE_TOPIC: messages})
        _run(jobs.page_pairs(wh, visitors.is_entry_page(), opened, BOUNCE_SECONDS))
    found = wh.topics.read(fx.spark, jobs.PAGE_PAIRS)
    of = F.from_json("value", "event_id bigint, ts bigint, next struct<event_id bigint, ts bigint>")
    rows = found.select(of.alias("pair")).select("pair.*")
    return rows.select("event_id", F.col("next.event_id").alias("next_event_id"), (F.col("next.ts") - F.col("ts")).alias("gap_ms"))


@query
def stream_raw_landing(fx: Fixtures) -> DataFrame:
    """Log files through the raw topic to one folder a day: messages and their ids by day."""
    wh = _warehouse(fx)
    fx.whole_logs().write.text(f"{wh.root}/files")
    _run(jobs.collect_logs(wh, f"{wh.root}/files"))
    _run(jobs.land_raw_logs(wh, f"{wh.root}/landed"))
    landed = fx.spark.read.text(f"{wh.root}/landed")
    event_id = F.get_json_object("value", "$.event_id").cast("long")
    return landed.groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("messages"), F.sum(event_id).alias("ids"))


@query
def stream_unusable(fx: Fixtures) -> DataFrame:
    """Of three batches of raw logs, some broken off and some without a time, what consumers leave out and why."""
    wh = _warehouse(fx)
    timeless = F.when(F.col("log_id") % 7 == 0, F.regexp_replace("value", r',"ts":\d+', "")).otherwise(F.col("value"))
    rows = fx.raw_logs().withColumn("value", timeless)
    for i in range(3):
        _publish(wh, jobs.LOG_JOB, i, **{logs.PAGE_TOPIC: rows.where(F.col("log_id") % 3 == i)})
        _run(jobs.keep_unusable(wh, logs.PAGE_TOPIC))
    kept = fx.spark.read.parquet(f"{wh.root}/unusable/{logs.PAGE_TOPIC}")
    return kept.groupBy("batch", "reason").agg(F.count("*").alias("n")).select(
        (F.col("batch") % jobs.BATCHES_PER_EPOCH).cast("int").alias("batch"), "reason", "n"
    )
