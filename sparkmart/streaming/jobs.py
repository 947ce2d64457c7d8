"""The warehouse's streaming jobs.

Each function starts one query and returns it.  A job reads topics, applies the
shared operators, and publishes per micro-batch; jobs only meet through topics
and tables, so each declares its own watermark.  Every layer of the warehouse
(raw, cleaned, wide, statistics) has its own topics and can be replayed alone.

With every batch a job also publishes how far event time has come, to all of its topics
(see ``sources/progress.py``), so that a topic without rows holds nobody up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import CORRUPT, parse_json, split_corrupt, to_json_text
from sparkmart.operators import logs, measures, routing, stats, visitors, wide
from sparkmart.operators.joins import bounded_broadcast
from sparkmart.operators.patterns import MATCHED, followed_by
from sparkmart.session import shared_dir
from sparkmart.sinks.batches import AppendedTable, publish_batch
from sparkmart.sinks.dims import MAX_BROADCAST_KEYS, DimTables
from sparkmart.sinks.writers import FolderStats, StatsSink, landing_writer
from sparkmart.sources import cdc, progress
from sparkmart.sources.files import list_names, make_dir
from sparkmart.sources.topics import POSITION, FolderTopics, Topics, read_text_lines
from sparkmart.streaming.rules import RuleTable

# Topics between the jobs.
RAW_LOG = "ods_base_log"
RAW_DB = "ods_base_db_m"
UNIQUE_VISIT = "dwm_unique_visit"
USER_JUMP = "dwm_user_jump_detail"
PAGE_PAIRS = "dwm_page_pairs"
ORDER_INFO = "dwd_order_info"
ORDER_DETAIL = "dwd_order_detail"
PAYMENT_INFO = "dwd_payment_info"
FAVOR_INFO = "dwd_favor_info"
CART_INFO = "dwd_cart_info"
REFUND_INFO = "dwd_order_refund_info"
COMMENT_INFO = "dwd_comment_info"
ORDER_WIDE = "dwm_order_wide"
PAYMENT_WIDE = "dwm_payment_wide"

ADAPTIVE = "spark.sql.adaptive.enabled"

# Fixed value: how far event time trails behind the latest event.
WATERMARK = "3 seconds"

# Dimension tables of the wide facts.
DIM_TABLES = {
    "user": "dim_user_info",
    "province": "dim_base_province",
    "sku": "dim_sku_info",
    "spu": "dim_spu_info",
    "category3": "dim_base_category3",
    "trademark": "dim_base_trademark",
}
# The column types of dimension attributes that are not text.
DIM_TYPES = {
    "id": "long", "birthday": "date", "price": "decimal(16,2)",
    "spu_id": "long", "tm_id": "long", "category3_id": "long",
}
DIM_COLUMNS = {
    "user": ["id", "gender", "birthday"],
    "province": ["id", "name", "area_code", "iso_code", "iso_3166_2"],
    "sku": ["id", "sku_name", "price", "spu_id", "tm_id", "category3_id"],
    "spu": ["id", "spu_name"],
    "category3": ["id", "name"],
    "trademark": ["id", "tm_name"],
}

# Keys of the dimensions that have as many rows as there are users and goods.
LARGE_DIM_KEYS = {"user_id", "sku_id"}

LOG_JOB = "base_log"
DB_JOB = "base_db"
# Topics written by a job that writes several.
PRODUCERS = dict.fromkeys([logs.PAGE_TOPIC, logs.START_TOPIC, logs.DISPLAY_TOPIC], LOG_JOB) | dict.fromkeys(
    [ORDER_INFO, ORDER_DETAIL, PAYMENT_INFO, FAVOR_INFO, CART_INFO, REFUND_INFO, COMMENT_INFO], DB_JOB
)


def topics_of(job: str) -> list[str]:
    return [topic for topic, producer in PRODUCERS.items() if producer == job]


# Ids of the batches of a checkpoint start at a multiple of this.
BATCHES_PER_EPOCH = 2**32


@dataclass(frozen=True)
class Warehouse:
    """Where the jobs read and write.

    ``root`` is a folder shared by all executors, by default one in
    ``spark.checkpoint.dir``; checkpoints, tables and, without Kafka, the topics are
    below it.  ``trigger`` goes to ``writeStream.trigger``.
    """

    spark: SparkSession
    root: str | None = None
    topics: Topics | None = None
    stats: StatsSink | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": "5 seconds"})
    watermark: str = WATERMARK
    salts: int = 4
    # Batches after which a job folds the changes of its tables into a snapshot.
    compact_every: int = 500
    # Buckets of a keyed table; a task compacts one, so it should fit.
    buckets: int = 16

    def __post_init__(self):
        if self.root is None:
            object.__setattr__(self, "root", f"{shared_dir(self.spark)}/warehouse")
        if self.topics is None:
            object.__setattr__(self, "topics", FolderTopics(f"{self.root}/topics", PRODUCERS))
        if self.stats is None:
            object.__setattr__(self, "stats", FolderStats(f"{self.root}/stats"))

    @property
    def dims(self) -> DimTables:
        return DimTables(self.spark, f"{self.root}/dims", self.buckets)

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def read(self, topic: str, job: str, with_progress: bool = False, position: bool = False) -> DataFrame:
        return self.topics.read_stream(self.spark, topic, job, with_progress, position)

    def logs(self, topic: str, job: str) -> DataFrame:
        """Readable logs with their text, and messages of progress, which have a key in ``progress.MARK``."""
        decoded = logs.decode_logs(self.read(topic, job, with_progress=True), keep_text=True)
        readable = decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        return readable.withColumn(progress.MARK, progress.key_of_mid(F.col("common.mid")))

    def facts(self, topic: str, job: str, schema, time: str = "create_time") -> DataFrame:
        """Readable facts, and messages of progress, which have a key in ``progress.MARK``."""
        marked = T.StructType(schema.fields + [T.StructField(progress.MARK, T.LongType())])
        return split_corrupt(wide.parse_facts(self.read(topic, job, with_progress=True), marked, time))[0]

    def trailing(self, at: Column, seconds: int = 0) -> Column:
        """The time that rows may still come from, after all that was published at time ``at``."""
        return at - F.expr(f"INTERVAL {self.watermark}") - F.expr(f"INTERVAL {int(seconds)} SECONDS")

    def late(self, seconds: int = 0) -> str:
        """The watermark of a stream whose rows come so many seconds out of order."""
        return f"{self.watermark} {int(seconds)} seconds" if seconds else self.watermark

    def keep_corrupt(self, rows: DataFrame, job: str, batch_id: int) -> None:
        """Text that a job could not read, as a table of its own."""
        publish_batch(rows.select(CORRUPT), f"{self.root}/corrupt/{job}", batch_id)

    def first_batch(self, job: str) -> int:
        """The id that a job's batch 0 is published under.

        Spark counts batches anew for a new checkpoint.  Each checkpoint therefore has an
        epoch of its own, kept beside it, and publishes after all earlier ones; what a
        caller loads itself, with small ids, comes before.  A restart finds its epoch again,
        so a batch that runs twice is still published once.
        """
        prefix, own, all_epochs = "epoch=", f"{self.checkpoint(job)}/epochs", f"{self.root}/epochs/{job}"

        def epochs(folder: str) -> list[int]:
            make_dir(self.spark, folder)
            return [int(n.removeprefix(prefix)) for n in list_names(self.spark, folder) if n.startswith(prefix)]

        found = epochs(own)
        epoch = max(found) if found else 1 + max(epochs(all_epochs), default=0)
        if not found:
            make_dir(self.spark, f"{all_epochs}/{prefix}{epoch}")
            make_dir(self.spark, f"{own}/{prefix}{epoch}")
        return epoch * BATCHES_PER_EPOCH

    def start(
        self, job: str, stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append"
    ) -> StreamingQuery:
        first = self.first_batch(job)

        def run(batch: DataFrame, batch_id: int) -> None:
            # A streaming query turns AQE off in its session, as its state fixes the
            # partitioning; what is done with a finished batch may be adapted again.
            conf = batch.sparkSession.conf
            before = conf.get(ADAPTIVE)
            conf.set(ADAPTIVE, "true")
            try:
                write(batch, first + batch_id)
            finally:
                conf.set(ADAPTIVE, before)

        return (
            stream.writeStream.queryName(job)
            .outputMode(mode)
            .foreachBatch(run)
            .option("checkpointLocation", self.checkpoint(job))
            .trigger(**self.trigger)
            .start()
        )

    def start_topic(self, job: str, topic: str, stream: DataFrame, mode: str = "append") -> StreamingQuery:
        """Publish a stream of ``value`` rows to one topic."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.topics.publish(batch.select(F.lit(topic).alias("topic"), "value"), topic, batch_id)

        return self.start(job, stream, write, mode)

    def dimensions(self, batch: DataFrame) -> wide.Dimensions:
        """The dimension tables as they are now, typed, as far as ``batch`` refers to users and skus.

        ``batch`` is one that is kept.  For a batch without rows, as those that only clear the state, nothing is looked up.
        """
        if not batch.count():
            typed = {n: ", ".join(f"{c} {DIM_TYPES.get(c, 'string')}" for c in columns) for n, columns in DIM_COLUMNS.items()}
            return wide.Dimensions(**{name: batch.sparkSession.createDataFrame([], schema) for name, schema in typed.items()})

        def table(name: str) -> DataFrame:
            columns, key, keys = DIM_COLUMNS[name], f"{name}_id", None
            if key in LARGE_DIM_KEYS and key in batch.columns:
                keys = batch.select(F.col(key).cast("string"))
            rows = self.dims.read(DIM_TABLES[name], "id", columns, keys=keys)
            return rows.select(*[F.col(c).try_cast(DIM_TYPES.get(c, "string")).alias(c) for c in columns])

        return wide.Dimensions(**{name: table(name) for name in DIM_TABLES})


@contextmanager
def persisted(batch: DataFrame) -> Iterator[None]:
    """Keep a batch that is read several times; lost blocks are computed again from the source."""
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


# Raw and cleaned layers -----------------------------------------------------


def collect_logs(wh: Warehouse, folder: str) -> StreamingQuery:
    """Log files, one message per line, to the raw log topic."""
    return wh.start_topic("collect_logs", RAW_LOG, read_text_lines(wh.spark, folder, stream=True))


def land_raw_logs(wh: Warehouse, path: str) -> StreamingQuery:
    """Keep every raw log message as text, one folder per day."""
    raw = wh.read(RAW_LOG, "land_raw_logs")
    writer = landing_writer(raw, path, wh.checkpoint("land_raw_logs")).queryName("land_raw_logs")
    return writer.trigger(**wh.trigger).start()


#: How the messages of a topic are read: schema and time field of facts; logs otherwise.
FACT_TOPICS = {
    ORDER_INFO: (schemas.ORDER_INFO, "create_time"),
    ORDER_DETAIL: (schemas.ORDER_DETAIL, "create_time"),
    PAYMENT_INFO: (schemas.PAYMENT_INFO, "callback_time"),
    FAVOR_INFO: (schemas.FAVOR_INFO, "create_time"),
    CART_INFO: (schemas.CART_INFO, "create_time"),
    REFUND_INFO: (schemas.REFUND_INFO, "create_time"),
    COMMENT_INFO: (schemas.COMMENT_INFO, "create_time"),
    ORDER_WIDE: (schemas.ORDER_WIDE, "create_time"),
    PAYMENT_WIDE: (schemas.PAYMENT_WIDE, "callback_time"),
}
NO_TIME, NO_JSON = "no event time", "no JSON object"


def unusable(wh: Warehouse, topic: str) -> DataFrame:
    """value and reason of the messages that no consumer of a topic can use: unreadable, or without an event time.

    Windows and interval joins have no place for such rows.  Progress is not among them.
    """
    raw = wh.read(topic, f"unusable_{topic}")
    if topic in FACT_TOPICS:
        schema, time = FACT_TOPICS[topic]
        kept = raw.select("value", F.col("value").alias("text"))
        parsed = parse_json(kept, schema, keep=("text",))
        at = tu.text_to_timestamp(time)
    else:
        parsed = logs.decode_logs(raw, keep_text=True).withColumnRenamed(logs.RAW, "text")
        at = F.col("event_time")
    reason = F.when(F.col(CORRUPT).isNotNull() | F.col("text").isNull(), NO_JSON).when(at.isNull(), NO_TIME)
    return parsed.select(F.col("text").alias("value"), reason.alias("reason")).where("reason IS NOT NULL")


def keep_unusable(wh: Warehouse, topic: str) -> StreamingQuery:
    """The `unusable` messages of a topic as a table, so that what its consumers leave out is not lost."""
    job = f"unusable_{topic}"
    return wh.start(job, unusable(wh, topic), lambda batch, i: publish_batch(batch, f"{wh.root}/unusable/{topic}", i))


FIRST_VISITS = schemas.row(mid=schemas.TEXT, first_ts=schemas.LONG)


def first_visits_table(wh: Warehouse) -> AppendedTable:
    return AppendedTable(wh.spark, f"{wh.root}/first_visits", FIRST_VISITS, wh.buckets)


def repair_batch(wh: Warehouse, batch: DataFrame, batch_id: int) -> DataFrame:
    """Repair new-visitor flags across batches.

    The first visits found so far are a table that each batch extends by the
    visitors it saw first.  Only those of the batch's visitors are fetched.  The
    first batch a visitor claims to be new in fixes the day, at the earliest
    time in that batch.
    """
    table = first_visits_table(wh)
    found = logs.first_visits(batch)
    wanted, _ = bounded_broadcast(found.select("mid"), MAX_BROADCAST_KEYS)
    # Only the batch's visitors are looked at, also on the side that is read in full.
    known = table.read(before=batch_id, keys=wanted).join(wanted, "mid", "left_semi")
    table.append(found.join(known, "mid", "left_anti"), batch_id)
    if (batch_id + 1) % wh.compact_every == 0:
        table.compact()
    firsts = table.read(before=batch_id + 1, keys=wanted).join(wanted, "mid", "left_semi")
    return logs.repair_new_visitors(batch, firsts)


def base_log(wh: Warehouse) -> StreamingQuery:
    """Raw logs to start, page and display topics; broken text to a table."""
    decoded = logs.decode_logs(wh.read(RAW_LOG, LOG_JOB), keep_text=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch):
            good, bad = split_corrupt(batch)
            wh.keep_corrupt(bad, LOG_JOB, batch_id)
            split = logs.log_outputs(repair_batch(wh, good, batch_id))
            come = progress.messages(good, F.col("event_time"), topics_of(LOG_JOB))
            wh.topics.publish(split.unionByName(come), LOG_JOB, batch_id)

    return wh.start(LOG_JOB, decoded, write)


def base_db(wh: Warehouse, rules: Callable[[], DataFrame]) -> StreamingQuery:
    """Change records to fact topics and dimension tables, by rules; the rest to a table.

    ``rules`` is called for every batch, so that rule changes take effect before the
    records after them, and dimensions are written before facts.
    """
    records = cdc.decode_records(wh.read(RAW_DB, DB_JOB, position=True), keep=(POSITION,))
    tables = DimCreator(wh.dims)

    def write(batch: DataFrame, batch_id: int) -> None:
        current = rules()
        good, bad = split_corrupt(batch)
        # Not kept as well: a filter by route and a few look-ups in a map cost less than a second copy of the data
        routed = routing.route(routing.clean(good), current)
        with persisted(batch):
            wh.keep_corrupt(bad, DB_JOB, batch_id)
            tables.create(current)
            seq = F.coalesce("ts", F.lit(0)).alias("seq")
            wh.dims.upsert(routing.dim_rows(routed.withColumn("seq", seq), "seq", POSITION), batch_id)
            times = (tu.text_to_timestamp(F.col("data")[c]) for c in ("create_time", "callback_time"))
            come = progress.messages(routed.where(F.col("route") == "fact"), F.greatest(*times), topics_of(DB_JOB))
            wh.topics.publish(routing.fact_payloads(routed).unionByName(come), DB_JOB, batch_id)
            rejected = routed.where(F.col("route") == "rejected")
            rejected = rejected.select("database", "table", "type", F.to_json("data").alias("data"), "reason")
            publish_batch(rejected, f"{wh.root}/rejected/{DB_JOB}", batch_id)

    return wh.start(DB_JOB, records, write)


class DimCreator:
    """Creates the dimension tables that rules name, and columns that they lack.

    Reads the dimension rules to the driver where they are not those of the batch before, and only
    looks at the store for a list of columns that it has not seen: a table has one rule per routed
    (table, operation), written by hand.
    """

    def __init__(self, dims: DimTables):
        self.dims = dims
        self._rules: DataFrame | None = None
        self._seen: set[tuple] = set()

    def create(self, rules: DataFrame) -> None:
        if rules is self._rules:
            return
        wanted = rules.where(F.col("sink_type") == routing.DIM_SINK).select("sink_table", "sink_columns", "sink_pk")
        for rule in wanted.distinct().collect():
            if tuple(rule) not in self._seen:
                self.dims.create(*rule)
                self._seen.add(tuple(rule))
        self._rules = rules


def rule_table(wh: Warehouse, topic: str) -> RuleTable:
    return RuleTable(wh.spark, f"{wh.root}/rules/{topic}")


def maintain_rules(wh: Warehouse, topic: str) -> StreamingQuery:
    """A topic of connector envelopes about the rule table, folded into the rules in force."""
    table = rule_table(wh, topic)
    return wh.start(f"rules_{topic}", wh.read(topic, f"rules_{topic}", position=True), table.fold)


def rules_from_topic(wh: Warehouse, topic: str) -> Callable[[], DataFrame]:
    """Rules in force according to a topic of connector envelopes about the rule table.

    Each call takes in what has come to a topic of folders since the last one.  Of a Kafka topic it
    gives what :func:`maintain_rules`, which then has to run as well, has folded so far.
    """
    table = rule_table(wh, topic)

    def rules() -> DataFrame:
        if isinstance(wh.topics, FolderTopics):
            upto, done = wh.topics.last(wh.spark, topic), table.version()
            if upto is not None and (done is None or upto > done):
                table.fold(wh.topics.read(wh.spark, topic, position=True, after=done), upto)
        return table.current()

    return rules


# Wide layer -----------------------------------------------------------------


def _visits(wh: Warehouse, job: str) -> DataFrame:
    """Page logs with what visits and bounces look at and the message's text, so that no state holds more."""
    page = F.struct("page.page_id", "page.last_page_id").alias("page")
    return wh.logs(logs.PAGE_TOPIC, job).select(
        F.struct("common.mid").alias("common"), page, "ts", "event_id", "event_time", logs.RAW, progress.MARK
    )


def unique_visitor(wh: Warehouse, delay: str = "2 days") -> StreamingQuery:
    """Page logs to the first entry page per visitor and day, as whole messages."""
    job = "unique_visitor"
    first = visitors.unique_visitors_stream(_visits(wh, job), delay)
    return wh.start_topic(job, UNIQUE_VISIT, first.select(F.col(logs.RAW).alias("value")), "update")


def user_jump(wh: Warehouse, within_seconds: int = 10) -> StreamingQuery:
    """Page logs to bounces, as whole messages.

    A message of progress times out like a bounce.  Later bounces are of windows of two limits
    that end after its own, so it trails by as much.
    """
    job = "user_jump"
    pages = _visits(wh, job).withWatermark("event_time", wh.watermark)
    found = visitors.bounces(pages, within_seconds)
    at = F.col("event_time") - F.expr(f"INTERVAL {2 * int(within_seconds)} SECONDS")
    come = F.when(F.col(progress.MARK).isNotNull(), progress.message(at, F.col(progress.MARK)))
    return wh.start_topic(job, USER_JUMP, found.select(F.coalesce(come, logs.RAW).alias("value")))


def page_pairs(wh: Warehouse, first: Column, follow: Column, within_seconds: int = 10) -> StreamingQuery:
    """Page logs to pairs of a ``first`` page and the one right after it, if that is a ``follow`` in time."""
    job = "page_pairs"
    pages = wh.logs(logs.PAGE_TOPIC, job).withWatermark("event_time", wh.watermark)
    columns = ["common", "page", "ts", "event_id", "event_time"]
    rows = pages.select(*columns, progress.MARK)
    # Progress moves the watermark; alone in its key it is in no pair
    found = followed_by(rows, visitors.MID, first, follow, within_seconds, MATCHED)
    fields = [c for c in columns if c != "event_time"]
    follower = F.struct(*(F.col(f"next.{c}").alias(c) for c in fields)).alias("next")
    return wh.start_topic(job, PAGE_PAIRS, found.select(to_json_text(*fields, follower).alias("value")))


def order_wide(
    wh: Warehouse, lower_seconds: int = -5, upper_seconds: int = 5, as_of: Column | None = None
) -> StreamingQuery:
    """Orders and details to wide orders, with the dimensions as of each batch.

    Messages of progress of both topics meet in the join.  Orders that wait for details are
    older than that by the interval and the watermark at most.
    """
    job = "order_wide"
    orders = wh.facts(ORDER_INFO, job, schemas.ORDER_INFO).withWatermark("create_ts", wh.watermark)
    details = wh.facts(ORDER_DETAIL, job, schemas.ORDER_DETAIL).withWatermark("create_ts", wh.watermark)
    joined = wide.order_detail_join(orders, details, lower_seconds, upper_seconds, wh.salts)
    key = progress.key_of_id(F.col("order_id"))
    come = progress.message(wh.trailing(F.col("create_ts"), max(upper_seconds, 0)), key)

    def write(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch):
            found = batch.where(key.isNull())
            rows = wide.order_wide(found, wh.dimensions(found), as_of)
            values = rows.select(to_json_text(*schemas.ORDER_WIDE.names).alias("value"))
            values = values.unionByName(batch.where(key.isNotNull()).select(come.alias("value")))
            wh.topics.publish(values.select(F.lit(ORDER_WIDE).alias("topic"), "value"), ORDER_WIDE, batch_id)

    return wh.start(job, joined, write)


def payment_wide(
    wh: Warehouse, lower_seconds: int = -1800, upper_seconds: int = 0, order_upper_seconds: int = 5, wide_late_seconds: int = 0
) -> StreamingQuery:
    """Payments and wide orders to wide payments.

    Progress of wide orders trails that of payments by ``order_upper_seconds``, the upper end of
    the interval in ``order_wide``, and the watermark.  So that both meet, that of payments is set
    back by as much; nothing is lost, as the join waits for the wide orders anyway.

    An order comes out of ``order_wide`` when its detail is there, so wide orders of several batches may be
    out of order by the length of its interval: ``wide_late_seconds``.
    """
    job = "payment_wide"
    payments = wh.facts(PAYMENT_INFO, job, schemas.PAYMENT_INFO, "callback_time")
    set_back = wh.trailing(F.col("callback_ts"), max(order_upper_seconds, 0))
    called = F.when(F.col(progress.MARK).isNotNull(), set_back).otherwise(F.col("callback_ts"))
    payments = payments.withColumn("callback_ts", called).withWatermark("callback_ts", wh.watermark)
    orders = wh.facts(ORDER_WIDE, job, schemas.ORDER_WIDE).withWatermark("create_ts", wh.late(wide_late_seconds))
    rows = wide.payment_wide(payments, orders, lower_seconds, upper_seconds, wh.salts)
    key = progress.key_of_id(F.col("order_id"))
    both = F.least("callback_ts", tu.text_to_timestamp("order_create_time"))
    come = F.when(key.isNotNull(), progress.message(wh.trailing(both, max(upper_seconds, 0)), key))
    value = F.coalesce(come, to_json_text(*schemas.PAYMENT_WIDE.names)).alias("value")
    return wh.start_topic(job, PAYMENT_WIDE, rows.select(value))


# Statistics layer -----------------------------------------------------------


def visitor_stats(wh: Warehouse, window: str = stats.WINDOW) -> StreamingQuery:
    """Pages, unique visits and bounces to visitor statistics."""
    job = "visitor_stats"
    union = measures.visitor_union(
        *[wh.logs(topic, job) for topic in (logs.PAGE_TOPIC, UNIQUE_VISIT, USER_JUMP)], watermark=wh.watermark
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        wh.stats.write(batch, "visitor_stats", schemas.VISITOR_STATS_COLUMNS, batch_id)

    return wh.start(job, stats.visitor_stats(union, window), write)


def product_stats(wh: Warehouse, window: str = stats.WINDOW, wide_late_seconds: int = 0) -> StreamingQuery:
    """Seven fact streams to product statistics with dimension attributes.

    ``wide_late_seconds``: how far wide facts may be out of order, see `payment_wide`.
    """
    job = "product_stats"
    union = measures.product_union(
        wh.logs(logs.PAGE_TOPIC, job),
        wh.facts(FAVOR_INFO, job, schemas.FAVOR_INFO),
        wh.facts(CART_INFO, job, schemas.CART_INFO),
        wh.facts(ORDER_WIDE, job, schemas.ORDER_WIDE),
        wh.facts(PAYMENT_WIDE, job, schemas.PAYMENT_WIDE, "callback_time"),
        wh.facts(REFUND_INFO, job, schemas.REFUND_INFO),
        wh.facts(COMMENT_INFO, job, schemas.COMMENT_INFO),
        watermark=wh.watermark,
        wide_watermark=wh.late(wide_late_seconds),
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch):
            rows = stats.product_stats_wide(batch, wh.dimensions(batch))
            wh.stats.write(rows, "product_stats", schemas.PRODUCT_STATS_COLUMNS, batch_id)

    return wh.start(job, stats.product_stats(union, window), write)


# Captured tables --------------------------------------------------------------


def capture_table(wh: Warehouse, topic: str, table: str, pk: str = "id") -> StreamingQuery:
    """Connector envelopes of one table, snapshot first and then changes, into a stored table."""
    job = f"capture_{table}"
    changes = cdc.decode_envelope(wh.read(topic, job, position=True), keep=(POSITION,))
    rows = changes.where(F.col(CORRUPT).isNotNull() | (F.col("table") == table)).select(
        F.coalesce("ts", F.lit(0)).alias("seq"),
        POSITION,
        F.lit(table).alias("sink_table"),
        cdc.row_image()[pk].alias("pk"),
        "type",
        cdc.row_image().alias("data"),
        CORRUPT,
    )
    store = DimTables(wh.spark, f"{wh.root}/captured/{table}", wh.buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch):
            good, bad = split_corrupt(batch)
            wh.keep_corrupt(bad, job, batch_id)
            store.upsert(good, batch_id)
        if (batch_id + 1) % wh.compact_every == 0:
            store.compact(table)

    return wh.start(job, rows, write)
