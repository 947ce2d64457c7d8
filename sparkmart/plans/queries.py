"""Registered queries: the operators over the benchmark tables.

Time limits and windows are wider than the operators' defaults where the tables
are sparser than live traffic; they are constants here and in ``oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.codes import decode_code
from sparkmart.functions.jsonutil import CORRUPT, evaluate_once, split_corrupt, to_json_text
from sparkmart.operators import joins, logs, measures, patterns, routing, stats, visitors, wide
from sparkmart.plans.fixtures import AS_OF, SPREAD_BY, Fixtures
from sparkmart.session import configure, shared_dir
from sparkmart.sinks.dims import DimTables
from sparkmart.sources import cdc, tables

BOUNCE_SECONDS = 3600
EVENT_WINDOW = "1 hour"
ORDER_WINDOW = "1 day"
ORDER_DETAIL_SECONDS = 5 * 86400

# The JSON text of a row takes up to so many times the row's bytes at rest.
EXPANSION = 32

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Register a function of the fixtures under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fx = Fixtures(spark, sf_dir)
        configure(spark, "UTC", shuffle_bytes=EXPANSION * fx.bytes_of(*SPREAD_BY))
        return comparable(build(fx))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that engines with other decimal widths compare equal."""
    doubles = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(doubles) if doubles else df


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


# Shared steps -------------------------------------------------------------


def _pages(fx: Fixtures) -> DataFrame:
    return logs.visit_columns(logs.page_logs(logs.repair_new_visitors(fx.logs())))


def _joined(fx: Fixtures) -> DataFrame:
    return wide.order_detail_join(fx.orders(), fx.details(), -ORDER_DETAIL_SECONDS, ORDER_DETAIL_SECONDS)


def _order_wide(fx: Fixtures) -> DataFrame:
    return wide.order_wide(_joined(fx), fx.dimensions(), _as_of())


def _payment_wide(fx: Fixtures, orders: DataFrame) -> DataFrame:
    return wide.payment_wide(fx.payments(), orders)


def _product_measures(fx: Fixtures) -> DataFrame:
    # The statistics need no dimension columns of the wide rows, so those joins stay out.
    none = {n: F.lit(None).cast(schemas.ORDER_WIDE[n].dataType) for n in schemas.ORDER_WIDE.names}
    joined = _joined(fx)
    bare = joined.select(*[F.col(n) if n in joined.columns else none[n].alias(n) for n in none], "create_ts")
    return measures.product_union(
        logs.page_logs(fx.logs()),
        fx.favors(),
        fx.carts(),
        bare,
        _payment_wide(fx, bare),
        fx.refunds(),
        fx.comments(),
    )


def _cleaned(fx: Fixtures) -> DataFrame:
    return routing.clean(cdc.decode_records(fx.change_records(), keep=("o_orderkey",)))


def _routed(fx: Fixtures) -> DataFrame:
    return routing.route(_cleaned(fx), fx.rules())


# Scans and scalars ---------------------------------------------------------


@query
def parse_log_json(fx: Fixtures) -> DataFrame:
    raw = fx.raw_logs()
    parsed = logs.decode_logs(raw)
    return parsed.select(
        F.col("common.mid").alias("mid"),
        F.col("common.is_new").alias("is_new"),
        F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"),
        F.size("displays").alias("n_displays"),
        F.get("displays", F.lit(0))["item"].alias("first_item"),
        F.size("start").alias("n_start"),
        "ts",
        F.col(CORRUPT).alias("corrupt"),
    )


@query
def parse_orders(fx: Fixtures) -> DataFrame:
    names = schemas.ORDER_INFO.names
    text = fx.orders().select(to_json_text(*names).alias("value"))
    parsed = wide.parse_facts(text, schemas.ORDER_INFO)
    return parsed.select(
        "id",
        "province_id",
        "user_id",
        "order_status",
        "total_amount",
        "coupon_reduce_amount",
        "create_time",
        F.unix_millis("create_ts").alias("create_ts"),
    )


@query
def scalar_time(fx: Fixtures) -> DataFrame:
    ms = F.unix_millis("event_time")
    text = tu.timestamp_to_text("event_time")
    return fx.raw_events().select(
        "event_id",
        tu.ms_to_day(ms).alias("day"),
        text.alias("text"),
        tu.text_to_ms(text).alias("text_ms"),
        tu.age_in_years(F.lit("1990-06-15").cast("date"), F.col("event_time")).alias("age"),
    )


@query
def code_labels(fx: Fixtures) -> DataFrame:
    """Labels of every group of codes, for known and unknown codes."""
    line = F.col("l_linenumber").cast("string")
    groups = F.array(*[F.lit(g) for g in ("100", "110", "120", "130", "140", "150", "240", "310", "320", "330")])
    rows = fx.table("lineitem").select("l_orderkey", "l_linenumber", F.explode(F.transform(groups, lambda g: F.concat(g, line))).alias("code"))
    return rows.select("l_orderkey", "l_linenumber", "code", decode_code("code").alias("label"))


@query
def dim_lookup(fx: Fixtures) -> DataFrame:
    first = tables.first_per_key(fx.table("customer"), ["c_nationkey", "c_mktsegment"], ["c_custkey"])
    return first.select("c_nationkey", "c_mktsegment", "c_custkey", "c_name")


@query
def to_json_rows(fx: Fixtures) -> DataFrame:
    rows = fx.carts().select("sku_id", tu.timestamp_to_text("create_ts").alias("create_time"))
    return rows.select(to_json_text("*").alias("value"))


# Change records --------------------------------------------------------------


@query
def cdc_decode(fx: Fixtures) -> DataFrame:
    decoded = cdc.decode_envelope(fx.envelopes(), keep=("o_orderkey",))
    return decoded.select(
        "o_orderkey",
        "database",
        "table",
        "type",
        F.size("data").alias("n_data"),
        F.col("data")["id"].alias("id"),
        F.col("data")["name"].alias("name"),
        F.col("before")["id"].alias("before_id"),
        "ts",
    )


@query
def cdc_current_table(fx: Fixtures) -> DataFrame:
    snapshot = fx.table("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("balance"),
        F.lit(-1).cast("long").alias("seq"),
        F.lit("r").alias("op"),
    )
    changes = fx.table("orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderpriority").startswith("4"), "d").otherwise("u").alias("op"),
    )
    return cdc.current_table(snapshot, changes, ["id"], ["seq"], F.col("op") == "d").drop("op")


@query
def cdc_sql_view(fx: Fixtures) -> DataFrame:
    changes = cdc.decode_envelope(fx.envelopes())
    cdc.create_cdc_view(fx.spark, "user_info", changes, "id INT, name STRING, age INT", "id", ["ts"])
    return fx.spark.sql("SELECT * FROM user_info")


@query
def cdc_clean_filter(fx: Fixtures) -> DataFrame:
    return _cleaned(fx).select("o_orderkey", "table", "type", F.size("data").alias("n_data"))


@query
def cdc_route(fx: Fixtures) -> DataFrame:
    return _routed(fx).select("o_orderkey", "table", "type", "sink_type", "sink_table", "route", "reason")


@query
def cdc_column_filter(fx: Fixtures) -> DataFrame:
    data = F.col("data")
    return _routed(fx).select(
        "o_orderkey",
        F.size(data).alias("n_data"),
        *[data[c].alias(c) for c in ("id", "status", "total", "note")],
    )


@query
def cdc_rules_current(fx: Fixtures) -> DataFrame:
    return cdc.current_rules(fx.rule_changes(), ["ts"])


@query
def fact_payloads(fx: Fixtures) -> DataFrame:
    return routing.fact_payloads(_routed(fx))


def _customer_rows(df: DataFrame, seq: str, kind: str, **data: Column) -> DataFrame:
    entries = [x for name, value in data.items() for x in (F.lit(name), value)]
    return df.select(
        F.col(seq).cast("long").alias("seq"),
        F.lit("customer").alias("sink_table"),
        data["id"].alias("pk"),
        F.lit(kind).alias("type"),
        F.create_map(*entries).alias("data"),
    )


def _customers(fx: Fixtures) -> DimTables:
    dims = DimTables(fx.spark, f"{shared_dir(fx.spark)}/{uuid.uuid4().hex}")
    dims.create("customer", "id,name,segment")
    rows = _customer_rows
    customer = {"name": F.col("c_name"), "segment": F.col("c_mktsegment")}
    dims.upsert(rows(fx.table("customer"), "c_custkey", "insert", id=F.col("c_custkey").cast("string"), **customer), 0)
    order = {"id": F.col("o_custkey").cast("string"), "name": F.concat(F.lit("name "), F.col("o_orderkey"))}
    finished = F.col("o_orderstatus") == "F"
    dims.upsert(rows(fx.table("orders").where(finished), "o_orderkey", "update", **order), 1)
    dims.compact("customer")
    dims.upsert(rows(fx.table("orders").where(~finished), "o_orderkey", "update", **order), 2)
    return dims


@query
def dim_upsert(fx: Fixtures) -> DataFrame:
    """A stored dimension: customers, then two batches of order changes by customer, compacted in between."""
    return _customers(fx).read("customer")


@query
def dim_upsert_deletes(fx: Fixtures) -> DataFrame:
    """The same, then deletions, a compaction, and a new column for some of the deleted and the others."""
    dims = _customers(fx)
    id_text = F.col("c_custkey").cast("string")
    gone = fx.table("customer").where("c_custkey % 3 = 0")
    dims.upsert(_customer_rows(gone, "c_custkey", "delete", id=id_text), 3)
    dims.compact("customer")
    dims.create("customer", "id,balance")
    back = fx.table("customer").where("c_custkey % 2 = 0")
    balance = F.col("c_custkey").cast("string")
    dims.upsert(_customer_rows(back, "c_custkey", "update", id=id_text, balance=balance), 4)
    return dims.read("customer", apply_deletes=True)


@query
def dim_upsert_tied(fx: Fixtures) -> DataFrame:
    """Order changes by customer, ten orders to a sequence number: the later of a tie sets all that it carries."""
    dims = DimTables(fx.spark, f"{shared_dir(fx.spark)}/{uuid.uuid4().hex}")
    dims.create("customer", "id,name,segment,note")
    order = {"id": F.col("o_custkey").cast("string"), "name": F.concat(F.lit("name "), F.col("o_orderkey"))}
    entries = [x for name, value in order.items() for x in (F.lit(name), value)]
    # Each change carries one more column, by its key
    more = F.when(F.col("o_orderkey") % 2 == 0, "segment").otherwise("note")
    position = F.struct(F.lit(0).cast("long").alias("part"), F.col("o_orderkey").alias("offset"))
    rows = fx.table("orders").select(
        F.call_function("div", "o_orderkey", F.lit(10)).alias("seq"), position.alias("position"), F.lit("customer").alias("sink_table"),
        order["id"].alias("pk"), F.lit("update").alias("type"),
        F.create_map(*entries, more, F.concat(F.lit("by "), F.col("o_orderkey"))).alias("data"),
    )
    dims.upsert(rows, 0)
    dims.compact("customer")
    return dims.read("customer")


@query
def cdc_rules_tied(fx: Fixtures) -> DataFrame:
    """Rules in force where a hundred changes have one time and their order decides."""
    position = F.struct(F.lit(0).cast("long").alias("part"), F.col("ts").alias("offset"))
    tied = fx.rule_changes().withColumn("position", position).withColumn("ts", F.call_function("div", "ts", F.lit(100)))
    return cdc.current_rules(tied, ["ts", "position"])


# Logs ------------------------------------------------------------------------


@query
def new_visitor_repair(fx: Fixtures) -> DataFrame:
    repaired = logs.repair_new_visitors(fx.logs())
    return repaired.select("event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))


#: What a message of the split holds, fields that no schema knows included.
MESSAGE = """ts STRING, common STRUCT<is_new: STRING, uid: STRING, os: STRING>, page STRUCT<page_id: STRING, source_type: STRING>,
    page_id STRING, actions ARRAY<STRUCT<action_id: STRING>>, err STRUCT<code: STRING>, item STRING, item_type STRING,
    order STRING, display_type STRING"""


def message_fields(messages: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the fields of the messages in ``value``, each parsed once."""
    counted = messages.withColumn("n_fields", F.size(F.json_object_keys("value")).cast("long"))
    return evaluate_once(counted, F.from_json("value", MESSAGE), [*keep, "n_fields"]).select(
        *keep,
        F.col("ts").cast("long").alias("ts"),
        "common.is_new",
        "common.uid",
        "common.os",
        F.coalesce("page.page_id", "page_id").alias("page_id"),
        "page.source_type",
        F.get("actions", F.lit(0))["action_id"].alias("action"),
        F.col("err.code").cast("long").alias("error"),
        "item",
        "item_type",
        F.col("order").cast("long").alias("shown_order"),
        "display_type",
        "n_fields",
    )


@query
def log_split(fx: Fixtures) -> DataFrame:
    """Every output message of the split, by topic, with all its fields."""
    decoded, _ = split_corrupt(logs.decode_logs(fx.whole_logs(), keep_text=True))
    messages = logs.log_outputs(logs.repair_new_visitors(decoded), "event_id")
    return message_fields(messages, "event_id", "topic")


@query
def display_explode(fx: Fixtures) -> DataFrame:
    return logs.split_logs(fx.logs()).display


@query
def unique_visitors(fx: Fixtures) -> DataFrame:
    first = visitors.unique_visitors(_pages(fx))
    return first.select(
        F.col("common.mid").alias("mid"),
        tu.ms_to_day("ts").alias("day"),
        "event_id",
        F.col("common.is_new").alias("is_new"),
    )


@query
def user_bounce(fx: Fixtures) -> DataFrame:
    out = visitors.bounces(_pages(fx), BOUNCE_SECONDS)
    return out.select("event_id", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")


@query
def pattern_match(fx: Fixtures) -> DataFrame:
    """Entry pages followed by a product page within the limit, with the time between."""
    pages = logs.visit_columns(logs.page_logs(fx.logs()))
    entry, opened = visitors.is_entry_page(), F.col("page.page_id") == measures.PRODUCT_PAGE
    pairs = patterns.followed_by(pages, visitors.MID, entry, opened, BOUNCE_SECONDS, patterns.MATCHED)
    return pairs.select(
        "event_id", F.col("next.event_id").alias("next_event_id"), (F.col("next.ts") - F.col("ts")).alias("gap_ms")
    )


# Wide facts --------------------------------------------------------------------


@query
def order_wide_join(fx: Fixtures) -> DataFrame:
    return _joined(fx).drop("create_ts")


@query
def dim_join_left(fx: Fixtures) -> DataFrame:
    """Order lines with the sku's name: a generic left dimension join with misses."""
    lines = fx.details().select("id", "sku_id", "sku_num")
    return joins.dim_join(lines, fx.skus(), "sku_id", {"name": F.upper("sku_name"), "price": "price"})


@query
def enrich_user(fx: Fixtures) -> DataFrame:
    return wide.with_user(fx.orders().select("id", "user_id"), fx.users(), _as_of())


@query
def enrich_province(fx: Fixtures) -> DataFrame:
    return wide.with_province(fx.orders().select("id", "province_id"), fx.provinces())


@query
def enrich_sku(fx: Fixtures) -> DataFrame:
    return wide.with_sku(fx.details().select("id", "sku_id"), fx.skus(), names=True)


def _with_sku(fx: Fixtures) -> DataFrame:
    return wide.with_sku(fx.details().select("id", "sku_id"), fx.skus())


@query
def enrich_spu(fx: Fixtures) -> DataFrame:
    return wide.with_spu(_with_sku(fx).select("id", "spu_id"), fx.spus())


@query
def enrich_category3(fx: Fixtures) -> DataFrame:
    return wide.with_category3(_with_sku(fx).select("id", "category3_id"), fx.categories())


@query
def enrich_trademark(fx: Fixtures) -> DataFrame:
    return wide.with_trademark(_with_sku(fx).select("id", "tm_id"), fx.trademarks())


@query
def order_wide(fx: Fixtures) -> DataFrame:
    return _order_wide(fx).drop("create_ts")


@query
def payment_wide(fx: Fixtures) -> DataFrame:
    return _payment_wide(fx, _order_wide(fx)).drop("callback_ts")


@query
def merge_partial_rows(fx: Fixtures) -> DataFrame:
    """Orders that are not open and orders that are not finished, each with part of the columns."""
    columns = ["order_status", "user_id", "total_amount", "create_time"]
    wide_rows = fx.orders().select(F.col("id").alias("order_id"), *columns)
    partial = F.col("order_status") == "P"
    known = F.when(~partial, F.col("total_amount"))
    left = wide_rows.where(F.col("order_status") != "O").withColumn("total_amount", known)
    right = wide_rows.where(F.col("order_status") != "F").withColumn("order_status", F.lit("1001")).drop("user_id")
    return joins.merge_partial_rows([left, right], ["order_id"])


# Statistics ----------------------------------------------------------------------


@query
def tumbling_counts(fx: Fixtures) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("events"), F.sum("during").alias("during")]
    rows = fx.raw_events().withColumn("during", F.round(F.col("value") * 1000).cast("long"))
    return stats.tumbling(rows, ["event_type"], aggregates, EVENT_WINDOW)


@query
def visitor_stats(fx: Fixtures) -> DataFrame:
    all_logs = fx.logs()
    pages = logs.visit_columns(logs.page_logs(all_logs))
    union = measures.visitor_union(pages, visitors.unique_visitors(pages), visitors.bounces(pages, BOUNCE_SECONDS))
    repaired = logs.repair_measures(union, logs.first_visits(all_logs))
    return stats.visitor_stats(repaired, EVENT_WINDOW)


def _totals(df: DataFrame, names: list[str], window: str = ORDER_WINDOW) -> DataFrame:
    return stats.tumbling(df, ["sku_id"], [F.sum(n).alias(n) for n in names], window)


@query
def product_clicks(fx: Fixtures) -> DataFrame:
    return _totals(measures.clicks(logs.page_logs(fx.logs())), ["click_ct"])


@query
def product_displays(fx: Fixtures) -> DataFrame:
    return _totals(measures.displays(logs.page_logs(fx.logs())), ["display_ct"])


@query
def product_comments(fx: Fixtures) -> DataFrame:
    return _totals(measures.comments(fx.comments()), ["comment_ct", "good_comment_ct"])


@query
def product_orders(fx: Fixtures) -> DataFrame:
    rows = measures.ordered(_joined(fx))
    ids = {"order_id": "order_ct"}
    return stats.distinct_per_window(rows, ["sku_id"], ids, ["order_sku_num", "order_amount"], ORDER_WINDOW)


@query
def distinct_orders(fx: Fixtures) -> DataFrame:
    """Distinct orders, refunded orders and quantities per sku and day, over all order lines."""
    lines = fx.details().select("sku_id", "order_id", "sku_num", F.col("create_ts").alias("event_time"))
    return stats.distinct_per_window(lines, ["sku_id"], {"order_id": "order_ct"}, ["sku_num"], ORDER_WINDOW)


@query
def product_union(fx: Fixtures) -> DataFrame:
    rows = _product_measures(fx)
    return rows.select(F.unix_millis("event_time").alias("ts"), *[c for c in rows.columns if c != "event_time"])


@query
def product_stats(fx: Fixtures) -> DataFrame:
    return stats.product_stats(_product_measures(fx), ORDER_WINDOW)


@query
def product_stats_wide(fx: Fixtures) -> DataFrame:
    return stats.product_stats_wide(stats.product_stats(_product_measures(fx), ORDER_WINDOW), fx.dimensions())
