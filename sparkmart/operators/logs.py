"""Application logs: decoding, new-visitor repair and splitting."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import CORRUPT, parse_json, to_json_text
from sparkmart.operators.joins import reshuffled_key

# Topics of the split logs.
PAGE_TOPIC = "dwd_page_log"
START_TOPIC = "dwd_start_log"
DISPLAY_TOPIC = "dwd_display_log"

CLAIM = "common.is_new"
#: The text a log was read from, with fields that no schema knows.
RAW = "raw"


def decode_logs(raw: DataFrame, value: str = "value", keep_text: bool = False) -> DataFrame:
    """Log text to typed rows with an ``event_time``; bad text in ``_corrupt_record``.

    ``keep_text`` keeps the text in ``raw``, for outputs that forward whole logs.

    The new-visitor flag is read from either of its two spellings into
    ``common.is_new``.  A log without an ``event_id`` gets a hash of its text, so
    that equal timestamps always sort the same way.
    """
    parsed = parse_json(raw, schemas.LOG, value, keep=(value,))
    common = F.col("common")
    flag = F.coalesce(common["is_new"], common["isNew"])
    return parsed.select(
        F.when(common.isNotNull(), common.withField("is_new", flag).dropFields("isNew")).alias("common"),
        "page",
        "displays",
        "start",
        "ts",
        F.coalesce("event_id", F.xxhash64(value)).alias("event_id"),
        tu.ms_to_timestamp("ts").alias("event_time"),
        *([F.col(value).alias(RAW)] if keep_text else []),
        CORRUPT,
    )


def encode_logs(logs: DataFrame, *keep: str) -> DataFrame:
    """Typed logs back to JSON text in ``value`` (inverse of :func:`decode_logs`)."""
    fields = ("common", "page", "displays", "start", "ts", "event_id")
    return logs.select(*keep, to_json_text(*fields).alias("value"))


def first_visits(logs: DataFrame) -> DataFrame:
    """Earliest time per visitor among the rows that claim a new visitor.

    A partial aggregate: however many rows a visitor has, each map task sends one.
    """
    return (
        logs.where(F.col(CLAIM) == "1")
        .groupBy(F.col("common.mid").alias("mid"))
        .agg(F.min("ts").alias("first_ts"))
    )


def _with_first_visit(df: DataFrame, mid: str, firsts: DataFrame) -> DataFrame:
    known = firsts.select(reshuffled_key(firsts, "mid").alias("_mid"), F.col("first_ts").alias("_first_ts"))
    return df.join(known, F.col(mid) == F.col("_mid"), "left").drop("_mid")


def _wrong_claim(flag: str, day: Column) -> Column:
    return (F.col(flag) == "1") & (day != tu.ms_to_date("_first_ts"))


def _open(value: Column) -> Column:
    """JSON text as a map whose values are whatever they were."""
    return F.from_json(value, "map<string,variant>")


def _with_flag(raw: Column, flag: str) -> Column:
    """The log's text with another new-visitor flag, and everything else as it was."""

    def patch(log: Column) -> Column:
        kept = F.map_filter(log["common"].cast("map<string,variant>"), lambda k, _: ~k.isin("is_new", "isNew"))
        common = F.to_variant_object(F.map_concat(kept, F.create_map(F.lit("is_new"), F.lit(flag).cast("variant"))))
        return F.to_json(
            F.map_concat(F.map_filter(log, lambda k, _: k != "common"), F.create_map(F.lit("common"), common))
        )

    return F.transform(F.array(_open(raw)), patch)[0]  # the parsed text is used twice


def repair_new_visitors(logs: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Set ``is_new`` to 0 where a visitor already came on another day.

    A visitor's first row with flag 1 fixes the day; flag 1 on any other day is
    wrong.  Rows with another flag are not touched and fix no day.  ``firsts``
    overrides the first visits found in ``logs`` itself.

    An aggregate joined back rather than a window per visitor: one visitor may
    own a large share of the log, and a window would put all of it in one task,
    while the skewed side of a join is split.
    """
    joined = _with_first_visit(logs, "common.mid", first_visits(logs) if firsts is None else firsts)
    wrong = _wrong_claim(CLAIM, tu.ms_to_date("ts"))
    common = F.when(wrong, F.col("common").withField("is_new", F.lit("0"))).otherwise(F.col("common"))
    repaired = {"common": common}
    if RAW in logs.columns:
        repaired[RAW] = F.when(wrong, _with_flag(F.col(RAW), "0")).otherwise(F.col(RAW))
    return joined.withColumns(repaired).drop("_first_ts")


def repair_measures(measures: DataFrame, firsts: DataFrame) -> DataFrame:
    """The repair on measure rows (``mid``, ``is_new``, ``event_time``).

    Neither unique visits nor bounces depend on the flag, so it can be repaired once
    after their union instead of in each of the branches.
    """
    wrong = _wrong_claim("is_new", F.to_date("event_time"))
    repaired = F.when(wrong, "0").otherwise(F.col("is_new"))
    return _with_first_visit(measures, "mid", firsts).withColumn("is_new", repaired).drop("_first_ts")


def is_start() -> Column:
    """A log with a non-empty ``start`` object is a start log and nothing else."""
    return F.coalesce(F.size("start") > 0, F.lit(False))


class SplitLogs(NamedTuple):
    start: DataFrame
    page: DataFrame
    display: DataFrame


def page_logs(logs: DataFrame) -> DataFrame:
    return logs.where(~is_start())


def visit_columns(pages: DataFrame) -> DataFrame:
    """Only what visitor statistics read, so that nothing else is shuffled."""
    page = F.struct("page.page_id", "page.last_page_id", "page.during_time").alias("page")
    return pages.select("common", page, "ts", "event_id", "event_time")


def explode_displays(pages: DataFrame) -> DataFrame:
    """One row per display of a page log, with the page's id and time."""
    return pages.select(F.explode("displays").alias("d"), F.col("page.page_id"), "ts", "event_id").select(
        "d.item", "d.item_type", "page_id", "ts", "event_id"
    )


def split_logs(logs: DataFrame) -> SplitLogs:
    """Start logs, page logs, and the displays of page logs."""
    pages = page_logs(logs)
    return SplitLogs(logs.where(is_start()), pages, explode_displays(pages))


def log_outputs(logs: DataFrame, *keep: str) -> DataFrame:
    """All three outputs in one pass: (topic, value) rows, ready for a topic sink.

    Each log yields its own start or page message and, on a page, one message
    per display.  A single scan feeds every topic, so nothing needs caching.
    Where the logs have their text (``raw``), it is forwarded, and a display with all
    its fields; otherwise the messages have the fields of the schema.
    """
    whole = RAW in logs.columns
    own = F.col(RAW) if whole else to_json_text("common", "page", "displays", "start", "ts", "event_id")
    message = schemas.row(topic=schemas.TEXT, value=schemas.TEXT)

    def record(topic: str, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), value.alias("value")).cast(message)

    def display(d: Column) -> Column:
        fields = d["item"].alias("item"), d["item_type"].alias("item_type")
        page_id, ts = F.col("page.page_id").alias("page_id"), F.col("ts").alias("ts")
        return record(DISPLAY_TOPIC, to_json_text(*fields, page_id, ts))

    def whole_display(d: Column) -> Column:
        added = F.create_map(
            F.lit("page_id"), F.col("page.page_id").cast("variant"), F.lit("ts"), F.col("ts").cast("variant")
        )
        kept = F.map_filter(d, lambda k, _: ~k.isin("page_id", "ts"))
        return record(DISPLAY_TOPIC, F.to_json(F.map_concat(kept, F.map_filter(added, lambda _, v: v.isNotNull()))))

    shown = F.transform("displays", display)
    if whole:
        shown = F.transform(F.from_json(RAW, "displays array<map<string,variant>>")["displays"], whole_display)
    displays = F.coalesce(shown, F.array().cast(T.ArrayType(message)))
    records = F.when(is_start(), F.array(record(START_TOPIC, own))).otherwise(
        F.concat(F.array(record(PAGE_TOPIC, own)), displays)
    )
    return logs.select(*keep, F.inline(records))
