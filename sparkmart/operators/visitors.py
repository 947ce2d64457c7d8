"""Daily unique visitors and single-page bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import timeutil as tu
from sparkmart.operators.patterns import followed_by
from sparkmart.sources.cdc import first_row_per_key

MID = "common.mid"


def is_entry_page() -> Column:
    """The visitor came from outside: there is no previous page."""
    return F.col("page.last_page_id").isNull()


def is_real_page() -> Column:
    page_id = F.col("page.page_id")
    return page_id.isNotNull() & (F.length(page_id) > 0)


def unique_visitors(pages: DataFrame) -> DataFrame:
    """First entry page of each visitor on each day.

    Only the first row of a group is kept, so Spark applies the limit before the
    shuffle too and a hot visitor costs one row per task and day.
    """
    per_day = [F.col(MID), tu.ms_to_date("ts")]
    return first_row_per_key(pages.where(is_entry_page()), per_day, [F.col("ts"), F.col("event_id")])


def unique_visitors_stream(pages: DataFrame, delay: str = "2 days") -> DataFrame:
    """Streaming form, for output mode ``update``: emitted when a visitor's day is first seen.

    The row is the first of its group by time in the micro-batch that opens the
    group; later batches find the group open and emit nothing.  A group's state is
    dropped once the watermark, ``delay`` behind the latest day, has passed its day.
    Partial aggregation leaves one row per task of a hot visitor's day.
    """
    now = F.current_timestamp()  # the same for all rows of a micro-batch, also when it is run again
    first = (
        pages.where(is_entry_page())
        .select(
            F.col(MID).alias("_mid"),
            F.date_trunc("day", F.col("event_time")).alias("_day"),
            F.struct("*").alias("_page"),
            now.alias("_seen"),
        )
        .withWatermark("_day", delay)
        .groupBy("_mid", "_day")
        .agg(
            F.min_by("_page", F.struct("_page.ts", "_page.event_id")).alias("_page"),
            F.min("_seen").alias("_opened"),
        )
    )
    return first.where(F.col("_opened") == now).select("_page.*")


def bounces(pages: DataFrame, within_seconds: int = 10) -> DataFrame:
    """Entry pages after which the visitor opened nothing within the limit."""
    return followed_by(pages, MID, is_entry_page(), is_real_page(), within_seconds)
