"""Tumbling-window statistics per subject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.operators.measures import PRODUCT_IDS, PRODUCT_MEASURES, VISITOR_KEYS, VISITOR_MEASURES
from sparkmart.operators.wide import Dimensions, with_full_sku

# Fixed value: the result window.
WINDOW = "10 seconds"


def window_bounds(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by its bounds as text, ``stt`` and ``edt``."""
    bounds = [
        tu.timestamp_to_text("window.start").alias("stt"),
        tu.timestamp_to_text("window.end").alias("edt"),
    ]
    return df.select(*bounds, *[c for c in df.columns if c != "window"])


def tumbling(
    df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], window: str = WINDOW, time: str = "event_time"
) -> DataFrame:
    """Epoch-aligned tumbling windows per key, with text bounds.

    On a stream a window comes out once the watermark has passed its end; rows
    later than that are dropped.
    """
    grouped = df.groupBy(F.window(time, window).alias("window"), *keys).agg(*aggregates)
    return window_bounds(grouped)


def distinct_per_window(
    df: DataFrame,
    keys: Sequence[str],
    ids: dict[str, str],
    sums: Sequence[str] = (),
    window: str = WINDOW,
    time: str = "event_time",
) -> DataFrame:
    """Sums and exact distinct id counts per window and key.

    ``ids`` maps id columns to the names of their counts; a row may carry at most
    one non-null id.  The first aggregate is keyed by the ids as well, so it spreads
    a hot key over its ids and leaves one row per distinct id; the second only
    counts.  No id sets are kept, neither in a task nor in the state of a stream,
    where both aggregates run chained in append mode.
    """
    per_id = (
        df.select("*", F.window(time, window).alias("window"))
        .groupBy("window", *keys, *ids)
        .agg(*[F.sum(m).alias(m) for m in sums])
    )
    grouped = per_id.groupBy("window", *keys).agg(
        *[F.sum(m).alias(m) for m in sums], *[F.count(i).alias(name) for i, name in ids.items()]
    )
    return window_bounds(grouped)


def visitor_stats(measures: DataFrame, window: str = WINDOW) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in VISITOR_MEASURES]
    return tumbling(measures, VISITOR_KEYS, sums, window)


def product_stats(measures: DataFrame, window: str = WINDOW) -> DataFrame:
    return distinct_per_window(measures, ["sku_id"], PRODUCT_IDS, list(PRODUCT_MEASURES), window)


def product_stats_wide(stats: DataFrame, dims: Dimensions) -> DataFrame:
    """Product statistics with the sku's attributes.

    Joined after the aggregation: one lookup per window and sku, not per fact.
    """
    wide = with_full_sku(stats, dims, names=True)
    return wide.select(*[c for c in schemas.PRODUCT_STATS_COLUMNS if c != "ts"])


def stamped(stats: DataFrame) -> DataFrame:
    """Add the processing time as ``ts`` in milliseconds; only sinks need it."""
    return stats.withColumn("ts", F.unix_millis(F.current_timestamp()))
