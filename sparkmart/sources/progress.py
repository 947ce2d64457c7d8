"""Event-time progress: messages that say how far a producer has come, beside the rows of its topics.

A consumer of several topics waits for the slowest one, so a topic without rows would stop it.  A
producing job therefore publishes with each batch, to all of its topics, the latest event time it has
seen.  Such a message is an ordinary row to whoever asks for it: it has the time fields of every kind
of message, and reserved ids that no row has.  So it passes a consumer's operators as rows do, and
comes out of a time-out or a join when the rows of its time have come out.  Readers that do not ask
for progress never see it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import to_json_text

#: The field that only progress has; it is the message's key, the time where it was first published.
MARK = "_progress"

_PREFIX = f'{{"{MARK}":'
#: Reserved ids: the least ones, one for each key.
_FIRST_ID = -(2**63)
_MID = f"{MARK}:"


def message(at: Column, key: Column) -> Column:
    """The text of a progress message: event time ``at`` (timestamp), ``key`` (milliseconds)."""
    ms, text, reserved = F.unix_millis(at), tu.timestamp_to_text(at), F.lit(_FIRST_ID) + key
    return to_json_text(
        key.alias(MARK),
        ms.alias("ts"),
        text.alias("create_time"),
        text.alias("callback_time"),
        reserved.alias("id"),
        reserved.alias("order_id"),
        F.struct(F.concat(F.lit(_MID), key).alias("mid")).alias("common"),
    )


def is_message(value: Column) -> Column:
    return F.coalesce(value.startswith(_PREFIX), F.lit(False))


def without(messages: DataFrame) -> DataFrame:
    return messages.where(~is_message(F.col("value")))


def messages(rows: DataFrame, time: Column, topics: Sequence[str]) -> DataFrame:
    """(topic, value): the latest ``time`` of ``rows`` for each topic; nothing if no row has one."""
    latest = rows.agg(F.max(time).alias("at")).where(F.col("at").isNotNull())
    told = latest.select(message(F.col("at"), F.unix_millis("at")).alias("value"))
    return told.select(F.explode(F.array(*map(F.lit, topics))).alias("topic"), "value")


def key_of_mid(mid: Column) -> Column:
    """The key of a progress message from its visitor id, null for a row."""
    return F.when(mid.startswith(_MID), F.substring(mid, len(_MID) + 1, 20).cast("long"))


def key_of_id(reserved: Column) -> Column:
    """The key of a progress message from its id, null for a row."""
    return F.when(reserved < _FIRST_ID // 2, reserved - _FIRST_ID)


def is_row(time: Column) -> Column:
    """Whether a row with the column ``MARK`` is none of progress.

    It reads ``time`` as well, so that the filter stays above a watermark on it, which progress must pass.
    """
    return F.when(time.isNull(), F.lit(True)).otherwise(F.col(MARK).isNull())
