"""Two-event sequences per key: a first event, the event right after it, a time limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCHED = "matched"
TIMED_OUT = "timed_out"


def timed_out(
    df: DataFrame,
    key: Column | str,
    first: Column,
    within_seconds: int = 10,
    time: str = "event_time",
    tie: str = "event_id",
) -> DataFrame:
    """Rows satisfying ``first`` after which the key has no event within the limit.

    Time is cut into slices as long as the limit.  All but the last event of a
    slice are followed in time, so only the last one can time out, and whether it
    does depends on the first event of the next slice alone.  Both facts come from
    one aggregate over windows of two slices: no event ordering, no self join, and
    a hot key shrinks to a row per slice before the shuffle.

    On a stream this is an append-mode window aggregate: a row comes out once
    the watermark has passed the end of the slice after its own.
    """
    names = df.columns
    seconds = int(within_seconds)
    limit = F.expr(f"INTERVAL {seconds} SECONDS")
    events = df.select(
        "*",
        (F.col(key) if isinstance(key, str) else key).alias("_key"),
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.window(time, f"{2 * seconds} seconds", f"{seconds} seconds").alias("_slice"),
    )
    # An event is in its own slice in the first half of a window and the next slice's
    # in the second half.  Only a first event can come out, so only it carries its row.
    own = F.col(time) < F.col("_slice.start") + limit
    next_slice = F.col(time) >= F.col("_slice.end") - limit
    slices = (
        events.select(
            "_key",
            "_slice",
            F.when(F.col("_first"), F.struct(*names)).alias("_row"),
            F.when(own, F.struct(time, tie)).alias("_at"),
            F.when(next_slice, F.col(time)).alias("_later"),
        )
        .groupBy("_key", "_slice")
        .agg(F.max_by("_row", "_at").alias("_last"), F.min("_later").alias("_next_time"))
    )
    alone = F.col("_next_time").isNull() | (F.col("_next_time") - F.col(f"_last.{time}") >= limit)
    return slices.where(F.col("_last").isNotNull() & alone).select("_last.*")


def matched(
    df: DataFrame,
    key: Column | str,
    first: Column,
    follow: Column,
    within_seconds: int = 10,
    time: str = "event_time",
    tie: str = "event_id",
    slices: int = 32,
) -> DataFrame:
    """Pairs of a ``first`` event and the event right after it, if that is a ``follow`` in time.

    Returns the row of the first event plus a struct ``next`` with the following
    row.  Rows are ordered inside buckets of ``slices`` time limits; a row near the
    start of a bucket is also put into the bucket before it, as a possible
    follower.  A key's history is thereby spread over many tasks.

    A stream needs a watermark on ``time``.  There the rows of a key and two time limits wait in its
    state, as an earlier one may still come, and a pair comes out once the watermark has
    passed the end of the slice after its first row; see `_stream_pairs`.
    """
    if df.isStreaming:
        return _stream_pairs(df, key, first, follow, within_seconds, time, tie)
    names = df.columns
    width = int(within_seconds) * slices * 1_000_000
    limit = int(within_seconds) * 1_000_000
    micros = F.unix_micros(time)
    offset = F.pmod(micros, F.lit(width))
    home = F.call_function("div", micros - offset, F.lit(width))
    early = offset < limit
    keyed = df.select(
        "*",
        (F.col(key) if isinstance(key, str) else key).alias("_key"),
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.coalesce(follow, F.lit(False)).alias("_follow"),
        home.alias("_home"),
        F.explode(F.when(early, F.array(home, home - 1)).otherwise(F.array(home))).alias("_bucket"),
    )
    order = Window.partitionBy("_key", "_bucket").orderBy(time, tie)
    following = F.lead(F.struct(*names, "_follow")).over(order)
    paired = keyed.withColumn("_next", following).where(
        (F.col("_home") == F.col("_bucket"))
        & F.col("_first")
        & F.col("_next._follow")
        & (F.unix_micros(F.col(f"_next.{time}")) - micros < limit)
    )
    return paired.select(*names, F.col("_next").dropFields("_follow").alias("next"))


def _stream_pairs(
    df: DataFrame, key: Column | str, first: Column, follow: Column, within_seconds: int, time: str, tie: str
) -> DataFrame:
    """`matched` on a stream: the follower is in the slice of the first event or in the next one, as in `timed_out`.

    The events of a key and two slices wait in the state of an aggregate; only rows that may come out
    are kept whole.
    """
    names, seconds = df.columns, int(within_seconds)
    events = df.select(
        "*",
        (F.col(key) if isinstance(key, str) else key).alias("_key"),
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.coalesce(follow, F.lit(False)).alias("_follow"),
        F.window(time, f"{2 * seconds} seconds", f"{seconds} seconds").alias("_slice"),
    )
    # A pair comes out of the window that has its first event in the first half.
    opens = F.col("_first") & (F.col(time) < F.col("_slice.start") + F.expr(f"INTERVAL {seconds} SECONDS"))
    event = F.struct(
        F.unix_micros(time).alias("at"), F.col(tie).alias("tie"), opens.alias("first"), F.col("_follow").alias("follow"),
        F.when(opens | F.col("_follow"), F.struct(*names)).alias("row"),
    )
    grouped = events.groupBy("_key", "_slice").agg(F.collect_list(event).alias("_events"))
    order = F.array_sort(
        F.transform("_events", lambda e, i: F.struct(e["at"].alias("at"), e["tie"].alias("tie"), i.alias("i"), e["first"].alias("first"), e["follow"].alias("follow")))
    )

    def pair(a: Column, b: Column) -> Column:
        matches = a["first"] & b["follow"] & (b["at"] - a["at"] < seconds * 1_000_000)
        return F.when(matches, F.struct(a["i"].alias("i"), b["i"].alias("j")))

    def pairs(line: Column) -> Column:
        return F.filter(F.zip_with(line, F.slice(line, 2, F.size(line)), pair), lambda p: p.isNotNull())

    found = F.transform(F.array(order), pairs)[0]  # the order is used twice
    some = F.exists("_events", lambda e: e["first"]) & (F.size("_events") > 1)
    rows = grouped.where(some).select("_events", F.explode(found).alias("_pair"))
    rows = rows.select(*(F.get("_events", F.col(f"_pair.{n}"))["row"].alias(c) for n, c in (("i", "_row"), ("j", "next"))))
    return rows.select("_row.*", "next")


def followed_by(
    df: DataFrame,
    key: Column | str,
    first: Column,
    follow: Column,
    within_seconds: int = 10,
    emit: str = TIMED_OUT,
    time: str = "event_time",
    tie: str = "event_id",
) -> DataFrame:
    """``first`` strictly followed by ``follow`` within a time limit, per key.

    ``emit="matched"`` returns the pairs, ``emit="timed_out"`` the first events
    whose time ran out.  A following event that fails ``follow`` breaks the pattern:
    its first event is in neither output.
    """
    if emit == TIMED_OUT:
        return timed_out(df, key, first, within_seconds, time, tie)
    if emit == MATCHED:
        return matched(df, key, first, follow, within_seconds, time, tie)
    raise ValueError(f"emit must be {MATCHED!r} or {TIMED_OUT!r}, not {emit!r}")
