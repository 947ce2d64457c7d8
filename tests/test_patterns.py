import random

import pytest
from conftest import log
from pyspark.sql import functions as F

from sparkmart.operators import patterns, visitors


def bounced(df, seconds=10):
    return sorted(r.event_id for r in visitors.bounces(df, seconds).collect())


def test_golden_rows(logs_of):
    df = logs_of(
        log("101", 10000, event_id=1),
        log("102", 12000, event_id=2),
        log("102", 15000, "good_list", "home", event_id=3),
        log("102", 30000, "good_list", "detail", event_id=4),
    )
    assert bounced(df) == [1]


@pytest.mark.parametrize(
    "gap, page, expected",
    [
        (9_999, "next", []),
        (10_000, "next", [1]),
        (5_000, "", []),  # breaks the pattern without a time-out
        (0, "next", []),
    ],
)
@pytest.mark.parametrize("start", [0, 4_321, 9_999])
def test_limit(logs_of, start, gap, page, expected):
    df = logs_of(log("a", start, event_id=1), log("a", start + gap, page, "home", event_id=2))
    assert bounced(df) == expected


def test_an_entry_page_also_counts_as_the_next_event(logs_of):
    df = logs_of(log("a", 0, event_id=1), log("a", 1000, event_id=2))
    assert bounced(df) == [2]


def by_hand(rows, limit):
    """Matched pairs and timed-out rows by walking through each key in order."""
    matched, timed_out = [], []
    for key in {r[0] for r in rows}:
        line = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, (_, ts, event, first, _) in enumerate(line):
            if not first:
                continue
            follower = line[i + 1] if i + 1 < len(line) else None
            if follower is None or follower[1] - ts >= limit:
                timed_out.append(event)
            elif follower[4]:
                matched.append((event, follower[2]))
    return sorted(matched), sorted(timed_out)


@pytest.mark.parametrize("seed", range(4))
def test_against_walking_through(spark, seed):
    rng = random.Random(seed)
    limit = 10
    rows = [
        (rng.choice("aaaab"), rng.randrange(0, 700) * 1000, i, rng.random() < 0.5, rng.random() < 0.7) for i in range(150)
    ]
    df = spark.createDataFrame(rows, "key string, ms long, event_id long, first boolean, follow boolean")
    df = df.withColumn("event_time", F.timestamp_millis("ms"))
    matched, timed_out = by_hand(rows, limit * 1000)
    args = (df, "key", F.col("first"), F.col("follow"), limit)
    out = patterns.followed_by(*args, emit=patterns.TIMED_OUT)
    assert out.columns == df.columns
    assert sorted(r.event_id for r in out.collect()) == timed_out
    pairs = patterns.followed_by(*args, emit=patterns.MATCHED)
    assert sorted((r.event_id, r.next.event_id) for r in pairs.collect()) == matched
    # Bucket borders everywhere.
    pairs = patterns.matched(*args, slices=1)
    assert sorted((r.event_id, r.next.event_id) for r in pairs.collect()) == matched


def test_unknown_output(spark):
    with pytest.raises(ValueError):
        patterns.followed_by(spark.range(1), "id", F.lit(True), F.lit(True), emit="both")


def test_unique_visitors_take_the_first_entry_page(logs_of):
    day = 86_400_000
    df = logs_of(
        log("a", 50, event_id=1),
        log("a", 20, event_id=2),
        log("a", 10, "list", "home", event_id=3),
        log("a", day, event_id=4),
        log("b", 20, event_id=6),
        log("b", 20, event_id=5),
    )
    out = visitors.unique_visitors(df)
    assert sorted(r.event_id for r in out.collect()) == [2, 4, 5]


def test_unique_visitors_are_cut_before_the_shuffle(logs_of):
    plan = visitors.unique_visitors(logs_of(log("a", 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_bounces_are_aggregated_before_the_shuffle(logs_of):
    plan = visitors.bounces(logs_of(log("a", 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan[plan.index("Exchange") :]
