"""Cleaning and rule-driven routing of change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.joins import bounded_broadcast, salted_left_join

# Sink types of the rule table, and the route each one means.
DIM_SINK = "hbase"
FACT_SINK = "kafka"
ROUTES = {DIM_SINK: "dim", FACT_SINK: "fact"}
BOOTSTRAP_INSERT = "bootstrap-insert"

DEFAULT_PK = "id"


def clean(records: DataFrame) -> DataFrame:
    """Keep records that name a table and carry data: more than an empty JSON object."""
    named = F.length("table") > 0
    data = F.col("data_text")
    return records.where(named & data.startswith("{") & (F.length(data) > 3))


def normalise_type(records: DataFrame) -> DataFrame:
    """Rows of an initial load count as inserts."""
    plain = F.when(F.col("type") == BOOTSTRAP_INSERT, "insert").otherwise(F.col("type"))
    return records.withColumn("type", plain)


def keep_columns(data: Column, sink_columns: Column) -> Column:
    """The entries of ``data`` whose names are in the comma list, compared exactly."""
    return F.map_filter(data, lambda name, _: F.array_contains(F.split(sink_columns, ","), name))


def route(records: DataFrame, rules: DataFrame, max_broadcast_rules: int = 10_000, salts: int = 64) -> DataFrame:
    """Add ``route`` (fact, dim or rejected), the rule's target and a ``reason`` for a rejection.

    ``data`` is cut down to the rule's columns.  There are few (table, operation)
    pairs, so joining by shuffle would put a third of the records into one task:
    the rules are broadcast after their number was checked, and a larger rule
    table is joined over salted keys.
    """
    keyed = rules.select(
        F.col("source_table").alias("table"),
        F.col("operate_type").alias("type"),
        "sink_type",
        "sink_table",
        "sink_columns",
        "sink_pk",
    )
    plain = normalise_type(records)
    small, fits = bounded_broadcast(keyed, max_broadcast_rules)
    if fits:
        joined = plain.join(small, ["table", "type"], "left")
    else:
        joined = salted_left_join(plain, keyed, ["table", "type"], "data_text", salts)
    targets = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    target = targets[F.coalesce("sink_type", F.lit(""))]
    reason = F.when(F.col("sink_type").isNull(), "no rule").when(target.isNull(), "unsupported sink type")
    kept = F.when(F.col("sink_columns").isNotNull(), keep_columns(F.col("data"), F.col("sink_columns")))
    return joined.select(
        *records.columns[: records.columns.index("data")],
        F.coalesce(kept, F.col("data")).alias("data"),
        *[c for c in records.columns[records.columns.index("data") + 1 :]],
        "sink_type",
        "sink_table",
        F.coalesce("sink_pk", F.lit(DEFAULT_PK)).alias("sink_pk"),
        F.coalesce(target, F.lit("rejected")).alias("route"),
        reason.alias("reason"),
    )


def fact_payloads(routed: DataFrame, *keep: str) -> DataFrame:
    """(topic, value) of every fact: its sink table and its data alone, without null fields.

    The values are taken from the record's text, so that numbers stay numbers.
    """
    typed = F.from_json("data_text", "MAP<STRING, VARIANT>")
    kept = F.map_filter(typed, lambda name, _: F.col("data")[name].isNotNull())
    return routed.where(F.col("route") == "fact").select(
        *keep, F.col("sink_table").alias("topic"), F.to_json(kept).alias("value")
    )


def dim_rows(routed: DataFrame, *keep: str) -> DataFrame:
    """(table, key, type, data) of every dimension change that carries data."""
    return routed.where((F.col("route") == "dim") & (F.size("data") > 0)).select(
        *keep, "sink_table", F.col("data")[F.col("sink_pk")].alias("pk"), "type", "data"
    )


def dim_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """Schema of a dimension table made from a rule: all text, the key not null."""
    pk = sink_pk or DEFAULT_PK
    return T.StructType([T.StructField(c, T.StringType(), c != pk) for c in sink_columns.split(",")])
