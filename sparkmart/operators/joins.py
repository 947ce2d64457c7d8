"""Join building blocks: interval join, dimension join, checked broadcast, merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.timeutil import col


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower_seconds: int,
    upper_seconds: int,
    salts: int = 1,
) -> DataFrame:
    """Inner join on equal keys with ``right_time`` in [left_time + lower, left_time + upper].

    Columns are reachable as ``l.*`` and ``r.*``.  In batch AQE splits a hot key.
    A stream has a fixed partitioning, so there ``salts`` > 1 spreads the right rows
    of a key over that many sub-keys and repeats the left rows for each.  On a
    stream both sides need a watermark, which then bounds the kept state.
    """
    on = [F.col(f"l.{left_key}") == F.col(f"r.{right_key}")]
    if salts > 1:
        left = left.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        row_hash = F.xxhash64(*[c for c in right.columns if not c.startswith("_")])
        right = right.withColumn("_salt", F.pmod(row_hash, F.lit(salts)).cast("int"))
        on.append(F.col("l._salt") == F.col("r._salt"))
    lower = F.expr(f"INTERVAL {int(lower_seconds)} SECONDS")
    upper = F.expr(f"INTERVAL {int(upper_seconds)} SECONDS")
    on.append(F.col(f"r.{right_time}") >= F.col(f"l.{left_time}") + lower)
    on.append(F.col(f"r.{right_time}") <= F.col(f"l.{left_time}") + upper)
    return left.alias("l").join(right.alias("r"), on, "inner")


def reshuffled_key(df: DataFrame, name: str) -> Column:
    """The key column ``name`` as an expression whose partitioning Spark does not know yet.

    AQE splits a hot key only where both inputs of a join come straight from an
    exchange.  A table grouped by its key has none left, as it is partitioned
    already.  With this key it is shuffled once more, one row per key, and the
    large side can be split.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.concat(F.col(name), F.lit(""))
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return F.col(name).bitwiseXOR(F.lit(0).cast(dtype))
    return F.col(name)


def dim_join(
    df: DataFrame, dim: DataFrame, key: Column | str, outputs: Mapping[str, Column | str], dim_key: str = "id"
) -> DataFrame:
    """Left join to a dimension with one row per ``dim_key``; every row of ``df`` stays.

    ``outputs`` maps new column names to expressions over the dimension.  A null
    key or a miss gives null attributes.

    No broadcast is forced: a dimension may have as many rows as there are users.
    Spark broadcasts it when its size is under ``autoBroadcastJoinThreshold``, at
    planning or at run time, and otherwise shuffles, splitting a hot key.
    """
    attributes = dim.select(
        reshuffled_key(dim, dim_key).alias("_dim_key"),
        *[col(expr).alias(f"_dim_{name}") for name, expr in outputs.items()],
    )
    joined = df.join(attributes, col(key) == F.col("_dim_key"), "left")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in outputs]
    return joined.select(*kept, *[F.col(f"_dim_{name}").alias(name) for name in outputs])


def bounded_broadcast(
    df: DataFrame, max_rows: int = 10_000, max_bytes: int = 64 * 2**20
) -> tuple[DataFrame, bool]:
    """(``df`` hinted for broadcast, True) if it is within both bounds, else (``df``, False).

    Rows and bytes, those of the rows as JSON, are summed in the tasks; no rows move.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, total = df.agg(F.count("*"), size).first()
    small = rows <= max_rows and (total or 0) <= max_bytes
    return (F.broadcast(df), True) if small else (df, False)


def salted_left_join(df: DataFrame, table: DataFrame, on: Sequence[str], salt_by: str, salts: int) -> DataFrame:
    """Left join for few, very hot keys: rows are spread over sub-keys, ``table`` is repeated.

    The sub-key is a hash of ``salt_by``, so a task that is run again sends every
    row to the same place.
    """
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*on, "_salt"], "left").drop("_salt")


def merge_partial_rows(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of partial rows: per key and column, the first non-null wins.

    Frames are listed by priority and hold one row per key; missing columns count
    as null.  A union with one partial aggregate, where a full outer join would
    need a shuffle per frame and could not split a hot key.
    """
    columns = list(dict.fromkeys(c for f in frames for c in f.columns if c not in keys))
    tagged = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    union = tagged[0]
    for frame in tagged[1:]:
        union = union.unionByName(frame, allowMissingColumns=True)

    def first_non_null(name: str) -> Column:
        per_frame = [
            F.max(F.when(F.col("_source") == i, F.col(name))) for i, f in enumerate(frames) if name in f.columns
        ]
        return F.coalesce(*per_frame).alias(name)

    return union.groupBy(*keys).agg(*[first_non_null(c) for c in columns])
