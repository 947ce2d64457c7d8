"""Tables at rest: parquet folders, JDBC tables, dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.cdc import first_row_per_key

DEFAULT_KEY = "id"

#: Bytes of a table that one task reads; JSON made of them takes many times as much.
TASK_BYTES = 8 * 2**20


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A parquet table; a given ``schema`` (DDL) saves the job that would read it from a file."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def tasks_for(spark: SparkSession, size_in_bytes: int) -> int:
    """Tasks for so many bytes of a table: one for each core, and no more than `TASK_BYTES` for one."""
    return max(spark.sparkContext.defaultParallelism, -(-size_in_bytes // TASK_BYTES))


def balanced(df: DataFrame, *keys: str, size: int = 0) -> DataFrame:
    """Spread the scan of a table of ``size`` bytes by ``keys`` if it has fewer tasks than `tasks_for` it.

    One row group is read by one task, which would then do all work up to the next
    shuffle.  A table of many row groups has its tasks already and is left alone.
    """
    wanted = tasks_for(df.sparkSession, size)
    tasks = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if tasks >= wanted else df.repartition(wanted, *keys)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; pass partitionColumn, lowerBound, upperBound and numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def dim_lookup(dim: DataFrame, where: Mapping[str, object] | object, order: Sequence[str] = ()) -> DataFrame:
    """The row with the given key values, or the first by ``order`` if there are several.

    A plain value is looked up in the default key column ``id``.
    """
    wanted = where if isinstance(where, Mapping) else {DEFAULT_KEY: where}
    found = dim
    for name, value in wanted.items():
        found = found.where(F.col(name) == F.lit(value))
    return found.orderBy(*order).limit(1) if order else found.limit(1)


def first_per_key(dim: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The lookup for all keys at once: one row per key, first by ascending ``order``.

    Gives a raw table the one-row-per-key form that dimension joins expect.
    """
    return first_row_per_key(dim, keys, [F.col(o).asc() for o in order])
