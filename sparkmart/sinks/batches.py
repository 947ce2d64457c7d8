"""Micro-batches as folders that appear whole and once.

``<root>/batch=<id>`` is written under a hidden name and then renamed.  A batch
that is run again after a failure finds its folder and writes nothing, so a
streaming query that publishes this way has each row exactly once, as long as
the file system renames a folder in one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources.files import exists, list_names, make_dir, rename

BATCH = "batch"
BUCKET = "bucket"

# Bytes of a row group, before compression: what a writer holds, and the least that one task of a reader takes.
ROW_GROUP = {"parquet.block.size": str(16 * 2**20)}


def publish_batch(df: DataFrame, root: str, batch_id: int, partition_by: Sequence[str] = ()) -> bool:
    """Write ``df`` as batch ``batch_id`` under ``root``; False if it is already there."""
    spark = df.sparkSession
    final = f"{root}/{BATCH}={batch_id}"
    if exists(spark, final):
        return False
    staging = f"{root}/_staging/{BATCH}={batch_id}"
    df.write.mode("overwrite").options(**ROW_GROUP).partitionBy(*partition_by).parquet(staging)
    rename(spark, staging, final)
    return True


def stage_batches(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> None:
    """Write the batches that the column ``batch`` names in one pass; `publish_staged` lets them appear one by one."""
    df.write.mode("overwrite").options(**ROW_GROUP).partitionBy(BATCH, *partition_by).parquet(f"{root}/_staging")


def publish_staged(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Let a staged batch appear; False if it has no rows or is already there."""
    staging, final = f"{root}/_staging/{BATCH}={batch_id}", f"{root}/{BATCH}={batch_id}"
    if not exists(spark, staging) or exists(spark, final):
        return False
    rename(spark, staging, final)
    return True


def batch_ids(spark: SparkSession, root: str) -> list[int]:
    """The ids of all batches under ``root``, ascending."""
    make_dir(spark, root)
    prefix = f"{BATCH}="
    return sorted(int(n.removeprefix(prefix)) for n in list_names(spark, root) if n.startswith(prefix))


def read_batches(
    spark: SparkSession, root: str, schema: T.StructType, before: int | None = None, after: int | None = None
) -> DataFrame:
    """Rows of all batches under ``root``, or of those between the given ids, with the column ``batch``.

    Only the folders of those batches are listed and opened.
    """
    make_dir(spark, root)
    with_batch = T.StructType(schema.fields + [T.StructField(BATCH, T.LongType(), True)])
    reader = spark.read.schema(with_batch).option("basePath", root)
    if before is None and after is None:
        return reader.parquet(root)
    wanted = [i for i in batch_ids(spark, root) if (before is None or i < before) and (after is None or i > after)]
    if not wanted:
        return spark.createDataFrame([], with_batch)
    return reader.parquet(*(f"{root}/{BATCH}={i}" for i in wanted))


def last_batch(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """The highest batch id under ``root``, or the highest below ``before``."""
    return max((i for i in batch_ids(spark, root) if before is None or i < before), default=None)


class Buckets:
    """The buckets of a keyed store: rows with equal keys are in one, whatever batch brought them.

    Their number is fixed by who uses the store first, and kept in it.
    """

    def __init__(self, spark: SparkSession, root: str, number: int):
        self.spark = spark
        self.root = f"{root}/layout"
        self._given, self._kept = number, None

    @property
    def number(self) -> int:
        if self._kept is None:
            make_dir(self.spark, self.root)
            found = [int(n.removeprefix("buckets=")) for n in list_names(self.spark, self.root) if n.startswith("buckets=")]
            if not found:
                make_dir(self.spark, f"{self.root}/buckets={self._given}")
            self._kept = min(found, default=self._given)
        return self._kept

    def of(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.number)).cast("int")

    def dealt(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with its bucket, each in one task."""
        return df.withColumn(BUCKET, self.of(key)).repartition(BUCKET)

    def holding(self, keys: DataFrame) -> list[int]:
        """The buckets of a one-column table of keys; no more than there are buckets come to the driver."""
        return sorted(r[0] for r in keys.select(self.of(keys.columns[0])).distinct().collect())


class Snapshots:
    """All rows up to a batch, by bucket; a newer snapshot has the buckets that changed only.

    ``<root>/batch=<id>/bucket=<b>``: the rows of bucket b up to batch id, if it changed since its last snapshot.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark = spark
        self.root = root
        self.schema = schema

    def upto(self, before: int | None = None) -> int | None:
        return last_batch(self.spark, self.root, before)

    def read(self, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """The newest rows of the buckets asked for, of all by default, with the column ``bucket``."""
        prefix, newest = f"{BUCKET}=", {}
        for batch in batch_ids(self.spark, self.root):
            if before is None or batch < before:
                names = list_names(self.spark, f"{self.root}/{BATCH}={batch}")
                newest |= {int(n.removeprefix(prefix)): batch for n in names if n.startswith(prefix)}
        schema = T.StructType(self.schema.fields + [T.StructField(BUCKET, T.IntegerType(), True)])
        wanted = sorted(newest) if buckets is None else [b for b in buckets if b in newest]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = (f"{self.root}/{BATCH}={newest[b]}/{prefix}{b}" for b in wanted)
        rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
        return rows.select(*schema.names)

    def publish(self, df: DataFrame, batch_id: int) -> bool:
        return publish_batch(df, self.root, batch_id, [BUCKET])


def in_buckets(buckets: Sequence[int] | None) -> Column:
    """Rows of the buckets, of any by default; rows that no bucket was written for may be in each."""
    return F.lit(True) if buckets is None else F.col(BUCKET).isin(*buckets) | F.col(BUCKET).isNull()


class AppendedTable:
    """A keyed table that a streaming query only appends to and reads back in later batches.

    ``changes/batch=<id>/bucket=<b>`` holds what a batch added, ``snapshots`` all rows up to a
    batch in few files.  A reader that has the keys it wants opens their buckets only.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, buckets: int = 16):
        self.spark = spark
        self.schema = schema
        self.key = schema.names[0]
        self.buckets = Buckets(spark, root, buckets)
        self.changes = f"{root}/changes"
        self.snapshots = Snapshots(spark, f"{root}/snapshots", schema)

    def append(self, df: DataFrame, batch_id: int) -> bool:
        rows = self.buckets.dealt(df.select(*self.schema.names), self.key)
        return publish_batch(rows, self.changes, batch_id, [BUCKET])

    def _changes(self, before: int | None, after: int | None) -> DataFrame:
        with_bucket = T.StructType(self.schema.fields + [T.StructField(BUCKET, T.IntegerType(), True)])
        return read_batches(self.spark, self.changes, with_bucket, before, after).select(*with_bucket.names)

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """All rows, or those of the batches before ``before``, as a batch that is run again must see them.

        ``keys``, one column: at least the rows of these keys.
        """
        buckets = None if keys is None else self.buckets.holding(keys)
        rows = self._changes(before, self.snapshots.upto(before)).where(in_buckets(buckets))
        return self.snapshots.read(buckets, before).unionByName(rows).select(*self.schema.names)

    def compact(self) -> bool:
        """Write the buckets anew that changed since the last snapshot; False if no batch came."""
        upto, done = last_batch(self.spark, self.changes), self.snapshots.upto()
        if upto is None or (done is not None and upto <= done):
            return False
        new = self._changes(upto + 1, done).withColumn(BUCKET, F.coalesce(BUCKET, self.buckets.of(self.key)))
        changed = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
        rows = self.snapshots.read(changed).unionByName(new)
        return self.snapshots.publish(rows.repartition(BUCKET), upto)
