"""Dimension tables: changes appended per batch, compacted into snapshots.

Layout under one root::

    changes/batch=<id>/sink_table=<table>/bucket=<b>/   upserts: seq, position, pk, type, data
    snapshots/<table>/batch=<id>/bucket=<b>/            a bucket as of that batch: pk, data, deleted
    columns/<table>/batch=<n>/                          names of the columns, as rules give them

An upsert appends its batch only; a reader takes the newest snapshots plus the
batches after them, and with keys it opens the buckets of these keys only.  No table
is rewritten per batch, and compaction rewrites the buckets that changed.  A change sets
the columns it carries and leaves the others, as an upsert by column does; a snapshot keeps
every column and the mark of a deleted row, so a reader finds the same before and after.

Changes are in total order: by batch, by ``seq``, then by their position in the source.  So
of two changes with equal ``seq`` the later one sets all of its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators.joins import bounded_broadcast
from sparkmart.operators.routing import dim_schema
from sparkmart.sinks.batches import BATCH, BUCKET, Buckets, Snapshots, in_buckets, last_batch, publish_batch, read_batches
from sparkmart.sources.files import list_names, make_dir
from sparkmart.sources.topics import POSITION, POSITION_TYPE

CHANGES = schemas.row(
    seq=schemas.LONG, position=POSITION_TYPE, pk=schemas.TEXT, type=schemas.TEXT, data=schemas.TEXT_MAP,
    sink_table=schemas.TEXT, bucket=schemas.INT,
)
SNAPSHOT = schemas.row(pk=schemas.TEXT, data=schemas.TEXT_MAP, deleted=schemas.LONG)
COLUMNS = schemas.row(name=schemas.TEXT, place=schemas.LONG)
DELETE = "delete"

# Keys are short text: a million of them take some tens of megabytes.
MAX_BROADCAST_KEYS = 1_000_000


class DimTables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root
        self.buckets = Buckets(spark, root, buckets)

    def _snapshots(self, table: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/snapshots/{table}", SNAPSHOT)

    def _columns(self, table: str) -> str:
        return f"{self.root}/columns/{table}"

    def columns(self, table: str) -> list[str]:
        """The columns of a table in the order in which rules brought them."""
        rows = read_batches(self.spark, self._columns(table), COLUMNS).collect()  # some tens of names
        return [r["name"] for r in sorted(rows, key=lambda r: (r[BATCH], r["place"]))]

    def create(self, table: str, sink_columns: str, sink_pk: str | None = None) -> bool:
        """Give a table the columns of a rule's list that it lacks, or make it; True if it was made."""
        known = self.columns(table)
        new = [n for n in dim_schema(sink_columns, sink_pk).names if n not in known]
        if new:
            rows = self.spark.createDataFrame([(n, i) for i, n in enumerate(new)], COLUMNS)
            last = last_batch(self.spark, self._columns(table))
            publish_batch(rows, self._columns(table), 0 if last is None else last + 1)
        return not known

    def tables(self) -> list[str]:
        make_dir(self.spark, f"{self.root}/columns")
        return sorted(n for n in list_names(self.spark, f"{self.root}/columns") if not n.startswith("_"))

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Append a batch of changes: ``seq``, ``sink_table``, ``pk``, ``type``, ``data``, and ``position`` if known.

        Without positions the order of the rows counts.  A change without a key belongs to no row;
        it is kept for `rejected`.
        """
        if POSITION not in rows.columns:
            place = F.struct(F.lit(0).cast("long").alias("part"), F.monotonically_increasing_id().alias("offset"))
            rows = rows.withColumn(POSITION, place)
        dealt = self.buckets.dealt(rows, "pk").select(*CHANGES.names)
        return publish_batch(dealt, f"{self.root}/changes", batch_id, ["sink_table", BUCKET])

    def rejected(self, table: str) -> DataFrame:
        """Changes that have no key."""
        rows = read_batches(self.spark, f"{self.root}/changes", CHANGES)
        return rows.where((F.col("sink_table") == table) & F.col("pk").isNull())

    def _versions(self, table: str, buckets: Sequence[int] | None = None, after: int | None = None) -> DataFrame:
        """Snapshot rows and later changes as (bucket, pk, at, type, data); ``at`` orders them."""
        changes = read_batches(self.spark, f"{self.root}/changes", CHANGES, after=after)
        own = (F.col("sink_table") == table) & F.col("pk").isNotNull() & in_buckets(buckets)
        rows = changes.where(own).select(
            F.coalesce(BUCKET, self.buckets.of("pk")).alias(BUCKET), "pk", F.struct(BATCH, "seq", POSITION).alias("at"), "type", "data"
        )
        first = F.struct(
            F.lit(-1 if after is None else after).cast("long").alias(BATCH), F.lit(None).cast("long").alias("seq"),
            F.lit(None).cast(POSITION_TYPE).alias(POSITION),
        )
        kind = F.when(F.col("deleted") == 1, DELETE).otherwise("snapshot").alias("type")
        return self._snapshots(table).read(buckets).select(BUCKET, "pk", first.alias("at"), kind, "data").unionByName(rows)

    def read(
        self,
        table: str,
        pk: str = "id",
        columns: Sequence[str] = (),
        apply_deletes: bool = False,
        keys: DataFrame | None = None,
    ) -> DataFrame:
        """The table's current rows as text columns.

        Each column has the value of the last change that carries it.  A deleted row stays, with its
        last image, unless ``apply_deletes``, which also forgets what was set before the
        deletion.  ``columns`` is needed only for a table that was never created.  ``keys``
        is one column of key values: only their buckets are opened, and of these their rows are
        taken, so that the cost of a small batch follows the batch and not the table.
        """
        columns = list(dict.fromkeys([*self.columns(table), *columns]))
        rows = self._versions(table, None if keys is None else self.buckets.holding(keys), self._snapshots(table).upto())
        if keys is not None:
            wanted = bounded_broadcast(keys.toDF("_wanted").distinct(), MAX_BROADCAST_KEYS)[0]
            rows = rows.join(wanted, F.col("pk") == F.col("_wanted"), "left_semi")

        def last(name: str) -> Column:
            value = F.struct("at", F.col("data")[name].alias("value"))
            return F.max(F.when(F.map_contains_key("data", name), value)).alias(f"_{name}")

        ends = [
            F.max(F.when(F.col("type") == DELETE, F.col("at"))).alias("deleted_at"),
            F.max(F.struct("at", "type")).alias("newest"),
        ]
        current = rows.groupBy("pk").agg(*ends, *[last(c) for c in columns])
        if apply_deletes:
            current = current.where(F.col("newest.type") != DELETE)

        def value(name: str) -> Column:
            found = F.col(f"`_{name}`")
            seen = F.col("deleted_at").isNull() | (found["at"] > F.col("deleted_at"))
            text = F.when(seen, found["value"]) if apply_deletes else found["value"]
            return (F.coalesce(text, F.col("pk")) if name == pk else text).alias(name)

        return current.select(*[value(c) for c in columns])

    def compact(self, table: str) -> bool:
        """Write the buckets anew that changed since the last snapshot; False if no batch came.

        Every column is kept, whether a rule names it or not, and deleted rows keep their mark.
        """
        upto, done = last_batch(self.spark, f"{self.root}/changes"), self._snapshots(table).upto()
        if upto is None or (done is not None and upto <= done):
            return False
        new = read_batches(self.spark, f"{self.root}/changes", CHANGES, after=done)
        own = new.where((F.col("sink_table") == table) & F.col("pk").isNotNull())
        changed = sorted(r[0] for r in own.select(F.coalesce(BUCKET, self.buckets.of("pk"))).distinct().collect())
        rows = self._versions(table, changed, done)
        newest = rows.groupBy(BUCKET, "pk").agg(F.max(F.struct("at", "type")).alias("newest"))
        values = rows.select(BUCKET, "pk", "at", F.explode("data").alias("name", "value"))
        last = values.groupBy(BUCKET, "pk", "name").agg(F.max(F.struct("at", "value")).alias("last"))
        # One entry for each column of a row.
        data = last.groupBy(BUCKET, "pk").agg(
            F.map_from_entries(F.collect_list(F.struct("name", F.col("last.value").alias("value")))).alias("data")
        )
        marked = newest.select(BUCKET, "pk", (F.col("newest.type") == DELETE).cast("long").alias("deleted"))
        none = F.create_map().cast("map<string,string>")
        snapshot = marked.join(data, [BUCKET, "pk"], "left").select("pk", F.coalesce("data", none).alias("data"), "deleted", BUCKET)
        return self._snapshots(table).publish(snapshot.repartition(BUCKET), upto)
