"""Statistics, raw landing and console sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sparkmart.operators.stats import stamped
from sparkmart.sinks.batches import publish_batch


def stats_rows(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the sink table's columns, in its order, with the processing time in ``ts``."""
    return stamped(stats).select(*columns)


@dataclass(frozen=True)
class FolderStats:
    """Statistics tables as folders, exactly once."""

    root: str

    def write(self, stats: DataFrame, table: str, columns: Sequence[str], batch_id: int) -> None:
        publish_batch(stats_rows(stats, columns), f"{self.root}/{table}", batch_id)


@dataclass(frozen=True)
class JdbcStats:
    """Statistics tables of a database, filled by position in batched inserts.

    A window leaves the stream once, so rows are only appended; after a failure a
    batch may be inserted again, which the table's key (stt, edt, dimensions)
    has to resolve.
    """

    url: str
    batch_rows: int = 1000
    options: dict[str, str] = field(default_factory=dict)

    def write(self, stats: DataFrame, table: str, columns: Sequence[str], batch_id: int) -> None:
        writer = stats_rows(stats, columns).write.format("jdbc").mode("append").options(**self.options)
        writer.option("url", self.url).option("dbtable", table).option("batchsize", self.batch_rows).save()


StatsSink = FolderStats | JdbcStats


def landing_rows(raw: DataFrame) -> DataFrame:
    """Raw messages with the ``day`` of their own time, or of their arrival if they have none."""
    own = F.timestamp_millis(F.get_json_object("value", "$.ts").try_cast("long"))
    day = F.date_format(F.coalesce(own, F.current_timestamp()), "yyyy-MM-dd")
    return raw.select("value", day.alias("day"))


def landing_writer(raw: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw messages as text files, one folder per day."""
    return (
        landing_rows(raw)
        .writeStream.format("text")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def console_writer(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows).option("truncate", False)
