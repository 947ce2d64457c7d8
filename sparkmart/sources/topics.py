"""Topics: Kafka where it is available, folders of files otherwise.

Both have the same methods.  A topic carries text messages in a column
``value``; rows to publish also say their ``topic``.  Messages of event-time progress
are left out unless asked for with ``progress``.  With ``position`` a message says where it
is in its topic; of messages about one key, the later one has the greater position.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.sinks.batches import last_batch, publish_batch, publish_staged, read_batches, stage_batches
from sparkmart.sources import progress as event_time
from sparkmart.sources.files import make_dir

VALUE = schemas.row(value=schemas.TEXT)

#: Where a message is in its source: a Kafka partition and offset, or a producer's batch and the row in it.
POSITION = "position"
POSITION_TYPE = schemas.row(part=schemas.LONG, offset=schemas.LONG)


def _position(part: str, offset: str) -> Column:
    return F.struct(F.col(part).cast("long").alias("part"), F.col(offset).cast("long").alias("offset")).alias(POSITION)


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster.

    Spark keeps the offsets in the checkpoint of the query; the group is only a
    name shown to the brokers.  Publishing is at least once.
    """

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)

    @staticmethod
    def _messages(rows: DataFrame, progress: bool, position: bool) -> DataFrame:
        places = [_position("partition", "offset")] if position else []
        values = rows.select(F.col("value").cast("string").alias("value"), *places)
        return values if progress else event_time.without(values)

    def read_stream(
        self, spark: SparkSession, topic: str, group: str | None = None, progress: bool = False, position: bool = False
    ) -> DataFrame:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("subscribe", topic)
            .options(**self.options)
        )
        if group:
            reader = reader.option("groupIdPrefix", group)
        return self._messages(reader.load(), progress, position)

    def read(self, spark: SparkSession, topic: str, progress: bool = False, position: bool = False) -> DataFrame:
        reader = spark.read.format("kafka").option("kafka.bootstrap.servers", self.servers)
        return self._messages(reader.option("subscribe", topic).load(), progress, position)

    def publish(self, messages: DataFrame, producer: str, batch_id: int) -> None:
        writer = messages.select("topic", "value").write.format("kafka")
        writer.option("kafka.bootstrap.servers", self.servers).save()


@dataclass(frozen=True)
class FolderTopics:
    """Topics kept as folders in shared storage, exactly once.

    A producing job owns ``<root>/<producer>`` and may write several topics into
    it.  ``producers`` names the producer of each topic that is not its own.  The
    files of a batch are in no time order, so a reader takes whole batches: there
    is no limit of files per trigger, which would make rows late that are not.
    """

    root: str
    producers: Mapping[str, str] = field(default_factory=dict)

    def folder(self, topic: str) -> str:
        return f"{self.root}/{self.producers.get(topic, topic)}"

    def _messages(self, rows: DataFrame, topic: str, progress: bool, position: bool) -> DataFrame:
        places = [_position("batch", "row")] if position else []
        own = rows.where(F.col("topic") == topic).select("value", *places)
        return own if progress else event_time.without(own)

    def read_stream(
        self, spark: SparkSession, topic: str, group: str | None = None, progress: bool = False, position: bool = False
    ) -> DataFrame:
        make_dir(spark, self.folder(topic))
        stored = schemas.row(value=schemas.TEXT, row=schemas.LONG, batch=schemas.LONG, topic=schemas.TEXT)
        return self._messages(spark.readStream.schema(stored).parquet(self.folder(topic)), topic, progress, position)

    def read(
        self, spark: SparkSession, topic: str, progress: bool = False, position: bool = False, after: int | None = None
    ) -> DataFrame:
        """All messages, or those of the producer's batches after ``after``."""
        stored = schemas.row(value=schemas.TEXT, row=schemas.LONG, topic=schemas.TEXT)
        return self._messages(read_batches(spark, self.folder(topic), stored, after=after), topic, progress, position)

    def last(self, spark: SparkSession, topic: str) -> int | None:
        """The last batch of the topic's producer."""
        return last_batch(spark, self.folder(topic))

    def publish(self, messages: DataFrame, producer: str, batch_id: int) -> None:
        """Publish a batch; its rows keep the order that they have."""
        rows = messages.select("topic", "value", F.monotonically_increasing_id().alias("row"))
        publish_batch(rows, f"{self.root}/{producer}", batch_id, ["topic"])

    def stage(self, messages: DataFrame, producer: str) -> None:
        """Write all batches of a producer, named by the column ``batch``, in one pass and out of sight."""
        rows = messages.select("batch", "topic", "value", F.monotonically_increasing_id().alias("row"))
        stage_batches(rows, f"{self.root}/{producer}", ["topic"])

    def publish_staged(self, spark: SparkSession, producer: str, batch_id: int) -> bool:
        """Publish one of the staged batches; False if it has no messages or is published already."""
        return publish_staged(spark, f"{self.root}/{producer}", batch_id)


Topics = KafkaTopics | FolderTopics


def read_text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Raw log files, one message per line."""
    return spark.readStream.text(path) if stream else spark.read.text(path)


def literal_topic(spark: SparkSession, messages: list[str]) -> DataFrame:
    """A few messages given in code."""
    return spark.createDataFrame([(m,) for m in messages], VALUE)
