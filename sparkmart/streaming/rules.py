"""Rules in force as a table that changes of the rule topic are folded into, version by version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.functions.jsonutil import CORRUPT
from sparkmart.sinks.batches import BATCH, last_batch, publish_batch
from sparkmart.sources import cdc
from sparkmart.sources.topics import POSITION, POSITION_TYPE

ORDER = ["ts", POSITION]
STATE = schemas.row(
    **dict.fromkeys(schemas.RULE_FIELDS, schemas.TEXT), type=schemas.TEXT, ts=schemas.LONG, position=POSITION_TYPE
)


class RuleTable:
    """The last change of every rule up to a batch of the rule topic; deleted rules keep their mark.

    ``versions/batch=<id>`` is a version, made from the one before and the changes since.  A change
    is decoded once, and the rules are a small file that a batch of records reads.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.versions = f"{root}/versions"
        self._frame: tuple[int | None, DataFrame] | None = None

    def version(self) -> int | None:
        return last_batch(self.spark, self.versions)

    def _state(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.versions}/{BATCH}={version}")

    def fold(self, messages: DataFrame, version: int) -> bool:
        """Make a version from the newest one before it and connector envelopes with their positions."""
        changes = cdc.decode_envelope(messages, keep=(POSITION,)).where(F.col(CORRUPT).isNull())
        before = self._state(last_batch(self.spark, self.versions, version))
        latest = cdc.latest_rules(changes, ORDER, before)
        return publish_batch(latest.select(*STATE.names).coalesce(1), self.versions, version)

    def current(self) -> DataFrame:
        """The rules in force; the same frame as before while there is no new version."""
        version = self.version()
        if self._frame is None or self._frame[0] != version:
            self._frame = version, cdc.rules_in_force(self._state(version))
        return self._frame[1]
