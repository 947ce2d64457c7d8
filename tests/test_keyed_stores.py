"""Total order of changes, stores in buckets, and rules kept as a table."""

import json
import os

import pytest
from conftest import log
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.sinks.batches import AppendedTable
from sparkmart.sinks.dims import DimTables
from sparkmart.sources import cdc
from sparkmart.sources.topics import POSITION, FolderTopics, literal_topic
from sparkmart.streaming import jobs

CHANGE = "seq long, sink_table string, pk string, type string, data map<string,string>"


def files_read(df):
    """Files that a query opened."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        found = node.metrics().apply("numFiles").value() if kind == "FileSourceScanExec" else 0
        children = node.children().iterator()
        while children.hasNext():
            found += walk(children.next())
        return found

    return walk(df._jdf.queryExecution().executedPlan())


def upserts(spark, ids, **data):
    return spark.createDataFrame([(1, "t", str(i), "update", {"id": str(i), **data}) for i in ids], CHANGE)


def test_positions_follow_the_rows_of_a_topic(spark, folder):
    topics = FolderTopics(folder)
    for i in range(2):
        messages = literal_topic(spark, [f"{i}{c}" for c in "abcdefgh"]).select(F.lit("a").alias("topic"), "value")
        topics.publish(messages, "a", i)
    rows = topics.read(spark, "a", position=True).collect()
    assert [r.value for r in sorted(rows, key=lambda r: r[POSITION])] == [f"{i}{c}" for i in range(2) for c in "abcdefgh"]
    assert [r.value for r in topics.read(spark, "a", after=0).collect()][0][0] == "1" and topics.last(spark, "a") == 1
    assert topics.read(spark, "a").columns == ["value"]


def test_the_later_of_two_equal_changes_wins_whole(spark, folder):
    dims = DimTables(spark, folder)
    dims.create("t", "id,x,y")
    rows = [(7, "t", "1", "update", {"id": "1", "x": x, "y": y}) for x, y in (("a", "z"), ("b", "y"), ("a", "x"))]
    dims.upsert(spark.createDataFrame(rows, CHANGE), 0)
    # By position, not by the order of the rows
    back = [(7, "t", "2", "update", {"id": "2", "x": x, "y": y}, -i) for i, (x, y) in enumerate((("a", "z"), ("b", "y")))]
    df = spark.createDataFrame(back, f"{CHANGE}, at long")
    place = F.struct(F.lit(0).cast("long").alias("part"), F.col("at").alias("offset"))
    dims.upsert(df.withColumn(POSITION, place), 1)
    want = [("1", "a", "x"), ("2", "a", "z")]
    assert sorted(map(tuple, dims.read("t").collect())) == want
    assert dims.compact("t") and sorted(map(tuple, dims.read("t").collect())) == want


def test_rules_of_one_time_follow_their_order(spark):
    rows = [({"source_table": "a", "operate_type": "insert", "sink_table": s}, 5, (0, i)) for i, s in enumerate(("old", "zzz", "new"))]
    changes = spark.createDataFrame(
        [("insert", d, None, ts, p) for d, ts, p in rows],
        "type string, data map<string,string>, before map<string,string>, ts long, position struct<part: long, offset: long>",
    )
    assert [r.sink_table for r in cdc.current_rules(changes, ["ts", POSITION]).collect()] == ["new"]


@pytest.mark.parametrize("rows", [100, 1000])
def test_a_small_batch_opens_its_buckets_only(spark, folder, rows):
    """However large the table is, a key opens one bucket's snapshot, and changes since."""
    dims = DimTables(spark, folder, buckets=32)
    dims.create("t", "id,x")
    dims.upsert(upserts(spark, range(rows), x="a"), 0)
    assert dims.compact("t")
    keys = spark.createDataFrame([("5",), ("none",)], "id string")
    got = dims.read("t", keys=keys.limit(1))
    assert files_read(got) == 1 and got.collect() == [("5", "a")]
    assert files_read(dims.read("t", keys=keys)) == 2
    dims.upsert(upserts(spark, [5, 6], x="b"), 1)
    got = dims.read("t", keys=keys)
    assert files_read(got) == 3 and got.collect() == [("5", "b")]
    assert files_read(dims.read("t")) >= 30
    assert dims.read("t").count() == rows and dims.read("t").where("x = 'b'").count() == 2


def test_compaction_rewrites_what_changed(spark, folder):
    dims = DimTables(spark, folder, buckets=32)
    dims.create("t", "id,x")
    dims.upsert(upserts(spark, range(200), x="a"), 0)
    dims.compact("t")
    dims.upsert(upserts(spark, [5], x="b"), 1)
    assert dims.compact("t") and not dims.compact("t")
    buckets = lambda batch: [n for n in os.listdir(f"{folder}/snapshots/t/batch={batch}") if n.startswith("bucket=")]
    assert len(buckets(1)) == 1 and len(buckets(0)) > 25
    # A batch without changes of the table leaves an empty snapshot and all rows
    dims.upsert(upserts(spark, [1], x="c").withColumn("sink_table", F.lit("other")), 2)
    assert dims.compact("t") and buckets(2) == []
    assert dims.read("t").count() == 200 and dims.read("t").where("x = 'b'").count() == 1
    # The store keeps its number of buckets, whatever a later user asks for
    assert DimTables(spark, folder, buckets=7).buckets.number == 32


def test_appended_table_by_key(spark, folder):
    table = AppendedTable(spark, folder, schemas.row(mid=schemas.TEXT, n=schemas.LONG), buckets=32)
    rows = lambda ids: spark.createDataFrame([(str(i), i) for i in ids], "mid string, n long")
    table.append(rows(range(300)), 0)
    assert table.compact()
    table.append(rows([1000]), 1)
    for key, want in (("7", 7), ("1000", 1000)):
        wanted = spark.createDataFrame([(key,)], "mid string")
        got = table.read(keys=wanted)
        assert files_read(got) <= 2 and got.where(F.col("mid") == key).first().n == want
    assert table.read().count() == 301 and table.read(before=1).count() == 300
    assert table.compact() and table.read().count() == 301 and table.read(before=1).count() == 300


def test_first_visits_are_looked_up_by_bucket(spark, folder, logs_of):
    wh = jobs.Warehouse(spark, folder, buckets=32)
    table = jobs.first_visits_table(wh)
    table.append(spark.createDataFrame([(f"m{i}", i) for i in range(500)], "mid string, first_ts long"), 0)
    table.compact()
    batch = logs_of(log("m5", 86_400_000 * 3, event_id=1, is_new="1"))
    assert [r.common.is_new for r in jobs.repair_batch(wh, batch, 1).collect()] == ["0"]
    assert files_read(jobs.repair_batch(wh, batch, 1)) <= 2


def envelope(sink, ts, kind="insert", op="u"):
    data = dict(zip(schemas.RULE_FIELDS.values(), ["t", kind, "kafka", sink, "id", None, None]))
    return json.dumps({"op": op, "source": {"db": "d", "table": "r"}, "before" if op == "d" else "after": data, "ts_ms": ts})


def test_rules_are_folded_version_by_version(spark, folder, monkeypatch):
    wh = jobs.Warehouse(spark, folder, trigger={"availableNow": True})
    decoded = []
    decode = cdc.decode_envelope
    monkeypatch.setattr(cdc, "decode_envelope", lambda raw, **more: decoded.append(raw.count()) or decode(raw, **more))
    rules = jobs.rules_from_topic(wh, "rules")

    def put(i, *messages):
        wh.topics.publish(literal_topic(spark, list(messages)).select(F.lit("rules").alias("topic"), "value"), "rules", i)

    def current():
        return sorted((r.operate_type, r.sink_table) for r in rules().collect())

    assert current() == []
    put(0, envelope("a", 1), envelope("b", 1, "update"), "{broken")
    assert current() == [("insert", "a"), ("update", "b")] and rules() is rules()
    put(1, envelope("late", 0), envelope("c", 2, "update", "d"))
    assert current() == [("insert", "a")]  # the late one is older than what is known
    put(2, envelope("b2", 1, "update"), envelope("a2", 1), envelope("a3", 1))
    assert current() == [("insert", "a3")]  # the removed rule came after
    current()
    assert decoded == [3, 2, 3]
    # The same rules by a job of its own, as for a topic that is no folder
    other = jobs.Warehouse(spark, folder, topics=wh.topics, trigger={"availableNow": True})
    object.__setattr__(other, "root", f"{folder}/other")
    jobs.maintain_rules(other, "rules").awaitTermination()
    assert [r.sink_table for r in jobs.rule_table(other, "rules").current().collect()] == ["a3"]
