import os

import pytest
from conftest import log
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.session import shared_dir
from sparkmart.sinks.batches import AppendedTable, last_batch, publish_batch, read_batches
from sparkmart.sinks.dims import DimTables
from sparkmart.sinks.writers import landing_rows
from sparkmart.sources.topics import FolderTopics, literal_topic

NUMBER = schemas.row(n=schemas.LONG)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], NUMBER)


def test_a_batch_is_published_once(spark, folder):
    assert publish_batch(numbers(spark, 1, 2), folder, 0)
    assert not publish_batch(numbers(spark, 3), folder, 0)
    assert publish_batch(numbers(spark, 4), folder, 1)
    assert sorted(map(tuple, read_batches(spark, folder, NUMBER).collect())) == [(1, 0), (2, 0), (4, 1)]
    assert [r.n for r in read_batches(spark, folder, NUMBER, before=1, after=-1).orderBy("n").collect()] == [1, 2]
    assert last_batch(spark, folder) == 1


def test_reading_what_is_not_there_yet(spark, folder):
    assert read_batches(spark, f"{folder}/none", NUMBER).isEmpty()
    assert last_batch(spark, f"{folder}/none") is None


def test_appended_table(spark, folder):
    table = AppendedTable(spark, folder, NUMBER)

    def values(**options):
        return sorted(r.n for r in table.read(**options).collect())

    assert values() == [] and not table.compact()
    table.append(numbers(spark, 1), 0)
    table.append(numbers(spark, 2), 1)
    assert table.compact() and not table.compact()
    table.append(numbers(spark, 3), 2)
    assert values() == [1, 2, 3]
    # What the batches saw when they were first run.
    assert [values(before=b) for b in range(4)] == [[], [1], [1, 2], [1, 2, 3]]


def test_half_written_batches_are_invisible(spark, folder):
    numbers(spark, 1).write.parquet(f"{folder}/_staging/batch=0")
    assert read_batches(spark, folder, NUMBER).isEmpty()
    assert publish_batch(numbers(spark, 2), folder, 0)
    assert [r.n for r in read_batches(spark, folder, NUMBER).collect()] == [2]


def test_row_chosen_topics(spark, folder):
    topics = FolderTopics(folder, {"a": "job", "b": "job"})
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string")
    topics.publish(rows, "job", 0)
    topics.publish(rows, "job", 0)
    assert sorted(r.value for r in topics.read(spark, "a").collect()) == ["1", "3"]
    assert [r.value for r in topics.read(spark, "b").collect()] == ["2"]
    assert topics.read(spark, "unknown").isEmpty()


def changes(spark, *rows):
    return spark.createDataFrame(
        [(seq, "people", data.get("id"), kind, data) for seq, kind, data in rows],
        "seq long, sink_table string, pk string, type string, data map<string,string>",
    )


def people(dims, **options):
    return sorted(tuple(r) for r in dims.read("people", **options).collect())


def test_dimension_upserts(spark, folder):
    dims = DimTables(spark, folder)
    assert dims.create("people", "id,name,note")
    assert not dims.create("people", "id,name,note")
    assert dims.tables() == ["people"] and people(dims) == []

    dims.upsert(changes(spark, (1, "insert", {"id": "1", "name": "a", "note": "it's"}), (2, "insert", {"id": "2", "name": "b"})), 0)
    dims.upsert(changes(spark, (4, "update", {"id": "1", "name": "d"}), (3, "update", {"id": "1", "name": "c"})), 1)
    assert people(dims) == [("1", "d", "it's"), ("2", "b", None)]  # what a change does not carry stays

    # A later batch wins even if its sequence numbers start again.
    dims.upsert(changes(spark, (1, "delete", {"id": "2", "name": "b"}), (2, "insert", {"id": "3", "name": "e"})), 2)
    everyone = [("1", "d", "it's"), ("2", "b", None), ("3", "e", None)]
    left = [everyone[0], everyone[2]]
    assert people(dims) == everyone
    assert people(dims, apply_deletes=True) == left

    assert dims.compact("people") and not dims.compact("people")
    assert people(dims) == everyone and people(dims, apply_deletes=True) == left
    dims.upsert(changes(spark, (1, "update", {"id": "3", "name": None, "note": "n"}), (2, "insert", {"id": "2", "note": "x"})), 3)
    assert people(dims) == [everyone[0], ("2", "b", "x"), ("3", None, "n")]
    assert people(dims, apply_deletes=True) == [everyone[0], ("2", None, "x"), ("3", None, "n")]


def test_columns_grow_with_their_rule(spark, folder):
    dims = DimTables(spark, folder)
    dims.create("people", "id,name")
    dims.upsert(changes(spark, (1, "insert", {"id": "1", "name": "a", "note": "kept"})), 0)
    assert dims.compact("people") and people(dims) == [("1", "a")]
    assert not dims.create("people", "id,note,name")
    assert dims.columns("people") == ["id", "name", "note"] and people(dims) == [("1", "a", "kept")]


def test_captured_tables_are_compacted(spark, folder):
    dims = DimTables(spark, folder)
    dims.upsert(changes(spark, (1, "insert", {"id": "1", "name": "a"}), (1, "insert", {"id": "1", "name": "b"})), 0)
    before = people(dims, columns=["id", "name"])
    assert before == [("1", "b")]  # a defined winner of equal changes
    assert dims.compact("people") and people(dims, columns=["id", "name"]) == before


def test_rows_without_a_key_are_rejected(spark, folder):
    dims = DimTables(spark, folder)
    dims.create("people", "id,name")
    dims.upsert(changes(spark, (1, "insert", {"name": "a"}), (1, "insert", {"id": "1"})), 0)
    assert people(dims) == [("1", None)]
    assert [r.data for r in dims.rejected("people").collect()] == [{"name": "a"}]
    dims.compact("people")
    assert dims.rejected("people").count() == 1


def test_landing_day(spark):
    rows = landing_rows(literal_topic(spark, [log("a", 86_400_000), "no json"])).collect()
    assert rows[0].day == "1970-01-02" and rows[1].day >= "2024-01-01"


class Session:
    """As much of a session as ``shared_dir`` looks at."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key, default))})


def test_shared_dir_is_the_configured_one():
    assert shared_dir(Session("yarn", **{"spark.checkpoint.dir": "/shared/here/"})) == "/shared/here"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"))
    with pytest.raises(ValueError):
        shared_dir(Session("local-cluster[2,1,1024]"))


def test_shared_dir_of_a_local_session(spark):
    made = shared_dir(spark)
    assert os.path.isdir(made) and shared_dir(spark) == made
