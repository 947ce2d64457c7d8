"""What grows with the tables: tasks, state partitions and batches of a replay; the results stay whole."""

import os
import random
import sys

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR, log
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import compare  # noqa: E402

from sparkmart.operators import logs, visitors  # noqa: E402
from sparkmart.plans import oracle, queries, stream_queries  # noqa: E402
from sparkmart.plans.fixtures import Fixtures  # noqa: E402
from sparkmart.session import START_PARTITIONS  # noqa: E402
from sparkmart.sources import tables  # noqa: E402
from sparkmart.sources.topics import literal_topic  # noqa: E402
from sparkmart.streaming import jobs  # noqa: E402


def test_tasks_follow_the_size_of_a_table(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "TASK_BYTES", 2_000)
    fx = Fixtures(spark, SF_DIR)
    wanted = -(-os.path.getsize(f"{SF_DIR}/events.parquet") // 2_000)
    assert wanted > cores and fx.table("events").rdd.getNumPartitions() == wanted
    assert stream_queries._warehouse(fx).spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)


def test_shuffles_follow_the_size_of_the_tables(spark, monkeypatch):
    monkeypatch.setattr(queries, "EXPANSION", 2**20)
    before = spark.conf.get(START_PARTITIONS, None)
    try:
        queries.QUERIES["product_stats"](spark, SF_DIR)
        size = sum(os.path.getsize(f"{SF_DIR}/{t}.parquet") for t in ("orders", "lineitem", "events"))
        assert spark.conf.get(START_PARTITIONS) == str(-(-size // 256))
    finally:
        spark.conf.unset(START_PARTITIONS) if before is None else spark.conf.set(START_PARTITIONS, before)


@pytest.mark.parametrize("name", ["stream_payment_wide", "stream_product_stats_wide", "stream_product_stats_idle"])
def test_a_replay_in_slices_equals_sql(spark, monkeypatch, name):
    monkeypatch.setattr(stream_queries, "SLICE_BYTES", 60_000)
    seen = []
    replay = stream_queries._replay
    monkeypatch.setattr(stream_queries, "_replay", lambda wh, cuts, *more: (seen.append((wh, cuts)), replay(wh, cuts, *more))[1])
    got = queries.QUERIES[name](spark, SF_DIR)
    assert compare.difference(got, compare.connect(SF_DIR), oracle.oracle_sql()[name]) is None
    wh, cuts = seen[0]
    assert len(cuts) == 2
    if name == "stream_payment_wide":
        # What the join holds at the end are details of the last slice, and those of the five days before
        state = spark.read.format("statestore").option("joinSide", "right").load(wh.checkpoint("order_wide"))
        assert 0 < state.count() < Fixtures(spark, SF_DIR).details().count() / 2


def test_the_state_of_a_slice_is_in_the_heap(spark):
    fx = Fixtures(spark, SF_DIR)
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert "HDFSBacked" in stream_queries._warehouse(fx, in_slices=True).spark.conf.get(provider)
    assert "RocksDB" in stream_queries._warehouse(fx).spark.conf.get(provider)


@pytest.mark.parametrize("in_slices", [False, True])
def test_a_task_of_a_stream_reads_little(spark, in_slices):
    session = stream_queries._warehouse(Fixtures(spark, SF_DIR), in_slices).spark
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_a_batch_without_rows_looks_nothing_up(spark, folder, monkeypatch):
    def fail(wh):
        raise AssertionError("looked up")

    wh = jobs.Warehouse(spark, folder)
    typed = wh.dimensions(spark.sql("SELECT 1L AS user_id, 2L AS sku_id"))
    monkeypatch.setattr(jobs.Warehouse, "dims", property(fail))
    empty = wh.dimensions(spark.sql("SELECT 1L AS user_id, 2L AS sku_id").where("false"))
    for name, dim in empty._asdict().items():
        assert dim.dtypes == getattr(typed, name).dtypes and dim.count() == 0


def test_topics_are_read_in_small_parts(spark, folder):
    wh = jobs.Warehouse(spark, folder)
    text = F.sha2(F.col("id").cast("string"), 512)
    wh.topics.publish(spark.range(400_000).coalesce(1).select(F.lit("t").alias("topic"), text.alias("value")), "t", 0)
    found = [f for f in os.listdir(f"{folder}/topics/t/batch=0/topic=t") if f.endswith(".parquet")]
    assert pq.ParquetFile(f"{folder}/topics/t/batch=0/topic=t/{found[0]}").num_row_groups > 2


@pytest.mark.parametrize("seed", range(2))
def test_matched_pairs_of_a_stream(spark, folder, seed):
    """Rows out of order, over several batches, against the same rows as a table."""
    rng = random.Random(seed)
    wh = jobs.Warehouse(spark, folder, trigger={"availableNow": True}, salts=2)
    opened = F.col("page.page_id") == "good_detail"
    texts, start = [], 19_000 * 86_400_000
    for i in range(3):
        batch = [
            log(rng.choice("aab"), start + (i * 60 + rng.randrange(60)) * 1000, rng.choice(["home", "good_detail"]), rng.choice([None, "home"]), event_id=100 * i + n)
            for n in range(60)
        ]
        texts += batch
        closing = [log("z", start + 86_400_000 * k, "list", "home", event_id=-k) for k in (1, 2)] if i == 2 else []
        put = literal_topic(spark, batch + closing).select(F.lit(logs.PAGE_TOPIC).alias("topic"), "value")
        wh.topics.publish(put, jobs.LOG_JOB, i)
        jobs.page_pairs(wh, visitors.is_entry_page(), opened, 10).awaitTermination()
    of = F.from_json("value", "event_id bigint, next struct<event_id bigint, common struct<mid string>>")
    found = wh.topics.read(spark, jobs.PAGE_PAIRS).select(of.alias("p")).select("p.event_id", "p.next.event_id", "p.next.common.mid")
    table = logs.decode_logs(literal_topic(spark, texts))
    want = jobs.followed_by(table, visitors.MID, visitors.is_entry_page(), opened, 10, jobs.MATCHED)
    want = want.select("event_id", F.col("next.event_id").alias("other"), "next.common.mid")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) != []
    stream = wh.logs(logs.PAGE_TOPIC, "test").withWatermark("event_time", wh.watermark)
    plan = jobs.followed_by(stream, visitors.MID, visitors.is_entry_page(), opened, 10, jobs.MATCHED)._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "collect_list" in plan


def test_low_scores_are_of_all_texts(spark):
    from sparkmart.llm import langid
    from sparkmart.llm.common import session

    session(spark)
    word = F.substring(F.sha2(F.concat(F.col("id"), F.lit("w")).cast("binary"), 256), 1, (F.col("id") % 40 + 3).cast("int"))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the same words again and again "), word).alias("text"), F.lit("en").alias("lang"))
    model = langid.train(docs)
    all_scores = langid.predict(docs, model).where("lang_pred = lang")
    want = all_scores.agg(F.percentile_approx("score", langid.LOW_SHARE)).first()[0]
    assert langid.low_scores(docs, model) == {"en": want}
