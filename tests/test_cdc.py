import json

from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import routing
from sparkmart.sources import cdc
from sparkmart.sources.tables import dim_lookup
from sparkmart.sources.topics import literal_topic


def envelope(op, after=None, before=None, ts=0, table="t"):
    return json.dumps({"op": op, "source": {"db": "d", "table": table}, "before": before, "after": after, "ts_ms": ts})


def record(table, kind, data, ts=0):
    return json.dumps({"database": "d", "table": table, "type": kind, "data": data, "ts": ts})


def records(spark, *messages):
    return cdc.decode_records(literal_topic(spark, list(messages)))


def rules(spark, *rows):
    return spark.createDataFrame([(*r, None, None)[:7] for r in rows], schemas.RULE)


def test_decode(spark):
    raw = literal_topic(
        spark,
        [envelope("c", {"id": 1}), envelope("r", {"id": 2}), envelope("u", {"id": 3}, {"id": 2}), envelope("d", None, {"id": 4})],
    )
    rows = [(r.type, r.data, r.before) for r in cdc.decode_envelope(raw).collect()]
    assert rows == [
        ("insert", {"id": "1"}, None),
        ("read", {"id": "2"}, None),
        ("update", {"id": "3"}, {"id": "2"}),
        ("delete", {}, {"id": "4"}),
    ]


def test_clean_filter(spark):
    df = records(
        spark,
        record("t", "insert", {}),
        record("t", "insert", {"a": 1}),
        record("", "insert", {"a": 2}),
        record(None, "insert", {"a": 3}),
        record("t", "insert", None),
    )
    assert [r.data for r in routing.clean(df).collect()] == [{"a": "1"}]


def routed(spark, df, table, **options):
    rows = routing.route(df, table, **options).orderBy(F.col("data")["id"]).collect()
    return [(r.data, r.type, r.route, r.sink_table, r.reason) for r in rows]


def test_route_broadcast_and_salted_agree(spark):
    df = records(
        spark,
        record("a", "bootstrap-insert", {"id": "1", "x": 5, " y": 6}),
        record("a", "update", {"id": "2", "x": 5}),
        record("b", "insert", {"id": "3"}),
        record("c", "insert", {"id": "4"}),
    )
    table = rules(
        spark,
        ("a", "insert", "kafka", "ta", "id,y"),
        ("a", "update", "hbase", "da", "id,x"),
        ("b", "insert", "clickhouse", "cb", "id"),
    )
    expected = [
        ({"id": "1"}, "insert", "fact", "ta", None),
        ({"id": "2", "x": "5"}, "update", "dim", "da", None),
        ({"id": "3"}, "insert", "rejected", "cb", "unsupported sink type"),
        ({"id": "4"}, "insert", "rejected", None, "no rule"),
    ]
    assert routed(spark, df, table) == expected
    assert routed(spark, df, table, max_broadcast_rules=1, salts=3) == expected


def test_payload_is_the_data_without_nulls(spark):
    data = {"id": 1, "x": None, "y": "it's", "n": "7", "z": 2.5, "deep": {"a": [1, "b"]}, "other": 1}
    df = records(spark, record("a", "insert", data))
    out = routing.fact_payloads(routing.route(df, rules(spark, ("a", "insert", "kafka", "ta", "id,x,y,n,z,deep"))))
    row = out.first()
    assert row.topic == "ta"
    assert json.loads(row.value) == {k: v for k, v in data.items() if k not in ("x", "other")}


def rule(op, ts, source="a", target="t1", before=False, snake=False):
    data = {"sourceTable": source, "operateType": "insert", "sinkType": "kafka", "sinkTable": target, "sinkColumns": "id"}
    if snake:
        names = {v: k for k, v in schemas.RULE_FIELDS.items()}
        data = {names[k]: v for k, v in data.items()}
    return envelope(op, None if op == "d" else data, data if before else None, ts)


def test_rules_last_change_wins_and_deletes_need_an_image(spark):
    raw = literal_topic(
        spark,
        [
            rule("r", 1),
            rule("u", 2, target="t2", snake=True),
            rule("c", 3, source="b"),
            rule("d", 4, source="b", before=True),
            rule("c", 5, source="c", target="t3"),
            rule("d", 6, source="c"),
        ],
    )
    current = cdc.current_rules(cdc.decode_envelope(raw), ["ts"])
    assert sorted((r.source_table, r.sink_table) for r in current.collect()) == [("a", "t2"), ("c", "t3")]


def test_declared_view(spark):
    raw = literal_topic(
        spark,
        [
            envelope("r", {"id": 1, "name": "a", "age": 3}, ts=1),
            envelope("u", {"id": 1, "name": "b", "age": "old"}, ts=2),
            envelope("r", {"id": 2, "name": "c", "age": 4}, ts=1),
            envelope("d", None, {"id": 2}, ts=3),
        ],
    )
    view = cdc.create_cdc_view(spark, "people", cdc.decode_envelope(raw), "id INT, name STRING, age INT", "id", ["ts"])
    assert [tuple(r) for r in spark.sql("SELECT * FROM people").collect()] == [(1, "b", None)]
    assert dict(view.dtypes) == {"id": "int", "name": "string", "age": "int"}


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 100, 1, 4).withColumn("k", F.col("id") % 2)
    plan = cdc.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_lookup(spark):
    dim = spark.createDataFrame([("1", "b", 2), ("1", "a", 1), ("2", "c", 3)], "id string, name string, n int")
    assert dim_lookup(dim, "1", ["n"]).first().name == "a"
    assert dim_lookup(dim, {"id": "1", "name": "b"}).first().n == 2
    assert dim_lookup(dim, "9").isEmpty()


def test_dim_schema():
    schema = routing.dim_schema("id,name")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [("id", "string", False), ("name", "string", True)]
