import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.codes import decode_code
from sparkmart.functions.jsonutil import CORRUPT, parse_json, split_corrupt, to_json_rows
from sparkmart.session import START_PARTITIONS, configure, streaming_session


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_time_round_trip(spark):
    ms = 1_700_000_000_000
    row = one(
        spark,
        tu.ms_to_day(F.lit(ms)),
        tu.timestamp_to_text(tu.ms_to_timestamp(F.lit(ms))),
        tu.text_to_ms(F.lit("2023-11-14 22:13:20")),
        tu.text_to_ms(F.lit("yesterday")),
    )
    assert list(row) == ["20231114", "2023-11-14 22:13:20", ms, None]


def test_one_zone_setting_for_parsing_and_printing(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        row = one(spark, tu.text_to_ms(F.lit("2023-11-15 06:13:20")), tu.ms_to_day(F.lit(1_700_000_000_000)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert list(row) == [1_700_000_000_000, "20231115"]


@pytest.mark.parametrize(
    "birthday, as_of, age",
    [
        ("2000-01-01", "2000-12-30", 0),
        ("2000-01-01", "2000-12-31", 1),  # 365 days, as the year has 366
        ("1960-01-01", "2024-01-01", 64),
        ("2024-06-01", "2024-01-01", 0),
    ],
)
def test_age(spark, birthday, as_of, age):
    value = tu.age_in_years(F.lit(birthday).cast("date"), F.lit(as_of).cast("timestamp"))
    assert one(spark, value)[0] == age


def test_codes(spark):
    assert list(one(spark, decode_code(F.lit("1201")), decode_code(F.lit("9999")))) == ["good", None]


def test_parse_json_is_lenient_about_quotes_and_keeps_bad_text(spark):
    raw = spark.createDataFrame(
        [('{"sku_id": "7", "order_id": 8, "refund_amount": "2.50"}',), ('{"sku_id": "x", "order_id": 9}',), ("{oops",)],
        schemas.row(value=schemas.TEXT),
    )
    good, bad = split_corrupt(parse_json(raw, schemas.REFUND_INFO))
    got = [(r.sku_id, r.order_id, None if r.refund_amount is None else float(r.refund_amount)) for r in good.collect()]
    assert got == [(7, 8, 2.5), (None, 9, None)]
    assert [r[CORRUPT] for r in bad.collect()] == ["{oops"]


def test_json_rows_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None, datetime.date(2024, 1, 2))], "a int, b string, c date")
    assert to_json_rows(df).first().value == '{"a":1,"c":"2024-01-02"}'


def test_streams_have_the_zone_and_settings_of_their_session(spark):
    parent = spark.newSession()
    parent.conf.set("spark.sql.shuffle.partitions", "3")
    configure(parent, "Asia/Shanghai", shuffle_bytes=2**32)
    session = streaming_session(parent)
    for key in ("spark.sql.session.timeZone", START_PARTITIONS, "spark.sql.shuffle.partitions"):
        assert session.conf.get(key) == parent.conf.get(key)
    assert streaming_session(parent, 5).conf.get("spark.sql.shuffle.partitions") == "5"
    assert configure(session).conf.get("spark.sql.session.timeZone") == "Asia/Shanghai"
    around_midnight = [(57_599_999,), (57_600_000,)]
    days = [[r[0] for r in s.createDataFrame(around_midnight, "ts long").select(tu.ms_to_day("ts")).collect()] for s in (parent, session)]
    assert days[0] == days[1] == ["19700101", "19700102"]
