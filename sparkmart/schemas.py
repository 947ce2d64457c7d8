"""Explicit schemas of the streams and tables."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
AMOUNT = T.DecimalType(16, 2)
TEXT_MAP = T.MapType(TEXT, TEXT)


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Logs.  ``event_id`` is optional in the data; it breaks ties on ``ts``.
LOG = row(
    common=row(mid=TEXT, vc=TEXT, ch=TEXT, ar=TEXT, is_new=TEXT, isNew=TEXT),
    page=row(page_id=TEXT, last_page_id=TEXT, item=TEXT, during_time=LONG),
    displays=T.ArrayType(row(item=TEXT, item_type=TEXT)),
    start=TEXT_MAP,
    ts=LONG,
    event_id=LONG,
)

ORDER_INFO = row(
    id=LONG,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    total_amount=AMOUNT,
    activity_reduce_amount=AMOUNT,
    coupon_reduce_amount=AMOUNT,
    original_total_amount=AMOUNT,
    feight_fee=AMOUNT,
    expire_time=TEXT,
    create_time=TEXT,
    operate_time=TEXT,
    create_date=TEXT,
    create_hour=TEXT,
)

ORDER_DETAIL = row(
    id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=AMOUNT,
    sku_num=LONG,
    sku_name=TEXT,
    create_time=TEXT,
    split_total_amount=AMOUNT,
    split_activity_amount=AMOUNT,
    split_coupon_amount=AMOUNT,
)

PAYMENT_INFO = row(
    id=LONG,
    order_id=LONG,
    user_id=LONG,
    total_amount=AMOUNT,
    subject=TEXT,
    payment_type=TEXT,
    create_time=TEXT,
    callback_time=TEXT,
)

FAVOR_INFO = row(
    sku_id=LONG,
    create_time=TEXT,
)
CART_INFO = FAVOR_INFO
REFUND_INFO = row(
    sku_id=LONG,
    order_id=LONG,
    refund_amount=AMOUNT,
    create_time=TEXT,
)
COMMENT_INFO = row(
    sku_id=LONG,
    appraise=TEXT,
    create_time=TEXT,
)

ORDER_WIDE = row(
    detail_id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=AMOUNT,
    sku_num=LONG,
    sku_name=TEXT,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    total_amount=AMOUNT,
    activity_reduce_amount=AMOUNT,
    coupon_reduce_amount=AMOUNT,
    original_total_amount=AMOUNT,
    feight_fee=AMOUNT,
    split_feight_fee=AMOUNT,
    split_activity_amount=AMOUNT,
    split_coupon_amount=AMOUNT,
    split_total_amount=AMOUNT,
    expire_time=TEXT,
    create_time=TEXT,
    operate_time=TEXT,
    create_date=TEXT,
    create_hour=TEXT,
    province_name=TEXT,
    province_area_code=TEXT,
    province_iso_code=TEXT,
    province_3166_2_code=TEXT,
    user_age=INT,
    user_gender=TEXT,
    spu_id=LONG,
    tm_id=LONG,
    category3_id=LONG,
    spu_name=TEXT,
    tm_name=TEXT,
    category3_name=TEXT,
)

PAYMENT_WIDE = row(
    payment_id=LONG,
    subject=TEXT,
    payment_type=TEXT,
    payment_create_time=TEXT,
    callback_time=TEXT,
    detail_id=LONG,
    order_id=LONG,
    sku_id=LONG,
    order_price=AMOUNT,
    sku_num=LONG,
    sku_name=TEXT,
    province_id=LONG,
    order_status=TEXT,
    user_id=LONG,
    total_amount=AMOUNT,
    activity_reduce_amount=AMOUNT,
    coupon_reduce_amount=AMOUNT,
    original_total_amount=AMOUNT,
    feight_fee=AMOUNT,
    split_feight_fee=AMOUNT,
    split_activity_amount=AMOUNT,
    split_coupon_amount=AMOUNT,
    split_total_amount=AMOUNT,
    order_create_time=TEXT,
    province_name=TEXT,
    province_area_code=TEXT,
    province_iso_code=TEXT,
    province_3166_2_code=TEXT,
    user_age=INT,
    user_gender=TEXT,
    spu_id=LONG,
    tm_id=LONG,
    category3_id=LONG,
    spu_name=TEXT,
    tm_name=TEXT,
    category3_name=TEXT,
)

# Change records.
CHANGE = row(
    database=TEXT,
    table=TEXT,
    type=TEXT,
    data=TEXT_MAP,
    before=TEXT_MAP,
    ts=LONG,
)

# Routing rules, as stored in the rule table of the source database.
RULE_FIELDS = {
    "source_table": "sourceTable",
    "operate_type": "operateType",
    "sink_type": "sinkType",
    "sink_table": "sinkTable",
    "sink_columns": "sinkColumns",
    "sink_pk": "sinkPk",
    "sink_extend": "sinkExtend",
}
RULE = row(**dict.fromkeys(RULE_FIELDS, TEXT))

# Statistics, in the column order of their sink tables.
VISITOR_STATS_COLUMNS = [
    "stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts",
]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
