"""Wide facts: order with detail and dimensions, payment with order."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import parse_json
from sparkmart.operators.joins import dim_join, interval_join

# Which columns a wide row takes from which side.
ORDER_COLUMNS = [
    "order_status", "create_time", "create_date", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "total_amount", "province_id", "user_id",
]
DETAIL_COLUMNS = [
    "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount", "split_coupon_amount",
    "split_total_amount",
]
# Declared in the wide row but filled by neither side.
UNFILLED_COLUMNS = ["expire_time", "operate_time", "create_hour", "split_feight_fee"]
PAYMENT_COLUMNS = ["subject", "payment_type", "callback_time", "order_id", "user_id", "total_amount"]


class Dimensions(NamedTuple):
    """Dimension tables, one row per ``id`` each."""

    user: DataFrame
    province: DataFrame
    sku: DataFrame
    spu: DataFrame
    category3: DataFrame
    trademark: DataFrame


def parse_facts(raw: DataFrame, schema: T.StructType, time: str = "create_time", value: str = "value") -> DataFrame:
    """Fact text to typed rows plus the event time read from text column ``time``.

    The event time is ``create_ts``, or ``callback_ts`` if read from ``callback_time``.
    """
    return parse_json(raw, schema, value).withColumn(time.replace("_time", "_ts"), tu.text_to_timestamp(time))


def order_detail_join(
    orders: DataFrame, details: DataFrame, lower_seconds: int = -5, upper_seconds: int = 5, salts: int = 1
) -> DataFrame:
    """Order and detail rows created within seconds of each other, as wide rows without dimensions.

    The order's ``create_ts`` stays as the event time.
    """
    joined = interval_join(
        orders, details, "id", "order_id", "create_ts", "create_ts", lower_seconds, upper_seconds, salts
    )
    unfilled = [F.lit(None).cast(schemas.ORDER_WIDE[c].dataType).alias(c) for c in UNFILLED_COLUMNS]
    return joined.select(
        F.col("r.id").alias("detail_id"),
        F.col("l.id").alias("order_id"),
        *[F.col(f"l.{c}") for c in ORDER_COLUMNS],
        *[F.col(f"r.{c}") for c in DETAIL_COLUMNS],
        *unfilled,
        F.col("l.create_ts"),
    )


def with_user(df: DataFrame, user: DataFrame, as_of: Column | None = None) -> DataFrame:
    age = tu.age_in_years("birthday", as_of)
    return dim_join(df, user, "user_id", {"user_age": age, "user_gender": F.col("gender")})


def with_province(df: DataFrame, province: DataFrame) -> DataFrame:
    outputs = {
        "province_name": "name",
        "province_area_code": "area_code",
        "province_iso_code": "iso_code",
        "province_3166_2_code": "iso_3166_2",
    }
    return dim_join(df, province, "province_id", outputs)


def with_sku(df: DataFrame, sku: DataFrame, names: bool = False) -> DataFrame:
    """Product, brand and category ids; with ``names`` also the sku's name and price."""
    outputs = {"spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id"}
    if names:
        outputs |= {"sku_name": "sku_name", "sku_price": "price"}
    return dim_join(df, sku, "sku_id", outputs)


def with_spu(df: DataFrame, spu: DataFrame) -> DataFrame:
    return dim_join(df, spu, "spu_id", {"spu_name": "spu_name"})


def with_category3(df: DataFrame, category3: DataFrame) -> DataFrame:
    return dim_join(df, category3, "category3_id", {"category3_name": "name"})


def with_trademark(df: DataFrame, trademark: DataFrame) -> DataFrame:
    return dim_join(df, trademark, "tm_id", {"tm_name": "tm_name"})


def full_sku(dims: Dimensions) -> DataFrame:
    """The sku dimension with its product, category and brand names joined on.

    Joining the small tables to the sku table once leaves one join for the facts
    instead of four; each lookup keeps its row, so the result is the same.
    """
    return with_trademark(with_category3(with_spu(dims.sku, dims.spu), dims.category3), dims.trademark)


SKU_ATTRIBUTES = {c: c for c in ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")}


def with_full_sku(df: DataFrame, dims: Dimensions, names: bool = False) -> DataFrame:
    outputs = dict(SKU_ATTRIBUTES)
    if names:
        outputs |= {"sku_name": "sku_name", "sku_price": "price"}
    return dim_join(df, full_sku(dims), "sku_id", outputs)


def order_wide(joined: DataFrame, dims: Dimensions, as_of: Column | None = None) -> DataFrame:
    """Joined order rows with all dimension attributes, in the wide schema plus ``create_ts``."""
    wide = with_full_sku(with_province(with_user(joined, dims.user, as_of), dims.province), dims)
    return wide.select(*schemas.ORDER_WIDE.names, "create_ts")


def payment_wide(
    payments: DataFrame, orders: DataFrame, lower_seconds: int = -1800, upper_seconds: int = 0, salts: int = 1
) -> DataFrame:
    """Payments with the wide order rows created in the half hour before the callback.

    ``payments`` carries ``callback_ts`` and ``orders`` carries ``create_ts``.  Where
    both sides have a column of the same name the payment's is taken, null or not.
    """
    joined = interval_join(
        payments, orders, "order_id", "order_id", "callback_ts", "create_ts", lower_seconds, upper_seconds, salts
    )
    renamed = {
        "payment_id": F.col("l.id"),
        "payment_create_time": F.col("l.create_time"),
        "order_create_time": F.col("r.create_time"),
    }

    def source(name: str) -> Column:
        if name in renamed:
            return renamed[name].alias(name)
        return F.col(f"l.{name}") if name in PAYMENT_COLUMNS else F.col(f"r.{name}")

    return joined.select(*[source(c) for c in schemas.PAYMENT_WIDE.names], F.col("l.callback_ts"))
