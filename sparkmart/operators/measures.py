"""Facts to measure rows: one row per fact, with the measures it contributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.functions.codes import GOOD_APPRAISAL
from sparkmart.schemas import AMOUNT, LONG
from sparkmart.sources import progress

# What marks a product click and a product display.
PRODUCT_PAGE = "good_detail"
PRODUCT_ITEM = "sku_id"

VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]
VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]

# Product measures that add up, with their types.
PRODUCT_MEASURES: dict[str, T.DataType] = {
    "display_ct": LONG,
    "click_ct": LONG,
    "favor_ct": LONG,
    "cart_ct": LONG,
    "order_sku_num": LONG,
    "order_amount": AMOUNT,
    "payment_amount": AMOUNT,
    "refund_amount": AMOUNT,
    "comment_ct": LONG,
    "good_comment_ct": LONG,
}
# Ids whose distinct number per group is a measure; a row carries at most one of them.
PRODUCT_IDS = {"order_id": "order_ct", "paid_order_id": "paid_order_ct", "refund_order_id": "refund_order_ct"}


# Visitor measures ----------------------------------------------------------


def _visitor_row(df: DataFrame, **measures: Column) -> DataFrame:
    """One row per fact with its keys and all measures; those not given and nulls are 0."""
    filled = [F.coalesce(measures.get(m, F.lit(0)), F.lit(0)).cast("long").alias(m) for m in VISITOR_MEASURES]
    return df.select("event_time", *[F.col(f"common.{k}") for k in ("mid", *VISITOR_KEYS)], *filled)


def page_measures(pages: DataFrame) -> DataFrame:
    """A page view; it starts a session when no page came before."""
    last_page = F.col("page.last_page_id")
    starts = F.when(last_page.isNull() | (last_page == ""), 1).otherwise(0)
    return _visitor_row(pages, pv_ct=F.lit(1), sv_ct=starts, dur_sum=F.col("page.during_time"))


def unique_visit_measures(visits: DataFrame) -> DataFrame:
    return _visitor_row(visits, uv_ct=F.lit(1))


def bounce_measures(bounced: DataFrame) -> DataFrame:
    return _visitor_row(bounced, uj_ct=F.lit(1))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


# Product measures ----------------------------------------------------------


def _product_row(df: DataFrame, sku: str, time: str, **given: str) -> DataFrame:
    """Measures not given are 0, ids not given are null; a null amount counts 0.

    All arguments are SQL expressions.
    """

    def zeroed(name: str, dtype: str) -> str:
        value = f"coalesce(cast({given[name]} AS {dtype}), 0)" if name in given else "0"
        return f"cast({value} AS {dtype}) AS {name}"

    measures = [zeroed(name, dtype.simpleString()) for name, dtype in PRODUCT_MEASURES.items()]
    ids = [f"cast({given.get(i, 'NULL')} AS bigint) AS {i}" for i in PRODUCT_IDS]
    return df.selectExpr(f"{time} AS event_time", f"cast({sku} AS bigint) AS sku_id", *measures, *ids)


def clicks(pages: DataFrame) -> DataFrame:
    opened = pages.where(F.col("page.page_id") == PRODUCT_PAGE)
    return _product_row(opened, "try_cast(page.item AS bigint)", "event_time", click_ct="1")


def displays(pages: DataFrame) -> DataFrame:
    shown = pages.select("event_time", F.explode("displays").alias("d")).where(F.col("d.item_type") == PRODUCT_ITEM)
    return _product_row(shown, "try_cast(d.item AS bigint)", "event_time", display_ct="1")


def page_actions(pages: DataFrame) -> DataFrame:
    """Clicks and displays together, reading the page log once."""
    action = T.ArrayType(schemas.row(item=schemas.TEXT, click=schemas.INT, display=schemas.INT))

    def act(item: Column, click: int, display: int) -> Column:
        return F.struct(item.alias("item"), F.lit(click).alias("click"), F.lit(display).alias("display"))

    clicked = F.when(F.col("page.page_id") == PRODUCT_PAGE, F.array(act(F.col("page.item"), 1, 0)))
    shown = F.transform(
        F.filter("displays", lambda d: d["item_type"] == PRODUCT_ITEM), lambda d: act(d["item"], 0, 1)
    )
    nothing = F.array().cast(action)
    acts = F.concat(F.coalesce(clicked.cast(action), nothing), F.coalesce(shown.cast(action), nothing))
    rows = pages.select("event_time", F.inline(acts))
    return _product_row(rows, "try_cast(item AS bigint)", "event_time", click_ct="click", display_ct="display")


def favors(facts: DataFrame) -> DataFrame:
    return _product_row(facts, "sku_id", "create_ts", favor_ct="1")


def carts(facts: DataFrame) -> DataFrame:
    return _product_row(facts, "sku_id", "create_ts", cart_ct="1")


def ordered(order_wide: DataFrame) -> DataFrame:
    return _product_row(
        order_wide,
        "sku_id",
        "create_ts",
        order_sku_num="sku_num",
        order_amount="split_total_amount",
        order_id="order_id",
    )


def paid(payment_wide: DataFrame) -> DataFrame:
    return _product_row(
        payment_wide, "sku_id", "callback_ts", payment_amount="split_total_amount", paid_order_id="order_id"
    )


def refunds(facts: DataFrame) -> DataFrame:
    return _product_row(facts, "sku_id", "create_ts", refund_amount="refund_amount", refund_order_id="order_id")


def comments(facts: DataFrame) -> DataFrame:
    good = f"CASE WHEN appraise = '{GOOD_APPRAISAL}' THEN 1 ELSE 0 END"
    return _product_row(facts, "sku_id", "create_ts", comment_ct="1", good_comment_ct=good)


def visitor_union(pages: DataFrame, visits: DataFrame, bounced: DataFrame, watermark: str | None = None) -> DataFrame:
    """Page views, unique visits and bounces as one stream of measures.

    With ``watermark`` each branch gets its own before the union: bounces arrive
    later than their pages, and the slowest branch must hold the time back.
    """
    pages, visits, bounced = (_watermarked(df, "event_time", watermark) for df in (pages, visits, bounced))
    return union_all([page_measures(pages), unique_visit_measures(visits), bounce_measures(bounced)])


def product_union(
    pages: DataFrame,
    favor: DataFrame,
    cart: DataFrame,
    order_wide: DataFrame,
    payment_wide: DataFrame,
    refund: DataFrame,
    comment: DataFrame,
    watermark: str | None = None,
    wide_watermark: str | None = None,
) -> DataFrame:
    """The seven product streams as one; see :func:`visitor_union` for ``watermark``.

    It is set on the facts, not on the measures, so that a page without any
    product action still moves the time on.  That of the wide facts, which joins bring in another order
    than that of time, is ``wide_watermark``, the same by default.
    """
    joined = watermark if wide_watermark is None else wide_watermark
    return union_all(
        [
            page_actions(_watermarked(pages, "event_time", watermark)),
            favors(_watermarked(favor, "create_ts", watermark)),
            carts(_watermarked(cart, "create_ts", watermark)),
            ordered(_watermarked(order_wide, "create_ts", joined)),
            paid(_watermarked(payment_wide, "callback_ts", joined)),
            refunds(_watermarked(refund, "create_ts", watermark)),
            comments(_watermarked(comment, "create_ts", watermark)),
        ]
    )


def _watermarked(df: DataFrame, time: str, watermark: str | None) -> DataFrame:
    """With a watermark, which messages of progress move too; they end here."""
    if watermark is not None:
        df = df.withWatermark(time, watermark)
    return df.where(progress.is_row(F.col(time))) if progress.MARK in df.columns else df
