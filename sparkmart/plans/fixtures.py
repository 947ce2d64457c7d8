"""The benchmark tables read as the streams and dimensions of the warehouse.

Plain projections, so that a query over them costs what its operators cost.
The amounts, ids and texts chosen here have no meaning of their own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.functions import timeutil as tu
from sparkmart.functions.jsonutil import to_json_text
from sparkmart.operators.wide import Dimensions
from sparkmart.schemas import AMOUNT
from sparkmart.sources.files import size
from sparkmart.sources.tables import balanced, read_table

AS_OF = "2024-01-01"


# Schemas of the benchmark tables, and the keys that spread the larger ones.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING""",
}
SPREAD_BY = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey"], "events": ["event_id"]}


class Fixtures:
    """Warehouse inputs over one folder of benchmark tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = read_table(self.spark, f"{self.folder}/{name}.parquet", TABLES[name])
            spread = SPREAD_BY.get(name)
            self._tables[name] = balanced(df, *spread, size=self.bytes_of(name)) if spread else df
        return self._tables[name]

    def bytes_of(self, *names: str) -> int:
        """The size of these tables at rest."""
        return sum(size(self.spark, f"{self.folder}/{name}.parquet") for name in names)

    # Logs ------------------------------------------------------------------

    def raw_events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time"),
            "user_id",
            "event_type",
            "value",
            k.alias("k"),
        )

    @cached_property
    def parts(self) -> int:
        return self.table("part").count()

    def _sku_of_user(self, shift: int = 0) -> Column:
        return F.pmod(F.col("user_id") + shift, F.lit(self.parts))

    def logs(self) -> DataFrame:
        """Typed logs, as ``decode_logs`` returns them."""
        kind = F.col("event_type")
        item_type = schemas.LOG["displays"].dataType

        def display(i: Column) -> Column:
            name = F.when(i % 2 == 0, "sku_id").otherwise("promotion")
            return F.struct(F.col("_sku")[i].alias("item"), name.alias("item_type"))

        skus = F.array(*[self._sku_of_user(i).cast("string") for i in range(3)])
        shown = F.transform(F.slice(F.sequence(F.lit(0), F.lit(2)), 1, F.col("k") % 4), display)
        return self.raw_events().withColumn("_sku", skus).select(
            F.struct(
                F.col("user_id").cast("string").alias("mid"),
                F.concat(F.lit("v"), F.col("k") % 3).alias("vc"),
                F.concat(F.lit("ch"), F.col("k") % 4).alias("ch"),
                (F.col("user_id") % 25).cast("string").alias("ar"),
                F.when(F.col("k") < 50, "1").otherwise("0").alias("is_new"),
            ).alias("common"),
            F.struct(
                F.when(kind == "click", "good_detail").otherwise(kind).alias("page_id"),
                F.when(kind.isin("view", "signup"), F.lit(None).cast("string")).otherwise("home").alias("last_page_id"),
                F.col("_sku")[0].alias("item"),
                F.round(F.col("value") * 1000).cast("long").alias("during_time"),
            ).alias("page"),
            shown.cast(item_type).alias("displays"),
            F.when((kind == "signup") & (F.col("k") % 2 == 0), F.create_map(F.lit("entry"), F.lit("icon")))
            .otherwise(F.create_map().cast("map<string,string>"))
            .alias("start"),
            F.unix_millis("event_time").alias("ts"),
            "event_id",
            tu.ms_to_timestamp(F.unix_millis("event_time")).alias("event_time"),
        )

    def whole_logs(self) -> DataFrame:
        """The same logs as text, with fields that the schemas do not know."""
        k = F.pmod(F.col("event_id"), F.lit(7)).cast("int")
        common = F.col("common").withField("uid", F.concat(F.lit("u"), "common.mid")).withField("os", F.concat(F.lit("os"), k))
        displays = F.transform("displays", lambda d, i: d.withField("order", i + 1).withField("display_type", F.lit("query")))
        actions = F.when(k == 1, F.array(F.struct(F.lit("get").alias("action_id"), F.col("ts").alias("ts"))))
        error = F.when(k == 2, F.struct((F.col("event_id") % 100).alias("code"), F.lit("m").alias("msg")))
        page = F.col("page").withField("source_type", F.lit("query"))
        fields = [common.alias("common"), page.alias("page"), displays.alias("displays"), "start", "ts", "event_id"]
        return self.logs().select(to_json_text(*fields, actions.alias("actions"), error.alias("err")).alias("value"))

    def raw_logs(self) -> DataFrame:
        """The same logs as text, some of them broken off in the middle."""
        fields = ("common", "page", "displays", "start", "ts", "event_id")
        text = to_json_text(*fields)
        broken = F.col("page.during_time") % 50 == 49
        return self.logs().select(
            F.col("event_id").alias("log_id"),
            F.when(broken, F.substring(text, 1, 20)).otherwise(text).alias("value"),
        )

    # Facts -----------------------------------------------------------------

    def orders(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        joined = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        created = F.col("o_orderdate").cast("timestamp")
        amount = F.col("o_totalprice").cast(AMOUNT)
        missing = ["expire_time", "operate_time", "create_hour"]
        return joined.select(
            F.col("o_orderkey").alias("id"),
            F.col("c_nationkey").cast("long").alias("province_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_custkey").alias("user_id"),
            amount.alias("total_amount"),
            F.lit(None).cast(AMOUNT).alias("activity_reduce_amount"),
            F.lit(None).cast(AMOUNT).alias("coupon_reduce_amount"),
            amount.alias("original_total_amount"),
            F.lit(5).cast(AMOUNT).alias("feight_fee"),
            *[F.lit(None).cast("string").alias(c) for c in missing],
            tu.timestamp_to_text(created).alias("create_time"),
            F.date_format(created, "yyyy-MM-dd").alias("create_date"),
            created.alias("create_ts"),
        )

    def _line_amount(self) -> Column:
        price = F.col("l_extendedprice").cast(AMOUNT)
        return (price * (1 - F.col("l_discount").cast(T.DecimalType(4, 2)))).cast(AMOUNT)

    def details(self) -> DataFrame:
        created = F.col("l_shipdate").cast("timestamp")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_extendedprice").cast(AMOUNT).alias("order_price"),
            F.col("l_quantity").cast("long").alias("sku_num"),
            F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"),
            tu.timestamp_to_text(created).alias("create_time"),
            self._line_amount().alias("split_total_amount"),
            F.lit(None).cast(AMOUNT).alias("split_activity_amount"),
            F.lit(None).cast(AMOUNT).alias("split_coupon_amount"),
            created.alias("create_ts"),
        )

    def payments(self) -> DataFrame:
        created = F.col("o_orderdate").cast("timestamp")
        called = F.timestamp_micros(F.unix_micros(created) + F.col("o_orderkey") % 60 * 60_000_000)
        return (
            self.table("orders")
            .where(F.col("o_orderstatus") == "F")
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("user_id"),
                (F.col("o_totalprice").cast(AMOUNT) + 1).cast(AMOUNT).alias("total_amount"),
                F.concat(F.lit("order "), F.col("o_orderkey")).alias("subject"),
                F.lit("1101").alias("payment_type"),
                tu.timestamp_to_text(created).alias("create_time"),
                tu.timestamp_to_text(called).alias("callback_time"),
                called.alias("callback_ts"),
            )
        )

    def _user_action(self, kind: str) -> DataFrame:
        rows = self.raw_events().where(F.col("event_type") == kind)
        return rows.select(self._sku_of_user().alias("sku_id"), F.col("event_time").alias("create_ts"))

    def favors(self) -> DataFrame:
        return self._user_action("view")

    def carts(self) -> DataFrame:
        return self._user_action("purchase")

    def refunds(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "R")
            .select(
                F.col("l_partkey").alias("sku_id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_extendedprice").cast(AMOUNT).alias("refund_amount"),
                F.col("l_shipdate").cast("timestamp").alias("create_ts"),
            )
        )

    def comments(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "A")
            .select(
                F.col("l_partkey").alias("sku_id"),
                F.when(F.col("l_linestatus") == "F", "1201").otherwise("1203").alias("appraise"),
                F.col("l_shipdate").cast("timestamp").alias("create_ts"),
            )
        )

    # Dimensions ------------------------------------------------------------

    def users(self) -> DataFrame:
        days = (F.col("c_custkey") * 37 % 14000).cast("int")
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
            F.date_add(F.lit("1960-01-01").cast("date"), days).alias("birthday"),
        )

    def provinces(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").cast("long").alias("id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("area_code"),
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("iso_code"),
            F.concat(F.lit("ISO-"), F.col("n_nationkey")).alias("iso_3166_2"),
        )

    def _spu_id(self) -> Column:
        return F.ascii(F.substring("p_type", 2, 1)).cast("long")

    def _tm_id(self) -> Column:
        return F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")

    def skus(self) -> DataFrame:
        """Every tenth part is left out, so that lookups miss."""
        return (
            self.table("part")
            .where(F.col("p_partkey") % 10 != 0)
            .select(
                F.col("p_partkey").alias("id"),
                F.col("p_name").alias("sku_name"),
                F.col("p_retailprice").cast(AMOUNT).alias("price"),
                self._spu_id().alias("spu_id"),
                self._tm_id().alias("tm_id"),
                F.col("p_size").cast("long").alias("category3_id"),
            )
        )

    def spus(self) -> DataFrame:
        return self.table("part").select(self._spu_id().alias("id"), F.col("p_type").alias("spu_name")).distinct()

    def trademarks(self) -> DataFrame:
        return self.table("part").select(self._tm_id().alias("id"), F.col("p_brand").alias("tm_name")).distinct()

    def categories(self) -> DataFrame:
        """Size 1 is left out, so that lookups miss."""
        sizes = self.table("part").where(F.col("p_size") != 1).select(F.col("p_size").cast("long").alias("id"))
        return sizes.distinct().withColumn("name", F.concat(F.lit("category "), F.col("id")))

    def dimensions(self) -> Dimensions:
        return Dimensions(
            self.users(), self.provinces(), self.skus(), self.spus(), self.categories(), self.trademarks()
        )

    # Change records --------------------------------------------------------

    def _priority(self) -> Column:
        return F.substring("o_orderpriority", 1, 1)

    def change_records(self) -> DataFrame:
        """Flat change records as text: ``o_orderkey`` and ``value``."""
        key = F.col("o_orderkey")
        kinds = {"1": "bootstrap-insert", "2": "insert", "3": "update", "4": "delete", "5": "insert"}
        names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
        table = F.when(key % 11 == 0, "").when(key % 13 == 0, "payments").otherwise("orders")
        # Null fields are left out of the text, so the "5" records have empty data.
        given = self._priority() != "5"
        data = F.struct(
            F.when(given, key).alias("id"),
            F.when(given, F.col("o_orderstatus")).alias("status"),
            F.when(given, F.col("o_totalprice").cast(AMOUNT).cast("string")).alias("total"),
            F.when(given, F.concat(F.lit("n'"), F.col("o_custkey"))).alias("note"),
        )
        return self.table("orders").select(
            "o_orderkey",
            to_json_text(
                F.lit("shop").alias("database"),
                table.alias("table"),
                names[self._priority()].alias("type"),
                data.alias("data"),
                key.alias("ts"),
            ).alias("value"),
        )

    def envelopes(self) -> DataFrame:
        """Connector envelopes about a customer's balance, one per order: ``o_orderkey`` and ``value``."""
        key = F.col("o_orderkey")
        codes = {"1": "r", "2": "c", "3": "u", "4": "d", "5": "u"}
        names = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
        image = F.struct(
            F.col("o_custkey").alias("id"),
            F.concat(F.lit("name "), key).alias("name"),
            (key % 90).alias("age"),
        )
        removed = self._priority() == "4"
        return self.table("orders").select(
            "o_orderkey",
            to_json_text(
                names[self._priority()].alias("op"),
                F.struct(F.lit("shop").alias("db"), F.lit("user_info").alias("table")).alias("source"),
                F.when(removed, image).alias("before"),
                F.when(~removed, image).alias("after"),
                key.alias("ts_ms"),
            ).alias("value"),
        )

    def rule_changes(self) -> DataFrame:
        """Changes of routing rules, one per order; each customer stands for one source table."""
        key, removed = F.col("o_orderkey"), self._priority() == "4"
        data = F.create_map(
            F.lit("source_table"), F.concat(F.lit("t"), F.col("o_custkey")),
            F.lit("operate_type"), F.when(F.col("o_orderstatus") == "F", "insert").otherwise("update"),
            F.lit("sink_type"), F.when(self._priority() == "1", "hbase").otherwise("kafka"),
            F.lit("sink_table"), F.concat(F.lit("sink_"), key),
            F.lit("sink_columns"), F.lit("id,status"),
            F.lit("sink_pk"), F.lit("id"),
            F.lit("sink_extend"), F.lit(None).cast("string"),
        )
        empty = F.create_map().cast("map<string,string>")
        # Every other delete comes without an image and must be ignored.
        return self.table("orders").select(
            F.lit("shop").alias("database"),
            F.lit("table_process").alias("table"),
            F.when(removed, "delete").when(self._priority() == "3", "update").otherwise("insert").alias("type"),
            F.when(removed, empty).otherwise(data).alias("data"),
            F.when(removed & (key % 2 == 0), data).alias("before"),
            key.alias("ts"),
        )

    def rules(self) -> DataFrame:
        rows = [
            ("orders", "insert", "kafka", "dwd_orders", "id,total", None, None),
            ("orders", "update", "hbase", "dim_orders", "id,status", "id", None),
            ("payments", "insert", "clickhouse", "ck_payments", "id,total", None, None),
        ]
        literals = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(schemas.RULE.names, r)]) for r in rows]
        return self.spark.range(1).select(F.inline(F.array(*literals)))
