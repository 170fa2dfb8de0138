"""Event streams derived from the benchmark tables.

Every record keeps a tie-breaker where arrival order matters: ``event_id`` for
events, ``seq`` for logins, the line item key for ad clicks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.session import pin


def load(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    table = pin(spark).read.parquet(path)
    # a stream source takes a single file only through a pattern
    return spark.readStream.schema(table.schema).parquet(path + "*") if streaming else table


def _seconds(df: DataFrame, column: str) -> Column:
    """Epoch seconds of a timestamp column, read as UTC when it carries no zone."""
    return F.unix_seconds(F.col(column).cast("timestamp"))


def _match(column: str, mapping: dict[str, str], other: str) -> Column:
    result = None
    for value, label in mapping.items():
        branch = F.col(column) == value
        result = F.when(branch, label) if result is None else result.when(branch, label)
    return result.otherwise(other)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def user_behavior(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    events = load(spark, sf_dir, "events", streaming)
    kinds = {"view": "pv", "purchase": "buy", "click": "cart"}
    return events.select(
        "user_id",
        _k().alias("item_id"),
        (_k() % 5).cast("int").alias("category_id"),
        _match("event_type", kinds, "fav").alias("behavior"),
        _seconds(events, "ts").alias("timestamp"),
        "event_id",
    )


def access_log(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    events = load(spark, sf_dir, "events", streaming)
    # every page takes part: an event goes to the page at its number, modulo the pages there are
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    number = pages.count()  # read from the file footers
    joined = events.join(pages, F.pmod("event_id", F.lit(max(number, 1))) == F.col("page_id"))
    return joined.select(
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        _seconds(events, "ts").alias("timestamp"),
        F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST").alias("method"),
        F.when(_k() % 10 == 0, "/static/app.css").otherwise(F.col("url")).alias("url"),
        "event_id",
    )


def delayed_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access log with an ``arrival`` order in which every tenth event is 15 minutes late."""
    late = F.when(F.col("event_id") % 10 == 3, 900).otherwise(0)
    order = F.shiftleft(F.col("timestamp") + late, 31) + F.col("event_id")  # unique below 2**31 events
    return access_log(spark, sf_dir).withColumn("arrival", order)


#: Seconds by which an event arrives late, by the last digit of its number; the others arrive in time.
DELAYS = {1: 45, 3: 900, 7: 300, 9: 7200}
RUSH_START = 1_704_067_200


def arriving(rows: DataFrame, number: str) -> DataFrame:
    """``rows`` with ``arrival``: the second in which they arrive."""
    late = F.lit(0)
    for digit, seconds in DELAYS.items():
        late = F.when(F.col(number) % 10 == digit, seconds).otherwise(late)
    return rows.withColumn("arrival", (F.col("timestamp") + late).cast("bigint"))


def rush(rows: DataFrame, fast: int) -> DataFrame:
    """``rows`` so many times as fast, so that windows hold more of them."""
    passed = F.floor((F.col("timestamp") - RUSH_START) / fast).cast("bigint")
    return rows.withColumn("timestamp", RUSH_START + passed)


def marketing(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    events = load(spark, sf_dir, "events", streaming)
    kinds = {"view": "BROWSE", "click": "CLICK", "purchase": "DOWNLOAD", "signup": "INSTALL"}
    channel = F.when(F.col("user_id") % 3 == 0, "app store").when(F.col("user_id") % 3 == 1, "wechat")
    return events.select(
        "user_id",
        _match("event_type", kinds, "UNINSTALL").alias("behavior"),
        channel.otherwise("weibo").alias("channel"),
        _seconds(events, "ts").alias("timestamp"),
        "event_id",
    )


def ad_click(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem", streaming)
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ad = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    clock = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 11) % 86400
    return (
        lineitem.join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("l_suppkey").alias("user_id"),
            ad.cast("bigint").alias("ad_id"),
            F.col("n_name").alias("province"),
            F.concat(F.lit("city"), (F.col("l_suppkey") % 7).cast("string")).alias("city"),
            (F.lit(1704067200) + clock).cast("bigint").alias("timestamp"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        )
    )


def ad_click_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad clicks over 47 hours, so that cycles of a day end within them."""
    clock = (F.col("l_orderkey") * 1237 + F.col("l_linenumber") * 11003) % 169_200
    return ad_click(spark, sf_dir).withColumn("timestamp", (F.lit(1704067200) + clock).cast("bigint"))


CLICK_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def login(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = load(spark, sf_dir, "orders").count() // 4  # read from the file footers
    number = F.row_number().over(Window.partitionBy("user_id").orderBy(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"))
    success = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    attempts = load(spark, sf_dir, "lineitem").withColumn("user_id", F.col("l_orderkey") % users)
    clock = F.lit(1704067200) + F.col("user_id") * 60 + F.expr("seq DIV 2") + F.expr("seq DIV 9") * 7
    return attempts.withColumn("seq", (number - 1).cast("bigint")).select(
        "user_id",
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.when(success, "success").otherwise("fail").alias("login_state"),
        clock.cast("bigint").alias("timestamp"),
        "seq",
    )


def _pay_second() -> Column:
    return F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (F.col("o_orderkey") * 7919) % 1800


def _tx() -> Column:
    return F.concat(F.lit("tx"), F.col("o_orderkey").cast("string"))


def order_event(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    orders = load(spark, sf_dir, "orders", streaming).select("o_orderkey", "o_orderdate")

    def event(kind: str, tx: Column, at: Column) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), tx.alias("tx_id"), at.alias("timestamp"))

    create = F.when(F.col("o_orderkey") % 50 != 7, event("create", F.lit(""), _seconds(orders, "o_orderdate")))
    pay = F.when(F.col("o_orderkey") % 4 != 0, event("pay", _tx(), _pay_second()))
    return orders.select(F.col("o_orderkey").alias("order_id"), F.inline(F.array_compact(F.array(create, pay))))


def receipt(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    orders = load(spark, sf_dir, "orders", streaming).select("o_orderkey", "o_orderdate")
    channel = F.when(F.col("o_orderkey") % 3 == 0, "alipay").when(F.col("o_orderkey") % 3 == 1, "wechat")
    return orders.where("o_orderkey % 6 <> 0").select(
        _tx().alias("tx_id"), channel.otherwise("card").alias("pay_channel"),
        (_pay_second() + (F.col("o_orderkey") * 31) % 13 - 5).alias("timestamp"))
