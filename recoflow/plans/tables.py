"""The library's input tables, derived from the TPC-H-like star schema and the event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recoflow.operators import preference, windows
from recoflow.schemas import KEY_VALUE_DUMP

# All recency rules of the registered queries use this moment as "now".
NOW = datetime(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(props: Column) -> Column:
    return F.regexp_extract(props, "[0-9]+", 0).cast("bigint")


def _case(column: Column, labels: dict, default: object) -> Column:
    result = F.when(F.lit(False), F.lit(default))
    for value, label in labels.items():
        result = result.when(column == value, F.lit(label))
    return result.otherwise(F.lit(default))


def behavior_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kinds = {"view": "VIEW", "click": "CLICK", "signup": "ADD_TO_CART", "purchase": "PURCHASE"}
    rating = F.when(F.col("event_type") == "error", 1.0 + (F.col("event_id") % 9) * 0.5)
    return e.select(
        "event_id", (F.col("user_id") + 1).alias("user_id"), (_k(F.col("props")) + 1).alias("item_id"),
        _case(F.col("event_type"), kinds, "RATE").alias("behavior_type"), rating.alias("rating"),
        F.col("ts").alias("event_time"),
    )


def item_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth part is off the shelf."""
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 10 != 7)
    return p.select(
        (F.col("p_partkey") + 1).alias("item_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"), F.col("p_brand").alias("tags"),
    )


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    return c.select(
        (key + 1).alias("user_id"), F.col("c_name").alias("nickname"),
        _case(key % 3, {0: "MALE", 1: "FEMALE"}, "UNKNOWN").alias("gender"),
        F.when(key % 4 != 0, F.lit("25-34")).alias("age_range"),
        F.when(key % 5 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("region"),
        F.when(key % 2 == 0, F.col("c_mktsegment")).alias("preference_tags"),
    )


def preference_deltas(spark: SparkSession, sf_dir: str, length: str = "1 day") -> DataFrame:
    """Window deltas with the day of the window as batch id."""
    deltas = windows.preference_delta(behavior_events(spark, sf_dir), length)
    return deltas.withColumn("batch_id", F.dayofmonth("window_start").cast("bigint"))


def preference_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.roll_up(windows.preference_delta(behavior_events(spark, sf_dir)))


def recall_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of a list for every user: all items the user with the next id prefers, best first."""
    best = Window.partitionBy("user_id").orderBy(F.desc("preference_score"), F.asc("item_id"))
    ranked = preference_matrix(spark, sf_dir).withColumn("rank_position", F.row_number().over(best))
    versions = F.explode(F.array(F.lit("als_v0"), F.lit("als_v1"), F.lit("als_v2")))
    return ranked.select(
        versions.alias("model_version"), (F.col("user_id") - 1).alias("user_id"), "item_id", "rank_position",
        F.col("preference_score").alias("score"), F.lit("ALS").alias("source"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as JSON messages; every seventh is sent twice, every 97th is negative."""
    return table(spark, sf_dir, "orders").selectExpr(
        "*", "explode(IF(o_orderkey % 7 = 0, array(0, 1), array(0))) AS copy",
    ).selectExpr(
        "o_orderkey * 2 + copy AS seq", "'etl.order.events' AS topic",
        """to_json(struct(
            struct(concat('evt-', o_orderkey) AS value) AS eventId, concat('ORD-', o_orderkey) AS orderId,
            o_custkey AS userId,
            CASE o_orderstatus WHEN 'O' THEN 'PAID' WHEN 'F' THEN 'COMPLETED' ELSE 'CREATED' END AS status,
            CAST(IF(o_orderkey % 97 = 0, -o_totalprice, o_totalprice) AS DECIMAL(18,2)) AS amount,
            CASE o_orderkey % 5 WHEN 0 THEN 'CNY' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'JPY' ELSE 'GBP' END
              AS currency,
            date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss") AS occurredAt)) AS value""",
    )


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls per customer, the second older for odd keys; every tenth payload is an error answer.

    Customers are dealt out first: they may lie in one small file, and parsing payloads is much work for few bytes.
    """
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").repartition("c_custkey").selectExpr(
        "*", "explode(array(0, 1)) AS d",
    ).selectExpr("*", "concat(c_name, '-', d) AS name").selectExpr(
        "c_custkey * 2 + d AS seq", "c_custkey + 1 AS supplier_id",
        "concat(CASE c_custkey % 3 WHEN 0 THEN 'KD_' WHEN 1 THEN 'YY_' ELSE 'GEN_' END, c_custkey) AS supplier_code",
        "CASE c_custkey % 3 WHEN 0 THEN 'KINGDEE' WHEN 1 THEN 'YONYOU' ELSE 'GENERIC' END AS erp_type",
        """CASE WHEN c_custkey % 10 = 9 THEN '{"code":500,"message":"mock error"}'
            WHEN c_custkey % 3 = 0 THEN concat('[["FID-', c_custkey, '","', name, '","SUP-', c_custkey, '","',
              IF(c_nationkey % 2 = 0, 'A', 'B'), '","2024-01-01 00:00:00"]]')
            WHEN c_custkey % 3 = 1 THEN concat('{"code":0,"data":{"rows":[{"code":"SUP-', c_custkey, '","name":"', name,
              '","status":"', IF(c_nationkey % 2 = 0, '1', 'N'), '"}]}}')
            ELSE concat('{"records":[{"id":', c_custkey, ',"name":"', name, '","status":"',
              CASE c_nationkey % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'INVALID' ELSE 'odd' END, '"}]}') END
            AS raw_payload""",
        "CAST(NULL AS STRING) AS page_token", "concat(' p', c_custkey) AS next_page_token",
        """timestampadd(HOUR, IF(c_custkey % 2 = 1, -d, d), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS pulled_at""",
    )


def pull_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("audit_id"), (F.col("user_id") + 1).alias("supplier_id"),
        _case(F.col("event_type"), {"error": "FAILURE", "signup": "SKIPPED_DUPLICATE"}, "SUCCESS").alias("outcome"),
        F.floor(F.col("value") * 10).alias("duration_ms"), F.col("ts").alias("executed_at"),
    )


def supplier_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduling state per customer, times within a day around NOW."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    status = _case(key % 11, {0: "SUSPENDED", 1: "PAUSED"}, "ACTIVE")
    lease = (F.when(key % 6 == 0, F.timestamp_add("MINUTE", F.lit(5), now))
             .when(key % 6 == 1, F.timestamp_add("MINUTE", F.lit(-5), now)))
    return c.select(
        (key + 1).alias("supplier_id"),
        F.concat(_case(key % 3, {0: "KD_", 1: "YY_"}, "GEN_"), key).alias("supplier_code"), status.alias("status"),
        (F.lit(300) + (key % 4) * 300).cast("int").alias("pull_interval_seconds"),
        F.timestamp_add("MINUTE", ((key * 37) % 1440 - 720).cast("int"), now).alias("next_pull_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_success_at"), F.lit(None).cast("timestamp_ntz").alias("last_error_at"),
        F.concat(F.lit("2024-01-01|"), (key % 50)).alias("last_cursor"), (key % 8).cast("int").alias("retry_count"),
        lease.alias("lease_until"), (key % 3).alias("version"), now.alias("updated_at"),
    )


def pull_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One outcome per connection; every ninth carries an outdated version."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    now = F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    kinds = {0: "SUCCESS", 1: "SUCCESS", 2: "AUTH_FAILURE", 3: "RATE_LIMITED", 4: "TIMEOUT"}
    stale = F.when(key % 9 == 0, F.lit(1)).otherwise(F.lit(0))
    return c.select(
        (key + 1).alias("supplier_id"), (key % 3 + stale).alias("version"),
        _case(key % 6, kinds, "DATA_ERROR").alias("outcome"),
        F.timestamp_add("SECOND", (key % 60).cast("int"), now).alias("finished_at"),
        F.concat(F.lit("2024-01-31|"), (key % 50 + 1)).alias("next_cursor"),
        F.when(key % 2 == 1, F.timestamp_add("MINUTE", F.lit(10), now)).alias("retry_after"),
    )


PAYMENT_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"]


def payment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment request per line item. Line numbers repeat, so more columns order the requests."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_no"), *PAYMENT_ORDER,
        _case(F.col("l_partkey") % 3, {0: "START", 1: "SUCCESS"}, "CLOSE").alias("action"),
    )


def reservation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    actions = {0: "ORDER", 1: "PAY", 2: "CANCEL", 3: "EXPIRE", 4: "RELEASE", 5: "ORDER"}
    return li.select(
        F.col("l_orderkey").alias("reservation_id"), *PAYMENT_ORDER,
        _case(F.col("l_partkey") % 7, actions, "PAY").alias("action"),
    )


def reservation_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sku each reservation holds."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("reservation_id"), (F.col("o_custkey") % 40).alias("sku_id"))


def reserved_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock that all reservations hold, and five pieces more of each sku."""
    held = reservation_skus(spark, sf_dir).groupBy("sku_id").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    return held.select(
        "sku_id", (F.col("n") + 5).alias("total_stock"), F.lit(5).cast("bigint").alias("available_stock"),
        F.col("n").alias("reserved_stock"), none.alias("sold_stock"), none.alias("version"))


def payment_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create requests: one per order, resent for every third one, with another key for every fifteenth."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    sent = o.withColumn("d", F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    changed = (F.col("d") == 1) & (key % 15 == 0)
    return sent.select(
        key.alias("order_no"), F.concat(F.lit("idem-"), key, F.when(changed, F.lit("-x")).otherwise(F.lit("")))
        .alias("idempotency_key"), (key * 2 + F.col("d")).alias("seq"), F.col("o_custkey").alias("user_id"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_fen"),
    )


def payment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment rows, some of them inconsistent with their status."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = _case(key % 4, {0: "UNPAID", 1: "PAYING", 2: "SUCCESS"}, "CLOSED")
    at = F.col("o_orderdate")
    none = F.lit(None).cast("timestamp_ntz")
    has_start = (key % 4).isin(1, 2) & (key % 13 != 1)
    return o.select(
        key.alias("order_no"), F.when(key % 101 != 0, F.concat(F.lit("idem-"), key)).otherwise(F.lit(" "))
        .alias("idempotency_key"), (F.col("o_custkey") + 1).alias("user_id"), F.lit("P").alias("product_code"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_fen"), status.alias("status"),
        F.when((key % 4 == 2) & (key % 17 != 2), F.concat(F.lit("CH-"), key)).alias("channel_trade_no"),
        F.when(has_start, at).otherwise(none).alias("paying_started_at"),
        F.when(key % 4 == 2, at).otherwise(none).alias("paid_at"),
        F.when((key % 4 == 3) | (key % 19 == 0), at).otherwise(none).alias("closed_at"),
    )


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = _case(key % 6, {0: "RESERVED", 1: "ORDER_CREATED", 2: "PAID", 3: "CANCELLED", 4: "EXPIRED"}, "RELEASED")
    return o.select(
        key.alias("reservation_id"), status.alias("status"),
        F.when(key % 5 != 0, F.concat(F.lit("PO-"), key)).alias("payment_order_no"),
        F.when(key % 7 != 0, F.col("o_orderdate")).alias("released_at"),
    )


def reserve_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    return e.select(
        F.col("event_id").alias("seq"), F.lit(1).alias("activity_id"), (_k(F.col("props")) % 20).alias("sku_id"),
        (F.col("user_id") + 1).alias("user_id"), F.col("ts").alias("at"),
    )


def sku_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per requested sku; sku 19 has no row."""
    skus = reserve_requests(spark, sf_dir).select("sku_id").distinct().filter(F.col("sku_id") != 19)
    zero = F.lit(0).cast("bigint")
    return skus.select(
        "sku_id", F.lit(25).cast("bigint").alias("total_stock"), F.lit(25).cast("bigint").alias("available_stock"),
        zero.alias("reserved_stock"), zero.alias("sold_stock"), zero.alias("version"),
    )


def stock_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kinds = {"view": "RESERVE", "click": "RESERVE", "purchase": "CONFIRM", "signup": "RELEASE"}
    return e.select(
        F.col("event_id").alias("seq"), (_k(F.col("props")) % 20).alias("sku_id"),
        _case(F.col("event_type"), kinds, "CONFIRM").alias("move"),
    )


OTHER_ADDRESSES = ["2001:4860:4860::8888", "::ffff:8.8.8.8", "2A00:1450:4001:80b::200e", "2001:::::1", "2002:7f00:1::", "::ffff:10.0.0.1", "::1", "fe80::1"]


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connection tests: client, target host and address, some of them IPv6, malformed or null."""
    e, k = table(spark, sf_dir, "events"), _k(F.col("props"))
    octets = {0: "10.0.", 1: "192.168.", 2: "8.8.", 3: "172.20.", 4: "203.0.", 5: "127.0.", 6: "169.254."}
    address = F.when(k == 99, F.lit("169.254.169.254")).otherwise(
        F.concat(_case(k % 7, octets, "8.8."), (k % 13).cast("string"), F.lit("."), (k % 29).cast("string")))
    others = F.array(*[F.lit(x) for x in OTHER_ADDRESSES])
    address = F.when(k % 11 == 4, F.get(others, F.floor(k / 11).cast("int"))).otherwise(address)
    host = F.when(k % 10 == 0, F.lit("LOCALHOST")).when(k % 10 == 1, F.concat(F.lit("db"), k, F.lit(".local"))).otherwise(
        F.concat(F.lit("db"), k, F.lit(".example.org")))
    return e.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("10.1.0."), F.col("user_id") % 20).alias("client"),
        host.alias("host"), address.alias("address"), F.col("ts").alias("at"),
    )


def key_value_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-value export: a string, hash, list or set per customer, one unknown kind."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    kind = _case(key % 6, {0: "string", 1: "hash", 2: "list", 3: "set", 4: "zset"}, "stream")
    items = F.transform(F.sequence(F.lit(1), (key % 150 + 1).cast("int")), lambda i: F.concat(F.lit("i"), i))
    fields = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    columns = [
        F.concat(F.when(key % 2 == 0, F.lit("user:")).otherwise(F.lit("cart:")), key).alias("key"), kind.alias("type"),
        F.when(key % 6 == 0, F.col("c_name")).alias("text"), F.when(key % 6 == 1, fields).alias("fields"),
        F.when((key % 6).isin(2, 3, 4), items).alias("items"),
    ]
    return c.select(*columns).select(*KEY_VALUE_DUMP.names)


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a sheet export: a title line, a header with one unnamed column, data, blank lines."""
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    data = F.concat_ws(",", key.cast("string"), F.col("c_name"), F.col("c_mktsegment"))
    text = (F.when(key % 10 == 3, F.lit("  ")).when(key % 10 == 4, F.concat(key.cast("string"), F.lit(",x"))).otherwise(data))
    body = c.select((key + 2).alias("line_no"), text.alias("text"))
    head = c.filter(key < 2).select(
        key.alias("line_no"), F.when(key == 0, F.lit("Customers")).otherwise(F.lit("id,name,,note")).alias("text"))
    return head.unionByName(body)


def timed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of three topics and of none, resent over weeks; offsets repeat across partitions, some ids are null."""
    e, key = table(spark, sf_dir, "events"), F.col("event_id")
    topics = {"view": "views", "click": "clicks", "purchase": "purchases"}
    return e.select(
        _case(F.col("event_type"), topics, None).alias("topic"),
        F.when(key % 53 != 0, F.concat(F.lit("m"), (F.col("user_id") * 7 + key % 3) % 97)).alias("event_id"),
        F.col("ts").alias("arrived"), (key % 3).cast("int").alias("partition"), F.floor(key / 3).alias("seq"),
    )


def network_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with owners: a small one per nation, a larger one per region, which nest; one is no block."""
    region = {0: "8.0.0.0/8", 1: "192.168.0.0/22", 2: "2001:4860::/31", 3: "203.0.0.0/13", 4: "::ffff:10.0.0.0/119"}
    nations = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") == 3, F.lit("8.8.3.0/33")).otherwise(F.concat(F.lit("8.8."), "n_nationkey", F.lit(".0/26"))).alias("cidr"),
        F.col("n_name").alias("owner"))
    return nations.unionByName(table(spark, sf_dir, "region").select(
        _case(F.col("r_regionkey"), region, None).alias("cidr"), F.col("r_name").alias("owner")))
