"""Registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recoflow.functions import codes, network, scoring, text, transforms
from recoflow.functions.codes import backoff_seconds
from recoflow.operators import (
    events as ev, ingest as ing, ledger, merge, orders, preference, profile, pulls, quality, recall, supplier, windows,
)
from recoflow.plans import tables as t, training
from recoflow.operators.marks import MarkStore
from recoflow.session import cut_lineage, shared_checkpoint_dir
from recoflow.sources import readers
from recoflow.sources.merge_log import DELETED, MergeLog

NOW = t.NOW
WIDE_ID = 1 << 40
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Windows and top lists.

@query
def window_behavior_agg(spark, d):
    return windows.behavior_aggregate(t.behavior_events(spark, d))


@query
def window_behavior_agg_day(spark, d):
    return windows.behavior_aggregate(t.behavior_events(spark, d), "1 day")


@query
def window_item_score(spark, d):
    return windows.item_scores(t.behavior_events(spark, d))


@query
def preference_delta(spark, d):
    return windows.preference_delta(t.behavior_events(spark, d))


@query
def preference_delta_day(spark, d):
    return windows.preference_delta(t.behavior_events(spark, d), "1 day")


@query
def latest_window_topn(spark, d):
    return windows.latest_top_items(windows.item_scores(t.behavior_events(spark, d), "6 hours"))


@query
def recommendation_items(spark, d):
    ranked = windows.latest_top_items(windows.item_scores(t.behavior_events(spark, d), "1 day"))
    lists = windows.item_lists(ranked).select("user_id", "window_start", "window_end", F.explode("items").alias("i"))
    return lists.select("user_id", "window_start", "window_end", F.col("i.rank").alias("rank"),
                        F.col("i.itemId").alias("item_id"), F.col("i.score").alias("score"))


@query
def recommendation_messages(spark, d):
    ranked = windows.latest_top_items(windows.item_scores(t.behavior_events(spark, d), "1 day"))
    return windows.recommendation_messages(ranked, NOW)


@query
def window_agg_upsert(spark, d):
    """Aggregates of the first 20 days, then all of them with one event less: replaced on the key."""
    keys = ["user_id", "behavior_type", "window_start", "window_end"]
    all_days = windows.behavior_aggregate(t.behavior_events(spark, d), "1 day")
    stored = all_days.filter(F.col("window_start") < ev.moment(datetime(2024, 1, 21)))
    incoming = (
        all_days.filter(F.col("window_start") >= ev.moment(datetime(2024, 1, 15)))
        .withColumn("event_count", F.col("event_count") + 1000)
    )
    return merge.upsert(stored, incoming, keys)


# Preference matrix.

@query
def preference_matrix(spark, d):
    return t.preference_matrix(spark, d)


@query
def preference_incremental(spark, d):
    deltas = t.preference_deltas(spark, d)
    stored = preference.roll_up(preference.batch_range(deltas, 0, 20))
    return preference.incremental_roll_up(stored, deltas, 20).matrix


@query
def high_water_mark(spark, d):
    return preference.high_water_mark(t.preference_deltas(spark, d))


@query
def delta_purge(spark, d):
    return preference.purge_deltas(t.preference_deltas(spark, d), datetime(2024, 2, 20), 15)


@query
def delta_purge_count(spark, d):
    return preference.purge_count(t.preference_deltas(spark, d), datetime(2024, 2, 20), 15)


@query
def preference_above(spark, d):
    return preference.count_above(t.preference_matrix(spark, d), 4.0)


@query
def delta_windows_after(spark, d):
    return preference.windows_after(t.preference_deltas(spark, d), datetime(2024, 1, 25))


# Recall.

@query
def recall_serving(spark, d):
    served = recall.serve(
        t.recall_lists(spark, d), "als_v2", t.item_catalog(spark, d), t.preference_matrix(spark, d), 10)
    return served.withColumn("price", F.col("price").cast("double"))


@query
def recall_for_users(spark, d):
    buyers = ev.last_hours(t.behavior_events(spark, d), NOW, 48).filter(F.col("behavior_type") == "PURCHASE")
    return recall.for_users(t.recall_lists(spark, d), "als_v2", buyers).drop("source")


@query
def recall_purge(spark, d):
    return recall.purge_recall(t.recall_lists(spark, d), ["als_v2", "als_v1"]).drop("source")


def _registry(spark, d):
    """One model per brand; the version follows from its parts."""
    p = t.table(spark, d, "part")
    now = ev.moment(NOW)
    return p.groupBy(F.col("p_brand").alias("model_name")).agg(
        F.concat(F.lit("als_"), F.max("p_partkey")).alias("current_version"),
        F.concat(F.lit("als_"), F.min("p_partkey")).alias("previous_version"),
    ).withColumn("status", F.lit("ACTIVE")).withColumn("updated_at", now)


@query
def model_switch(spark, d):
    """Brands whose largest part has an even size release a new version."""
    releases = t.table(spark, d, "part").groupBy(F.col("p_brand").alias("model_name")).agg(
        F.concat(F.lit("als_new_"), F.count(F.lit(1))).alias("new_version"), F.max("p_size").alias("size"))
    releases = releases.filter(F.col("size") % 2 == 0).drop("size")
    return recall.switch_version(_registry(spark, d), releases.withColumn("updated_at", ev.moment(datetime(2024, 2, 1))))


@query
def recall_active(spark, d):
    """Each brand's model serves the version that the registry names; some models are not active."""
    registry = t.table(spark, d, "part").groupBy(F.col("p_brand").alias("model_name")).agg(
        F.concat(F.lit("als_v"), F.count(F.lit(1)) % 3).alias("current_version"),
        F.when(F.sum("p_size") % 3 != 0, F.lit("ACTIVE")).otherwise(F.lit("RETIRED")).alias("status"))
    served = recall.serve_active(
        t.recall_lists(spark, d), registry, t.item_catalog(spark, d), t.preference_matrix(spark, d), 2)
    return served.select("model_name", "user_id", "item_id", "rank_position", "score", "name")


@query
def catalog_by_price(spark, d):
    return recall.by_category(t.item_catalog(spark, d), "ECONOMY", 950, 1000).select(
        "item_id", "name", F.col("price").cast("double").alias("price"))


@query
def als_recall(spark, d):
    return training.als_recall(t.preference_matrix(spark, d), NOW).drop("created_at", "updated_at")


@query
def als_invariants(spark, d):
    """What must hold of every user's list; the ids are moved beyond the integers that ALS takes."""
    matrix = t.preference_matrix(spark, d)
    far = matrix.select(*[(F.col(c) + WIDE_ID).alias(c) if c in ("user_id", "item_id") else c for c in matrix.columns])
    lists = training.als_recall(far, NOW)
    trained = training.training_rows(far, NOW).select("item_id").distinct()
    known = lists.join(trained, "item_id", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("known_items"))
    return training.list_invariants(lists).join(known, "user_id").select(
        (F.col("user_id") - WIDE_ID).alias("user_id"), "items", "known_items", "ranks_dense", "scores_fall", "items_distinct")


@query
def als_training_rows(spark, d):
    return training.training_rows(t.preference_matrix(spark, d), datetime(2024, 4, 5))


@query
def als_training_users(spark, d):
    rows = training.training_rows(t.preference_matrix(spark, d), datetime(2024, 4, 5))
    return rows.agg(F.count_distinct("user_id").alias("user_count"))


# Behaviour analysis.

@query
def event_checks(spark, d):
    checked = t.behavior_events(spark, d).withColumn("reason", ev.reject_reason(datetime(2024, 1, 29)))
    return checked.select("event_id", "reason", ev.is_valid(datetime(2024, 1, 29)).alias("is_valid"))


@query
def event_scores(spark, d):
    e = t.behavior_events(spark, d)
    kind, rating = F.col("behavior_type"), F.col("rating")
    return e.select("event_id", scoring.preference_score(kind, rating).alias("preference_score"),
                    scoring.event_weight(kind, rating).alias("event_weight"))


@query
def events_in_range(spark, d):
    rows = ev.in_time_range(t.behavior_events(spark, d), datetime(2024, 1, 10), datetime(2024, 1, 12, 6))
    return rows.select("event_id", "user_id", "event_time")


@query
def expired_events(spark, d):
    return ev.expired(t.behavior_events(spark, d), NOW, 240).select("event_id", "event_time")


@query
def behavior_summary(spark, d):
    return profile.behavior_summary(windows.behavior_aggregate(t.behavior_events(spark, d)), NOW)


@query
def category_preference(spark, d):
    return profile.category_preferences(t.behavior_events(spark, d))


@query
def active_users(spark, d):
    return profile.active_users(t.behavior_events(spark, d), NOW)


@query
def favorite_type(spark, d):
    return profile.favorite_type(t.behavior_events(spark, d))


@query
def bot_users(spark, d):
    """Thresholds of the rule scaled to the table: a week instead of an hour."""
    return profile.bot_users(t.behavior_events(spark, d), NOW, hours=24 * 7, max_events=25, max_single_type=1)


@query
def behavior_pattern(spark, d):
    return profile.behavior_pattern(
        profile.behavior_summary(windows.behavior_aggregate(t.behavior_events(spark, d), "1 day"), NOW))


@query
def dedup_gap(spark, d):
    return ev.dedup_within_gap(t.behavior_events(spark, d)).select("event_id", "user_id", "item_id", "event_time")


@query
def dedup_gap_day(spark, d):
    kept = ev.dedup_within_gap(t.behavior_events(spark, d), timedelta(days=1), ("user_id", "behavior_type"))
    return kept.select("event_id", "user_id", "behavior_type", "event_time")


@query
def bounded_history(spark, d):
    return ev.bounded_history(t.behavior_events(spark, d), limit=60, step=10).select("event_id", "user_id")


@query
def user_portrait(spark, d):
    summary = profile.behavior_summary(windows.behavior_aggregate(t.behavior_events(spark, d), "1 day"), NOW)
    return profile.user_portraits(t.user_profiles(spark, d), summary)


@query
def profile_tags(spark, d):
    e = t.behavior_events(spark, d)
    summary = profile.behavior_summary(windows.behavior_aggregate(e, "1 day"), NOW)
    return profile.profile_tags(e, t.item_catalog(spark, d), summary, NOW.date(), 904.0, 906.0).drop("computed_at")


@query
def profile_merge(spark, d):
    e = t.behavior_events(spark, d)
    cut = ev.moment(datetime(2024, 1, 29))
    static = t.user_profiles(spark, d).select(
        "user_id", F.lit("favorite").alias("tag_category"), F.col("gender").alias("tag_value"))

    def favorite(events):
        return profile.favorite_type(events).select(
            "user_id", F.lit("favorite").alias("tag_category"), F.col("favorite_type").alias("tag_value"))

    return profile.merge_profiles(favorite(e.filter(F.col("event_time") >= cut)),
                                  favorite(e.filter(F.col("event_time") < cut)), static)


# Rule-driven ingestion.

@query
def ingest_filter_project(spark, d):
    request = ing.IngestionRequest(
        source_table="orders",
        mappings=[ing.FieldMapping("orders.o_orderkey"), ing.FieldMapping("o_totalprice", "price"),
                  ing.FieldMapping("o_orderstatus", "status"), ing.FieldMapping("o_custkey", enabled=False)],
        filters=[ing.FilterRule("o_orderpriority", "like", "1-urg%"),
                 ing.FilterRule("o_totalprice", "AFTER", "250000"),
                 ing.FilterRule("o_orderstatus", "in_list", "F, P", logic="OR"),
                 ing.FilterRule("o_orderdate", "<", "1996-01-01"),
                 ing.FilterRule("o_custkey", "NOT_NULL")],
        target=ing.Target(incremental_field="o_orderdate"), max_rows=None,
    )
    return ing.ingest(spark, request, t.table(spark, d, "orders"))


@query
def ingest_transforms(spark, d):
    request = ing.IngestionRequest(
        source_table="part",
        mappings=[ing.FieldMapping("p_partkey", "id"), ing.FieldMapping("p_retailprice", "price_cents"),
                  ing.FieldMapping("p_name", "name"), ing.FieldMapping("p_size", "size"),
                  ing.FieldMapping("p_brand", "brand")],
        transforms=[ing.TransformRule("p_retailprice", "MULTIPLY", "100", target="price_cents"),
                    ing.TransformRule("price_cents", "DIVIDE", "7", target="seventh"),
                    ing.TransformRule("seventh", "ROUND", "2", target="rounded"),
                    ing.TransformRule("size", "SUBTRACT", "25.5", target="shifted"),
                    ing.TransformRule("size", "ADD", "0.5"),
                    ing.TransformRule("name", "UPPERCASE"), ing.TransformRule("name", "PREFIX", "P:"),
                    ing.TransformRule("brand", "LOWERCASE"), ing.TransformRule("brand", "SUFFIX", "!"),
                    ing.TransformRule("absent", "REPLACE_NULL", "none", target="note"),
                    ing.TransformRule("note", "TRIM", enabled=False)],
        max_rows=None,
    )
    df = ing.ingest(spark, request, t.table(spark, d, "part"))
    numbers = ["price_cents", "seventh", "rounded", "shifted", "size"]
    return df.select(*[transforms.canonical_number(F.col(c)).alias(c) if c in numbers else c for c in df.columns])


@query
def ingest_upsert_dedup(spark, d):
    request = ing.IngestionRequest(
        source_table="orders",
        mappings=[ing.FieldMapping("o_custkey", "customer"), ing.FieldMapping("o_orderkey", "order_no"),
                  ing.FieldMapping("o_orderstatus", "status")],
        transforms=[ing.TransformRule("status", "LOWERCASE")],
        target=ing.Target("customers", "MERGE", "customer", "o_orderdate"), max_rows=None,
    )
    return ing.ingest(spark, request, t.table(spark, d, "orders"), sequence=["o_orderkey"])


@query
def ingest_custom_query(spark, d):
    t.table(spark, d, "customer").createOrReplaceTempView("recoflow_customer")
    request = ing.IngestionRequest(
        query="SELECT c_custkey, c_mktsegment, c_acctbal * 2 AS doubled FROM recoflow_customer WHERE c_acctbal > 0",
        mappings=[ing.FieldMapping("c_custkey", "id"), ing.FieldMapping("c_mktsegment", "segment"),
                  ing.FieldMapping("missing")],
        filters=[ing.FilterRule("c_custkey", "LT", "0")],
        transforms=[ing.TransformRule("segment", "LOWERCASE")], max_rows=None,
    )
    return ing.ingest(spark, request)


@query
def ingest_summary(spark, d):
    c = t.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    summary = ing.ingestion_summary(c, ["c_custkey"], {"mode": "RULE_BUILDER"})
    return summary.select("total_records", F.array_join("columns", ",").alias("columns"),
                          F.array_join("sample_rows", "\n").alias("sample_rows"), F.col("metadata")["mode"].alias("mode"))


@query
def kv_dump_scan(spark, d):
    return readers.key_value_dump(t.key_value_dump(spark, d), "user:*", max_keys=None)


@query
def sheet_scan(spark, d):
    return readers.parse_sheet(t.sheet_lines(spark, d), header_row_index=1, max_rows=None)


# Supplier payloads.

def _records_of(spark, d, erp_type):
    payloads = t.raw_payloads(spark, d).filter(F.col("erp_type") == erp_type)
    return supplier.records(supplier.parse_payloads(payloads), keep=("seq",)).drop("item_index")


@query
def normalize_kingdee(spark, d):
    return _records_of(spark, d, "KINGDEE")


@query
def normalize_yonyou(spark, d):
    return _records_of(spark, d, "YONYOU")


@query
def normalize_generic(spark, d):
    return _records_of(spark, d, "GENERIC")


@query
def supplier_dlq(spark, d):
    return supplier.dead_letters(supplier.parse_payloads(t.raw_payloads(spark, d)), NOW, keep=("seq",))


def _all_records(spark, d):
    # Written once: its readers (counts of hot keys, outcomes, results) would each parse all texts again.
    parsed = cut_lineage(supplier.parse_payloads(t.raw_payloads(spark, d)).drop("raw_payload"))
    return parsed, supplier.records(parsed, keep=("seq",)).drop("item_index")


RECORD_KEYS = ["supplier_id", "erp_type", "source_record_id"]


@query
def newer_wins_upsert(spark, d):
    rows = supplier.records(supplier.parse_payloads(t.raw_payloads(spark, d)), keep=("seq",)).drop("item_index")
    merged = merge.newer_wins(rows, RECORD_KEYS, "pulled_at", "seq", ev.moment(NOW))
    return merged.select(*RECORD_KEYS, "supplier_name", "supplier_status", "pulled_at", "created_at", "updated_at")


@query
def upsert_outcomes(spark, d):
    _, rows = _all_records(spark, d)
    return merge.outcome_summary(merge.write_outcomes(rows, RECORD_KEYS, "pulled_at", "seq"), ["erp_type"])


@query
def payload_results(spark, d):
    parsed, rows = _all_records(spark, d)
    return supplier.payload_results(parsed, merge.write_outcomes(rows, RECORD_KEYS, "pulled_at", "seq"), "seq")


@query
def supplier_codes(spark, d):
    """Small rules per connection: system, cursor parts, backoff, masked code."""
    c = t.supplier_connections(spark, d)
    return c.select(
        "supplier_id", codes.erp_type_of(F.col("supplier_code")).alias("erp_type"),
        codes.cursor_date(F.col("last_cursor")).alias("cursor_date"),
        codes.cursor_offset(F.col("last_cursor"), 1).alias("cursor_page"),
        codes.encode_cursor(codes.cursor_date(F.col("last_cursor")), codes.cursor_offset(F.col("last_cursor"), 0) + 1)
        .alias("next_cursor"),
        backoff_seconds(F.col("retry_count"), 30, 1200).alias("backoff"),
        text.mask_secret(F.col("supplier_code")).alias("masked"), text.snippet(F.col("supplier_code"), 4).alias("head"),
    )


# Supplier pulls.

@query
def due_connections(spark, d):
    return pulls.due_connections(t.supplier_connections(spark, d), NOW).select(
        "supplier_id", "supplier_code", "next_pull_at", "retry_count")


@query
def apply_pull_outcomes(spark, d):
    return pulls.apply_outcomes(t.supplier_connections(spark, d), t.pull_outcomes(spark, d)).drop("supplier_code")


@query
def pull_report(spark, d):
    return pulls.pull_report(t.pull_audit(spark, d), 60_000)


@query
def pull_task_dedup(spark, d):
    tasks = pulls.dedup_tasks(t.pull_audit(spark, d), "executed_at", "audit_id")
    return tasks.select("audit_id", "supplier_id", "idempotency_key")


@query
def connection_status(spark, d):
    return pulls.status_counts(t.supplier_connections(spark, d))


@query
def latest_audit(spark, d):
    latest = recall.latest_per_key(t.pull_audit(spark, d), "supplier_id", "executed_at", "audit_id")
    return latest.select("supplier_id", "audit_id", "outcome", "executed_at")


@query
def recent_audits(spark, d):
    return pulls.recent(t.pull_audit(spark, d), "executed_at", "audit_id", 100).select("audit_id", "supplier_id", "outcome")


@query
def recent_audits_per_supplier(spark, d):
    rows = pulls.recent_per_key(t.pull_audit(spark, d), "supplier_id", "executed_at", "audit_id", 5)
    return rows.select("audit_id", "supplier_id", "outcome")


# Orders.

@query
def order_etl(spark, d):
    loaded = orders.order_etl(t.order_messages(spark, d), NOW).orders
    money = [F.col(c).cast("double").alias(c) for c in ("amount_cny", "amount")]
    return loaded.select("order_id", "user_id", "status", *money, "currency", "occurred_at", "seq")


@query
def order_dlq(spark, d):
    letters = orders.order_etl(t.order_messages(spark, d), NOW).dead_letters
    return letters.select("seq", "original_topic", "error_reason")


@query
def order_outcomes(spark, d):
    return orders.order_etl(t.order_messages(spark, d), NOW).counts


@query
def order_classification(spark, d):
    """Outcome of every single message."""
    return orders.classify(orders.decode_orders(t.order_messages(spark, d))).select("seq", "event_id", "outcome")


# Ledgers and audits.

@query
def payment_first_create(spark, d):
    return ledger.first_creates(t.payment_requests(spark, d))


@query
def payment_replay(spark, d):
    return ledger.replay_summary(t.payment_log(spark, d), "order_no", t.PAYMENT_ORDER, "action", ledger.PAYMENT)


@query
def reservation_replay(spark, d):
    log = t.reservation_log(spark, d)
    return ledger.replay_summary(log, "reservation_id", t.PAYMENT_ORDER, "action", ledger.RESERVATION)


@query
def release_moves(spark, d):
    """Stock after the changes of reservations, whose log arrives twice: each release returns its stock once."""
    log = t.reservation_log(spark, d).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    sku = t.reservation_skus(spark, d)
    order = [*t.PAYMENT_ORDER, "copy"]
    moves = ledger.linked_moves(log, "reservation_id", order, "action", ledger.RESERVATION).join(sku, "reservation_id")
    stock = ledger.replay_stock(moves, t.reserved_stock(spark, d), [*order, "reservation_id"])
    broken = quality.stock_violations(stock).select("sku_id", F.lit(False).alias("_holds"))
    return stock.join(broken, "sku_id", "left").select(
        *stock.columns, F.coalesce("_holds", F.lit(True)).alias("identity_holds"))


@query
def payment_transition(spark, d):
    """Close the unpaid orders that were asked to close."""
    rows = t.payment_orders(spark, d).select("order_no", "status", F.col("paying_started_at").alias("updated_at"))
    asked = t.table(spark, d, "orders").filter(F.col("o_orderpriority") == "5-LOW").select(
        F.col("o_orderkey").alias("order_no"), ev.moment(NOW).alias("updated_at"))
    return ledger.conditional_transition(rows, asked, "UNPAID", "CLOSED")


@query
def stock_replay(spark, d):
    return ledger.replay_stock(t.stock_moves(spark, d), t.sku_stock(spark, d))


@query
def flash_sale_admission(spark, d):
    return ledger.flash_sale_admission(t.reserve_requests(spark, d), t.sku_stock(spark, d)).select(
        "seq", "sku_id", "user_id", "outcome")


@query
def stuck_payments(spark, d):
    return ledger.stuck_payments(t.payment_orders(spark, d), datetime(1996, 1, 1), 50).select("order_no", "paying_started_at")


@query
def quality_audit(spark, d):
    bad = quality.payment_violations(t.payment_orders(spark, d))
    return bad.select("order_no", "status", F.array_join("violations", "; ").alias("violations"))


@query
def reservation_audit(spark, d):
    bad = quality.reservation_violations(t.reservations(spark, d))
    return bad.select("reservation_id", "status", F.array_join("violations", "; ").alias("violations"))


@query
def stock_audit(spark, d):
    replayed = ledger.replay_stock(t.stock_moves(spark, d), t.sku_stock(spark, d))
    # Every third sku gets a total that cannot add up.
    bent = replayed.withColumn("total_stock", F.col("total_stock") + (F.col("sku_id") % 3 == 0).cast("bigint"))
    return quality.stock_violations(bent).select("sku_id", F.array_join("violations", "; ").alias("violations"))


@query
def lease_audit(spark, d):
    return quality.lease_violations(t.supplier_connections(spark, d)).select("supplier_id", "status", "lease_until")


@query
def idempotency_conflicts(spark, d):
    return quality.idempotency_conflicts(t.payment_requests(spark, d))


@query
def target_guard(spark, d):
    verdict = quality.target_verdict(
        F.col("host"), F.col("address"), exact_hosts=["db21.local"], suffixes=["3.example.org"], blocks=["192.168.4.0/22"])
    return t.access_log(spark, d).select("seq", "host", "address", verdict.alias("verdict"))


@query
def target_networks(spark, d):
    """Owner of the smallest block of a table of blocks that holds the address."""
    matched = network.longest_match(t.access_log(spark, d), "address", t.network_blocks(spark, d))
    return matched.select("seq", "address", F.col("block.cidr").alias("cidr"), F.col("block.owner").alias("owner"))


@query
def request_cap(spark, d):
    """Cap per client over two days, so that it binds in this table."""
    rows = quality.request_cap(t.access_log(spark, d), ["client"], 20, timedelta(days=2))
    return rows.select("seq", "client", "accepted")


@query
def top_items_per_user(spark, d):
    """Events → scores → preference matrix → catalog → ten best items per user."""
    offered = recall.on_shelf(t.preference_matrix(spark, d), t.item_catalog(spark, d))
    best = Window.partitionBy("user_id").orderBy(F.desc("preference_score"), F.asc("item_id"))
    ranked = offered.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= windows.TOP_N)
    return ranked.select("user_id", "rank", "item_id", "preference_score", "interaction_count", "name", "category")


# Logs of batches.

@query
def delta_log_merge(spark, d):
    """Daily preference deltas in nine overlapping batches, removals in the last; merged level by level, read newest per key."""
    deltas = windows.preference_delta(t.behavior_events(spark, d), "1 day")
    keys = ["user_id", "item_id", "window_start", "window_end"]
    log = MergeLog(spark, f"{shared_checkpoint_dir(spark)}/delta-log-{uuid.uuid4().hex}", keys, ["window_date"], fanout=4)
    day = F.dayofmonth("window_start")
    for batch in range(1, 10):
        part = deltas.filter(day.between(3 * batch - 2, 3 * batch + 3))
        part = part.withColumn("interaction_delta", F.col("interaction_delta") + 1000 * batch)
        removed = (F.col("item_id") % 10 == 3) if batch == 9 else F.lit(False)
        log.append(part.withColumn("window_date", F.to_date("window_start")).withColumn(DELETED, F.coalesce(removed, F.lit(False))), batch)
        log.compact()
    return log.read().drop("window_date")


@query
def marks_ttl(spark, d):
    """Messages in three batches against durable marks that live 7 days, 2 for views and 14 for purchases."""
    messages = t.timed_messages(spark, d)
    store = MarkStore(spark, f"{shared_checkpoint_dir(spark)}/marks-{uuid.uuid4().hex}", 7, {"views": 2, "purchases": 14}, fanout=2)
    day, parts = F.dayofmonth("arrived"), []
    for batch, (first, last) in enumerate(((1, 9), (10, 19), (20, 31)), 1):
        judged = cut_lineage(store.acquire(messages.filter(day.between(first, last)), batch))
        store.remember(judged, batch)
        store.compact(F.lit(f"2024-01-{last:02}").cast("date"))
        parts.append(judged)
    return reduce(DataFrame.unionByName, parts)
