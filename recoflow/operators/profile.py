"""User behaviour analysis, profile texts and profile tags."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from recoflow.functions.codes import BEHAVIOR_LABELS, GENDER_LABELS, UNKNOWN_LABEL
from recoflow.functions.scoring import event_weight
from recoflow.functions.text import is_blank, labelled, value_or_default
from recoflow.operators.events import last_hours, moment
from recoflow.operators.skew import pick_row

SUMMARY_DAYS = 7
ACTIVE_EVENTS = 10
BOT_EVENTS, BOT_SINGLE_TYPE_EVENTS = 1_000, 50

# Pattern names and sentences of the profile text.
PATTERN_LABELS = {
    "COMPARER": "比价型（浏览多购买少，建议强调性价比和对比）",
    "DECISIVE": "目标明确型（决策快，建议直接推荐 Top 选项）",
    "EXPLORER": "探索型（行为均匀，建议多样化推荐）",
}
PORTRAIT_INTRO = "你正在和一位用户对话。以下是该用户的画像："
NEW_VISITOR_LINE = "- 用户基础信息：未注册，新访客"
NICKNAME_LINE, NICKNAME_DEFAULT = "- 昵称：", "未设置"
GENDER_LINE = "- 性别："
AGE_LINE = "- 年龄段："
REGION_LINE = "- 地域："
TAGS_LINE = "- 自选偏好："
NO_BEHAVIOR_LINE = "- 行为记录：暂无（新用户）"
BEHAVIOR_INTRO = "- 近 7 天行为分布："
BEHAVIOR_ITEM, BEHAVIOR_COLON, BEHAVIOR_TIMES = "  - ", "：", " 次"
PATTERN_LINE = "- 行为模式："
TONE_LINE = "请基于以上画像，以专业但亲和的语气与用户对话。"
TAG_ADVICE, TAG_ADVICE_END = "当用户询问推荐时，优先推荐与偏好标签（", "）相关的产品。"
VISITOR_ADVICE = "如果用户是新访客，主动询问偏好以建立画像。"


def behavior_summary(aggregates: DataFrame, now: datetime, days: int = SUMMARY_DAYS) -> DataFrame:
    """Events per user and type over the windows that start in the last days."""
    since = moment(now - timedelta(days=days))
    return (
        aggregates.filter(F.col("window_start") >= since)
        .groupBy("user_id", "behavior_type").agg(F.sum("event_count").alias("total_count"))
    )


def category_preferences(events: DataFrame) -> DataFrame:
    """Share of each user's event weight per item category (item id modulo 10)."""
    weights = (
        events.groupBy("user_id", F.concat(F.lit("category_"), (F.col("item_id") % 10).cast("string")).alias("category"))
        .agg(F.sum(event_weight(F.col("behavior_type"), F.col("rating"))).alias("weight"))
    )
    total = F.sum("weight").over(Window.partitionBy("user_id"))
    share = F.when(total > 0, F.col("weight") / total).otherwise(F.col("weight"))
    return weights.withColumn("preference", share).drop("weight")


def active_users(events: DataFrame, now: datetime, days: int = SUMMARY_DAYS, at_least: int = ACTIVE_EVENTS) -> DataFrame:
    """Per user: events after the cutoff and whether they make the user active."""
    recent = F.count_if(F.col("event_time") > moment(now - timedelta(days=days)))
    return (
        events.groupBy("user_id").agg(recent.alias("recent_events"))
        .withColumn("is_active", F.col("recent_events") >= at_least)
    )


def favorite_type(events: DataFrame) -> DataFrame:
    """Most frequent behaviour type per user; ties go to the first name in the alphabet."""
    counts = events.groupBy("user_id", "behavior_type").agg(F.count(F.lit(1)).alias("event_count"))
    best = pick_row(counts, ["user_id"], F.struct(-F.col("event_count"), F.col("behavior_type")), newest=False)
    return best.select("user_id", F.coalesce("behavior_type", F.lit("VIEW")).alias("favorite_type"), "event_count")


def bot_users(events: DataFrame, now: datetime, hours: int = 1, max_events: int = BOT_EVENTS,
              max_single_type: int = BOT_SINGLE_TYPE_EVENTS) -> DataFrame:
    """Users with too many recent events, or many of one single type."""
    per_type = last_hours(events, now, hours).groupBy("user_id", "behavior_type").agg(F.count(F.lit(1)).alias("n"))
    users = per_type.groupBy("user_id").agg(
        F.sum("n").alias("recent_events"), F.count(F.lit(1)).alias("distinct_types")
    )
    flood = F.col("recent_events") > max_events
    monotone = (F.col("recent_events") > max_single_type) & (F.col("distinct_types") == 1)
    return users.withColumn("is_bot", flood | monotone)


def pattern_code(total: Column, browsing: Column, purchases: Column) -> Column:
    """COMPARER, DECISIVE, EXPLORER; null without events."""
    return (
        F.when(total > 0, F.when(browsing / total > 0.7, F.lit("COMPARER"))
               .when(purchases / total > 0.3, F.lit("DECISIVE")).otherwise(F.lit("EXPLORER")))
    )


def behavior_pattern(summary: DataFrame) -> DataFrame:
    """Pattern per user from a behaviour summary."""
    count, kind = F.col("total_count"), F.col("behavior_type")
    sums = summary.groupBy("user_id").agg(
        F.sum(count).alias("total"),
        F.coalesce(F.sum(F.when(kind.isin("VIEW", "CLICK"), count)), F.lit(0)).alias("browsing"),
        F.coalesce(F.sum(F.when(kind == "PURCHASE", count)), F.lit(0)).alias("purchases"),
    )
    return sums.withColumn("pattern", F.coalesce(
        pattern_code(F.col("total"), F.col("browsing"), F.col("purchases")), F.lit("UNKNOWN")))


def _behavior_lines(summary: DataFrame) -> DataFrame:
    """Behaviour section per user. A user has at most one row per behaviour type here."""
    line = F.concat(
        F.lit(BEHAVIOR_ITEM), labelled(F.col("behavior_type"), BEHAVIOR_LABELS, F.col("behavior_type")),
        F.lit(BEHAVIOR_COLON), F.col("total_count").cast("string"), F.lit(BEHAVIOR_TIMES),
    )
    lines = summary.groupBy("user_id").agg(
        F.sort_array(F.collect_list(
            F.struct((-F.col("total_count")).alias("n"), F.col("behavior_type").alias("t"), line.alias("line"))
        ))["line"].alias("lines")
    )
    pattern = behavior_pattern(summary).select(
        "user_id", labelled(F.col("pattern"), PATTERN_LABELS, UNKNOWN_LABEL).alias("pattern_text"))
    return lines.join(pattern, "user_id").select("user_id", F.concat(
        F.array(F.lit(BEHAVIOR_INTRO)), "lines", F.array(F.concat(F.lit(PATTERN_LINE), "pattern_text"))
    ).alias("behavior_lines"))


def user_portraits(profiles: DataFrame, summary: DataFrame) -> DataFrame:
    """Profile text of every user known from a profile or from behaviour.

    ``profiles`` has user_id, nickname, gender, age_range, region, preference_tags.
    """
    joined = profiles.withColumn("_known", F.lit(True)).join(_behavior_lines(summary), "user_id", "full_outer")
    known, tags = F.col("_known").isNotNull(), F.col("preference_tags")
    gender = F.coalesce(labelled(F.col("gender"), GENDER_LABELS), F.lit(UNKNOWN_LABEL))
    static = F.when(~known, F.array(F.lit(NEW_VISITOR_LINE))).otherwise(F.array_compact(F.array(
        F.concat(F.lit(NICKNAME_LINE), value_or_default(F.col("nickname"), NICKNAME_DEFAULT)),
        F.concat(F.lit(GENDER_LINE), gender),
        F.concat(F.lit(AGE_LINE), value_or_default(F.col("age_range"), UNKNOWN_LABEL)),
        F.concat(F.lit(REGION_LINE), value_or_default(F.col("region"), UNKNOWN_LABEL)),
        F.when(~is_blank(tags), F.concat(F.lit(TAGS_LINE), tags)),
    )))
    behavior = F.coalesce("behavior_lines", F.array(F.lit(NO_BEHAVIOR_LINE)))
    advice = F.array_compact(F.array(
        F.lit(""), F.lit(TONE_LINE),
        F.when(known & tags.isNotNull(), F.concat(F.lit(TAG_ADVICE), tags, F.lit(TAG_ADVICE_END))),
        F.lit(VISITOR_ADVICE),
    ))
    text = F.array_join(F.concat(F.array(F.lit(PORTRAIT_INTRO)), static, behavior, advice), "\n")
    return joined.select("user_id", F.concat(text, F.lit("\n")).alias("portrait"))


# Profile tags. Each function returns user_id, tag_category, tag_value, confidence.

def _tag(category: str, value: Column, confidence: Column) -> list[Column]:
    return [F.col("user_id"), F.lit(category).alias("tag_category"), value.alias("tag_value"),
            confidence.cast("double").alias("confidence")]


def _top_share(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent values per user with their share of the user's events (user_id, value, n)."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy("user_id"))
    ranking = Window.partitionBy("user_id").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("share", share).withColumn("r", F.row_number().over(ranking)).filter(F.col("r") <= n)


def _per_item(events: DataFrame) -> DataFrame:
    """Events per user and item: joins with the catalog see a popular item once per user."""
    return events.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))


def category_tags(events: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """Top categories by number of events."""
    counts = (
        _per_item(events).join(catalog.select("item_id", "category"), "item_id")
        .groupBy("user_id", F.col("category").alias("value")).agg(F.sum("n").alias("n"))
    )
    return _top_share(counts, n).select(*_tag("category_pref", F.col("value"), F.col("share")))


def purchase_power_tags(events: DataFrame, catalog: DataFrame, low: float, high: float) -> DataFrame:
    """LOW / MEDIUM / HIGH by the mean price of purchased items."""
    bought = _per_item(events.filter(F.col("behavior_type") == "PURCHASE"))
    priced = bought.join(catalog.select("item_id", "price"), "item_id").filter(F.col("price").isNotNull())
    mean = priced.groupBy("user_id").agg(
        (F.sum(F.col("price").cast("decimal(10,2)") * F.col("n")).cast("double") / F.sum("n")).alias("mean"))
    band = F.when(F.col("mean") < low, F.lit("LOW")).when(F.col("mean") > high, F.lit("HIGH")).otherwise(F.lit("MEDIUM"))
    return mean.select(*_tag("purchase_power", band, F.lit(1.0)))


def pattern_tags(summary: DataFrame) -> DataFrame:
    return behavior_pattern(summary).select(*_tag("behavior_pattern", F.col("pattern"), F.lit(1.0)))


def active_hour_tags(events: DataFrame, n: int = 3) -> DataFrame:
    """Busiest hours of the day."""
    hours = events.groupBy("user_id", F.hour("event_time").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = _top_share(hours, n)
    return top.select(*_tag("active_hours", F.col("value").cast("string"), F.col("share")))


def rating_tags(events: DataFrame, strict: float = 3.0, lenient: float = 4.0) -> DataFrame:
    """STRICT / NEUTRAL / LENIENT by mean rating."""
    mean = events.filter(F.col("rating").isNotNull()).groupBy("user_id").agg(F.avg("rating").alias("mean"))
    value = (F.when(F.col("mean") < strict, F.lit("STRICT"))
             .when(F.col("mean") > lenient, F.lit("LENIENT")).otherwise(F.lit("NEUTRAL")))
    return mean.select(*_tag("rating_tendency", value, F.lit(1.0)))


def profile_tags(events: DataFrame, catalog: DataFrame, summary: DataFrame, computed_at: date,
                 low_price: float, high_price: float) -> DataFrame:
    """All tag families of one day."""
    tags = category_tags(events, catalog)
    for more in (purchase_power_tags(events, catalog, low_price, high_price), pattern_tags(summary),
                 active_hour_tags(events), rating_tags(events)):
        tags = tags.unionByName(more)
    return tags.withColumn("computed_at", F.lit(computed_at.isoformat()).cast("date"))


def merge_profiles(realtime: DataFrame, offline: DataFrame, static: DataFrame) -> DataFrame:
    """One value per user and tag category; realtime beats offline beats static.

    Each source has user_id, tag_category, tag_value. Within a source the smallest value wins.
    """
    sources = [("REALTIME", realtime), ("OFFLINE", offline), ("STATIC", static)]
    merged = None
    for priority, (name, df) in enumerate(sources):
        rows = df.select("user_id", "tag_category", "tag_value", F.lit(name).alias("source"),
                         F.lit(priority).alias("_priority"))
        merged = rows if merged is None else merged.unionByName(rows)
    best = pick_row(merged, ["user_id", "tag_category"], F.struct("_priority", "tag_value"), newest=False)
    return best.drop("_priority")


