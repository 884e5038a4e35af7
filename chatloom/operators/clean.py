"""From raw messages to clean ones, with the reason for every drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.config import Config, Roles
from chatloom.functions import text as T

#: Order and labels of the drop report.
REASONS = {
    "media": "media (no text)", "service": "service", "empty": "empty after clean", "short": "too short",
    "forwarded": "forwarded", "via_bot": "via_bot", "unknown_sender": "unknown sender",
}


def role_of(sender: Column, roles: Roles) -> Column:
    """assistant, user or empty; assistant if both ids are the same."""
    return F.when(sender == roles.assistant_id, "assistant").when(sender == roles.user_id, "user").otherwise("")


def with_reason(raw: DataFrame, config: Config) -> DataFrame:
    """``raw`` with ``clean_text`` and ``reason`` (``kept`` or the first drop rule met)."""
    rules, absent = config.clean, F.lit("")
    flat = T.flatten(F.col("text"), F.col("text_entities"), rules.strip_links, rules.redact_pii)
    media, emoji = F.coalesce("media_type", absent), F.coalesce("sticker_emoji", absent)
    if rules.stickers_to_emoji:
        flat = F.when((media == "sticker") & (flat == "") & (emoji != ""), emoji).otherwise(flat)
    rows = raw.withColumn("clean_text", flat)
    text = F.col("clean_text")
    reason = F.when(F.coalesce("type", absent) != "message", "service").when(role_of(F.coalesce("from_id", absent), config.roles) == "", "unknown_sender")
    if rules.drop_forwarded:
        reason = reason.when(F.col("forwarded_from").isNotNull(), "forwarded")
    if rules.drop_via_bot:
        reason = reason.when(F.coalesce("via_bot", absent) != "", "via_bot")
    reason = reason.when((media != "") & (text == ""), "media").when(text == "", "empty").when(F.char_length(text) < rules.min_runes, "short")
    return rows.withColumn("reason", reason.otherwise("kept"))


def messages(reasoned: DataFrame) -> DataFrame:
    """The kept rows as clean messages: id, date, from_id, from, text, ord."""
    absent = F.lit("")
    return reasoned.filter("reason = 'kept'").select(
        F.coalesce("id", F.lit(0)).cast("long").alias("id"),
        T.epoch(F.col("date_unixtime")).alias("date"),
        F.coalesce("from_id", absent).alias("from_id"),
        F.coalesce("`from`", absent).alias("from"),
        F.col("clean_text").alias("text"),
        "ord",
    )


def report(counts: DataFrame) -> DataFrame:
    """(place, label, n) of a histogram: rows read and kept first, then the drop reasons that occur in the report's order."""
    labels = counts.sparkSession.createDataFrame([(i + 2, r, label) for i, (r, label) in enumerate(REASONS.items())] + [(1, "kept", "kept")], "place int, reason string, label string")
    named = counts.join(F.broadcast(labels), "reason").select("place", "label", "n")
    return counts.agg(F.lit(0).alias("place"), F.lit("read").alias("label"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).unionByName(named)


def histogram(reasoned: DataFrame) -> DataFrame:
    """(reason, n), ``kept`` included; rows read are their sum."""
    return reasoned.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
