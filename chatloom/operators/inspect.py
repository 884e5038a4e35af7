"""Who takes part in an export, and which media it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def participants(raw: DataFrame) -> DataFrame:
    """(from_id, name, messages), most messages first; the name is that of the first message."""
    named = raw.filter(F.coalesce("from_id", F.lit("")) != "")
    counted = named.groupBy("from_id").agg(F.min_by(F.coalesce("`from`", F.lit("")), "ord").alias("name"), F.count(F.lit(1)).alias("messages"))
    return counted.orderBy(F.desc("messages"), "from_id")


def media(raw: DataFrame) -> DataFrame:
    """(media_type, n)."""
    return raw.filter(F.coalesce("media_type", F.lit("")) != "").groupBy("media_type").agg(F.count(F.lit(1)).alias("n"))
