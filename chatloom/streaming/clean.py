"""Cleaning as a stream of new JSON-lines files: stateless, so any batch split gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatloom import schema
from chatloom.config import Config, require_roles
from chatloom.operators.clean import messages, with_reason
from chatloom.sources.export import _columns


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    fields = schema.RAW.removeprefix("struct<").removesuffix(">")
    rows = spark.readStream.schema(_columns(fields)).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.withColumn("ord", F.coalesce("ord", "id"))


def clean_stream(raw: DataFrame, config: Config, out: str, checkpoint: str) -> StreamingQuery:
    """Appends clean messages to Parquet at ``out``; ends when all present files are done."""
    require_roles(config)
    kept = messages(with_reason(raw, config))
    return kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
