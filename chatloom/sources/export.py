"""Sources and sinks: chat exports, clean messages and dataset lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom import schema


def read_export(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Messages of the root's ``messages`` array with ``ord``, their position.

    A JSON document is parsed by one task; what follows is spread again.  Malformed
    documents raise.
    """
    root = spark.read.schema(schema.EXPORT).option("multiLine", True).option("mode", "FAILFAST").json(path)
    rows = root.select(F.posexplode("messages").alias("ord", "m")).select(F.col("ord").cast("long"), "m.*")
    return rows.repartition(partitions) if partitions else rows


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages, one JSON object a line: splittable, the form for large exports."""
    fields = schema.RAW.removeprefix("struct<").removesuffix(">")
    kept = spark.read.schema(_columns(fields)).option("mode", "FAILFAST").json(path)
    return kept.withColumn("ord", F.coalesce("ord", "id"))


def _columns(fields: str) -> str:
    """Struct fields as columns: the first colon of each top-level field becomes a blank."""
    out, depth, named = [], 0, False
    for c in fields:
        depth += (c == "<") - (c == ">")
        if c == ":" and not depth and not named:
            c, named = " ", True
        if c == "," and not depth:
            named = False
        out.append(c)
    return "ord bigint," + "".join(out)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Clean messages from JSON lines (blank lines skipped, bad ones raise), with ``ord`` if written, else the id."""
    rows = spark.read.schema(f"{schema.MESSAGE}, ord bigint").option("mode", "FAILFAST").json(path)
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("id", "date")] + [F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in ("from_id", "from", "text")]
    return rows.select(*filled, F.coalesce("ord", "id").alias("ord"))


def write_lines(df: DataFrame, line: Column, path: str, order: list[str] | None = None, single_file: bool = False) -> None:
    """One JSON text a line, in order across the part files; one file only if asked."""
    df = df.orderBy(*order) if order else df
    lines = df.select(line.alias("value"))
    (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(path)


def split_paths(path: str) -> tuple[str, str]:
    """Names for the train and validation files: before the last dot of the whole path."""
    stem, dot, suffix = path.rpartition(".")
    return tuple(f"{stem}.{part}.{suffix}" if dot else f"{path}.{part}" for part in ("train", "val"))


def memory_line(text: Column, embedding: Column) -> Column:
    """``{"text", "embedding"}``; an empty embedding is left out."""
    return F.to_json(F.struct(text.alias("text"), F.when(F.size(embedding) > 0, embedding).alias("embedding")))
