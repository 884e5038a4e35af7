"""Answers of a service, kept in a table as they come: a run that failed goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.config import Service

#: Requests that a worker is given at a time; what a failed call may lose.
WAVE = 16


def place(spark: SparkSession, path: str):
    """The path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def removed(spark: SparkSession, path: str) -> None:
    found, system = place(spark, path)
    system.delete(found, True)


def below(folder: str, name: str) -> str:
    """``name`` if it is absolute or names its file system, else the place of that name in ``folder``."""
    return name if name.startswith("/") or "://" in name else f"{folder}/{name}"


def digest(service: Service, instruction: str, content: str) -> Column:
    """All that an answer depends on."""
    parts = [F.lit(service.model), F.lit(str(service.temperature)), F.lit(instruction), F.col(content)]
    return F.sha2(F.concat_ws("\x1e", *parts), 256)


def kept_answers(requests: DataFrame, at: str, cache: str, ask: Callable[[], Callable[[str], object]], answer: str, workers: int = 1) -> DataFrame:
    """(digest, answer) for each digest of ``requests`` (digest, content, and ``at``, its number from 0).

    ``ask`` makes a partition's callable from content to answer, ``answer`` is the
    answer's name and type.  What the Parquet table ``cache`` lacks is asked in
    waves by number, each digest once; a wave is appended before the next begins,
    so a call that fails loses at most its own wave, ``WAVE`` requests a worker.
    """
    spark, name, schema = requests.sparkSession, answer.split()[0], f"digest string, {answer}"
    workers = max(1, workers)

    def known() -> DataFrame:
        path, system = place(spark, cache)
        return spark.read.schema(schema).parquet(cache).dropDuplicates(["digest"]) if system.exists(path) else spark.createDataFrame([], schema)

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = ask()
        for frame in frames:
            yield pd.DataFrame({"digest": frame["digest"], name: [call(c) for c in frame["content"]]})

    # Written once, a folder a wave: no wave computes or reads the others' requests.
    lacking = requests.join(known(), "digest", "left_anti").groupBy("digest").agg(F.min("content").alias("content"), F.floor(F.min(at) / (WAVE * workers)).alias("wave"))
    lacking.write.mode("overwrite").partitionBy("wave").parquet(f"{cache}.lacking")
    lacking = spark.read.schema("digest string, content string, wave bigint").parquet(f"{cache}.lacking")
    for wave in sorted(r["wave"] for r in lacking.select("wave").distinct().collect()):
        rows = lacking.filter(F.col("wave") == wave).select("digest", "content")
        rows.repartition(workers).mapInPandas(asked, schema).write.mode("append").parquet(cache)
    removed(spark, f"{cache}.lacking")
    return known()
