"""Facts about one participant: windows, extraction, consolidation, embedding.

Calls to services go through ``mapInPandas`` over a written table of requests, and
their answers are written before anything reads them, so that a lost executor or
a second reader repeats no call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.facts import fact_key, parse_list
from chatloom.functions.text import month
from chatloom.operators.sequence import DAY, batches, numbered, token_windows

Ask = Callable[[str, str], str]


def assistant_messages(messages: DataFrame, assistant_id: str) -> DataFrame:
    return messages.filter(F.col("from_id") == assistant_id)


def window_texts(messages: DataFrame, size: Column, max_size: int) -> DataFrame:
    """(win, content, date): each window's texts by line, and its last date."""
    rows = token_windows(messages, size, max_size)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("date", "ord", "text"))), lambda m: F.concat(m["text"], F.lit("\n")))
    return rows.groupBy("win").agg(F.array_join(texts, "").alias("content"), F.max("date").alias("date"))


def answers(requests: DataFrame, ask: Callable[[], Ask], instruction: str) -> DataFrame:
    """``requests`` (key, content, date) with ``facts``: one call a row; ``ask`` makes a partition's client."""

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = ask()
        for frame in frames:
            yield frame.assign(facts=[parse_list(call(instruction, c)) for c in frame["content"]])

    return requests.select("key", "content", "date").mapInPandas(asked, "key bigint, content string, date bigint, facts array<string>").select("key", "date", "facts")


def facts(answered: DataFrame) -> DataFrame:
    """(text, date, ord): facts in order of request and answer, the first of equal ones kept."""
    rows = answered.select("key", "date", F.posexplode("facts").alias("at", "text")).withColumn("text", F.trim("text")).filter("text <> ''")
    firsts = rows.withColumn("_key", fact_key(F.col("text"))).groupBy("_key").agg(F.min(F.struct("key", "at", "text", "date")).alias("f"))
    return numbered(firsts.select("f.*"), F.floor(F.col("key") / 64), ["key", "at"], "ord").select("text", "date", "ord")


def consolidation_batches(rows: DataFrame, size: int, even: bool) -> DataFrame:
    """``rows`` (text, date, ord) with ``batch``: ``size`` neighbours by text in even passes, by date in odd ones.

    Positions are counted within texts of the same first three characters, or within days; only the counts meet in one place.
    """
    size = size if size >= 2 else 40
    # Code points follow the order of the texts, and three of 21 bits fit in a number; what is null comes first.
    begins = sum((F.ascii(F.substring("text", at, 1)).cast("long") * F.lit(1 << bits) for at, bits in ((1, 42), (2, 21), (3, 0))), F.lit(0))
    bucket = F.coalesce(begins, F.lit(-1)) if even else F.coalesce(F.floor(F.col("date") / DAY), F.lit(-(1 << 62)))
    return batches(numbered(rows, bucket, ["text", "ord"] if even else ["date", "ord"], "position"), "position", size)


def batch_requests(batched: DataFrame) -> DataFrame:
    """(key, content, date): lines ``[month] fact`` of each batch and its latest date."""
    line = F.concat(F.lit("["), month(F.col("date")), F.lit("] "), F.col("text"), F.lit("\n"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))), lambda x: x["line"])
    return batched.groupBy(F.col("batch").alias("key")).agg(F.array_join(lines, "").alias("content"), F.max("date").alias("date"))


def consolidate(rows: DataFrame, ask: Callable[[], Ask], instruction: str, size: int, passes: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Passes over the facts; stops after one that shrinks nothing, whose output still counts.

    ``keep`` writes a table and gives it back.  Every fact of a batch gets the
    batch's latest date; a batch answered with nothing is gone.
    """
    rows = keep(rows, "facts-0")
    for number in range(max(1, passes)):
        answered = keep(answers(batch_requests(consolidation_batches(rows, size, number % 2 == 0)), ask, instruction), f"answers-{number + 1}")
        listed = answered.select("key", "date", F.posexplode("facts").alias("at", "text"))
        after = keep(numbered(listed, F.floor(F.col("key") / 64), ["key", "at"], "ord").select("text", "date", "ord"), f"facts-{number + 1}")
        shrunk = after.count() < rows.count()
        rows = after
        if not shrunk:
            break
    return rows


def embeddings(rows: DataFrame, embed: Callable[[], Callable[[str], list[float]]]) -> DataFrame:
    """(text, embedding, ord), one call a row."""

    def embedded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = embed()
        for frame in frames:
            yield frame.assign(embedding=[call(t) for t in frame["text"]])

    return rows.select("text", "ord").mapInPandas(embedded, "text string, ord bigint, embedding array<double>")
