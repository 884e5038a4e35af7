"""Order-sensitive steps: sessions, bursts, windows, dense numbering.

``by`` names key columns of independent timelines (several chats at once).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window, WindowSpec

DAY = 86_400
HOUR = 3_600


def slotted(keys: Sequence[str]) -> tuple[Column, WindowSpec, WindowSpec, WindowSpec]:
    """The hour of a row (no date is the earliest), the order of rows inside it and up to a row, and the order of hours.

    Runs over a timeline are found inside its hours; one summary row per hour says
    what the hours before carry over.  However long the timeline, no task holds
    more rows of it than an hour's.
    """
    inside = Window.partitionBy(*keys, "_slot").orderBy("date", "id", "ord")
    slot = F.coalesce(F.floor(F.col("date") / HOUR), F.lit(-(1 << 62)))
    return slot, inside, inside.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys).orderBy("_slot")


def carried(rows: DataFrame, slots: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the breaks inside the hour (``_inner``) and before it, of ``slots`` (``_breaks``, ``_opens``)."""
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("_breaks") + F.col("_opens")).over(earlier), F.lit(0)) + F.col("_opens")
    slots = slots.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate([*keys, "_slot"])], before.alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_of{i}")) for i, k in enumerate([*keys, "_slot"])]
    joined = rows.join(slots, reduce(and_, same)).withColumn(name, F.col("_before") + F.col("_inner"))
    return joined.drop("_slot", "_last", "_break", "_inner", "_before", *[f"_of{i}" for i in range(len(same))])


def sessions(messages: DataFrame, gap_seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """``messages`` with ``session``: a new one after more than ``gap_seconds`` of silence, in order of (date, id, ord)."""
    by = list(by)
    slot, inside, so_far, hours = slotted(by)
    # The first row of an hour breaks or not by the hours before; the others are known within it.
    rows = messages.withColumn("_slot", slot).withColumn("_last", F.lag("date").over(inside))
    rows = rows.withColumn("_break", F.coalesce((F.col("date") - F.col("_last") > gap_seconds).cast("long"), F.lit(0)))
    rows = rows.withColumn("_inner", F.sum("_break").over(so_far))
    slots = rows.groupBy(*by, "_slot").agg(F.min("date").alias("_first"), F.max("date").alias("_max"), F.sum("_break").alias("_breaks"))
    latest = F.max("_max").over(hours.rowsBetween(Window.unboundedPreceding, -1))
    slots = slots.withColumn("_opens", F.coalesce((F.col("_first") - latest > gap_seconds).cast("long"), F.lit(0)))
    return carried(rows, slots, by, "session")


def bursts(rows: DataFrame, role: Column, separator: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per turn of a session: (by, session, turn_idx, role, content); neighbours of one role are joined."""
    keys = [*by, "session"]
    slot, inside, so_far, hours = slotted(keys)
    rows = rows.withColumn("role", role).withColumn("_slot", slot).withColumn("_last", F.lag("role").over(inside))
    rows = rows.withColumn("_break", F.coalesce((F.col("_last") != F.col("role")).cast("long"), F.lit(0)))
    rows = rows.withColumn("_inner", F.sum("_break").over(so_far))
    at = F.struct("date", "id", "ord")
    slots = rows.groupBy(*keys, "_slot").agg(F.min_by("role", at).alias("_first"), F.max_by("role", at).alias("_end"), F.sum("_break").alias("_breaks"))
    slots = slots.withColumn("_opens", F.coalesce((F.lag("_end").over(hours) != F.col("_first")).cast("long"), F.lit(0)))
    rows = carried(rows, slots, keys, "turn_idx")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("date", "id", "ord", "text"))), lambda m: m["text"]), separator)
    return rows.groupBy(*keys, "turn_idx").agg(F.first("role").alias("role"), joined.alias("content"))


def _fold(batches: Iterator[pa.RecordBatch], max_count: int, max_size: int | None) -> Iterator[pa.RecordBatch]:
    """Appends the window number; the first column says where a sequence begins, the second the sizes."""
    window = count = size = 0
    for batch in batches:
        out = np.empty(batch.num_rows, np.int64)
        for i, (begins, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if begins:
                window = count = size = 0
            if count and (0 < max_count <= count or max_size is not None and size + n > max_size):
                window, count, size = window + 1, 0, 0
            count, size, out[i] = count + 1, size + n, window
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(out)], names=[*batch.schema.names[2:], "win"])


def windows(turns: DataFrame, size: Column, max_turns: int, max_size: int, by: Sequence[str] = ()) -> DataFrame:
    """``turns`` with ``win``: greedy windows of at most ``max_turns`` turns and ``max_size``; a limit <= 0 is none.

    A turn above the size limit stands alone.  The size limit makes this a fold over
    each session; it carries three numbers from row to row, so sessions of any
    length pass through in bounded memory.
    """
    if max_size <= 0:
        return turns.withColumn("win", F.floor(F.col("turn_idx") / max_turns) if max_turns > 0 else F.lit(0).cast("long"))
    keys = [*by, "session"]
    rows = turns.select((F.col("turn_idx") == 0).alias("_begins"), size.cast("long").alias("_size"), "*")
    schema = StructType([*turns.schema.fields, StructField("win", LongType())])
    return rows.repartition(*keys).sortWithinPartitions(*keys, "turn_idx").mapInArrow(lambda b: _fold(b, max_turns, max_size), schema)


def token_windows(messages: DataFrame, size: Column, max_size: int) -> DataFrame:
    """``messages`` with ``win``: one sequence in order of (date, ord), cut by size alone.

    One sequence is one fold by definition; only its order and sizes go through the
    single task, the texts are joined back.
    """
    slim = messages.select(F.lit(False).alias("_begins"), size.cast("long").alias("_size"), "date", "ord")
    schema = StructType([messages.schema["date"], messages.schema["ord"], StructField("win", LongType())])
    numbered = slim.repartition(1).sortWithinPartitions("date", "ord").mapInArrow(lambda b: _fold(b, 0, max_size), schema)
    return messages.join(numbered.select("ord", "win"), "ord")


def numbered(rows: DataFrame, bucket: Column, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their dense position from 0 under ``order``.

    ``bucket`` must not decrease along the order; rows are counted per bucket, and
    only the counts are added up in one place.
    """
    rows = rows.withColumn("_bucket", bucket)
    sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1
    return rows.withColumn("_inner", inner).join(sizes, "_bucket").withColumn(name, F.col("_before") + F.col("_inner")).drop("_bucket", "_inner", "_before")


def batches(rows: DataFrame, ordinal: str, size: int) -> DataFrame:
    """``rows`` with ``batch`` of ``size`` consecutive positions."""
    return rows.withColumn("batch", F.floor(F.col(ordinal) / size).cast("long"))
