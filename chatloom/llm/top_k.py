"""Exact top-k inner product search by the threshold algorithm.

Every block of candidates has, for each dimension, its vectors sorted by that
component, read from the end that the query's sign favours.  Sorted access goes
down all lists together; each vector met for the first time is scored in full.
The bound at a depth is the score of a vector holding every list's component
there: no vector still unmet can score more.  A query stops in a block once that
bound is below its kth result over all blocks its task has seen.

Queries are a stated set, taken in blocks of about ``QUERIES``; one block at a
time is sent to all tasks, each of which returns at most k rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatloom.llm.shared import cut, partitions, scratch

SCALE = 256
K = 5
EVERY = 50
QUERIES = 2048
CANDIDATES = 8192
FIRST_DEPTH = 32
#: No vector: sorts behind every score.
NONE = np.iinfo(np.int64).min


class Lists:
    """A block of candidates with its sorted lists."""

    def __init__(self, ids: np.ndarray, table: np.ndarray):
        self.ids, self.table = ids, table
        self.down = np.argsort(-table, axis=0, kind="stable")
        self.up = np.argsort(table, axis=0, kind="stable")
        self.high = np.take_along_axis(table, self.down, axis=0)
        self.low = np.take_along_axis(table, self.up, axis=0)

    def best(self, query: int, vector: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of (scores, ids) and this block, better first, smaller id first among equals."""
        n, k = len(self.ids), len(scores)
        plus = vector > 0
        up, down = np.flatnonzero(~plus & (vector != 0)), np.flatnonzero(plus)
        met = np.zeros(n, bool)
        at, depth = 0, FIRST_DEPTH
        while at < n:
            to = min(n, at + depth)
            fresh = np.zeros(n, bool)
            fresh[self.down[at:to, down]] = True
            fresh[self.up[at:to, up]] = True
            fresh &= ~met
            new = np.flatnonzero(fresh)
            if not len(down) and not len(up):
                new, to = np.flatnonzero(~met), n  # a zero query: every score is 0
            met[new] = True
            new = new[self.ids[new] != query]
            found = self.table[new] @ vector
            if len(found):
                may = found >= scores[-1]
                scores, ids = np.concatenate([scores, found[may].astype(np.int64)]), np.concatenate([ids, self.ids[new[may]]])
                order = np.lexsort((ids, -scores.astype(np.float64) if np.abs(scores[scores != NONE]).max(initial=0) < 2**52 else ~scores))[:k]
                scores, ids = scores[order], ids[order]
            bound = self.high[to - 1, down] @ vector[down] + self.low[to - 1, up] @ vector[up]
            if to == n or scores[-1] > bound or met.all():
                break
            at, depth = to, depth * 2
        return scores, ids


def _tables(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of at most ``CANDIDATES`` (ids, components); a vector of fewer components has zeros for the rest."""
    ids, rows = [], []
    for batch in batches:
        lengths = np.diff(batch.column(1).offsets.to_numpy())
        flat = batch.column(1).flatten().to_numpy()
        if (lengths == dims).all():
            table = flat.reshape(-1, dims)
        else:
            table = np.zeros((len(lengths), max(dims, int(lengths.max(initial=0)))), np.int64)
            table[np.arange(table.shape[1]) < lengths[:, None]] = flat
            table = table[:, :dims]
        ids.append(batch.column(0).to_numpy())
        rows.append(table)
        while sum(map(len, ids)) >= CANDIDATES:
            all_ids, all_rows = np.concatenate(ids), np.concatenate(rows)
            yield all_ids[:CANDIDATES], all_rows[:CANDIDATES]
            ids, rows = [all_ids[CANDIDATES:]], [all_rows[CANDIDATES:]]
    if sum(map(len, ids)):
        yield np.concatenate(ids), np.concatenate(rows)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(``_id``, ``_v``): floor(scale * x) of each component; rows with a null id, vector or component, or one not finite, are left out."""
    rows = vectors.select(vectors[id_col].cast("long").alias("_id"), vectors[vector_col].cast("array<double>").alias("_x"))
    bad = F.exists("_x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("_id").isNotNull() & F.col("_x").isNotNull() & ~bad).select("_id", F.transform("_x", lambda x: F.floor(x * scale).cast("long")).alias("_v"))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, all if fewer; ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all rows
    but those with the query's id.  A repeated query id is one query (its first
    vector by content); repeated candidate rows each count.  Components beyond a
    shorter vector's count as zero; products that could leave 64 bits raise.  An empty table gives an empty result; other
    columns are ignored.
    """
    spark = vectors.sparkSession
    rows = cut(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    asked = rows.filter(F.col("_id") % every == 0).groupBy("_id").agg(F.min("_v").alias("_v"))
    asked = cut(asked.repartition(partitions(spark), "_id"), "topk-queries")
    blocks = math.ceil(asked.count() / QUERIES)
    path = scratch(spark, "topk-partial")
    schema = "query_id bigint, vec_id bigint, score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == block).collect()
        if not part:
            continue
        dims = max(len(r["_v"]) for r in part)
        table = np.array([[*r["_v"], *[0] * (dims - len(r["_v"]))] for r in part], np.int64).reshape(len(part), dims)
        sent = spark.sparkContext.broadcast((np.array([r["_id"] for r in part]), table))

        def searched(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            query_ids, queries = sent.value
            scores = np.full((len(queries), k), NONE)
            ids = np.full((len(queries), k), np.iinfo(np.int64).max)
            widest = int(np.abs(queries).max(initial=0))
            for own, table in _tables(batches, queries.shape[1]):
                # Exact in doubles, which have fast products, while every sum stays below 2**52.
                most = widest * int(np.abs(table).max(initial=0)) * max(1, table.shape[1])
                if most >= 2**63:
                    raise OverflowError("scores do not fit 64 bits")
                exact = most < 2**52
                lists = Lists(own, table.astype(np.float64 if exact else np.int64))
                for q, query in enumerate(queries.astype(lists.table.dtype)):
                    scores[q], ids[q] = lists.best(int(query_ids[q]), query, scores[q], ids[q])
            at, rank = np.nonzero(scores != NONE)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[at]), pa.array(ids[at, rank]), pa.array(scores[at, rank])], names=["query_id", "vec_id", "score"])

        rows.mapInArrow(searched, schema).write.mode("append").parquet(path)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    partial = spark.read.schema(schema).parquet(path)
    return partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
