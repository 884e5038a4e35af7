"""What the operators share: scratch tables, column handling, stable hashing."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bits of the bitmaps that say which keys are touched: for each key, and the least and most of all.
SPARSE = 32
LEAST_BITS = 18
MOST_BITS = 27
#: Bits of a row of a bitmap, as ``bitmap_construct_agg`` makes them.
PAGE = 32_768


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is named and there is no cluster."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="chatloom-")
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named


_collected: list[list[str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared one, removed when the session's JVM ends, or with ``discard``."""
    path = f"{checkpoint_dir(spark)}/chatloom-{tag}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    for paths in _collected:
        paths.append(path)
    return path


@contextlib.contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Adds to ``paths`` the folders that ``scratch`` names meanwhile."""
    _collected.append(paths)
    try:
        yield
    finally:
        _collected.remove(paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Removes the folders; no table that reads them may be needed any more."""
    while paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and reread.

    Cuts the lineage so that a lost executor never repeats the work before, and
    gives the planner real sizes: a join broadcasts the table only when its
    measured size is under Spark's own threshold.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(docs: DataFrame) -> DataFrame:
    """``docs`` with columns named c0, c1, ...: dots, letter case and clashes of the names given don't matter."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def at(docs: DataFrame, name: str) -> str:
    """What ``positional`` calls the column ``name``."""
    return f"c{docs.columns.index(name)}"


def renamed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in its order and by its names, of rows that come from ``positional``."""
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def quoted(name: str) -> str:
    """A column's name that dots and backquotes in it don't break."""
    return "`" + name.replace("`", "``") + "`"


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, ``_text``) with null texts as empty; other columns can't clash."""
    return positional(docs).select(F.col(at(docs, id_col)).alias("_id"), F.coalesce(at(docs, text_col), F.lit("")).alias("_text"))


def apart(rows: DataFrame, key: str, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key is surely not among ``touched`` (one column of a written table), and the others.

    Only the others, the touched keys and about one in ``SPARSE`` more, have to be
    joined, so most texts are not shuffled.  What is broadcast is a bitmap of the
    touched keys' hashes, of ``SPARSE`` bits a key but at most 2 ** ``MOST_BITS`` bits
    (16 MB): beyond some ten million touched keys more rows become others, and no
    result changes.
    """
    n = touched.count()
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (SPARSE * n - 1).bit_length()))

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits))

    spot = place(F.col(touched.columns[0]))
    page, bit = (spot / F.lit(PAGE)).cast("int"), F.pmod(spot, F.lit(PAGE)).cast("long")
    pages = cut(touched.select(page.alias("_page"), bit.alias("_bit")).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmap")
    marked = rows.withColumn("_at", place(F.col(key))).withColumn("_page", (F.col("_at") / F.lit(PAGE)).cast("int"))
    marked = marked.join(F.broadcast(pages), "_page", "left")
    hit = F.expr(f"coalesce(getbit(cast(conv(hex(substring(_bits, cast(pmod(_at, {PAGE}) div 8 as int) + 1, 1)), 16, 10) as int), cast(pmod(_at, 8) as int)) = 1, false)")
    marked = marked.withColumn("_hit", hit)
    return tuple(marked.filter(which).drop("_at", "_page", "_bits", "_hit") for which in ("not _hit", "_hit"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``salt`` alone."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))


_remembered: dict[str, Callable[[], None]] = {}


_at_work = ""


def only(name: str, forget: Callable[[], None] | None = None) -> None:
    """Called in a worker by the operator ``name``: what other operators remember there is given up.

    Workers outlive tasks, and word tables are worth keeping from task to task; of a
    pipeline's operators, only the one at work may hold one.  Memory that an operator
    before it has freed goes back to the system.
    """
    global _at_work
    for other in [n for n in _remembered if n != name]:
        _remembered.pop(other)()
    if forget:
        _remembered[name] = forget
    if _at_work not in ("", name):
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)
    _at_work = name


def slices(batch: pa.RecordBatch, column: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text, so that lists of words stay small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
    for at, to in zip(cuts, cuts[1:], strict=False):
        if to > at:
            yield batch.slice(at, to - at)
