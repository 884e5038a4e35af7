"""SimHash near-dedup through a byte-position inverted index with count filtering.

Fingerprints differing in at most ``MAX_BITS`` = 4 of their 64 bits differ in at
most four of their eight bytes, so they share at least ``MIN_SHARED`` = 4 bytes at
the same positions.  Postings of single bytes would grow with the square of the
corpus; the index therefore posts each fingerprint under 20 triples of byte
positions, the fewest for which any four positions contain one (``triples``), so
no qualifying pair is missed.  Within a posting every pair's shared positional
bytes are tallied, pairs below the guaranteed minimum go, the rest are verified
by counting differing bits.

Only distinct fingerprints are indexed, so a group of copies is one entry.  A
posting hands on a spanning forest of its links, never all pairs.  A posting of
more than ``CROWDED`` fingerprints is not compared pairwise at all: two
fingerprints are within four bits just when some point lies within two bits of
both, so each member is sent to the points around it (over the bits its posting
leaves open) and members meeting at a point are linked.  That is exact, spreads
evenly, and takes work in proportion to the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components
from chatloom.llm.shared import apart, at, cut, only, partitions, positional, renamed, texts

SHINGLE = 4
SEED = 42
MAX_BITS = 4
MIN_SHARED = 4
CROWDED = 4096
#: Bytes of hash bits unpacked at a time, so that a long text takes bounded memory.
BLOCK = 1 << 15


def triples() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that every 4 positions contain one: three parts in a ring, a triple lies in one part or has two in a part and one in the next."""
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [p for p in parts if len(p) == 3]
    for k, part in enumerate(parts):
        found += [(*two, one) for two in combinations(part, 2) for one in parts[(k + 1) % 3]]
    return [tuple(sorted(t)) for t in found]


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """64 bits, each the majority over all shingles' XXH64 (repeats included); 0 without words."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly [\x20\x09-\x0D]
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(size, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    n = len(words) - span
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        cuts = zip(starts[at:to].tolist(), ends[at + span : to + span].tolist(), strict=True)
        hashes = np.array([digest(line[i:j], SEED) for i, j in cuts], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(``_id``, ``_fp``): each row's fingerprint as a signed long."""
    rows = texts(docs, id_col, text_col)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("simhash")
        for batch in batches:
            found = np.array([fingerprint(v.as_py(), size) for v in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["_id", "_fp"])

    return rows.mapInArrow(made, f"_id {rows.schema['_id'].dataType.simpleString()}, _fp bigint")


def _linked(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each run of equal keys."""
    at, found_a, found_b = np.arange(len(keys)), [], []
    for step in range(1, len(keys)):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        differ = fps[at] ^ fps[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = shared >= MIN_SHARED
        near[near] = np.bitwise_count(differ[near].view(np.uint64)) <= MAX_BITS
        found_a.append(at[near])
        found_b.append(at[near] + step)
    if not found_a:
        return fps[:0], fps[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    label = np.arange(len(keys))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    mine = np.flatnonzero(label != np.arange(len(keys)))
    return fps[mine], fps[label[mine]]


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted (key, fingerprint) batches regrouped so that no run of equal keys is cut."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if len(keys) >= rows:
            done = int(np.searchsorted(keys, keys[-1]))
            if done:
                yield keys[:done], fps[:done]
                keys, fps = keys[done:], fps[done:]
    if len(keys):
        yield keys, fps


def links(distinct: DataFrame) -> DataFrame:
    """(``a``, ``b``): links between the distinct fingerprints ``_fp`` that connect just what lies within ``MAX_BITS``."""
    spark, chosen = distinct.sparkSession, triples()

    def byte(position: int):
        return F.shiftrightunsigned("_fp", 8 * position).bitwiseAND(F.lit(255))

    def posting(number: int, triple: tuple[int, ...]):
        key = F.lit(number)
        for p in triple:
            key = key * 256 + byte(p)
        return key.cast("long")

    index = distinct.select(F.explode(F.array(*[posting(i, t) for i, t in enumerate(chosen)])).alias("key"), "_fp")
    crowded = cut(index.groupBy("key").count().filter(F.col("count") > CROWDED).select("key"), "simhash-crowded")
    schema = "a bigint, b bigint"
    some = bool(crowded.take(1))
    calm = index.join(crowded, "key", "left_anti") if some else index

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in _runs(batches, 1 << 17):
            a, b = _linked(keys, fps)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    found = calm.repartition(partitions(spark), "key").sortWithinPartitions("key", "_fp").mapInArrow(compared, schema)
    if not some:
        return found

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = []
        for triple in chosen:
            bits = [np.uint64(1 << (8 * p + i)) for p in range(8) if p not in triple for i in range(8)]
            masks.append(np.array([0, *bits, *(x | y for x, y in combinations(bits, 2))], np.uint64).view(np.int64))
        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(keys >> 24).tolist():
                own = fps[keys >> 24 == number]
                for at in range(0, len(own), 512):
                    part = own[at : at + 512]
                    points = (part[:, None] ^ masks[number][None, :]).ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(part, len(masks[number])))], names=["key", "_fp"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in _runs(batches, 1 << 17):
            first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if len(keys) else 0))
            head = np.repeat(fps[first], np.diff(np.append(first, len(keys))))
            pairs = np.unique(np.stack([fps, head])[:, fps != head], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    points = index.join(crowded, "key", "left_semi").mapInArrow(around, "key bigint, _fp bigint")
    return found.unionByName(points.repartition(partitions(spark), "key").sortWithinPartitions("key", "_fp").mapInArrow(met, schema))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links, the row's own
    included.  Null texts count as empty and, as texts without words, have
    fingerprint zero, which links like any other.  Null ids take part but never
    name a component unless all its ids are null.  Repeated rows pass through; an
    empty table gives an empty result; other columns are ignored.
    """
    marked = cut(fingerprints(docs, id_col, text_col, size), "simhash-fingerprints")
    classes = cut(marked.groupBy("_fp").agg(F.min("_id").alias("_least")), "simhash-classes")
    roots = components(cut(links(classes.select("_fp")), "simhash-links"))
    named = classes.join(roots, classes["_fp"] == roots["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    named = cut(named, "simhash-roots")
    least = cut(named.groupBy("_root").agg(F.min("_least").alias("_component")), "simhash-names")
    named = cut(named.join(least, "_root").select(F.col("_fp").alias("_class"), "_component"), "simhash-components")
    return marked.join(named, marked["_fp"] == named["_class"]).select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; columns as they were.

    Rows that repeat an id are one document, of which one row stays; rows without
    an id can't be told apart and stay.  Null and empty texts and an empty table are
    as in ``simhash_components``.
    """
    kept = F.col(id_col) == F.col("component_id")
    found = simhash_components(docs, id_col, text_col).filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_doc"))
    found = found.agg(F.max(kept).alias("stays"), F.count(F.lit(1)).alias("rows")).filter("not stays or rows > 1")
    found = cut(found, "simhash-touched")
    key = at(docs, id_col)
    untouched, others = apart(positional(docs), key, found.select("_doc"))
    gone = found.filter("not stays")
    stay = others.join(gone, others[key] == gone["_doc"], "left_anti")
    if found.filter("stays").take(1):
        stay = stay.filter(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(stay.filter(F.col(key).isNull()))
    return renamed(untouched.unionByName(stay), docs)
