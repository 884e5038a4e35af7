"""Near-dedup by SimHash and Jaccard: texts of 0.8 or more on shingles of five words are linked.

A text is the set of its distinct five-word shingles (XXH64 of the words, lower
case as in ``simhash``).  Texts of equal sets are one node, named by a hash of the
set.  Fingerprint, index, tally and verification are those of ``simhash``, made
wide enough for a similarity instead of four bits: at 0.8, SimHash bits differ in 15
of 100, so that 64 of them guarantee no shared byte.  A fingerprint here has
``POSITIONS`` bytes, each bit the majority over all shingles of the set.

A node is posted under each byte with the next one, the last with the first.  A pair
at exactly 0.8 shares a byte with probability 0.27 and meets in no posting with 7e-6;
it shares fewer than ``SHARED`` of the positional bytes, or differs in more than
``APART`` bits, with less.  The postings' own look at 168 bits of the fingerprint misses
3e-6.  These are for large sets; the fewer the shingles, the more it depends on
their number (bits differ in 16 of 100 at the most, in 19 for sets of four against
five, of which 3 in 1,000 are missed).  Sets of fewer than four are within 0.8 of no
other set and not posted.  Every link is verified by the exact similarity of the two
sets, so nothing below ``LEAST`` is linked.

1. Within a posting, nodes of the same two bytes are compared by the checked bits;
   most share the bytes by chance and go.  What is left falls into groups, each a
   posting of its own from here on.  A posting of more than ``CROWDED`` is one group.
2. A posting's central node is that whose postings hold the most nodes.  Every node
   is verified against the most central of its postings' central nodes that it may be
   linked to.  This joins a large group of near copies by one link a node, and most
   postings then lie in one component.
3. In the other postings, only nodes outside the central node's component are
   compared with the rest, in cells of at most about ``CELL`` by ``CELL`` nodes.
   A cell tallies positional bytes, counts the differing bits of pairs that share
   enough, and names the nodes that may have a link.
4. These meet once more in their cells, with their sets, and are verified there.

So what travels is nodes, not pairs.  A node keeps its postings in one row, to which
what is known of it is joined once; a task that deals a posting to cells holds four
longs for each of its nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.components import components
from chatloom.llm.shared import apart, at, cut, only, partitions, positional, renamed, slices, texts

SHINGLE = 5
#: The least Jaccard similarity, as a fraction.
LEAST = (4, 5)
#: Bytes of a fingerprint, a multiple of 8 of at least 16 and at most 256.
POSITIONS = 192
#: Positional bytes that a pair has to share to be verified: 52 are expected at 0.8, with a deviation of 6, and 0.8 of unlike texts.
SHARED = 16
#: Bits that a pair may differ in: 233 of 1,536 are expected at 0.8, with a deviation of 14, and 768 of unlike texts.
APART = 350
#: Of the two longs of a summary a pair may differ in so many bits: 19 of 128 are expected at 0.8, with a deviation of 4.
FAR = 40
#: Of the 168 bits of the fingerprint that travel with a posting a pair may differ in so many: 25 are expected at 0.8, with a deviation of 5, and 84 of unlike texts, with one of 6.5.
CHECK = 48
#: Nodes of a posting that are compared there; of a larger one all go on.
CROWDED = 4096
#: Rows of postings held at a time, and those to a task.
HELD = 1 << 17
DEALT = 1 << 22
#: Nodes of a posting that meet in one cell, on either side.
CELL = 256
SEED = 42
#: Hashes taken at a time, so that a long text takes bounded memory.
BLOCK = 2048

_rng = np.random.default_rng(SEED)
_FACTORS = _rng.integers(0, 1 << 63, POSITIONS // 8, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, POSITIONS // 8, np.uint64)
#: Rows of bits that add up in a byte.
ADDED = 255
#: Where a posting's key begins: 8 bits each of its number and its two bytes; checked bits lie below.
KEY = 40


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles; a shorter text is one shingle, one without words the empty one."""
    words = text.encode().lower().split()
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(size, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    if not words:
        return np.array([digest(b"", SEED)], np.uint64)
    found = []
    for low in range(0, len(words) - span, BLOCK):
        cuts = zip(starts[low : low + BLOCK].tolist(), ends[low + span : low + span + BLOCK].tolist(), strict=False)
        found.append(np.array([digest(line[i:j], SEED) for i, j in cuts], np.uint64))
    return np.unique(np.concatenate(found))


def _node(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def widened(hashes: np.ndarray) -> np.ndarray:
    """``POSITIONS`` bytes for each hash, a row each."""
    with np.errstate(over="ignore"):
        x = (hashes ^ (hashes >> np.uint64(31)))[:, None] * _FACTORS + _SHIFTS
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    return x.astype("<u8", copy=False).view(np.uint8)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``POSITIONS`` bytes; a bit is 1 if it is set in over half of the set's widened hashes."""
    ones = np.zeros(8 * POSITIONS, np.int64)
    for low in range(0, len(hashes), ADDED):
        ones += np.unpackbits(widened(hashes[low : low + ADDED]), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes))


def _keys(positions: np.ndarray) -> np.ndarray:
    """The keys of fingerprints, a row each: for each position its number, its byte and the next."""
    number = np.arange(POSITIONS, dtype=np.uint64) << np.uint64(KEY + 16)
    here, following = positions.astype(np.uint64), np.roll(positions, -1, axis=1).astype(np.uint64)
    return number | here << np.uint64(KEY + 8) | following << np.uint64(KEY)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(a key for each posting, the bytes of the fingerprint, a summary in two longs: its first 16 bytes) of a set."""
    positions = fingerprint(hashes)
    return _keys(positions[None, :])[0].view(np.int64), positions, positions[:16].view("<i8").tolist()


def _signed(rows: DataFrame) -> DataFrame:
    """(``_id``, ``_its``, ``_node``, ``_n``, ``_bytes``, ``_s0``, ``_s1``) of the rows (``_id``, ``_its``, ``_text``)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("near")
        for batch in batches:
            nodes, sizes, positions, s0, s1 = [], [], [], [], []
            for v in batch.column(2):
                hashes = shingles(v.as_py())
                own = fingerprint(hashes)
                a, b = own[:16].view("<i8").tolist()
                nodes.append(_node(hashes))
                sizes.append(len(hashes))
                positions.append(own.tobytes())
                s0.append(a)
                s1.append(b)
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(positions, pa.binary()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_its", "_node", "_n", "_bytes", "_s0", "_s1"])

    return rows.mapInArrow(made, f"_id {rows.schema['_id'].dataType.simpleString()}, _its bigint, _node bigint, _n int, _bytes binary, _s0 bigint, _s1 bigint")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, POSITIONS)


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``key`` and the lowest ``KEY`` bits of the first long of the fingerprint, the second long, the third) of the rows (``_bytes``, ``_s0``, ``_s1``), a row for each posting."""
    only("near")
    for whole in batches:
        for low in range(0, whole.num_rows, 256):
            batch = whole.slice(low, 256)
            check = batch.column(1).to_numpy().view(np.uint64) & np.uint64((1 << KEY) - 1)
            positions = _matrix(batch.column(0))
            keys = (_keys(positions) | check[:, None]).ravel().view(np.int64)
            further = [batch.column(2).to_numpy(), positions[:, 16:24].copy().view("<i8").ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.repeat(c, POSITIONS)) for c in further)], names=["key", "_check", "_further"])


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the least member of everyone's group) after the groups of each ``a`` and ``b`` have become one."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != (after := label[label])).any():
            label = after


def _groups(keys: np.ndarray, checked: list[np.ndarray], crowded: np.ndarray) -> np.ndarray:
    """The least row of everyone's group: rows of equal keys joined where the checked bits differ in at most ``CHECK``."""
    label, at = np.arange(len(keys)), np.flatnonzero(~crowded)
    a, b, waiting = [], [], 0
    for step in range(1, len(keys)):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        differ = sum(np.bitwise_count(bits[at] ^ bits[at + step]) for bits in checked)
        near = at[differ <= CHECK]
        a.append(near)
        b.append(near + step)
        waiting += len(near)
        if waiting > HELD:
            label, a, b, waiting = _joined(label, np.concatenate(a), np.concatenate(b)), [], [], 0
    return _joined(label, np.concatenate(a), np.concatenate(b)) if a else label


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(``key``, ``_band``, ``_check``) of the groups of two and more within a posting, each by a key of its own; batches come sorted.

    Columns after ``_check`` are further bits to compare.
    """

    def found(rows: np.ndarray, full: int) -> pa.RecordBatch:
        words = rows.view(np.uint64)
        keys, first = words[0] >> np.uint64(KEY), words[0] & np.uint64((1 << KEY) - 1)
        _, place, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        crowded = (sizes[place] > most) | (keys.astype(np.int64) == full)
        label = _groups(keys, [first, *words[1:]], crowded)
        own = np.where(crowded, keys << np.uint64(KEY), words[0][label])
        some = crowded | (np.bincount(label, minlength=len(label))[label] > 1)
        pairs = np.unique(np.stack([own[some], words[1][some]]), axis=1)
        bands = (pairs[0] >> np.uint64(KEY + 16)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(bands), pa.array(pairs[1].view(np.int64))], names=["key", "_band", "_check"])

    only("near")
    held, n, full = [], 0, -1
    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns]))
        n += batch.num_rows
        if n < max(HELD, 2 * most):
            continue
        rows = np.concatenate(held, axis=1)
        keys = rows[0].view(np.uint64) >> np.uint64(KEY)
        edges = np.flatnonzero(np.diff(keys))
        done = int(edges[-1]) + 1 if len(edges) else n
        now = full
        if not len(edges):  # one posting, and more of it may come
            now = full = int(keys[0])
        yield found(rows[:, :done], now)
        held, n = [rows[:, done:]], n - done
    if n:
        yield found(np.concatenate(held, axis=1), full)


def _sized(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``_together`` with ``_size``, the rows of their group; of a crowded posting, those that came together."""
    for batch in _together(batches, most):
        _, place, sizes = np.unique(batch.column(0).to_numpy(), return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes[place])], names=[*batch.schema.names, "_size"])


def _sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(``_node``, ``_set``) of ``nodes`` (``_its``: one row's of each), and of a few more; no text is shuffled."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("near")
        for whole in batches:
            for batch in slices(whole, 0):
                sets = [shingles(v.as_py()) for v in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["_node", "_set"])

    _, others = apart(rows, "_its", nodes)
    return others.select("_text").mapInArrow(made, "_node bigint, _set array<bigint>").dropDuplicates(["_node"])


def _large(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can reach LEAST."""
    up, down = LEAST
    return F.least(a, b) * (up + down) >= up * (a + b)


def _to_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``a``, ``b``, ``central``): the first node of each posting with the others that may be linked to it; batches (key, _node, _n, _s0, _s1, _central) come sorted."""
    up, down = LEAST
    only("near")
    first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy() for c in batch.columns])
        if first is not None:  # a posting may go on from the batch before
            rows = np.concatenate([first, rows], axis=1)
        key, node, size, s0, s1, central = rows
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lead = np.repeat(starts, np.diff(np.append(starts, len(key))))
        far = np.bitwise_count((s0 ^ s0[lead]).view(np.uint64)) + np.bitwise_count((s1 ^ s1[lead]).view(np.uint64))
        large = np.minimum(size, size[lead]) * (up + down) >= up * (size + size[lead])
        pairs = np.unique(np.stack([node[lead], node, central[lead]])[:, (node != node[lead]) & large & (far <= FAR)], axis=1)
        first = rows[:, lead[-1] : lead[-1] + 1]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names=["a", "b", "central"])


def _stars(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(``a``, ``b``): links between nodes and the most central one of the central nodes of their postings; ``met``: _node, _n, _s0, _s1, _central, _in."""
    rows = met.select(F.explode("_in").alias("p"), "_central", "_node", F.col("_n").cast("long").alias("_n"), "_s0", "_s1")
    rows = rows.select(F.col("p.key").alias("key"), "_node", "_n", "_s0", "_s1", "_central")
    rows = rows.repartition(partitions(met.sparkSession), "key").sortWithinPartitions("key", F.desc("_central"), F.desc("_node"))
    best = rows.mapInArrow(_to_leaders, "a bigint, b bigint, central bigint").groupBy("b").agg(F.max(F.struct("central", "a")).alias("l"))
    pairs = cut(best.select("l.a", "b"), "near-pairs")
    one = sets.select(F.col("_node").alias("a"), F.col("_set").alias("_a"))
    two = sets.select(F.col("_node").alias("b"), F.col("_set").alias("_b"))
    same = F.size(F.array_intersect("_a", "_b"))
    up, down = LEAST
    near = same * (up + down) >= up * (F.size("_a") + F.size("_b"))
    return cut(pairs.join(one, "a").join(two, "b").filter(near).select("a", "b"), "near-stars")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each long."""
    x = x.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _cells(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows (key, _band, _node, _root), which come sorted with each posting's central node first, once for each cell of an undecided posting.

    The nodes outside the central node's component are the minor ones.  They and the
    others are dealt to blocks of about ``size`` by a hash.  Cell (0, i, j) compares minor
    block i with major block j, (1, i, 0) also minor block i with itself, (2, i, k) minor
    blocks i and k.
    """

    def dealt(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.size:
            return
        starts = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1]))
        lengths = np.diff(np.append(starts, rows.shape[1]))
        minor = rows[3] != np.repeat(rows[3, starts], lengths)
        others = np.add.reduceat(minor.astype(np.int64), starts)
        p, q = (np.repeat(-(-n // size), lengths) for n in (others, lengths - others))
        rows, minor, p, q = rows[:, p > 0], minor[p > 0], p[p > 0], q[p > 0]
        block = (_mixed(rows[2]) % np.where(minor, p, q).astype(np.uint64)).astype(np.int64)
        times = np.where(minor, q + p - 1, p)
        pieces = np.cumsum(times) // HELD
        for low, high in zip(cuts := [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(times)], cuts[1:], strict=False):
            at = np.repeat(np.arange(low, high), times[low:high])
            k = np.arange(len(at)) - np.repeat(np.cumsum(times[low:high]) - times[low:high], times[low:high])
            own, small = block[at], minor[at]
            among = small & (k >= q[at])  # with another minor block
            other = k - q[at] + (k - q[at] >= own)
            i = np.where(small, np.where(among, np.minimum(own, other), own), k)
            j = np.where(small, np.where(among, np.maximum(own, other), k), own)
            kind = np.where(among, 2, j == 0)
            cell = _mixed(_mixed(rows[0, at]) ^ (kind | i << 2 | j << 33).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(kind, pa.int32()), pa.array(small), pa.array(own, pa.int32()), pa.array(rows[1, at], pa.int32()), pa.array(rows[2, at]), pa.array(rows[3, at])], names=["cell", "_kind", "_minor", "_block", "_band", "_node", "_root"])

    only("near")
    held, n = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns]))
        n += batch.num_rows
        if n < HELD:
            continue
        rows = np.concatenate(held, axis=1)
        done = int(np.searchsorted(rows[0], rows[0, -1]))  # the last posting may go on
        if done:
            yield from dealt(rows[:, :done])
        held, n = [rows[:, done:]], rows.shape[1] - done if done else 0
    if held:
        yield from dealt(np.concatenate(held, axis=1))


def _in_cells(met: DataFrame, classes: DataFrame) -> DataFrame:
    """The nodes of undecided postings in their cells; ``met``: _node, _central, _in, _root.  What describes a node is joined once, not for each posting."""
    size = CELL
    rows = met.select(F.explode("_in").alias("p"), "_central", "_node", "_root").select(F.col("p.key").alias("key"), F.col("p._band").cast("long").alias("_band"), "_central", "_node", "_root")
    rows = rows.repartition(partitions(met.sparkSession), "key").sortWithinPartitions("key", F.desc("_central"), F.desc("_node")).drop("_central")
    schema = "cell bigint, _kind int, _minor boolean, _block int, _band int, _node bigint, _root bigint"
    cells = rows.mapInArrow(lambda batches: _cells(batches, size), schema)
    own = cells.groupBy("_node", "_root").agg(F.collect_list(F.struct("cell", "_kind", "_minor", "_block", "_band")).alias("_in"))
    described = classes.select(F.col("_node").alias("_of"), "_n", "_bytes")
    own = own.join(described, own["_node"] == described["_of"]).select(F.explode("_in").alias("c"), "_node", "_n", "_root", "_bytes")
    return own.select("c.*", "_node", "_n", "_root", "_bytes")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other; batches come sorted by the first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cells = batch.column(0).to_numpy()
        edges = np.flatnonzero(np.diff(cells)) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)], strict=True):
            if held and high > low and held[0].column(0)[0].as_py() != cells[low]:
                yield pa.Table.from_batches(held)
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def _to_compare(kind: np.ndarray, minor: np.ndarray, block: np.ndarray, root: np.ndarray, u: int) -> np.ndarray:
    """The rows of a cell that minor row ``u`` is compared with, each pair once."""
    other = (root != root[u]) & (~minor | (kind == 1) & (np.arange(len(root)) > u) | (kind == 2) & (block > block[u]))
    return np.flatnonzero(other)


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a cell that share enough positional bytes with a row of another component, and enough bits, met first in this posting."""
    up, down = LEAST
    only("near")
    for cell in _runs(batches):
        if len(cell) < 2:
            continue
        kind, minor, block, band, size, root = (cell.column(c).to_numpy() for c in ("_kind", "_minor", "_block", "_band", "_n", "_root"))
        positions = _matrix(cell.column("_bytes"))
        words = positions.view(np.uint64)
        size = size.astype(np.int64)
        found = np.zeros(len(cell), bool)
        for u in np.flatnonzero(minor).tolist():
            v = _to_compare(kind, minor, block, root, u)
            v = v[np.minimum(size[v], size[u]) * (up + down) >= up * (size[v] + size[u])]
            equal = positions[v] == positions[u]
            enough = equal.sum(axis=1) >= SHARED
            v, equal = v[enough], equal[enough]
            near = np.bitwise_count(words[v] ^ words[u]).sum(axis=1, dtype=np.int64) <= APART
            v, equal = v[near], equal[near]
            if len(v):
                both = equal & np.roll(equal, -1, axis=1)
                v = v[both.any(axis=1) & (both.argmax(axis=1) == band[u])]
                found[v] = True
                found[u] |= len(v) > 0
        own = cell.select(["cell", "_kind", "_minor", "_block", "_root", "_node"]).filter(pa.array(found))
        yield from own.combine_chunks().to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``a``, ``b``): links that join what the rows of a cell link, verified by their sets; of each two components one link at most."""
    up, down = LEAST
    only("near")
    for cell in _runs(batches):
        if len(cell) < 2:
            continue
        kind, minor, block, root, node = (cell.column(c).to_numpy() for c in ("_kind", "_minor", "_block", "_root", "_node"))
        sets = cell.column("_set").combine_chunks()
        ends = np.cumsum(sets.value_lengths().to_numpy())
        starts = ends - sets.value_lengths().to_numpy()
        _, code = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        seen, links = np.zeros(code.max(initial=0) + 1, bool), {}
        for u in np.flatnonzero(minor).tolist():
            v = _to_compare(kind, minor, block, root, u)
            if not len(v):
                continue
            seen[code[starts[u] : ends[u]]] = True
            same = np.add.reduceat(seen[code].astype(np.int32), starts)[v]
            seen[code[starts[u] : ends[u]]] = False
            v = v[same * (up + down) >= up * (ends[v] - starts[v] + ends[u] - starts[u])]
            for w in v.tolist():
                links[root[u], root[w]] = u, w
        pairs = np.array(list(links.values()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"])


def _linked(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """(``a``, ``b``): links between nodes that connect just what candidates of LEAST and more connect."""
    n = partitions(rows.sparkSession)
    classes = cut(marked.groupBy("_node").agg(F.min("_its").alias("_its"), *[F.first(c).alias(c) for c in ("_n", "_bytes", "_s0", "_s1")]), "near-classes")
    up, down = LEAST
    linkable = classes.filter(F.col("_n") * (down - up) >= up)  # a smaller set is less than 0.8 of itself and one more shingle
    tasks, most = max(n, linkable.count() * POSITIONS // DEALT), CROWDED
    postings = linkable.select("_bytes", "_s0", "_s1").mapInArrow(_posted, "key bigint, _check bigint, _further bigint")
    postings = postings.repartition(tasks, F.shiftrightunsigned("key", KEY)).sortWithinPartitions("key")
    together = cut(postings.mapInArrow(lambda batches: _sized(batches, most), "key bigint, _band int, _check bigint, _size bigint"), "near-together")
    within = together.groupBy("_check").agg(F.sum("_size").alias("_central"), F.collect_set(F.struct("key", "_band")).alias("_in"))
    met = cut(within.join(linkable.select("_node", "_its", "_n", "_s0", "_s1"), F.col("_check") == F.col("_s1")).drop("_check"), "near-met")
    sets = cut(_sets(rows, cut(met.select("_its"), "near-nodes")), "near-sets")
    first = _stars(met, sets)

    roots = cut(components(first), "near-first")
    placed = met.join(roots, met["_node"] == roots["node"], "left").select("_node", "_central", "_in", F.coalesce("root", "_node").alias("_root"))
    cells = _in_cells(cut(placed, "near-placed"), classes)
    schema = "cell bigint, _kind int, _minor boolean, _block int, _root bigint, _node bigint"
    maybe = cut(cells.repartition(n, "cell").sortWithinPartitions("cell", "_node").mapInArrow(_may_link, schema), "near-maybe")
    with_sets = maybe.join(sets.withColumnRenamed("_node", "_of"), F.col("_node") == F.col("_of")).drop("_of")
    rest = with_sets.repartition(n, "cell").sortWithinPartitions("cell", "_node").mapInArrow(_verified, "a bigint, b bigint")
    return first.unionByName(cut(rest, "near-rest"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of links, that of the smallest id, nulls last; columns as they were.

    Rows are told apart by id and text, so rows of one id with different texts, and
    rows without an id, are judged each by its own text; rows equal in both are one
    document, of which one stays.  Null texts count as empty, and texts without
    words equal each other.  An empty table gives an empty result.  A text's set
    takes memory in proportion to its length.  Other columns, whatever their
    names, come back as they were.
    """
    rows = texts(docs, id_col, text_col).select("_id", F.xxhash64("_text").alias("_its"), "_text")
    marked = cut(_signed(rows), "near-signatures")
    roots = cut(components(_linked(rows, marked)), "near-roots")
    named = marked.join(roots, marked["_node"] == roots["node"], "left").select("_id", "_its", F.coalesce("root", "_node").alias("_root"))
    named = cut(named, "near-named")
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_its").alias("its")))
    stays = cut(named.groupBy("_root").agg(first.alias("best")).select(F.col("best.id").alias("_keep"), F.col("best.its").alias("_kept")), "near-decisions")

    each = named.groupBy("_id", "_its").agg(F.count(F.lit(1)).alias("rows"))
    same = each["_id"].eqNullSafe(stays["_keep"]) & (each["_its"] == stays["_kept"])
    touched = cut(each.join(stays, same, "left").select("_id", F.col("_its").alias("_text_of"), "rows", F.col("_kept").isNotNull().alias("stays")).filter("not stays or rows > 1"), "near-touched")
    key, text = at(docs, id_col), at(docs, text_col)
    own = positional(docs).withColumn("_its", F.xxhash64(F.coalesce(text, F.lit(""))))
    untouched, others = apart(own, "_its", touched.select("_text_of"))
    gone = touched.filter("not stays")
    stay = others.join(gone, others[key].eqNullSafe(gone["_id"]) & (others["_its"] == gone["_text_of"]), "left_anti")
    if touched.filter("rows > 1").take(1):
        stay = stay.dropDuplicates([key, "_its"])
    return renamed(untouched.unionByName(stay), docs)
