"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered through their first ``WINDOW`` bytes only, by passes from the
most significant digit on; a suffix alone in its group leaves the sort, and the
groups left after the last pass are exactly the repeated windows.

The first digit is the one that is dealt to tasks, so it has to be even where
leading bytes are not: it is the window's anchor, the ``GRAM`` bytes in it with the
least hash, and the anchor's offset.  Equal windows have the same anchor at the
same offset, so no two equal windows part ways; of a text about every 35th
position is an anchor, so windows travel not one by one but by their anchor.

1. Documents are packed, ordered by id, into compressed rows of about ``PACK``
   bytes, written once with their anchors.
2. Each pack sends, per distinct (anchor, surroundings), its first occurrence:
   two 64-bit hashes, the document and the place.  An anchor's surroundings are
   all bytes that windows over it can reach, cut at the document's ends.
3. Where surroundings agree, all windows over the later occurrences repeat.
   Where one anchor has several surroundings, the first of each is asked for.
4. Packs send those surroundings, and the remaining digits (``DIGIT`` bytes each)
   sort the windows over them.
5. Packs apply what was found.

Hot anchors, such as a line shorter than the window in every document, have as many
surroundings as occurrences.  Those with over ``CROWDED`` surroundings are not gathered by
anchor: the windows that have them are dealt one by one by two hashes of all their digits,
once a pack, and groups of equal ones are read off.  Anchors with more than about two
``SHARE``-ths of all are known before step 2: each pack lists those with a
``SHARE``-th of its own, so none can be missed and at most ``SHARE`` are broadcast.  The
others come to light in step 3.  Both ways give the same windows.

A passage in a third of all documents is one row per pack, and the number of parts
that are dealt grows with the number of packs.  Digits and surroundings are compared
by 64-bit hashes, four a window or two, not by a last look at the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import cut, partitions

WINDOW = 100
GRAM = 32
DIGIT = 25
PACK = 1 << 21
#: Windows sorted at a time.
SORTED = 1 << 21
#: Surroundings of an anchor beyond which its windows are dealt by their own digits; the share of all anchors, as 1 / ``SHARE``, that is looked for beforehand.
CROWDED = 4096
SHARE = 4096
#: Packs whose anchors, dealt, are as many as one part holds.
TO_A_PART = 32
STEP = np.uint64(0x5851F42D4C957F2D)
MIX = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xD1342543DE82EF95)
LAST = np.iinfo(np.int64).max


def _powers(n: int) -> np.ndarray:
    """STEP ** (n-1), ..., STEP ** 0."""
    return np.array([pow(int(STEP), i, 1 << 64) for i in range(n - 1, -1, -1)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` codes from each position on, by doubling lengths."""
    h, have = codes, 1
    tail, tail_size = None, 0  # hash of the last codes already taken for the remainder of size
    rest = size
    while True:
        if rest & 1:
            if tail is None:
                tail, tail_size = h, have
            else:
                weight = _powers(tail_size + 1)[0]
                n = len(codes) - have - tail_size + 1
                tail, tail_size = h[:n] * weight + tail[have : have + n], have + tail_size
        rest >>= 1
        if not rest:
            return tail
        h = h[:-have] * _powers(have + 1)[0] + h[have:]
        have *= 2


#: Columns of a pack's row; ``heavy`` are the hashes that many of its anchors have, with their surroundings' number.
PACKED = "pack bigint, ids binary, lengths binary, text binary, anchors binary, nulls int, n_anchors bigint, heavy array<struct<h:bigint,n:bigint>>"


class Pack:
    """Documents one after the other, ordered by id (``nulls`` ones without an id last).

    ``places`` are the anchors, ``lows`` the first window of each; the windows that
    have an anchor follow one another.
    """

    def __init__(self, number: int, ids: np.ndarray, lengths: np.ndarray, text: np.ndarray, window: int, gram: int, nulls: int = 0):
        self.number, self.ids, self.lengths, self.text = number, ids, lengths, text
        self.window, self.gram, self.nulls = window, gram, nulls
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    @classmethod
    def of(cls, row: list, window: int, gram: int) -> Pack:
        number, ids, lengths, text, anchors, nulls, n, _ = row
        own = cls(number, np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64), np.frombuffer(zstandard.decompress(text), np.uint8), window, gram, nulls)
        steps, before = _columns(anchors, [np.uint32, np.uint32]) if n else (np.zeros(0, np.uint32),) * 2
        own.places = np.cumsum(steps, dtype=np.int64)
        own.lows = own.places - before
        return own

    def row(self, share: int) -> tuple:
        """What ``of`` reads back, in the order of ``PACKED``."""
        self.places, self.lows = self.anchors()
        packer = zstandard.ZstdCompressor(level=1)
        steps = np.diff(self.places, prepend=0).astype(np.uint32)
        anchors = packer.compress(steps.tobytes() + (self.places - self.lows).astype(np.uint32).tobytes())
        return self.number, self.ids.tobytes(), self.lengths.tobytes(), packer.compress(self.text), anchors, self.nulls, len(self.places), self.heavy(share)

    def heavy(self, share: int) -> list[dict]:
        """Anchors that hold a ``share``-th of this pack's, with the number of their surroundings if that is as many."""
        h = self.hashes(self.places)
        order = np.argsort(h)
        edges = np.flatnonzero(np.diff(h[order], prepend=~h[order][:1], append=~h[order][-1:]))
        many = np.diff(edges) * share >= len(h)
        chosen = order[np.repeat(many, np.diff(edges))]
        kinds = np.unique(np.stack([h[chosen], self.surroundings(self.places[chosen])], axis=1), axis=0)[:, 0]
        return [{"h": a, "n": n} for a, n in zip(*[x.tolist() for x in np.unique(kinds.view(np.int64), return_counts=True)], strict=True) if n * share >= len(h)]

    def hashes(self, at: np.ndarray) -> np.ndarray:
        """The hash of the gram at each place."""
        h = np.zeros(len(at), np.uint64)
        for i in range(self.gram):
            h = h * STEP + self.text[at + i]
        return _mixed(h)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, first windows) of the anchors of all windows."""
        reach = self.window - self.gram + 1
        places, lows, size, latest = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1 << 20, -1
        for at in range(0, len(self.text), size):
            codes = self.text[at : at + size + self.window - 1].astype(np.uint64)
            if len(codes) < self.window:
                break
            h = _mixed(_grams(codes, self.gram))
            # Least hash, leftmost among equals: the place fills the low bits.
            key = (h & ~np.uint64((1 << 22) - 1)) | np.arange(len(h), dtype=np.uint64)
            whole = -(-len(key) // reach) * reach
            padded = np.full(whole, np.iinfo(np.uint64).max, np.uint64)
            padded[: len(key)] = key
            blocks = padded.reshape(-1, reach)
            ahead = np.minimum.accumulate(blocks, axis=1).ravel()
            behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            n = len(codes) - self.window + 1
            least = np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n])
            # The last window of the document that each of these starts lies in.
            first, beyond = np.searchsorted(self.ends, at, side="right"), np.searchsorted(self.starts, at + n)
            own = slice(first, beyond)
            last = np.repeat(self.ends[own] - self.window, np.minimum(self.ends[own], at + n) - np.maximum(self.starts[own], at))
            start = np.flatnonzero(np.arange(at, at + n) <= last)
            place = (least[start] & np.uint64((1 << 22) - 1)).astype(np.int64) + at
            new = np.flatnonzero(np.diff(place, prepend=latest))
            places.append(place[new])
            lows.append(start[new] + at)
            latest = place[-1] if len(place) else latest
        return np.concatenate(places), np.concatenate(lows)

    def windows(self, at: np.ndarray) -> np.ndarray:
        """The starts of all windows that have one of these anchors."""
        which = np.searchsorted(self.places, np.sort(at))
        following = np.append(self.lows[1:], len(self.text))[which] - 1
        n = np.minimum(following, self.ends[self.document(self.places[which])] - self.window) - self.lows[which] + 1
        return np.repeat(self.lows[which] - np.cumsum(n) + n, n) + np.arange(n.sum())

    def digits(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of all bytes of each window."""
        one, two = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for i in range(self.window):
            code = self.text[starts + i].astype(np.uint64) + np.uint64(1)
            one, two = one * STEP + code, two * OTHER + code
        return _mixed(one), _mixed(two)

    def room(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the document before each place, at most window - gram, and from it on, at most window."""
        doc = self.document(at)
        return np.minimum(at - self.starts[doc], self.window - self.gram), np.minimum(self.ends[doc] - at, self.window)

    def around(self, at: np.ndarray) -> np.ndarray:
        """Each place's surroundings, code + 1, and 0 outside its document."""
        left, right = self.room(at)
        before = self.window - self.gram
        offset = np.arange(-before, self.window)
        inside = (offset >= -left[:, None]) & (offset < right[:, None])
        place = np.clip(at[:, None] + offset, 0, len(self.text) - 1)
        return np.where(inside, self.text[place].astype(np.uint16) + np.uint16(1), np.uint16(0))

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """A hash of each place's surroundings, bounds included."""
        weights = _mixed(np.arange(1, 2 * self.window - self.gram + 1, dtype=np.uint64) * MIX) | np.uint64(1)
        return np.concatenate([np.zeros(0, np.uint64), *[_mixed(self.around(at[i : i + 4096]).astype(np.uint64) @ weights) for i in range(0, len(at), 4096)]])

    def firsts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, hashes, surroundings) of the first anchor of each kind, sorted by these hashes, and the places of later ones."""
        at, h = self.places, self.hashes(self.places)
        around = self.surroundings(at)
        order = np.lexsort((at, around, h))
        at, h, around = at[order], h[order], around[order]
        first = np.ones(len(at), bool)
        first[1:] = (h[1:] != h[:-1]) | (around[1:] != around[:-1])
        return at[first], h[first], around[first], at[~first]


def _dealt(number: int, h: np.ndarray, parts: int, columns: list[np.ndarray], kind: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """(part, pack, columns one after the other, compressed) for the parts of a kind that ``h`` deals rows to."""
    part = (h % np.uint64(parts)).astype(np.int64) + kind * parts
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    packer = zstandard.ZstdCompressor(level=1)
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(part[a]), number, packer.compress(b"".join(np.ascontiguousarray(c[a:b]).tobytes() for c in columns))


def _columns(data: bytes, kinds: list) -> list[np.ndarray]:
    """What ``_dealt`` put together; a kind is a dtype or a dtype with a row length."""
    raw = zstandard.decompress(data)
    dtypes = [np.dtype(k) for k in kinds]
    n = len(raw) // sum(d.itemsize for d in dtypes)
    out, at = [], 0
    for d in dtypes:
        out.append(np.frombuffer(raw, d, n, at))
        at += n * d.itemsize
    return out


def _by_part(batches: Iterator[pa.RecordBatch], kinds: list[list], parts: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Per part, which of ``kinds`` it holds, its rows' packs and columns; rows come sorted by part, ``parts`` parts of each kind."""
    part, held = None, []

    def whole():
        kind = part // parts
        columns = [_columns(data, kinds[kind]) for _, data in held]
        packs = np.repeat(np.array([p for p, _ in held]), [len(c[0]) for c in columns])
        return kind, packs, [np.concatenate(c) for c in zip(*columns, strict=True)]

    for batch in batches:
        for own, pack, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if own != part and held:
                yield whole()
                held = []
            part = own
            held.append((pack, data.as_py()))
    if held:
        yield whole()


def _to_packs(packs: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(packs, kind="stable")
    packs, columns = packs[order], [c[order] for c in columns]
    edges = np.flatnonzero(np.diff(packs, prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(packs[a]), b"".join(c[a:b].tobytes() for c in columns)


def _repeats(group: np.ndarray, around: np.ndarray, window: int, gram: int, digit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(member, offset of the anchor in the window) of the windows that an earlier member also has.

    ``group`` numbers the members' anchors; members of a group are in order.  The
    radix passes: groups of windows are split by one digit after the other, and
    windows left alone drop out.
    """
    before = window - gram
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    # Members of whole groups together while their windows fit; of a large group, fewer offsets at a time.
    at = 0
    while at < len(edges) - 1:
        to = at + 1
        while to < len(edges) - 1 and (edges[to + 1] - edges[at]) * (before + 1) <= SORTED:
            to += 1
        a, b = edges[at], edges[to]
        per_pass = max(1, min(before + 1, SORTED // (b - a)))
        codes = around[a:b]
        hashes = {size: _block_hashes(codes, size) for size in {min(digit, window - d) for d in range(0, window, digit)}}
        for low in range(0, before + 1, per_pass):
            offsets = np.arange(low, min(before + 1, low + per_pass))
            member, offset = (x.ravel() for x in np.meshgrid(np.arange(b - a), offsets, indexing="ij"))
            whole = (codes[member, before - offset] > 0) & (codes[member, before - offset + window - 1] > 0)
            member, offset = member[whole], offset[whole]
            key = (group[a:b][member] - group[a]) * (before + 1) + offset
            for d in range(0, window, digit):
                value = hashes[min(digit, window - d)][member, before - offset + d]
                order = np.lexsort((value, key))
                member, offset, key, value = member[order], offset[order], key[order], value[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (value[1:] != value[:-1])
                key = np.cumsum(new) - 1
                many = np.bincount(key, minlength=1)[key] > 1 if len(key) else np.zeros(0, bool)
                member, offset, key = member[many], offset[many], key[many]
            later = np.zeros(len(key), bool)
            later[1:] = key[1:] == key[:-1]
            yield member[later] + a, offset[later]
        at = to


def _block_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` codes from each column on."""
    out = np.zeros((len(codes), codes.shape[1] - size + 1), np.uint64)
    for i in range(size):
        out = out * STEP + codes[:, i : i + out.shape[1]]
    return _mixed(out)


def suffix_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    digit: int = DIGIT,
    pack: int = PACK,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_kept: bool = False,
    crowded: int = CROWDED,
    share: int = SHARE,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, spans and, if asked, kept.

    Every byte goes that lies in a ``window``-byte string which also starts
    earlier: in a row of smaller id, or before in the same row.  ``spans`` are the
    maximal removed runs as (start, end) bytes, ``kept`` the remaining bytes.  Null
    texts are empty.  Null ids come after all others; rows with equal ids are in
    an arbitrary but fixed order.  Texts shorter than the window lose nothing.  A
    text longer than ``pack`` is a pack of its own, whose task holds it and its anchors
    (some 6 bytes a byte).  An empty table gives an empty result; other columns
    are ignored.  ``crowded`` and ``share`` decide how windows travel, never the result.
    """
    if not 0 < gram < window:
        raise ValueError("gram must be shorter than window")
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("_text"), F.spark_partition_id().alias("_task"))
    packs = cut(rows.mapInArrow(lambda b: _packed(b, pack, window, gram, share), PACKED), "suffix-packs")
    n_packs, n_anchors = packs.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_anchors"), F.lit(0))).first()
    heavy = packs.select(F.explode("heavy").alias("e")).groupBy("e.h").agg(F.sum("e.n").alias("n")).filter(F.col("n") >= F.greatest(F.lit(crowded + 1), F.lit(-(-n_anchors // share))))
    hot = np.array([r["h"] for r in heavy.collect()], np.int64).view(np.uint64)  # at most ``share`` of them
    parts = max(4 * partitions(spark), n_packs // TO_A_PART)
    tasks = max(partitions(spark), parts // 4)
    sent = "part int, pack bigint, data binary"
    n_columns = len(PACKED.split(", "))

    def opened(batches: Iterator[pa.RecordBatch], *more: int) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(n_columns)]
                yield Pack.of(row, window, gram), *[batch.column(n_columns + c)[i].as_py() or [] for c in more]

    def dealt(made: DataFrame) -> DataFrame:
        return made.repartition(tasks, "part").sortWithinPartitions("part")

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, in opened(batches):
            at, h, around, _ = own.firsts()
            few = ~np.isin(h, hot)
            at, h, around = at[few], h[few], around[few]
            yield _rows(_dealt(own.number, h, parts, [h, around, own.ids[own.document(at)], at.astype(np.uint32)]), sent)

    lists = "pack bigint, again binary, detail binary, crowd binary"

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, number, (h, around, doc, at) in _by_part(batches, [[np.uint64, np.uint64, np.int64, np.uint32]], parts):
            order = np.lexsort((at, number, doc, around, h))
            number, h, around, at = number[order], h[order], around[order], at[order]
            head = np.ones(len(h), bool)
            head[1:] = h[1:] != h[:-1]
            kind = head.copy()
            kind[1:] |= around[1:] != around[:-1]
            kinds = np.bincount(np.cumsum(head) - 1, kind)[np.cumsum(head) - 1]
            found = [dict(_to_packs(number[which], [at[which]])) for which in (~kind, kind & (kinds > 1) & (kinds <= crowded), kind & (kinds > crowded))]
            yield _rows(((p, *[f.get(p) for f in found]) for p in sorted({p for f in found for p in f})), lists)

    found = cut(dealt(packs.mapInArrow(asks, sent)).mapInArrow(answers, lists), "suffix-answers")

    # What is dealt next, by kind: surroundings of an anchor's place, windows by their digits, and places known to repeat.
    kinds = [[np.uint64, np.int64, np.uint32, (np.uint16, (2 * window - gram,))], [np.uint64, np.uint64, np.int64, np.uint32], [np.uint32]]

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, details, crowd in opened(batches, 0, 1):
            at = np.sort(_places(details))
            for i in range(0, len(at), 20_000):
                some = at[i : i + 20_000]
                h = own.hashes(some)
                yield _rows(_dealt(own.number, h, parts, [h, own.ids[own.document(some)], some.astype(np.uint32), own.around(some)]), sent)
            at = _places(crowd)
            if len(hot):
                first, h, *_ = own.firsts()
                at = np.concatenate([at, first[np.isin(h, hot)]])
            yield _rows(windows(own, own.windows(at)), sent)

    def windows(own: Pack, starts: np.ndarray) -> Iterator[tuple]:
        if not len(starts):
            return
        one, two = (np.concatenate(d) for d in zip(*[own.digits(starts[i : i + SORTED // 8]) for i in range(0, len(starts), SORTED // 8)], strict=True))
        order = np.lexsort((starts, two, one))
        one, two, starts = one[order], two[order], starts[order].astype(np.uint32)
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        yield from _dealt(own.number, one[first], parts, [one[first], two[first], own.ids[own.document(starts[first])], starts[first]], 1)
        later = starts[~first]
        yield from _dealt(own.number, np.full(len(later), own.number, np.uint64), parts, [later], 2)

    def sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, number, columns in _by_part(batches, kinds, parts):
            if kind == 0:
                h, doc, at, around = columns
                order = np.lexsort((at, number, doc, h))
                group = np.cumsum(np.diff(h[order], prepend=h[order][:1]) != 0)
                found = ((number[order][member], at[order][member] - offset.astype(np.uint32)) for member, offset in _repeats(group, around[order], window, gram, digit))
            elif kind == 1:
                one, two, doc, at = columns
                order = np.lexsort((at, number, doc, two, one))
                one, two = one[order], two[order]
                later = np.flatnonzero((one[1:] == one[:-1]) & (two[1:] == two[:-1])) + 1
                found = [(number[order][later], at[order][later])]
            else:
                found = [(number, columns[0])]
            for packs, starts in found:
                yield _rows(_to_packs(packs, [starts]), "pack bigint, starts binary")

    wanted = found.filter("detail is not null or crowd is not null").groupBy("pack").agg(F.collect_list("detail").alias("detail"), F.collect_list("crowd").alias("crowd"))
    wanted = cut(wanted.withColumnRenamed("pack", "_wanted"), "suffix-wanted")
    asked = packs.join(wanted, packs["pack"] == wanted["_wanted"], "left" if len(hot) else "inner").drop("_wanted")
    starts = dealt(asked.mapInArrow(surroundings, sent)).mapInArrow(sorted_windows, "pack bigint, starts binary")
    starts = starts.groupBy("pack").agg(F.collect_list("starts").alias("starts")).withColumnRenamed("pack", "_starts")
    again = found.filter("again is not null").groupBy("pack").agg(F.collect_list("again").alias("again"))
    verdict = cut(again.join(starts, F.col("pack") == F.col("_starts"), "full").select(F.coalesce("pack", "_starts").alias("_of"), "again", "starts"), "suffix-verdicts")

    schema = f"`{id_col}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>" + ", kept binary" * with_kept

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, again, partly in opened(batches, 0, 1):
            yield _rows(_kept(own, _places(again), _places(partly), with_kept), schema)

    everything = packs.join(verdict, packs["pack"] == verdict["_of"], "left").drop("_of")
    kind = docs.schema[id_col].dataType
    return everything.mapInArrow(applied, schema).withColumn(id_col, F.col(f"`{id_col}`").cast(kind))


def _places(lists: list[bytes]) -> np.ndarray:
    """Places that came back, one after the other."""
    return np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(d, np.uint32) for d in lists]])


def _kept(own: Pack, again: np.ndarray, partly: np.ndarray, with_kept: bool) -> Iterator[tuple]:
    """The result rows of a pack, from the anchors and windows found to repeat."""
    *_, later = own.firsts()
    repeated = np.concatenate([later, again])
    left, right = own.room(repeated)  # all windows over these anchors
    start = np.concatenate([repeated - left, partly])
    end = np.concatenate([repeated + right, partly + own.window])
    order = np.argsort(start)
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > end[:-1]) | np.diff(own.document(start)).astype(bool)
    heads = np.flatnonzero(new)
    start, end = start[heads], end[np.append(heads[1:], len(end))[: len(heads)] - 1]
    of = np.searchsorted(start, np.append(own.starts, len(own.text)))
    known = len(own.ids) - own.nulls
    for i, (doc, a, b) in enumerate(zip(own.ids.tolist(), own.starts.tolist(), own.ends.tolist(), strict=True)):
        runs = list(zip(start[of[i] : of[i + 1]].tolist(), end[of[i] : of[i + 1]].tolist(), strict=True)) if b > a else []
        digest, kept, at = hashlib.sha256(), [], a
        for s, e in [*runs, (b, b)]:
            digest.update(own.text[at:s])
            if with_kept:
                kept.append(own.text[at:s].tobytes())
            at = e
        spans = [{"start": s - a, "end": e - a} for s, e in runs]
        row = (doc if i < known else None, b - a, sum(e - s for s, e in runs), len(spans), digest.hexdigest(), spans)
        yield (*row, b"".join(kept)) if with_kept else row


def _packed(batches: Iterator[pa.RecordBatch], size: int, window: int, gram: int, share: int) -> Iterator[pa.RecordBatch]:
    """Rows gathered into packs of about ``size`` bytes, each ordered by id."""
    held, total, count, task = [], 0, 0, 0

    def packed() -> pa.RecordBatch:
        held.sort(key=lambda r: (r[0] is None, r[0] or 0))
        ids = np.array([LAST if r[0] is None else r[0] for r in held], np.int64)
        lengths = np.array([len(r[1]) for r in held], np.int64)
        nulls = sum(r[0] is None for r in held)
        text = np.frombuffer(b"".join(r[1] for r in held), np.uint8)
        held.clear()
        return _rows([Pack((task << 32) + count, ids, lengths, text, window, gram, nulls).row(share)], PACKED)

    for batch in batches:
        for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            task = own
            held.append((doc, text.as_buffer().to_pybytes()))
            total += len(held[-1][1])
            if total >= size:
                yield packed()
                total, count = 0, count + 1
    if held:
        yield packed()


def _rows(rows, schema: str) -> pa.RecordBatch:
    """Python rows as a batch with the columns of a Spark schema."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds |= {f"array<struct<{a}:bigint,{b}:bigint>>": pa.list_(pa.struct([(a, pa.int64()), (b, pa.int64())])) for a, b in (("start", "end"), ("h", "n"))}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name.strip("`") for name, _ in fields])
