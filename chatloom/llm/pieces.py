"""SentencePiece encoding with N-best segmentation, and decoding.

The lattice of a text has a node between any two characters and an edge for each
vocabulary piece, weighted by the piece's score in the public model file.  A
forward Viterbi pass gives every node the best score from the start; run
backwards from the end, A* with these scores as its heuristic is exact, so it
takes segmentations off its queue in order of score, best first.

No piece holds the blank mark after another character or joins letters to other
characters (both checked on loading), and characters outside the vocabulary stand
alone as bytes.  Each path therefore passes the nodes between words, and a text's N
best are the N best sums over its words.  ``learn`` finds the best segmentation of
words up to ``SHORT`` characters, and how much less the second best scores, by a dense
forward and backward pass over many words at once; the search with A* runs for
other words, and for the few words of a text whose second choice costs least.  At most ``REMEMBERED`` words are kept.

The order is fully defined.  Within a word: higher score, then longer last piece,
then longer piece before it, and so on.  In a text: higher score, then departing
from the best segmentation earlier in the text.

The segmentation that scores best is not the one the library's merge procedure
finds for a model of merge type: scores there are merge ranks.  The library's own
ids are given beside it.  Decoding is the library's, and encoding followed by decoding gives every text back: a blank mark
that the text itself holds is written as bytes.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.lattice import SHORT, Lattice, groups
from chatloom.llm.shared import at as column_at
from chatloom.llm.shared import only, positional, quoted, slices, texts

#: Bytes of the words that are kept, as ``_size`` estimates them.
REMEMBERED = 64 << 20
#: Bytes of text whose chunks are taken together.
TOGETHER = 1 << 22
N_BEST = 3
#: Below the lowest score of a piece that ranks merges, as for unknown characters elsewhere.
UNKNOWN_PENALTY = 10.0
#: Fixed value: the mark that stands for a blank.
MARK = "▁"


def _size(word: str) -> int:
    """Bytes that a word takes, about: its string, its ids and its place in a dictionary."""
    return 230 + 6 * len(word)


def _spelled(word: str) -> str:
    """What a word stands for in a text: marks are blanks, but for one behind a zero, which is itself."""
    return word[1:] if len(word) > 1 and word[0] == "\0" else word.replace(MARK, " ")


class Runs:
    """Lists of numbers, one after the other in one array."""

    def __init__(self, flat=(), sizes=(), starts=None):
        self.flat, self.sizes = np.asarray(flat, np.int32), np.asarray(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes if starts is None else starts

    def cut(self, first: np.ndarray) -> Runs:
        """Each list without as many of its first numbers."""
        return Runs(self.flat, self.sizes - first, self.starts + first).take(np.arange(len(first)))

    def take(self, at: np.ndarray) -> Runs:
        """The lists at these places."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return Runs(self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + sizes, sizes)], sizes)

    def __add__(self, other: Runs) -> Runs:
        return Runs(np.concatenate([self.flat, other.flat]), np.concatenate([self.sizes, other.sizes]))

    def __getitem__(self, at: int) -> tuple[int, ...]:
        return tuple(self.flat[self.starts[at] : self.starts[at] + self.sizes[at]].tolist())


class Segmenter:
    """N-best segmentation over the vocabulary of the model file at ``path``."""

    def __init__(self, path: str):
        self.remembered = REMEMBERED
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.score: dict[int, float] = {}
        self.byte: dict[int, int] = {}
        scores = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} holds a blank mark inside")
                self.pieces[piece] = i
                scores.append(model.get_score(i))
        # Pieces outside the merge ranking carry a huge negative score; all of them rank just below the others.
        low = min(s for s in scores if s > -1e6) - UNKNOWN_PENALTY
        for piece, i in self.pieces.items():
            self.score[i] = max(model.get_score(i), low * len(piece))
        self.byte_score = 2 * low
        # Bytes above ASCII stand as the surrogates that encoding turns back into bytes.
        self.text_of = [""] * model.get_piece_size()
        for piece, i in self.pieces.items():
            self.text_of[i] = piece.replace(MARK, " ")
        for b, i in self.byte.items():
            self.text_of[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.longest = max(map(len, self.pieces))
        single = {c for piece in self.pieces for c in piece} - {MARK}
        letters = {c for c in single if c.isalpha()}
        if any(len({c in letters for c in piece.lstrip(MARK)}) > 1 for piece in self.pieces):
            letters = set()  # some piece joins letters to others: words end at blanks alone
        self.joins = letters.issuperset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
        kinds = ["".join(map(re.escape, sorted(kind))) for kind in (letters, single - letters) if kind]
        self.inside = single | {MARK}
        runs = "|".join(f"[{kind}]+" for kind in kinds)
        self.split = re.compile(f"{MARK}*(?:{runs})|{MARK}+|[^{''.join(kinds)}{MARK}]").findall
        self.lattice = Lattice(self.pieces, lambda piece: list(map(ord, piece)))
        scores = np.array(list(self.score.values()))
        # Ranks are whole numbers, whose sums over a short word are exact in 24 bits; others take 53.
        exact = (scores == np.rint(scores)).all() and -scores.min() * SHORT < 1 << 24
        self.by_id = np.full(model.get_piece_size() + 1, -np.inf, np.float32 if exact else np.float64)  # the last stands for no piece
        self.by_id[list(self.score)] = scores
        self.known: dict[str, int] = {}
        self.time = 0
        self.clear()

    def clear(self) -> None:
        """Forgets all words."""
        self.known.clear()
        self.held = 0
        self.spelling: list[str] = []
        self.ids, self.library = Runs(), Runs()
        self.firsts = np.zeros(0)
        self.seconds = np.zeros(0)  # what the second choice scores less
        self.faithful = np.zeros(0, bool)  # whether the ids decode to the word
        self.used = np.zeros(0, np.int32)  # when the word was last asked for
        self.choices: dict[int, list[tuple[float, tuple[int, ...]]]] = {}

    def keep(self, words: set[str]) -> None:
        """Forgets the words that have not been used for longest, about half, but none of these."""
        late = self.used > np.median(self.used)
        stay = [w for w, n in self.known.items() if late[n] or w in words]
        at = np.fromiter(map(self.known.__getitem__, stay), np.int64, len(stay))
        ids, library, firsts, seconds, faithful, used = self.ids.take(at), self.library.take(at), self.firsts[at], self.seconds[at], self.faithful[at], self.used[at]
        self.clear()
        self.known.update(zip(stay, range(len(stay)), strict=True))
        self.spelling, self.held, self.used = stay, sum(map(_size, stay)), used
        self.ids, self.library, self.firsts, self.seconds, self.faithful = ids, library, firsts, seconds, faithful

    def edges(self, word: str, end: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """(start, score, ids) of the edges into node ``end``, longest first."""
        found = False
        for start in range(max(0, end - self.longest), end):
            i = self.pieces.get(word[start:end])
            if i is not None:
                found = found or start == end - 1
                yield start, self.score[i], (i,)
        if not found:
            spelled = tuple(self.byte[b] for b in word[end - 1].encode())
            yield end - 1, self.byte_score * len(spelled), spelled

    def nbest(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations of a word: forward Viterbi, then backward A*."""
        into = [()] + [tuple(self.edges(word, k)) for k in range(1, len(word) + 1)]
        forward = [0.0] + [0.0] * len(word)
        for k in range(1, len(word) + 1):
            forward[k] = max(forward[start] + s for start, s, _ in into[k])
        # An entry is where a path leaves another one: its best total, the departures so far, and the tail taken.
        # From there the path follows edges that lose nothing, the longest first, and every other edge is queued.
        # A departure sorts by whether its piece is longer or shorter than that edge's, then by how early from the end.
        queue: list[tuple] = [(-forward[-1], (), len(word), 0.0, None, 0)]
        found = []
        while queue and len(found) < n:
            _, left, node, so_far, tail, depth = heapq.heappop(queue)
            while node:
                best, on = forward[node], None
                for start, s, ids in into[node]:
                    if on is None and forward[start] + s == best:
                        on = start, s, ids
                        continue
                    side = (1, -depth, start - node) if on else (-1, depth, start - node)
                    heapq.heappush(queue, (-(forward[start] + s + so_far), (*left, side), start, s + so_far, (ids, tail), depth + 1))
                node, so_far, tail, depth = on[0], so_far + on[1], (on[2], tail), depth + 1
            ids = []
            while tail:
                ids += tail[0]
                tail = tail[1]
            found.append((so_far, tuple(ids)))
        return found

    def learn(self, words: set[str]) -> None:
        """Best segmentation of each new word, how much less the second best scores, and the library's own ids.

        Forward and backward scores of many equally long words at once: the second
        best path has an edge off the best path, so it is the best path through one.
        """
        new = words.difference(self.known)
        self.held += sum(map(_size, new))
        if self.held > self.remembered:
            self.keep(words)
            self.held += sum(map(_size, new))
        plain = [w for w in new if w[0] in self.inside and len(w) <= SHORT]
        found: list[str] = []
        firsts, losses, ids, sizes = [], [], [], []
        for own in groups(plain):
            n, length = len(own), len(own[0])
            pieces = self.lattice.edges(np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).reshape(n, length))
            score = self.by_id[pieces]
            forward, backward = np.full((2, length + 1, n), -np.inf, score.dtype)
            forward[0] = backward[length] = 0
            for end in range(1, length + 1):
                forward[end] = (forward[:end] + score[:end, end]).max(axis=0)
            for start in range(length - 1, -1, -1):
                backward[start] = (backward[start + 1 :] + score[start, start + 1 :]).max(axis=0)
            through = forward[:, None] + score + backward[None, :]
            node, taken = np.full(n, length), np.full((n, length), -1, np.int32)
            for end in range(length, 0, -1):
                at = np.flatnonzero(node == end)
                start = (forward[:end, at] + score[:end, end, at] == forward[end, at]).argmax(axis=0)
                taken[at, end - 1] = pieces[start, end, at]
                through[start, end, at] = -np.inf
                node[at] = start
            found += own
            firsts.append(forward[length].astype(np.float64))
            losses.append((forward[length] - through.max(axis=(0, 1))).astype(np.float64))
            ids.append(taken[taken >= 0])
            sizes.append((taken >= 0).sum(axis=1))
        for word in new.difference(plain):
            best = self.options(word, 2)
            found.append(word)
            firsts.append([best[0][0]])
            losses.append([best[0][0] - best[1][0] if len(best) > 1 else np.inf])
            ids.append(best[0][1])
            sizes.append([len(best[0][1])])
        self.time += 1
        self.used = np.concatenate([self.used, np.full(len(found), self.time, np.int32)])
        self.used[[self.known[w] for w in words.difference(new)]] = self.time
        if not found:
            return
        runs = Runs(np.concatenate(ids), np.concatenate(sizes))
        known = len(self.spelling)
        self.known.update(zip(found, range(known, known + len(found)), strict=True))
        self.spelling += found
        self.ids, self.library = self.ids + runs, self.library + self.merged(found)
        self.firsts, self.seconds = np.concatenate([self.firsts, *firsts]), np.concatenate([self.seconds, *losses])
        pieces = list(map(self.text_of.__getitem__, runs.flat.tolist()))
        ends = np.cumsum(runs.sizes).tolist()
        self.faithful = np.concatenate([self.faithful, [self.joined(pieces[a:b]) == _spelled(w) for w, a, b in zip(found, [0, *ends], ends, strict=False)]]).astype(bool)

    def merged(self, words: list[str]) -> Runs:
        """The library's ids of the words.

        Nothing merges across the ends of words, so each is encoded behind a word of the
        other kind, whose ids are then left out; the library itself sets a mark before a
        text.  Marks alone stand before a byte that merges with nothing.
        """
        ids = {x: len(self.model.encode(x)) for x in (",", "a")}
        marked, skip, drop = [w[1:] for w in words], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            if word[0] == MARK:
                if word[-1] == MARK:
                    marked[i], drop[i] = " " * (len(word) - 1) + "\x01", 1
            elif len(word) == 1 or word[0] != "\0":
                other = "," if word[0].isalpha() else "a"
                marked[i], skip[i] = other + word, ids[other]
        found = Runs(*self.encoded(marked))
        return Runs(found.flat, found.sizes - drop, found.starts).cut(skip)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        found = self.model.encode(texts, num_threads=1)
        return np.fromiter(chain.from_iterable(found), np.int32), list(map(len, found))

    def options(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        return self.spelled(word[1:]) if len(word) > 1 and word[0] == "\0" else self.nbest(word, n)

    def chosen(self, number: int, n: int) -> list[tuple[float, tuple[int, ...]]]:
        found = self.choices.get(number)
        if found is None:
            found = self.choices[number] = self.options(self.spelling[number], n)
        return found

    def spelled(self, text: str) -> list[tuple[float, tuple[int, ...]]]:
        ids = tuple(self.byte[b] for b in text.encode())
        return [(self.byte_score * len(ids), ids)]

    def words(self, text: str) -> list[str]:
        """The text's words, blanks as marks, one added in front; marks of the text itself as bytes."""
        if not text:
            return []
        parts = text.split(MARK)
        found = self.split(MARK + parts[0].replace(" ", MARK))
        for part in parts[1:]:
            found.append("\0" + MARK)
            found += self.split(part.replace(" ", MARK))
        return found

    def together(self, batch: pa.StringArray) -> tuple[Runs, np.ndarray]:
        """(the words' numbers by text, whether their ids decode to the text)."""
        lines = pc.split_pattern(batch, "\n")
        line_ends = lines.offsets.to_numpy().astype(np.int64)
        listed = pc.split_pattern(lines.flatten(), " ")
        chunk_ends = listed.offsets.to_numpy().astype(np.int64)
        line_ends, chunk_ends = line_ends - line_ends[0], chunk_ends - chunk_ends[0]
        ends = chunk_ends[line_ends]  # of the texts' chunks
        coded = listed.flatten().dictionary_encode()
        code, chunks = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        opening = np.zeros(len(code), bool)  # a line, but not the text
        opening[chunk_ends[:-1]] = True
        opening[ends[:-1]] = False
        # Runs of blanks, and marks of the text itself, need the whole text; so do empty texts.
        marks = np.fromiter((MARK in c for c in chunks), bool, len(chunks))
        empty = np.fromiter((not c for c in chunks), bool, len(chunks))
        odd = marks[code] | empty[code] & ~opening
        slow = np.flatnonzero(np.logical_or.reduceat(odd, ends[:-1]))
        apart = [batch[int(i)].as_py() for i in slow]

        # A chunk behind a mark or a line end, or a text of its own, is a unit.
        code += opening * len(chunks)
        used, unit_of = np.unique(np.append(code, 2 * len(chunks)), return_inverse=True)
        units, whole = [], []
        n, plain, split = len(chunks), self.joins, self.split
        for u in used[:-1].tolist():
            before, chunk = (MARK, chunks[u]) if u < n else ("\n", chunks[u - n])
            if plain and chunk.isascii() and chunk.isalpha():
                units.append((MARK + chunk,) if u < n else ("\n", chunk))
                whole.append(True)
            else:
                units.append(own := split(before + chunk))
                whole.append("".join(own) == before + chunk)
        for text in apart:
            units.append(own := self.words(text))
            whole.append("".join(map(_spelled, own)).removeprefix(" ") == text)
        self.learn(set(chain.from_iterable(units)))
        numbers = Runs(np.fromiter(map(self.known.__getitem__, chain.from_iterable(units)), np.int64), [len(u) for u in units])

        length = np.diff(ends)
        length[slow] = 1
        unit_ends = np.cumsum(length)
        unit = np.zeros(int(unit_ends[-1]), np.int64)
        fast = np.ones(len(batch), bool)
        fast[slow] = False
        unit[np.repeat(fast, length)] = unit_of[:-1][np.repeat(fast, np.diff(ends))]
        unit[unit_ends[slow] - 1] = len(used) - 1 + np.arange(len(slow))
        taken = numbers.take(unit)
        words = Runs(taken.flat, np.add.reduceat(taken.sizes, unit_ends - length))
        back = np.logical_and.reduceat(np.array(whole, bool)[unit], unit_ends - length)
        some = np.flatnonzero(words.sizes)
        if len(some):
            back[some] &= np.logical_and.reduceat(self.faithful[words.flat], words.starts[some])
        return words, back

    def cheapest(self, words: Runs, n: int) -> list[list[int]]:
        """The places in each text of the ``n`` words whose second choice costs least, the earliest first among equals."""
        found: list[list[int]] = [[] for _ in words.sizes]
        some = np.flatnonzero(words.sizes)
        if not len(some):
            return found
        costs, starts, sizes = self.seconds[words.flat], words.starts[some], words.sizes[some]
        for _ in range(n):
            least = np.minimum.reduceat(costs, starts)
            at = np.flatnonzero(costs == np.repeat(least, sizes))
            at = at[np.searchsorted(at, starts)]
            real = np.isfinite(least)
            for text, k in zip(some[real].tolist(), (at - starts)[real].tolist(), strict=True):
                found[text].append(k)
            costs[at] = np.inf
        return found

    def best(self, words: Runs, n: int) -> Iterator[tuple[list[float], list[dict[int, int]]]]:
        """Of each text the ``n`` best scores, and for each which words (by place) take which other choice."""
        totals = np.concatenate([[0.0], np.cumsum(self.firsts[words.flat])])
        totals = (totals[words.starts + words.sizes] - totals[words.starts]).tolist()
        # Only the n - 1 cheapest departures can be in the n best.
        for text, (total, cheap) in enumerate(zip(totals, self.cheapest(words, n - 1), strict=True)):
            cheap.sort(reverse=True)
            # Backward over these words; choices from the end settle ties.
            queue: list[tuple] = [(0.0, (), 0)]
            scores, choices = [], []
            while queue and len(scores) < n:
                cost, taken, depth = heapq.heappop(queue)
                if depth == len(cheap):
                    scores.append(total - cost)
                    choices.append({k: c for k, c in zip(cheap, taken, strict=True) if c})
                    continue
                options = self.chosen(int(words.flat[words.starts[text] + cheap[depth]]), n)
                for c, (score, _) in enumerate(options):
                    heapq.heappush(queue, (cost + options[0][0] - score, (*taken, c), depth + 1))
            yield scores, choices

    def encode(self, text: str, n: int = 1) -> list[tuple[float, list[int]]]:
        """The ``n`` best (score, ids), best first."""
        words, _ = self.together(pa.array([text]))
        ((scores, choices),) = self.best(words, max(n, 2))
        return [(s, [i for k, w in enumerate(words.flat.tolist()) for i in (self.chosen(w, max(n, 2))[other[k]][1] if k in other else self.ids[w])]) for s, other in zip(scores[:n], choices, strict=False)]

    def joined(self, pieces: list[str]) -> str:
        text = "".join(pieces)
        return text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        """The text that ``ids`` stand for, without the blank added in front; broken byte sequences are replaced."""
        return self.joined([self.text_of[i] for i in ids]).removeprefix(" ")


@lru_cache(2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(path)


def encode_pieces(docs: DataFrame, path: str, n_best: int = N_BEST, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, remembered: int = REMEMBERED, together: int = TOGETHER) -> DataFrame:
    """One row per input row: id, n_pieces, score, margin, nbest_scores, round_trip, ids_sha256, n_library, library_sha256 and, if asked, ids and library_ids.

    ``margin`` is the best score less the second (null if there is none);
    ``round_trip`` says that decoding the ids gave the text back; digests are of
    ids as little-endian 32-bit integers; ``library_ids`` are those of the library's
    own procedure.  Null texts count as empty: no pieces.  Repeated rows and null ids
    pass through, an empty table gives an empty result, other columns are ignored.
    Long texts take memory in proportion to their length.  ``remembered`` and
    ``together`` bound what a worker holds besides, and change no result.
    """
    if n_best < 2:
        raise ValueError("n_best must be 2 or more")
    rows = texts(docs, id_col, text_col)
    kinds = {"n_pieces": "bigint", "score": "double", "margin": "double", "nbest_scores": "array<double>", "round_trip": "boolean", "ids_sha256": "string", "n_library": "bigint", "library_sha256": "string"}
    if with_ids:
        kinds |= {"ids": "array<int>", "library_ids": "array<int>"}
    schema = f"{quoted(id_col)} {rows.schema['_id'].dataType.simpleString()}, " + ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    arrow = {"bigint": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()), "boolean": pa.bool_(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    digest = lambda ids: hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(path)
        only("pieces", own.clear)
        own.remembered = remembered
        gc.disable()  # hundreds of thousands of short lists at a time, none in a cycle
        try:
            # Batches of long texts are taken apart, so that ids and texts together stay small.
            for whole in batches:
                for batch in slices(whole, 1, together):
                    yield result(own, batch)
        finally:
            gc.enable()

    def result(own: Segmenter, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, back = own.together(batch.column(1))
        ids, merged = own.ids.take(words.flat), own.library.take(words.flat)
        out: dict[str, list] = {name: [] for name in kinds}
        ends = [np.concatenate([[0], np.cumsum(x.sizes)])[np.concatenate([[0], np.cumsum(words.sizes)])].tolist() for x in (ids, merged)]
        for i, (scores, _) in enumerate(own.best(words, n_best)):
            best, its = ids.flat[ends[0][i] : ends[0][i + 1]], merged.flat[ends[1][i] : ends[1][i + 1]]
            row = (len(best), scores[0], scores[0] - scores[1] if len(scores) > 1 else None, scores, bool(back[i]), digest(best), len(its), digest(its), best, its)
            for column, value in zip(out.values(), row, strict=False):
                column.append(value)
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[name], arrow[kind]) for name, kind in kinds.items()]], names=[id_col, *kinds])

    return rows.mapInArrow(encoded, schema)


def decode_pieces(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts that the arrays of ids stand for; null arrays give null."""
    rows = positional(encoded).select(F.col(column_at(encoded, id_col)).alias("_id"), F.col(column_at(encoded, ids_col)).alias("_ids"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(path)
        for batch in batches:
            found = [None if v is None else own.decode(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[id_col, "text"])

    return rows.mapInArrow(decoded, f"{quoted(id_col)} {rows.schema['_id'].dataType.simpleString()}, text string")
