"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

For one pre-token the table holds, at every byte prefix, the exact token count of
that prefix's own encoding: ``count[k] = count[k - len] + 1`` where the last token is
the only vocabulary entry ending at ``k`` that the merge rules leave beside the last
token before it.  Pre-tokens encode independently, so a text's table is the running
sum of its pre-tokens' tables, and both "how many tokens has this prefix" and "how
much fits in a budget" are lookups in tables that are kept: ``fits`` encodes nothing.

Pre-tokens end at single blanks and line ends between other characters, so texts are
cut there in Arrow, equal chunks of a batch are counted once, and a text's running
sum is a sum over the numbers of its chunks.  A table's entry depends on nothing
behind it, so new pre-tokens are taken in order and share the entries of common
prefixes.  Tables are remembered in at most about ``REMEMBERED`` bytes.

Counts equal the ``tokenizers`` library's for the same file, without added begin
or end tokens; strings of special tokens inside a text count as that one token,
the library's default.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from chatloom.llm.shared import only, quoted, slices, texts

#: Bytes of what is remembered, as ``_size`` estimates them.
REMEMBERED = 192 << 20
#: Longer pre-tokens (in characters) are not remembered.
LONG = 256
LIMIT = 1024
#: Characters that stand alone as a pre-token behind letters, at the end of a chunk.
SINGLE = frozenset(".,;:!?")
#: Bytes of text whose chunks are taken together.
TOGETHER = 1 << 24


def _size(word: str) -> int:
    """Bytes that a remembered word takes, about: the string, a table as long as it, and its place in a dictionary."""
    return 240 + 3 * len(word)


def _byte_letters() -> dict[str, int]:
    """The printable letters by which the vocabulary file writes the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts at every prefix, for the byte-level BPE in the file at ``path``."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        to_bytes = {w: bytes(letters[c] for c in w) for w in spec["model"]["vocab"]}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        singles = [b for b, _ in sorted((to_bytes[w], i) for w, i in spec["model"]["vocab"].items() if len(to_bytes[w]) == 1)]
        # Numbered by merge rank, which the comparison of tokens below relies on.
        self.number = {b: i for i, b in enumerate(singles)}
        self.left = list(range(len(singles)))
        self.right = list(range(len(singles)))
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            x, y, n = self.number[to_bytes[a]], self.number[to_bytes[b]], len(self.left)
            self.merged[x, y] = n
            self.number[to_bytes[a] + to_bytes[b]] = n
            self.left.append(x)
            self.right.append(y)
        # The tokens by their last bytes: a tree whose edges are ``node * 256 + byte``, and the token that a node stands for.
        self.before: dict[int, int] = {}
        self.token = [-1]
        for word, n in self.number.items():
            node = 0
            for byte in reversed(word):
                node = self.before.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = n
        self.split = regex.compile(pattern).findall
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_strings = specials
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.beside = lru_cache(1 << 18)(self._beside)
        self.forget()

    def forget(self) -> None:
        # What has been used lately, and what was before; the latter goes when the former is full.
        self.kept: dict[str, bytes | array] = {}
        self.older: dict[str, bytes | array] = {}
        self.held = 0

    def _beside(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow ``a``: no merge across the seam comes before those that made them.

        The merges that made ``a`` and ``b`` are undone, the latest first; tokens are
        numbered by rank, so the larger number is the later merge.  At each point in
        time the two tokens that touch the seam are known; had a pair of them a merge
        earlier than ``rank``, the merge undone last, the library would have taken it
        across the seam, and the two tokens would not stand side by side.  ``b + 1`` and
        ``a`` as the new rank settle ties: of equal ranks the one to the left comes first.
        """
        merged, left, right = self.merged, self.left, self.right
        rank = len(left)
        while True:
            if merged.get((a, b), rank) < rank:
                return False
            if a > b:
                rank, a = a, right[a]
                if a == rank:
                    rank, b = b + 1, left[b]
                    if b + 1 == rank:
                        return True
            else:
                rank, b = b + 1, left[b]
                if b + 1 == rank:
                    rank, a = a, right[a]
                    if a == rank:
                        return True

    def extend(self, piece: bytes, last: list[int], count: list[int]) -> None:
        """Appends what is missing of the last tokens and the counts at every prefix of ``piece``."""
        before, token, beside = self.before.get, self.token, self.beside
        for end in range(len(count), len(piece) + 1):
            node, start, starts, tokens = 0, end, [], []
            while start and (node := before(node << 8 | piece[start - 1])):
                start -= 1
                if (t := token[node]) >= 0:
                    starts.append(start)
                    tokens.append(t)
            while (start := starts.pop()) and not beside(last[start], tokens[-1]):
                tokens.pop()
            last.append(tokens[-1])
            count.append(count[start] + 1)

    def table(self, piece: bytes) -> list[int]:
        """Token counts of ``piece[:0], piece[:1], ...``, each prefix encoded on its own."""
        last, count = [-1], [0]
        self.extend(piece, last, count)
        return count

    def tables(self, pieces: set[str]) -> dict[str, bytes | array]:
        """The tables of these pre-tokens, in order, so that common prefixes are encoded once."""
        found, last, count, previous = {}, [-1], [0], b""
        for data, piece in sorted([(p.encode(), p) for p in pieces]):
            same = 0
            for x, y in zip(data, previous):  # noqa: B905  as far as both go
                if x != y:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            self.extend(data, last, count)
            previous = data
            found[piece] = bytes(count) if len(count) < 256 else array("I", count)
        return found

    def hold(self, piece: str, table: bytes | array) -> bytes | array:
        if len(piece) <= LONG:
            self.held += _size(piece)
            if self.held > REMEMBERED // 2:
                self.older, self.kept, self.held = self.kept, {}, _size(piece)
            self.kept[piece] = table
        return table

    def of(self, piece: str) -> bytes | array:
        """The table of a pre-token, remembered."""
        found = self.kept.get(piece)
        if found is None:
            found = self.older.get(piece)
            found = self.hold(piece, array("I", self.table(piece.encode())) if found is None else found)
        return found

    def chunk(self, chunk: str) -> int:
        """Tokens of a text without special tokens."""
        return sum([self.of(p)[-1] for p in self.split(chunk)])

    def pieces(self, chunk: str, blank: str) -> list[str]:
        """The pre-tokens of ``blank + chunk``, a chunk without blanks."""
        if chunk.isalpha():
            return [blank + chunk]
        if chunk[-1:] in SINGLE and chunk[:-1].isalpha():
            return [blank + chunk[:-1], chunk[-1]]
        return self.split(blank + chunk)

    def counts(self, chunks: list[str], blank: str) -> np.ndarray:
        """Tokens of each chunk, a blank in front."""
        split = [self.pieces(c, blank) for c in chunks]
        new = set(chain.from_iterable(split))
        used = {p: t for p in new if (t := self.kept.get(p) or self.older.get(p)) is not None}
        new.difference_update(used)
        used |= self.tables(new)
        for piece in used.keys() - self.kept.keys():
            self.hold(piece, used[piece])
        return np.fromiter((sum([used[p][-1] for p in own]) for own in split), np.int64, len(split))

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special tokens; true marks those."""
        at = 0
        if self.specials is not None:
            for m in self.specials.finditer(text):
                if m.start() > at:
                    yield text[at : m.start()], False
                yield m[0], True
                at = m.end()
        if at < len(text):
            yield text[at:], False

    def prefixes(self, text: str) -> list[int]:
        """The text's table: tokens of its first 0, 1, 2, ... bytes, the last pre-token of each encoded as far as it goes.

        Inside a special token's string the count is that before it.
        """
        out, total = [0], 0
        for part, special in self.parts(text):
            if special:
                out += [total] * (len(part.encode()) - 1) + [total + 1]
                total += 1
                continue
            for piece in self.split(part):
                table = self.of(piece)
                out += [total + n for n in table[1:]]
                total += table[-1]
        return out

    def count(self, text: str) -> int:
        return sum(1 if special else self.chunk(part) for part, special in self.parts(text))

    def fits(self, text: str, budget: int) -> int:
        """Code points of the longest run of whole pre-tokens, then characters of the next, within ``budget`` tokens."""
        at = 0
        for part, special in self.parts(text):
            if special:
                if not budget:
                    return at
                at, budget = at + len(part), budget - 1
                continue
            for piece in self.split(part):
                table = self.of(piece)
                if table[-1] > budget:
                    ends = accumulate(len(c.encode()) for c in piece)
                    return at + max((i for i, b in enumerate(ends, 1) if table[b] <= budget), default=0)
                at, budget = at + len(piece), budget - table[-1]
        return at

    def together(self, batch: pa.StringArray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, code points that fit ``limit``) of each text."""
        lines = pc.split_pattern(batch, "\n")
        line_ends = lines.offsets.to_numpy().astype(np.int64)
        listed = pc.split_pattern(lines.flatten(), " ")
        chunk_ends = listed.offsets.to_numpy().astype(np.int64)
        line_ends, chunk_ends = line_ends - line_ends[0], chunk_ends - chunk_ends[0]
        ends = chunk_ends[line_ends]  # of the texts' chunks
        coded = listed.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # A cut is one between pre-tokens if characters other than blanks stand on both sides.
        odd = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in words), bool, len(words))
        slow = np.add.reduceat(odd[code].astype(np.int32), ends[:-1]) > 0
        for special in self.special_strings:
            slow |= pc.match_substring(batch, special).to_numpy(zero_copy_only=False)
        # A line's first chunk has no blank in front, but the line end, which is a token, unless it is the text's first.
        opening = chunk_ends[:-1]
        first = np.zeros(len(code), bool)
        first[opening] = True
        tokens = np.zeros(len(code), np.int64)
        for which, blank in ((~first, " "), (first, "")):
            used = np.unique(code[which])
            of_word = np.zeros(len(words), np.int64)
            of_word[used] = self.counts([words[c] for c in used.tolist()], blank)
            tokens[which] = of_word[code[which]]
        tokens[opening] += 1
        tokens[ends[:-1]] -= 1
        totals = np.add.reduceat(tokens, ends[:-1])
        fits = pc.utf8_length(batch).to_numpy().astype(np.int64)
        points = pc.utf8_length(coded.dictionary).to_numpy().astype(np.int64)
        for i in np.flatnonzero(slow).tolist():
            totals[i] = self.count(batch[i].as_py())
        for i in np.flatnonzero(totals > limit).tolist():
            if slow[i]:
                fits[i] = self.fits(batch[i].as_py(), limit)
                continue
            own = code[ends[i] : ends[i + 1]]
            running = np.cumsum(tokens[ends[i] : ends[i + 1]])
            k = bisect_right(running, limit)
            before = int((points[own[:k]] + 1).sum()) - (k > 0)  # a blank or line end before all but the first
            between = "" if not k else "\n" if first[ends[i] + k] else " "
            fits[i] = before + self.fits(between + words[own[k]], limit - (int(running[k - 1]) if k else 0))
        return totals, fits


@lru_cache(4)
def counter(path: str, pattern: str) -> PrefixCounter:
    return PrefixCounter(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, fit_chars.

    ``fit_chars`` is how many code points of the text fit within ``limit`` tokens.
    Null texts count as empty: 0 bytes, 0 tokens.  Repeated rows and null ids pass
    through; an empty table gives an empty result; other columns are ignored.
    Long texts take memory in proportion to their length, never more rows.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"{quoted(id_col)} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, pattern)
        only("tokens", own.forget)
        for whole in batches:
            for batch in slices(whole, 1, TOGETHER):
                tokens, fits = own.together(batch.column(1), limit)
                sizes = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit), pa.array(fits)], names=[id_col, "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return rows.mapInArrow(counted, schema)
