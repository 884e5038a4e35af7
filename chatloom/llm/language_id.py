"""Language identification with interpolated Kneser-Ney character models.

One character model per language, of order ``ORDER``, over lower-cased words with
their word ends; the highest order counts occurrences, the lower ones distinct
left extensions, each discounted by its own ``D = n1 / (n1 + 2 n2)`` and
interpolated down to a uniform floor.  All languages share one sorted array of
n-gram hashes per order, found by binary search, with a discounted mass and a
back-off weight per language beside each hash.

A text goes to the language of the lowest cross-entropy per character over all
its words.  The posterior is a softmax of the entropies at a temperature fitted
on labelled texts that took no part in counting.  A text is rejected beyond the
middle between the highest entropy of these and the lowest of texts of random
letters of the models' own alphabet: neither side has an error in calibration.

Fitting reads a sample of at most about ``PER_LANGUAGE`` labelled rows a language
(twice: counting and calibration), drawn by a hash of the id, so the model's size
is bounded by that parameter.  Prediction reads every text whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import at as column_at
from chatloom.llm.shared import only, positional, quoted, slices, uniform

ORDER = 4
PER_LANGUAGE = 300
#: Distinct labels above this are refused: the model has a column for each.
LANGUAGES = 512
#: Bytes of the words whose scores are kept, as ``_size`` estimates them.
REMEMBERED = 64 << 20
#: Texts of random letters that show what reads like no language, and how long a word of theirs may be.
RANDOM_TEXTS = 200
RANDOM_LETTERS = 60
RANDOM_WORD = 9
UNKNOWN = "und"

LETTERS = regex.compile(r"\p{L}+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """The lower-cased runs of letters (category L), all of them."""
    return LETTERS.findall(text.lower())


def held_out(id_col: Column) -> Column:
    """True for the rows kept from all fitting: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order 1..ORDER the hash of the n-gram ending at each position; the positions' word and whether they count.

    A word is its letters between ORDER - 1 opening blanks and one closing blank.
    """
    pad = " " * (ORDER - 1)
    line = "".join([pad + w + " " for w in words])
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    word = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    counted = np.arange(len(codes)) - starts[word] >= ORDER - 1
    with np.errstate(over="ignore"):
        own = (codes + np.uint64(1)) * MIX
        own ^= own >> np.uint64(29)
        hashes = [own]
        for n in range(1, ORDER):
            longer = hashes[-1].copy()
            longer[n:] ^= (own[:-n] + np.uint64(n)) * (MIX * np.uint64(2 * n + 1)) + np.uint64(n)
            longer *= MIX
            longer ^= longer >> np.uint64(32)
            hashes.append(longer)
    return hashes, word, counted


def _size(word: str, languages: int) -> int:
    """Bytes that a remembered word takes, about: the string, its place in a dictionary, and its scores."""
    return 180 + 2 * len(word) + 8 * languages


class Models:
    """``keys[n]`` sorted hashes; ``mass[n]``, ``back[n]`` a column per language."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.keys: list[np.ndarray] = []
        self.mass: list[np.ndarray] = []
        self.back: list[np.ndarray] = []
        self.floor = 1.0
        self.alphabet: list[str] = []
        self.temperature = 1.0
        self.worst = np.inf
        self.words: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))
        self.held = 0

    def __getstate__(self):
        return self.__dict__ | {"words": {}, "scores": np.zeros((0, len(self.languages))), "held": 0}

    def forget(self) -> None:
        self.words.clear()
        self.scores, self.held = np.zeros((0, len(self.languages))), 0

    @classmethod
    def fit(cls, counts: dict[str, Counter]) -> Models:
        """``counts``: per language how often each word occurs."""
        own = cls(sorted(counts))
        tables: list[list[tuple]] = [[] for _ in range(ORDER)]
        alphabet: set[str] = {" "}
        for k, language in enumerate(own.languages):
            words = sorted(counts[language])
            alphabet.update(*words)
            often = np.array([counts[language][w] for w in words], np.float64)
            hashes, word, counted = _grams(words)
            at = np.flatnonzero(counted)
            weight = often[word[at]]
            grams = [h[at] for h in hashes]
            # The context of an n-gram is the (n-1)-gram one position before it.
            contexts = [np.zeros(len(at), np.uint64)] + [h[at - 1] for h in hashes[:-1]]
            for n in range(ORDER - 1, -1, -1):
                if n == ORDER - 1:
                    keys, first, inverse = np.unique(grams[n], return_index=True, return_inverse=True)
                    c = np.bincount(inverse, weight)
                else:
                    _, one = np.unique(grams[n + 1], return_index=True)  # each longer n-gram once
                    keys, first, inverse = np.unique(grams[n][one], return_index=True, return_inverse=True)
                    c = np.bincount(inverse).astype(np.float64)
                    first = one[first]
                ones, twos = (c == 1).sum(), (c == 2).sum()
                d = ones / (ones + 2 * twos) if ones and twos else 0.5
                before, of = np.unique(contexts[n][first], return_inverse=True)
                total, kinds = np.bincount(of, c), np.bincount(of)
                tables[n].append((k, keys, np.maximum(c - d, 0) / total[of], before, d * kinds / total))
        own.floor = 1.0 / (len(alphabet) + 1)
        own.alphabet = sorted(alphabet - {" "})
        for n in range(ORDER):
            later = tables[n + 1] if n + 1 < ORDER else []
            keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *[t[1] for t in tables[n]], *[t[3] for t in later]]))
            mass, back = np.zeros((len(keys), len(own.languages))), np.ones((len(keys), len(own.languages)))
            for k, grams, m, _, _ in tables[n]:
                mass[np.searchsorted(keys, grams), k] = m
            for k, _, _, before, b in later:
                back[np.searchsorted(keys, before), k] = b
            own.keys.append(keys)
            own.mass.append(mass)
            own.back.append(back)
        own.root = np.array([t[4][0] if len(t[4]) else 1.0 for t in tables[0]])
        return own

    def _find(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[n]
        if not len(keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        return at, keys[at] == hashes

    def bits(self, words: list[str]) -> np.ndarray:
        """Per word and language, the summed -log2 probability of its letters and its end."""
        out = np.zeros((len(words), len(self.languages)))
        if not words:
            return out
        hashes, word, counted = _grams(words)
        p = np.full((len(word), len(self.languages)), self.floor) * self.root
        back = None
        for n in range(ORDER):
            at, found = self._find(n, hashes[n])
            if n:
                p *= back
            p[found] += self.mass[n][at[found]]
            if n < ORDER - 1:
                back = np.ones_like(p)
                after = np.flatnonzero(found[:-1])
                back[after + 1] = self.back[n][at[after]]
        bits = -np.log2(np.maximum(p[counted], 1e-300))
        np.add.at(out, word[counted], bits) if len(words) == 1 else out.__iadd__(np.add.reduceat(bits, np.flatnonzero(np.diff(word[counted], prepend=-1)), axis=0))
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each text and language; nan without letters."""
        split = [words_of(t) for t in texts]
        known = self.words
        new = list(dict.fromkeys(w for words in split for w in words if w not in known))
        if sum(_size(w, len(self.languages)) for w in new) + self.held > REMEMBERED:
            self.forget()
            new = list(dict.fromkeys(w for words in split for w in words))
        self.held += sum(_size(w, len(self.languages)) for w in new)
        found = [self.bits(new[i : i + 20_000]) for i in range(0, len(new), 20_000)]
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, *found])
        out = np.full((len(texts), len(self.languages)), np.nan)
        for i, words in enumerate(split):
            if words:
                out[i] = self.scores[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0) / (sum(map(len, words)) + len(words))
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
        """(language, posterior, bits per character, rejected) of each text."""
        found = []
        if not self.languages:
            return [(UNKNOWN, 0.0, None, not LETTERS.search(t)) for t in texts]
        for row in self.entropies(texts):
            if np.isnan(row[0]):
                found.append((UNKNOWN, 0.0, None, True))
                continue
            best = int(np.argmin(row))
            odds = np.exp2((row[best] - row) * self.temperature)
            found.append((self.languages[best], float(1 / odds.sum()), float(row[best]), bool(row[best] > self.worst)))
        return found

    def calibrate(self, rows: list[tuple[str, list[float]]]) -> None:
        """Fits the temperature and the rejection threshold to (language, entropies)."""
        if not rows:
            return
        table = np.array([r[1] for r in rows])
        truth = np.array([self.languages.index(r[0]) for r in rows])
        span = table - table.min(axis=1, keepdims=True)

        def loss(t: float) -> float:
            z = -span * t * np.log(2)
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

        self.temperature = min((0.25 * 1.3**k for k in range(24)), key=loss)
        rng = np.random.default_rng(0)
        texts = []
        for _ in range(RANDOM_TEXTS):
            letters = "".join(rng.choice(self.alphabet, RANDOM_LETTERS))
            ends = np.cumsum(rng.integers(1, RANDOM_WORD + 1, RANDOM_LETTERS))
            texts.append(" ".join(letters[a:b] for a, b in zip([0, *ends], ends, strict=False) if letters[a:b]))
        highest, lowest = float(table.min(axis=1).max()), float(np.nanmin(self.entropies(texts), axis=1).min())
        self.worst = max(highest, (highest + lowest) / 2)


def fit_language_models(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Models:
    """Models from the labelled rows that ``held_out`` leaves.

    Rows with a null text, label or id are not used.  Without labelled rows there
    is no language: every text is ``und``, and those without letters are rejected.
    """
    rows = positional(docs).select(F.col(column_at(docs, id_col)).alias("_id"), F.col(column_at(docs, text_col)).alias("_text"), F.col(column_at(docs, lang_col)).cast("string").alias("_lang"))
    rows = rows.filter("_id is not null and _text is not null and _lang is not null").filter(~held_out(F.col("_id")))
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return Models([])
    wanted = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * per_language / n))])
    sample = rows.filter(uniform(F.col("_id"), "language-id") < wanted[F.col("_lang")])
    counting = uniform(F.col("_id"), "language-id-half") < 0.7

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language")
        for batch in batches:
            counts: Counter = Counter()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((lang, w) for w in words_of(text))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])

    counts: dict[str, Counter] = {lang: Counter() for lang in sizes}
    counted = sample.filter(counting).select("_text", "_lang").mapInArrow(words, "lang string, word string, n bigint")
    for r in counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["lang"]][r["word"]] = r["n"]
    models = Models.fit({lang: c for lang, c in counts.items() if c})
    if not models.languages:
        return models
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def entropies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = shared.value.entropies(batch.column(0).to_pylist())
            keep = ~np.isnan(bits[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(keep)), pa.array(bits[keep].tolist(), pa.list_(pa.float64()))], names=["lang", "bits"])

    checked = sample.filter(~counting).filter(F.col("_lang").isin(models.languages)).select("_text", "_lang").mapInArrow(entropies, "lang string, bits array<double>")
    models.calibrate([(r["lang"], r["bits"]) for r in checked.collect()])
    return models


def identify_languages(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score, bits_per_char, rejected.

    Texts that are null or have no letter are ``und`` with score 0 and rejected;
    so is, keeping its best language, a text whose entropy lies beyond what the
    calibration rows showed.  Ties go to the first language by name.  Repeated rows
    and null ids pass through, long texts are read whole in memory in proportion to
    their length, other columns are ignored whatever their names.  An empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows = positional(docs).select(F.col(column_at(docs, id_col)).alias("_id"), F.col(column_at(docs, text_col)).alias("_text"))
    schema = f"{quoted(id_col)} {rows.dtypes[0][1]}, lang_pred string, score double, bits_per_char double, rejected boolean"

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language", shared.value.forget)
        for whole in batches:
            for batch in slices(whole, 1):
                found = shared.value.predict([t or "" for t in batch.column(1).to_pylist()])
                columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "lang_pred", "score", "bits_per_char", "rejected"])

    return rows.mapInArrow(named, schema)


def drop_rejected(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``identify_languages`` rejects; columns as they were.

    Null and empty texts go, repeated rows and null ids stay or go by their texts;
    an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language", shared.value.forget)
        for whole in batches:
            for batch in slices(whole, at):
                found = shared.value.predict([t or "" for t in batch.column(at).to_pylist()])
                yield batch.filter(pa.array([not f[3] for f in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
