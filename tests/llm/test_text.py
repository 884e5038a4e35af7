from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import SCHEMA, WORDS, clashing, documents, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chatloom.llm import mixing
from chatloom.llm import token_counts as token_counts_module
from chatloom.llm.language_id import Models, drop_rejected, fit_language_models, held_out, identify_languages
from chatloom.llm.pieces import Segmenter, decode_pieces, encode_pieces
from chatloom.llm.token_counts import PrefixCounter, token_counts

BPE, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "日", "▁", "'s", "'re", "'", "22", "<|endoftext|>", "<0x0A>", "　", "\x85", "\x1c", "😀", "_", "...", "The", " the", "½", "\r\n", "x" * 30, "\x00", "٣"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    return documents(random.Random(4))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False))


def test_counts_equal_the_library(library):
    own, texts = PrefixCounter(BPE, PATTERN), odd_texts(1500)
    assert [own.count(t) for t in texts] == [count(library, t) for t in texts]


@pytest.mark.parametrize("word", ["interesting", "ééé日本", "thanedble", "aaaaaaaaaa"])
def test_every_prefix(library, word):
    table = PrefixCounter(BPE, PATTERN).table(word.encode())
    for k in range(len(word) + 1):
        assert table[len(word[:k].encode())] == count(library, word[:k])


@pytest.mark.parametrize("limit", [0, 7, 1024])
def test_texts_together(library, limit):
    own = PrefixCounter(BPE, PATTERN)
    texts = [*odd_texts(800, 3), "", " ", "a\nb c", "x.\nFoo bar, baz!", "it's\nno's", "a\n\nb", " a", "a "]
    counts, fits = own.together(pa.array(texts), limit)
    assert counts.tolist() == [count(library, t) for t in texts]
    for t, n, k in zip(texts, counts.tolist(), fits.tolist(), strict=True):
        assert k == (own.fits(t, limit) if n > limit else len(t)) and count(library, t[:k]) <= limit


def test_prefixes_of_a_text(library):
    own, text = PrefixCounter(BPE, PATTERN), "The interesting cat's\nmarché, 22"
    table = own.prefixes(text)
    assert len(table) == len(text.encode()) + 1
    for k in range(len(text) + 1):
        if text[:k][-1:] != " ":  # a blank at the end belongs to the next pre-token
            assert table[len(text[:k].encode())] == count(library, text[:k])


def test_few_bytes_remembered(library, monkeypatch):
    monkeypatch.setattr(token_counts_module, "REMEMBERED", 3000)
    own, texts = PrefixCounter(BPE, PATTERN), odd_texts(300, 5)
    for at in range(0, 300, 50):
        assert own.together(pa.array(texts[at : at + 50]), 5)[0].tolist() == [count(library, t) for t in texts[at : at + 50]]
        assert len(own.kept) + len(own.older) < 40


def test_token_query(spark, docs, rows, library):
    found = token_counts(docs, BPE, PATTERN, limit=20).collect()
    expected = [(r[0], len((r[1] or "").encode()), count(library, r[1] or "")) for r in rows]
    key = lambda r: (r[0] is None, *[x or 0 for x in r])
    assert sorted([tuple(r)[:3] for r in found], key=key) == sorted(expected, key=key)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found:
        assert r["over_limit"] == (r["n_tokens"] > 20)
        if r["doc_id"] is not None:
            assert count(library, texts[r["doc_id"]][: r["fit_chars"]]) <= 20
    assert token_counts(docs.limit(0), BPE, PATTERN).count() == 0


def paths(own, word):
    """All segmentations, best first."""

    def to(end):
        if end == 0:
            return [(0.0, (), ())]
        return [(s + score, (start - end, *lengths), (*before, *ids)) for start, score, ids in own.edges(word, end) for s, lengths, before in to(start)]

    return [(s, ids) for s, _, ids in sorted(to(len(word)), key=lambda p: (-p[0], p[1]))]


@pytest.fixture(scope="module")
def segmenter():
    return Segmenter(PIECES)


@pytest.mark.parametrize("word", ["▁the", "▁▁▁a", "▁aaaa", "日本", "▁marché", "▁walking", "ing", "▁", "éé"])
def test_nbest_of_a_word(segmenter, word):
    everything = paths(segmenter, word)
    assert segmenter.nbest(word, 6) == everything[:6]
    segmenter.clear()
    segmenter.learn({word})
    assert segmenter.ids[0] == everything[0][1] and segmenter.firsts[0] == everything[0][0]
    assert segmenter.seconds[0] == (everything[0][0] - everything[1][0] if len(everything) > 1 else math.inf)


@pytest.mark.parametrize("text", ["the cat sat", "a a a a", "hello hello, hello", "xx ▁ xx", ""])
def test_nbest_of_a_text(segmenter, text):
    options = [segmenter.options(w, 4) for w in segmenter.words(text)]
    choices = itertools.product(*[range(len(o)) for o in options])
    ranked = sorted((-sum(o[c][0] for o, c in zip(options, cs, strict=True)), cs[::-1]) for cs in choices)[:3]
    expected = [(-s, [i for o, c in zip(options, cs[::-1], strict=True) for i in o[c][1]]) for s, cs in ranked]
    assert segmenter.encode(text, 3) == expected


def test_long_words_and_round_trips(segmenter):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in [*odd_texts(400, 2), "x" * 3000, "abcdefghij" * 200]:
        for _, ids in segmenter.encode(text, 3):
            assert segmenter.decode(ids) == text
            if "▁" not in text:
                assert library.decode(ids) == text


def test_library_ids(segmenter, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    segmenter.clear()  # of what other tests left
    monkeypatch.setattr(segmenter, "remembered", 20_000)
    texts = [t for t in [*odd_texts(600, 9), "The cat sat,\nand sat.", "a  b", "\n", " x", "x ", "\x00"] if "▁" not in t]
    before = 0
    for at in range(0, len(texts), 100):
        words, back = segmenter.together(pa.array(texts[at : at + 100]))
        ends, own = np.cumsum(words.sizes), len(set(words.flat.tolist()))
        assert back.all() and len(segmenter.known) <= 20_000 / 230 + before + own
        before = own
        for t, a, b in zip(texts[at : at + 100], [0, *ends], ends, strict=False):
            assert segmenter.library.take(words.flat[a:b]).flat.tolist() == library.encode(t)
    segmenter.clear()


def test_pieces_query(spark, docs, rows):
    found = encode_pieces(docs, PIECES)
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) and r["n_library"] == len(r["library_ids"]) for r in found.collect())
    back = sorted((r["text"] for r in decode_pieces(found, PIECES).collect()))
    assert back == sorted(r[1] or "" for r in rows)
    r = found.filter("doc_id = 1003").first()
    assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<i4").tobytes()).hexdigest()
    assert r["margin"] == r["nbest_scores"][0] - r["nbest_scores"][1] >= 0 and r["score"] == r["nbest_scores"][0]
    assert encode_pieces(docs.limit(0), PIECES).count() == 0


class PlainKneserNey:
    """Interpolated Kneser-Ney of order 4 in dictionaries of strings, straight from the formulas."""

    def __init__(self, counts, alphabet_size):
        self.floor = 1.0 / (alphabet_size + 1)
        self.counts = [defaultdict(Counter) for _ in range(4)]  # by order: context -> letter -> count
        for word, n in counts.items():
            line = "   " + word + " "
            for i in range(3, len(line)):
                self.counts[3][line[i - 3 : i]][line[i]] += n
        for order in (2, 1, 0):  # a lower order counts the different letters to the left
            for context, letters in self.counts[order + 1].items():
                for letter in letters:
                    self.counts[order][context[1:]][letter] += 1
        self.discounts = []
        for order in range(4):
            all_counts = [n for letters in self.counts[order].values() for n in letters.values()]
            ones, twos = all_counts.count(1), all_counts.count(2)
            self.discounts.append(ones / (ones + 2 * twos) if ones and twos else 0.5)

    def p(self, context, letter, order=3):
        if order < 0:
            return self.floor
        letters, d = self.counts[order].get(context), self.discounts[order]
        lower = self.p(context[1:], letter, order - 1)
        if letters is None:
            return lower
        total = sum(letters.values())
        return max(letters[letter] - d, 0) / total + d * len(letters) / total * lower

    def bits(self, word):
        line = "   " + word + " "
        return sum(-math.log2(self.p(line[i - 3 : i], line[i])) for i in range(3, len(line)))


COUNTS = {"en": Counter({"the": 5, "then": 2, "than": 1, "cat": 2, "ten": 1}), "de": Counter({"der": 4, "den": 3, "dort": 1, "ä": 1})}


def test_kneser_ney_against_dictionaries():
    own, letters = Models.fit(COUNTS), {c for words in COUNTS.values() for w in words for c in w} | {" "}
    plain = [PlainKneserNey(COUNTS[lang], len(letters)) for lang in own.languages]
    words = ["the", "then", "cat", "xyz", "t", "thederän", "ä", "nehtnehtneht"]
    assert np.abs(own.bits(words) - [[m.bits(w) for m in plain] for w in words]).max() < 1e-9
    for text in ["the cat", "der then xyz"]:
        split = text.split()
        n = sum(map(len, split)) + len(split)
        assert np.abs(own.entropies([text])[0] - [sum(map(m.bits, split)) / n for m in plain]).max() < 1e-9


def test_kneser_ney_sums_to_one():
    letters = sorted({c for words in COUNTS.values() for w in words for c in w} | {" "})
    for words in COUNTS.values():
        model = PlainKneserNey(words, len(letters))
        for context in ["   ", "  t", "the", "en ", "qqq", "ord"]:
            # The floor gives each letter, and one unknown letter, the same share.
            assert abs(sum(model.p(context, c) for c in letters) + model.p(context, "?") - 1) < 1e-9


def test_language_ties_repeats_and_letters(spark):
    docs = spark.createDataFrame([(i, t, lang) for i in range(60) for t, lang in (("the cat sat", "en"), ("the cat sat", "de"))], "doc_id long, text string, lang string")
    models = fit_language_models(docs)
    asked = [(1, "the cat"), (1, "the cat"), (None, "the cat"), (2, "½ ² ① 12"), (3, None), (4, ""), (5, "cat " * 40_000), (6, "x9y")]
    found = identify_languages(clashing(spark.createDataFrame(asked, "doc_id long, text string")), models).collect()
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in found)
    # Equal models: the first language by name; no letters: und.  Letters beside digits count.
    assert got == [("1", "de"), ("1", "de"), ("2", "und"), ("3", "und"), ("4", "und"), ("5", "de"), ("6", "de"), ("None", "de")]


def test_rejection_is_calibrated_on_both_sides(spark):
    rng = random.Random(6)
    langs = sorted(WORDS)
    rows = [(i, sentence(rng, langs[i % 3], 40), langs[i % 3]) for i in range(900)]
    models = fit_language_models(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    prose = [r[1] for r in rows]
    noise = [" ".join("".join(rng.choice(models.alphabet) for _ in range(rng.randint(2, 9))) for _ in range(12)) for _ in range(300)]
    assert not any(rejected for *_, rejected in models.predict(prose))
    assert all(rejected for *_, rejected in models.predict(noise))


def test_language_accuracy(spark):
    rng = random.Random(5)
    langs = sorted(WORDS)
    rows = [(i, sentence(rng, langs[i % 3], 40), None if i % 11 == 0 else langs[i % 3]) for i in range(300)]
    rows += [(900, None, "en"), (901, "", "en"), (902, "123 ...", "de"), (None, sentence(rng, "fr", 30), "fr"), (903, "zxq vkjw " * 30, None)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    models = fit_language_models(docs)
    found = {r["doc_id"]: r for r in identify_languages(docs, models).collect()}
    out = [(i, t) for i, t, _ in rows if i is not None and i < 900]
    assert sum(found[i]["lang_pred"] == langs[i % 3] for i, _ in out) >= 0.98 * len(out)
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert {found[i]["lang_pred"] for i in (900, 901, 902)} == {"und"} and found[900]["score"] == 0
    assert found[903]["rejected"] and not any(found[i]["rejected"] for i, _ in out)
    kept = drop_rejected(docs, models)
    assert kept.columns == docs.columns and kept.count() == 301


def test_held_out_rows_teach_nothing(spark):
    import zlib

    ids = list(range(200))
    docs = spark.createDataFrame([(i, "qqqq wwww" if zlib.crc32(str(i).encode()) % 4 == 2 else "the house", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in ids], "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in docs.filter(held_out(F.col("doc_id"))).collect()} == {i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2}
    assert fit_language_models(docs).languages == ["en"]


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "hello there", None), (2, "", None)], "doc_id long, text string, lang string")
    models = fit_language_models(docs)
    assert [(r["lang_pred"], r["rejected"]) for r in identify_languages(docs, models).orderBy("doc_id").collect()] == [("und", False), ("und", True)]
    assert identify_languages(docs.limit(0), models).count() == 0


def mixed(spark, n=400):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        toxic, low = rng.random() < 0.2, rng.random() < 0.3
        words = sentence(rng, "en", rng.randint(10, 60)) + " idiot" * toxic * rng.randint(1, 3)
        docs.append((i, words.replace(" ", "### ") if low else words))
        if rng.random() < 0.7:
            labels.append((i, int(not low), int(toxic)))
    docs += [(900, None), (901, ""), (None, "the house"), docs[0]]
    labels += [(900, 1, 0), (None, 1, 1), (0, None, 0), (5000, 1, 1)]
    return clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def domain():
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


def test_mixing_reaches_the_targets(spark):
    docs, labels = mixed(spark)
    targets = {"q1t0": 0.7, "q0t0": 0.2, "q1t1": 0.07, "q0t1": 0.03}
    found = mixing.mix(docs, labels, domain(), targets).collect()
    assert len(found) == 404 and all(r["rate"] >= 0 for r in found)
    totals = {k: sum(r["rate"] * r["n_tokens"] * r["posteriors"][k] for r in found) for k in targets}
    for k, w in targets.items():
        assert abs(totals[k] / sum(totals.values()) - w) < 0.002
    truth = {r["doc_id"]: f"q{r['quality']}t{r['toxic']}" for r in labels.filter("quality is not null").collect()}
    judged = [r for r in found if r["doc_id"] in truth and r["n_tokens"]]
    assert sum(r["domain"] == truth[r["doc_id"]] for r in judged) >= 0.9 * len(judged)
    assert all(abs(sum(r["posteriors"].values()) - 1) < 1e-12 for r in found)


def test_rates_equal_plain_projected_gradient(spark):
    rng = np.random.default_rng(7)
    units = np.array([rng.multinomial(mixing.GRID, rng.dirichlet([0.5, 0.3, 0.2])) for _ in range(200)])
    tokens = rng.integers(1, 100, 200)
    judged = spark.createDataFrame([(int(t), [int(x) for x in u]) for t, u in zip(tokens, units, strict=True)], "_tokens long, _units array<int>")
    domains, targets = ["a", "b", "c"], {"a": 0.2, "b": 0.3, "c": 0.5}
    history = mixing.fit_rates(judged, domains, targets, "a")
    rates = np.array([r["rate"] for r in judged.select(mixing._rate(F.col("_units"), history).alias("rate")).collect()])
    p = units / mixing.GRID
    start = (tokens[:, None] * p).sum(0)
    goal = np.array([0.2, 0.3, 0.5]) * mixing.HEADROOM * start[0] / 0.2
    plain = np.ones(200)
    for _ in range(20_000):
        plain = np.maximum(0, plain - p @ (((plain * tokens) @ p - goal) / start))
    loss = lambda r: ((((r * tokens) @ p - goal) ** 2) / start).sum()
    assert (rates >= 0).all() and loss(rates) <= loss(plain) + 1e-3 * goal.sum()


def test_mixing_sample(spark):
    docs, labels = mixed(spark)
    kept = mixing.sample_mix(docs, labels, domain(), {"q1t0": 0.9, "q0t0": 0.05, "q1t1": 0.05}, "q1t0")
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    rates = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, labels, domain(), {"q1t0": 0.9, "q0t0": 0.05, "q1t1": 0.05}, "q1t0").collect()}
    assert all(i in ids for i, r in rates.items() if r >= 1) and len(ids) < len(rates)


def test_mixing_without_labels(spark):
    docs, labels = mixed(spark, 20)
    found = mixing.mix(docs, labels.limit(0), domain(), {"q1t0": 1.0})
    assert {r["rate"] for r in found.collect()} == {1.0}
    assert mixing.sample_mix(docs, labels.limit(0), domain(), {"q1t0": 1.0}).count() == docs.count()
    assert mixing.mix(docs.limit(0), labels, domain(), {"q1t0": 1.0}).count() == 0
