"""Mixing towards target weights with soft domain membership.

A labelled table names the domain of some documents.  A multinomial logistic
regression over the ``FEATURES`` most telling words, fitted on at most ``LABELLED``
documents a domain, gives every document its posterior over the domains.
A document then counts towards all domains, by posterior times tokens, and gets a
rate >= 0; expected domain totals are ``A_k = sum rate * tokens * p_k``.

The rates solve the nonnegative least squares problem for ``A = target`` by
projected gradient, residuals weighted by 1 / (domain total at rate 1), gradients
by 1 / tokens.  In that metric the largest eigenvalue is 1 (the weighted Gram
matrix is column-stochastic), so the step is 1 and needs no tuning; momentum with
restarts shortens the way.  Each step is one distributed sum; nothing is stored per document between steps, since a rate
is the fold of the residuals so far over the document's posterior.  Posteriors
are kept in steps of 1 / ``GRID``, so documents of equal posterior share a rate
and are added up once, before the first step, by partial aggregation.  Rounding to
steps is dithered by a hash of the text, so its expected error is zero, and the
domain totals add up the posteriors themselves.
"""

from __future__ import annotations

import json
import re
import warnings
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from chatloom.llm.shared import at, cut, only, positional, renamed, slices, uniform

#: Labelled rows used for fitting, at most about this many a domain.
LABELLED = 700
DOMAINS = 32
MIN_DOCUMENTS = 5
FEATURES = 32_768
RIDGE = 0.3
EPOCHS = 150
GRID = 256
STEPS = 120
TOLERANCE = 1e-4
#: Over the total at which a domain just stays whole, so that its documents of nearly certain posterior do too.
HEADROOM = 1.05

WORDS = re.compile(r"[^\W_]+|[^\w\s]+|_+")


class Classifier:
    """Posteriors over ``domains`` from the presence of words."""

    def __init__(self, domains: list[str]):
        self.domains = domains
        self.features: dict[str, int] = {}
        self.weights = np.zeros((0, len(domains)))
        self.bias = np.zeros(len(domains))

    @classmethod
    def fit(cls, rows: list[tuple[str, list[str]]], sizes: Mapping[str, int]) -> Classifier:
        """``rows``: (domain, distinct words); ``sizes``: labelled documents of each domain, of which ``rows`` are a sample.

        Domains are drawn at different rates; the bias takes that back at the end.
        """
        own = cls(sorted({d for d, _ in rows}))
        often = Counter(w for _, words in rows for w in words)
        truth = np.zeros((len(rows), len(own.domains)))
        truth[np.arange(len(rows)), [own.domains.index(d) for d, _ in rows]] = 1
        by_domain = [Counter(w for d, words in rows if d == domain for w in words) for domain in own.domains]
        share = truth.mean(axis=0)

        def telling(word: str) -> float:
            """How far the word's documents are from the domains' shares (chi-squared)."""
            expected = often[word] * share
            return float((([c[word] for c in by_domain] - expected) ** 2 / expected).sum())

        chosen = sorted((w for w, n in often.items() if n >= MIN_DOCUMENTS), key=lambda w: (-telling(w), w))[:FEATURES]
        own.features = {w: i for i, w in enumerate(chosen)}
        present = [[own.features[w] for w in words if w in own.features] for _, words in rows]
        row = np.repeat(np.arange(len(rows)), [len(p) for p in present])
        column = np.array([i for p in present for i in p], np.int64)
        own.weights = np.zeros((len(chosen), len(own.domains)))
        own.bias = np.log(truth.mean(axis=0))
        seen = np.zeros_like(own.weights)
        seen_bias = np.zeros_like(own.bias)
        for _ in range(EPOCHS):  # gradient steps scaled by past gradients
            wrong = own._softmax(np.stack([np.bincount(row, w[column], len(rows)) for w in own.weights.T], axis=1) + own.bias) - truth
            steep = np.stack([np.bincount(column, wrong[:, k][row], len(chosen)) for k in range(len(own.domains))], axis=1) + RIDGE * own.weights
            seen += steep**2
            seen_bias += wrong.sum(axis=0) ** 2
            own.weights -= 0.3 * steep / np.sqrt(seen + 1e-9)
            own.bias -= 0.1 * wrong.sum(axis=0) / np.sqrt(seen_bias + 1e-9)
        own.bias += np.log([sizes[d] for d in own.domains]) - np.log(truth.sum(axis=0))
        return own

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, posteriors in units of 1 / GRID that sum to GRID, posteriors) of each text."""
        tokens, scores = np.zeros(len(texts), np.int64), np.tile(self.bias, (len(texts), 1))
        features = self.features
        for i, text in enumerate(texts):
            words = WORDS.findall(text.lower())
            tokens[i] = len(words)
            known = [features[w] for w in set(words) if w in features]
            if known:
                known.sort()
                scores[i] += self.weights[known].sum(axis=0)
        p = self._softmax(scores) if len(texts) else scores
        dither = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), GRID) >> 11 for t in texts], np.float64) / (1 << 53)
        ends = np.floor(np.cumsum(p, axis=1) * GRID + dither[:, None])
        ends[:, -1] = GRID
        units = np.diff(ends, axis=1, prepend=0).astype(np.int32)
        return tokens, units, p


def fit_classifier(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", labelled: int = LABELLED) -> Classifier | None:
    """From at most about ``labelled`` rows a domain, drawn by a hash of the id; rows with a null id, text or domain are not used.

    None if no document is labelled.  A document labelled twice takes the lesser name.
    """
    named = labels.select(labels[label_id].alias("_of"), domain.cast("string").alias("_domain")).filter("_of is not null and _domain is not null")
    named = named.groupBy("_of").agg(F.min("_domain").alias("_domain"))
    sizes = {r["_domain"]: r["count"] for r in named.groupBy("_domain").count().limit(DOMAINS + 1).collect()}
    if len(sizes) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains")
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, min(1.0, labelled / n))])
    named = cut(named.filter(uniform(F.col("_of"), "mixing") < share[F.col("_domain")]), "mixing-labels")
    rows = positional(docs).select(F.col(at(docs, id_col)).alias("_id"), F.col(at(docs, text_col)).alias("_text")).filter("_text is not null")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(set(WORDS.findall(t.lower()))) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], names=["domain", "words"])

    # The drawn labels number DOMAINS * labelled at most, so sending them to all tasks is bounded.
    drawn = rows.join(F.broadcast(named), rows["_id"] == named["_of"]).select("_domain", "_text").mapInArrow(words, "domain string, words array<string>")
    found = [(r["domain"], r["words"]) for r in drawn.collect()]
    return Classifier.fit(found, sizes) if found else None


def with_posteriors(docs: DataFrame, classifier: Classifier, text_col: str = "text", names: tuple[str, str, str] = ("_tokens", "_units", "_p")) -> DataFrame:
    """``docs`` with three more columns: tokens, posteriors in units of 1 / GRID, and posteriors."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    place = docs.columns.index(text_col)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("mixing")
        for whole in batches:
            for batch in slices(whole, place):
                tokens, units, p = shared.value.posteriors([t or "" for t in batch.column(place).to_pylist()])
                listed = pa.FixedSizeListArray.from_arrays(pa.array(units.ravel(), pa.int32()), units.shape[1]).cast(pa.list_(pa.int32()))
                exact = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel(), pa.float64()), p.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens), listed, exact], names=[*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields, StructField(names[0], LongType()), StructField(names[1], ArrayType(IntegerType())), StructField(names[2], ArrayType(DoubleType()))])
    return docs.mapInArrow(judged, schema)


def _rate(units: Column, history: list[list[float]], ahead: bool = False) -> Column:
    """The rate that the residuals so far leave to a posterior: one projected step after the other from 1.

    Steps start from the last rate moved on by momentum; ``ahead`` gives that point.
    A row of ``history`` is the residuals over GRID, then the momentum after the step.
    """
    if not history:
        return F.lit(1.0)
    steps = F.from_json(F.lit(json.dumps(history)), "array<array<double>>")
    k = len(history[0]) - 1
    move = lambda h: sum((units[i] * h[i] for i in range(1, k)), units[0] * h[0])

    def step(at: Column, h: Column) -> Column:
        rate = F.greatest(F.lit(0.0), at["ahead"] - move(h))
        return F.struct(rate.alias("rate"), (rate + h[k] * (rate - at["rate"])).alias("ahead"))

    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    return F.aggregate(steps, start, step, lambda x: x["ahead" if ahead else "rate"])


def fit_rates(judged: DataFrame, domains: list[str], targets: Mapping[str, float], whole: str | None = None) -> list[list[float]]:
    """The residuals of all steps, which ``_rate`` folds into rates.

    ``targets`` are weights per domain, scaled to 1 over the domains that have
    tokens; a domain not named has weight 0.  The wanted total is the one at which
    the domain ``whole`` stays whole, times HEADROOM; without such a domain, the
    one scarcest for its weight.  Totals are of the posteriors ``_p``; of the units where
    ``judged`` has none.
    """
    exact = "_p" in judged.columns
    held = [F.sum(F.col("_tokens") * (F.col("_p")[k] if exact else F.col("_units")[k] / GRID)) for k in range(len(domains))]
    cells = cut(judged.groupBy("_units").agg(F.array(*held).alias("_held")), "mixing-cells")

    def totals(history: list[list[float]], ahead: bool = False) -> np.ndarray:
        rate = _rate(F.col("_units"), history, ahead)
        row = cells.agg(*[F.sum(rate * F.col("_held")[k]) for k in range(len(domains))]).first()
        return np.array([x or 0.0 for x in row])

    start = totals([])
    weight = np.array([max(0.0, float(targets.get(d, 0.0))) for d in domains]) * (start > 0)
    if not weight.sum():
        return []
    weight /= weight.sum()
    reach = {d: s / w for d, s, w in zip(domains, start, weight, strict=True) if w}
    budget = HEADROOM * reach.get(whole, min(reach.values()))
    goal = weight * budget
    history: list[list[float]] = []
    at, speed, before = start, 1.0, np.inf
    for _ in range(STEPS):
        off = np.abs(at - goal).max()
        if off <= TOLERANCE * budget:
            break
        speed = 1.0 if off > before else (1 + np.sqrt(1 + 4 * speed**2)) / 2  # begins anew where it overshoots
        before = off
        residual = np.where(start > 0, (at - goal) / np.where(start > 0, start, 1), 0.0)
        history.append([*(float(x) / GRID for x in residual), float((speed - 1) / (speed + 2))])
        at = totals(history, ahead=True)
    else:
        warnings.warn(f"the rates miss a target by {np.abs(at - goal).max() / budget:.2%} of all tokens", stacklevel=2)
    return history


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: Mapping[str, float], whole: str | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, n_tokens, domain (likeliest), posteriors (map by domain), rate.

    Null texts count as empty: no tokens, and the posterior of no words.  Ties go
    to the first domain by name.  Repeated rows and null ids pass through.  Without
    labelled documents every rate is 1 and the domain null.  An empty table gives
    an empty result; other columns are ignored.
    """
    classifier = fit_classifier(docs, labels, domain, id_col, text_col, label_id)
    rows = positional(docs).select(F.col(at(docs, id_col)).alias("_id"), F.col(at(docs, text_col)).alias("_text"))
    if classifier is None:
        words = F.size(F.filter(F.split(F.coalesce("_text", F.lit("")), r"\s+"), lambda w: w != "")).cast("long")
        return rows.select(F.col("_id").alias(id_col), words.alias("n_tokens"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("map<string,double>").alias("posteriors"), F.lit(1.0).alias("rate"))
    judged = cut(with_posteriors(rows, classifier, "_text").drop("_text"), "mixing-posteriors")
    history = fit_rates(judged, classifier.domains, targets, whole)
    names = F.array(*[F.lit(d) for d in classifier.domains])
    return judged.select(
        F.col("_id").alias(id_col),
        F.col("_tokens").alias("n_tokens"),
        names[F.array_position("_p", F.array_max("_p")).cast("int") - 1].alias("domain"),
        F.map_from_arrays(names, F.col("_p")).alias("posteriors"),
        _rate(F.col("_units"), history).alias("rate"),
    )


def sample_mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: Mapping[str, float], whole: str | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """``docs`` thinned to the mixture: a document stays if a hash of its id, in [0, 1), is below its rate.

    Rates of 1 and more keep a document, once.  Rows without an id stay if their
    domain's rate is 1 or more; rows that repeat an id and a text stay or go together.
    Null texts count as empty; without labelled documents all rows stay; an empty
    table gives an empty result.  All columns are returned as they were.
    """
    classifier = fit_classifier(docs, labels, domain, id_col, text_col, label_id)
    if classifier is None:
        return docs
    judged = cut(with_posteriors(positional(docs), classifier, at(docs, text_col)), "mixing-posteriors")  # read twice
    history = fit_rates(judged.select("_tokens", "_units", "_p"), classifier.domains, targets, whole)
    key = F.col(at(docs, id_col))
    drawn = F.when(key.isNull(), F.lit(1.0 - 1e-12)).otherwise(uniform(key, "mixing-draw"))
    kept = judged.filter(drawn < _rate(F.col("_units"), history))
    return renamed(kept, docs)
