from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
import xxhash
from helpers import SCHEMA, clashing, documents

from chatloom.llm import simhash, suffix_dedup
from chatloom.llm.components import components
from chatloom.llm.exact_dedup import drop_exact, exact_dedup
from chatloom.llm.simhash import drop_near, fingerprint, simhash_components, triples


@pytest.fixture(scope="module")
def rows():
    return documents(random.Random(1))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return clashing(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r)
    found = exact_dedup(docs, digest=True).collect()
    assert len(found) == len(rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"] is None, r["keep_id"] or 0, r["group_size"], r["text_sha256"]) for r in found) == sorted(
        (r[0] is None, r[0] or 0, best is None, best or 0, len(groups[normal(r[1])]), hashlib.sha256(normal(r[1]).encode()).hexdigest())
        for r in rows
        for best in [min(groups[normal(r[1])], key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))[0]]
    )
    assert sum(r["kept"] for r in found) == len(groups)
    lazy = exact_dedup(docs).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in lazy} == {(r["doc_id"], r["keep_id"], r["group_size"]) for r in found}
    kept = drop_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(normal(r["text"]) for r in kept.collect()) == sorted(groups)


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(links):
    """Node -> least node of its component."""
    at = {}

    def root(x):
        while at.setdefault(x, x) != x:
            x = at[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return {x: root(x) for x in at}


def test_fingerprint_of_long_text(monkeypatch):
    text = " ".join(f"Wört{i % 97}" for i in range(500))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert fingerprint(text) == plain_fingerprint(text)


def test_triples_lie_in_every_four():
    assert len(triples()) == 20
    assert all(any(set(t) <= set(four) for t in triples()) for four in combinations(range(8), 4))


@pytest.mark.parametrize("crowded", [4096, 1])
def test_simhash(docs, rows, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    prints = [plain_fingerprint(r[1]) for r in rows]
    near = joined([(p, p) for p in prints] + [(p, q) for p, q in combinations(set(prints), 2) if (p ^ q).bit_count() <= 4])
    least = {c: min((r[0] for r, p in zip(rows, prints, strict=True) if near[p] == c and r[0] is not None), default=None) for c in set(near.values())}
    found = simhash_components(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1)
    assert sorted(map(tuple, found), key=key) == sorted(((r[0], f"{p:016x}", least[near[p]]) for r, p in zip(rows, prints, strict=True)), key=key)
    if crowded > 1:
        kept = drop_near(docs)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(x for x in least.values() if x is not None)


def test_links_of_a_tight_cluster(spark, monkeypatch):
    rng = random.Random(2)
    centre = rng.getrandbits(63)
    points = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(63), rng.randint(1, 6))) for _ in range(150)} | {rng.getrandbits(63) for _ in range(50)}
    expected = joined([(p, p) for p in points] + [(p, q) for p, q in combinations(points, 2) if (p ^ q).bit_count() <= 4])
    for crowded in (4096, 20):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        found = [tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in points], "_fp long")).collect()]
        assert len(found) < 821 * 20 * len(points) and joined([(p, p) for p in points] + found) == expected


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = joined(links)
    assert found == {x: c for x, c in expected.items() if x in found} and all(c == x for x, c in expected.items() if x not in found)


def removed(rows, window):
    """(id, bytes, removed, spans, digest) by a dictionary of all windows."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - window + 1):
            if data[i : i + window] in seen:
                gone[i : i + window] = [True] * window
            seen.add(data[i : i + window])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("window", "gram", "digit", "pack", "alphabet"), [(20, 8, 5, 300, "ab"), (20, 7, 6, 200, "abcdefgh"), (13, 5, 4, 1 << 20, "aé"), (20, 8, 5, 100, "a"), (100, 32, 25, 1 << 21, "abc")])
def test_suffix(spark, monkeypatch, window, gram, digit, pack, alphabet):
    rng = random.Random(window * 7 + gram)
    monkeypatch.setattr(suffix_dedup, "SORTED", 500)
    parts = ["".join(rng.choices(alphabet, k=3 * window)) for _ in range(6)]
    rows = [(3 * d, "".join(rng.choice(parts)[rng.randint(0, window) : rng.randint(window, 3 * window)] + rng.choice(["", "x", "yz"]) for _ in range(rng.randint(0, 4)))) for d in range(50)]
    rows += [(1000, "".join(rng.choices(alphabet, k=900))), (1001, None), (1002, ""), (None, rows[5][1])]
    rng.shuffle(rows)
    found = suffix_dedup.suffix_dedup(clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), window, gram, digit, pack, with_kept=True).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:5]) for r in found) == sorted((r[0] is None, r[0] or 0, *r[1:]) for r in removed(rows, window))
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


@pytest.mark.parametrize(("crowded", "share"), [(0, 1 << 30), (3, 50), (3, 1), (1 << 30, 1)])
def test_suffix_of_hot_anchors(spark, crowded, share):
    """A line shorter than the window in every document, one longer, and texts beyond a pack; with and without windows dealt by their digits."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 9)))
    short, long, passage = "menu of the site " * 2, "a line that is longer than the window, everywhere", " ".join(word() for _ in range(30))
    rows = []
    for d in range(120):
        lines = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(3)] + [short, rng.choice([short, long]), rng.choice([passage, word()])]
        rng.shuffle(lines)
        rows.append((rng.randint(-50, 50) if d % 5 else 1000 + d, "\n".join(lines)))
    rows = list(dict(rows).items()) + [((1 << 63) - 1, short + long), (None, long + passage), (-60, "é" * 3000 + passage + "".join(rng.choices("ab", k=4000))), (2000, None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_dedup.suffix_dedup(frame, 40, 16, 10, 700, with_kept=True, crowded=crowded, share=share).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:5]) for r in found) == sorted((r[0] is None, r[0] or 0, *r[1:]) for r in removed(rows, 40))


def test_suffix_of_a_long_text(spark):
    """Several blocks of anchors in a text longer than a pack, of which the second half repeats the first."""
    half = "".join(random.Random(6).choices("abcdefghij", k=1_500_000))
    rows = [(1, half + "|" + half), (2, half[700_000:900_000])]
    found = {r["doc_id"]: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert (found[1]["n_bytes"], found[1]["n_removed"], found[1]["n_spans"]) == (3_000_001, 1_500_000, 1)
    assert [tuple(s) for s in found[1]["spans"]] == [(1_500_001, 3_000_001)] and [tuple(s) for s in found[2]["spans"]] == [(0, 200_000)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(empty).count() == simhash_components(empty).count() == suffix_dedup.suffix_dedup(empty).count() == drop_exact(empty).count() == drop_near(empty).count() == 0
