"""The pipeline's near stage against brute force on the Jaccard of five-word shingles."""

from __future__ import annotations

import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, clashing
from test_dedup import joined

import corpus_pipeline
from chatloom.llm import near_dedup


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    return Fraction(len(a & b), len(a | b)) >= Fraction(4, 5)


def corpus(rng, n=40):
    """Texts with copies changed in a few places, at similarities around 0.8, and many of one template."""
    texts = []
    for _ in range(n):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 300))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            for _ in range(rng.randint(1, 1 + len(copy) // 30)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 5000)}"
            texts.append(" ".join(copy))
    template = [f"t{i}" for i in range(100)]
    texts += [" ".join([*template[: rng.randint(70, 100)], *(f"y{rng.randint(0, 999)}" for _ in range(rng.randint(0, 30)))]) for _ in range(60)]
    return texts


@pytest.mark.parametrize("cell", [256, 3])
def test_near_stage_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    rng = random.Random(11)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(dict.fromkeys(corpus(rng)))] + [(9000, None, "en", "s", 0), (9001, " ", "en", "s", 1)]
    sets = {r[0]: shingles(r[1]) for r in rows}
    near = joined([(i, i) for i in sets] + [(a, b) for a, b in combinations(sorted(sets), 2) if similar(sets[a], sets[b])])
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    kept = corpus_pipeline.near(spark, docs, "")
    assert kept.columns == docs.columns
    assert 50 < len(set(near.values())) < len(rows) - 50
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(near.values()))


def test_signature_recall_at_the_bound():
    rng = np.random.default_rng(5)
    for _ in range(1000):
        same, a, b = np.split(rng.integers(0, 1 << 63, 200, np.uint64), [160, 180])  # 160 of 200: just 0.8
        (x, p, s), (y, q, t) = near_dedup.signature(np.concatenate([same, a])), near_dedup.signature(np.concatenate([same, b]))
        assert (p == q).sum() >= near_dedup.SHARED
        differ = np.bitwise_count(np.array(s, np.int64).view(np.uint64) ^ np.array(t, np.int64).view(np.uint64)).sum()
        assert (x == y).any() and differ <= near_dedup.FAR


def test_signature_is_simhash():
    """Every bit of the bytes is the majority over all shingles, and every key is two neighbouring ones."""
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 601, np.uint64)
    for n in (1, 4, 5, 300, 601):
        keys, positions, summary = near_dedup.signature(hashes[:n])
        rows = [int.from_bytes(near_dedup.widened(h[None]).tobytes()) for h in hashes[:n]]
        bits = [2 * sum(r >> i & 1 for r in rows) > n for i in range(8 * near_dedup.POSITIONS)]
        whole = sum(bit << i for i, bit in enumerate(bits)).to_bytes(near_dedup.POSITIONS)
        assert positions.tobytes() == whole and np.array(summary, "<i8").tobytes() == whole[:16]
        found = [((k >> 56) % 256, k >> 48 & 255, k >> 40 & 255) for k in keys.tolist()]
        assert found == [(i, b, whole[(i + 1) % len(whole)]) for i, b in enumerate(whole)]


def postings(rng, n):
    """Sorted rows (key and checked bits, further checked bits) of five keys, each some bits away from one of nine."""
    signed = lambda x: x - (x >> 63 << 64)
    centres = [(rng.getrandbits(40), rng.getrandbits(64)) for _ in range(9)]
    flips = lambda bits: sum(1 << i for i in rng.sample(range(bits), rng.randint(0, 4)))
    found = []
    for _ in range(n):
        key, (one, two) = rng.choice([3, 3, 3, 5, 200 << 16, 201 << 16 | 7]), rng.choice(centres)
        found.append((signed(key << 40 | one ^ flips(40)), signed(two ^ flips(64))))
    return sorted(found)


@pytest.mark.parametrize("most", [1000, 30])
def test_groups_of_a_posting(monkeypatch, most):
    monkeypatch.setattr(near_dedup, "HELD", 50)
    monkeypatch.setattr(near_dedup, "CHECK", 8)
    rows = postings(random.Random(4), 400)
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 7], strict=True)], names=["key", "_check"]) for i in range(0, 400, 7)]
    found = {}
    for b in near_dedup._together(iter(batches), most):
        for key, band, check in zip(*b.to_pydict().values(), strict=True):
            assert band == key >> 56 & 255
            found.setdefault(key >> 40, {}).setdefault(key, set()).add(check)
    for key in {k >> 40 for k, _ in rows}:
        own = sorted({r for r in rows if r[0] >> 40 == key})
        if sum(r[0] >> 40 == key for r in rows) > most:
            assert found.pop(key) == {key << 40: {c for _, c in own}}
            continue
        far = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b, strict=True))
        near = joined([(a, a) for a in own] + [(a, b) for a, b in combinations(own, 2) if far(a, b) <= 8])
        groups = {}
        for row, group in near.items():
            groups.setdefault(group, []).append(row)
        several = [g for g in groups.values() if sum(rows.count(r) for r in g) > 1]
        assert sorted(sorted(g) for g in found.pop(key, {}).values()) == sorted(sorted({c for _, c in g}) for g in several)
    assert not found


def test_near_decides_by_row(spark):
    words = [f"w{i}" for i in range(60)]
    one, other, third = " ".join(words), " ".join(reversed(words)), " ".join(f"z{i}" for i in range(60))
    rows = [(1, one), (1, other), (1, one), (2, one + " more"), (None, third), (None, third + " more"), (None, other + " more")]
    kept = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    ids = [r["doc_id"] for r in kept]
    assert {r["text"] for r in kept if r["doc_id"] == 1} == {one, other} and ids.count(1) == 2 and 2 not in ids
    assert ids.count(None) == 1 and {r["text"] for r in kept if r["doc_id"] is None} <= {third, third + " more"}


def test_unlike_fingerprints_form_no_groups():
    """Random fingerprints share two bytes by the hundred thousand; the checked bits tell them apart."""
    own = np.random.default_rng(7).integers(0, 256, (8000, near_dedup.POSITIONS), np.uint8)
    summaries = own[:, :16].copy().view("<i8")
    rows = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in own]), pa.array(summaries[:, 0]), pa.array(summaries[:, 1])], names=["_bytes", "_s0", "_s1"])
    posted = pa.Table.from_batches(near_dedup._posted(iter([rows]))).sort_by("key").combine_chunks()
    assert posted.num_rows == 8000 * near_dedup.POSITIONS
    keys = posted["key"].to_numpy() >> near_dedup.KEY
    assert (np.diff(keys) == 0).sum() > 50_000
    assert sum(b.num_rows for b in near_dedup._together(iter(posted.to_batches()), near_dedup.CROWDED)) <= 4


def test_cells_compare_each_pair_once(monkeypatch):
    monkeypatch.setattr(near_dedup, "HELD", 50)
    rng = random.Random(2)
    rows = [(key, key % 192, node, rng.choice([1, 1, 1, node]) if key else 1) for key in range(-3, 4) for node in rng.sample(range(10, 200), rng.choice([2, 9, 60]))]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 7], strict=True)], names=["key", "_band", "_node", "_root"]) for i in range(0, len(rows), 7)]
    found, band = {}, {r[0] % 192: r[0] for r in rows}
    table = pa.Table.from_batches(near_dedup._cells(iter(batches), 4)).sort_by("cell").combine_chunks()
    for cell in near_dedup._runs(iter(table.to_batches(max_chunksize=5))):
        kind, minor, block, root, node, at = (cell.column(c).to_numpy() for c in ("_kind", "_minor", "_block", "_root", "_node", "_band"))
        assert len(cell) <= 40 and len({*at}) == 1
        for u in np.flatnonzero(minor).tolist():
            for v in near_dedup._to_compare(kind, minor, block, root, u).tolist():
                found.setdefault(band[int(at[0])], []).append(tuple(sorted((int(node[u]), int(node[v])))))
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        expected = [tuple(sorted((a[2], b[2]))) for a, b in combinations(own, 2) if a[3] != b[3]]
        assert sorted(found.get(key, [])) == sorted(expected)


def test_a_large_group_is_joined_by_node(spark, monkeypatch):
    """Near copies of one text, most of them below 0.8 of each other, meet in many postings; rows of them are joined once a node."""
    rng = random.Random(6)
    template = [f"w{i}" for i in range(150)]
    copies = [[f"x{rng.randint(0, 10**6)}" if rng.random() < 0.03 else w for w in template] for _ in range(150)]
    rows = [(i, " ".join(words)) for i, words in enumerate(copies)]
    tables, cut = {}, near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df, tag: tables.setdefault(tag, []).append(kept := cut(df, tag)) or kept)
    kept = near_dedup.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    near = joined([(i, i) for i, _ in rows] + [(a, b) for (a, x), (b, y) in combinations(rows, 2) if similar(shingles(x), shingles(y))])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(near.values()))
    sizes = {tag: sum(t.count() for t in found) for tag, found in tables.items()}
    assert sizes["near-together"] > 10 * len(rows)
    assert {tag: n for tag, n in sizes.items() if n > 2 * len(rows)}.keys() <= {"near-together", "near-maybe", "near-rest"}
