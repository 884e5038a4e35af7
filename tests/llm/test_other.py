from __future__ import annotations

import base64
import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing
from pyspark.sql import functions as F

from chatloom.llm import top_k as search
from chatloom.llm import warc
from chatloom.llm.line_dedup import html_lines, host_of, line_dedup
from chatloom.llm.warc import LoserTree, base32_of_hex, read_warc, records, url_key, warc_index, write_warc


def test_lines(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        host = rng.choice(["a.com", "a.com", "b.com", "small.com" if i < 20 else "b.com"])
        lines = [rng.choice(["menu", "  menu ", "about", "", " "]) for _ in range(rng.randint(0, 3))] + [f"own {i} {k}" for k in range(rng.randint(0, 4))]
        rows.append((i, rng.choice([f"http://{host}/{i}", f"https://user@{host.upper()}:80?x"]), "\n".join(lines)))
    rows += [(500, None, "menu\nx"), (501, "http://b.com", None), (502, "nonsense", ""), (None, "http://b.com/", "menu\nlast"), rows[3], rows[3]]
    rng.shuffle(rows)

    def host(url):
        found = re.match(r"(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        return found[1].lower() if found else ""

    split = [(i, host(u), [x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")]) for i, u, t in rows]
    pages = Counter(h for _, h, _ in split)
    held = Counter((h, x) for _, h, xs in split for x in set(xs))
    gone = {k for k, n in held.items() if n > 1 and n > 0.15 * pages[k[0]]}
    expected = [(i, h, len(xs), sum((h, x) in gone for x in xs), "\n".join(x for x in xs if (h, x) not in gone)) for i, h, xs in split]
    docs = clashing(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))
    found = line_dedup(docs, host_of(F.col("url")), F.col("html")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert gone and sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    assert line_dedup(docs.limit(0), host_of(F.col("url")), F.col("html")).count() == 0


def test_lines_of_a_long_page(spark):
    shared, own = [f"line {i}" for i in range(40_000)], [f"own {i}" for i in range(40_000)]
    long = "\n".join(x for pair in zip(shared, own, strict=True) for x in pair)
    rows = [(0, "http://a.com", long), (1, "http://a.com", "\n".join(shared)), (2, "http://a.com", "\n".join(shared[::-1]))]
    rows += [(i, "http://a.com", f"short {i}") for i in range(3, 14)]
    found = {r["page_id"]: r for r in line_dedup(spark.createDataFrame(rows, "page_id long, url string, html string"), host_of(F.col("url")), F.col("html")).collect()}
    assert (found[0]["n_lines"], found[0]["n_dropped"], found[0]["kept_text"]) == (80_000, 40_000, "\n".join(own))
    assert found[1]["kept_text"] == found[2]["kept_text"] == "" and found[2]["n_dropped"] == 40_000 and found[5]["kept_text"] == "short 5"


def test_html_lines(spark):
    html = '<HTML><script>x<p></script><!-- <p> --><nav><li><a href="/">Home</a></li></nav><p class="a">one <b>two</b><br/>three<pre>four</pre><param>five'
    text = spark.createDataFrame([(html,)], "h string").select(html_lines(F.col("h"))).first()[0]
    assert [x.strip() for x in text.split("\n") if x.strip()] == ["Home", "one two", "three", "four", "five"]


def plain_top(rows, k, every, scale):
    ok = [(i, [int(np.floor(x * scale)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted(ok, key=lambda r: (r[0], list(r[1]))):
        if i % every == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)[:k]
        out += [(q, rank, i, int(-s)) for rank, (s, i) in enumerate(scores, 1)]
    return out


@pytest.mark.parametrize("big", [1, 1_000_000])
def test_top_k(spark, monkeypatch, big):
    rng = random.Random(2)
    monkeypatch.setattr(search, "QUERIES", 7)
    monkeypatch.setattr(search, "CANDIDATES", 50)
    monkeypatch.setattr(search, "FIRST_DEPTH", 2)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) * big for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[10][1]) for i in range(400, 460)]  # many ties
    rows += [(1000, None), (1001, [None] * 6), (1010, [float("nan")] * 6), (1020, [float("inf")] * 6), (None, rows[0][1]), (1030, [0.0] * 6), (1031, [0.5, 0.5]), (1040, [0.5, 0.5]), rows[20], rows[21]]
    rng.shuffle(rows)
    docs = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    found = [tuple(r) for r in search.top_k(docs, every=10).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(found) == sorted(plain_top(rows, 5, 10, 256))
    assert search.top_k(docs.limit(0)).count() == 0
    assert search.top_k(docs.filter("vec_id = 50")).count() == 0


def test_threshold_stops_early():
    table = np.zeros((1000, 4))
    table[:, 0] = np.arange(1000)
    met = []

    class Watched(search.Lists):
        pass

    own = Watched(np.arange(1000), table)
    own.table = type("T", (), {"__getitem__": lambda _, at: met.extend(at) or table[at], "dtype": table.dtype})()
    scores, ids = own.best(-1, np.array([1.0, 0, 0, 0]), np.full(5, search.NONE), np.full(5, 2**62))
    assert ids.tolist() == [999, 998, 997, 996, 995] and len(met) < 100


def test_loser_tree():
    rng = random.Random(3)
    for _ in range(200):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 9))]
        assert list(LoserTree([iter(r) for r in runs], key=lambda x: x)) == sorted(x for r in runs for x in r)


def test_base32(spark):
    digests = [hashlib.sha1(str(i).encode()) for i in range(50)]
    found = [r[0] for r in spark.createDataFrame([(d.hexdigest(),) for d in digests], "h string").select(base32_of_hex(F.col("h"))).collect()]
    assert found == [base64.b32encode(d.digest()).decode() for d in digests]


def test_url_key():
    assert url_key("http://User@WWW.Example.com:80/a?b#c") == "com,example,www)/a?b"
    assert url_key("http://example.com") == "com,example)/" and url_key("odd one") == "odd one" and url_key("") == ""


PAGES = [(1, "http://a.b/x", "same"), (2, "http://a.b/x", "same"), (5, None, None), (4, "http://a.b/w?", ""), (3, "a bad\r\nurl", "same"), (None, "http://A.B:80/y#z", "é\r\n\r\nWARC/1.1\r\n"), (7, "http://a.b/long", "long " * 200_000)]
PAGES += [(i, "http://hot.org/", f"version {i % 7}") for i in range(10, 60)]


def test_warc(spark):
    pages = clashing(spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(6))
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    found = warc_index(pages, captured).collect()
    first = defaultdict(list)
    for i, _, html in PAGES:
        first[html or ""].append(i)
    least = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    expected = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        response = i == least[html or ""]
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else least[html or ""]))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([tuple(r)[:5] for r in found], key=key) == sorted(expected, key=key)
    order = [(r["url_key"], r["captured_at"]) for r in found]
    assert order == sorted(order)
    assert warc_index(pages.limit(0), captured).count() == 0


def test_more_ranges_than_partitions(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://{'hot' if i % 3 else i}.org/", f"v{i % 11}") for i in range(600)], "page_id long, url string, html string").repartition(5)
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("page_id"), F.lit(7)))
    whole = warc_index(pages, captured).drop("archive", "offset").collect()
    monkeypatch.setattr(warc, "RANGE", 20)
    index = warc_index(pages, captured)
    assert index.rdd.getNumPartitions() == 30
    found = index.drop("archive", "offset").collect()
    order = [(r["url_key"], r["captured_at"], str(r["page_id"])) for r in found]
    assert order == sorted(order) and sorted(map(str, found)) == sorted(map(str, whole)) and len(found) == 600


def test_merge_of_runs_in_pieces(monkeypatch):
    monkeypatch.setattr(warc, "BUFFER", 3)
    rng = random.Random(8)
    rows = [(f"k{rng.randint(0, 9)}", str(rng.randint(0, 3)), rng.choice([None, "1", "2"]), 1, "D", "response", None, f"a{i % 6}", i) for i in range(500)]
    pieces = [part[at : at + 17] for name in range(6) for part in [sorted((r for r in rows if r[7] == f"a{name}"), key=warc.order)] for at in range(0, len(part), 17)]
    rng.shuffle(pieces)  # as a shuffle may bring them
    columns = list(zip(*(r for piece in pieces for r in piece), strict=True))
    table = pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, warc.KINDS, strict=True)], names=warc.NAMES)
    found = [r for batch in warc.merge_runs(table) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    assert found == sorted(rows, key=warc.order)
    assert list(warc.merge_runs(table.slice(0, 0))) == []


def test_revisits_only_from_a_length_on(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = read_warc(spark, write_warc(pages, F.timestamp_seconds(F.lit(0)), min_revisit=5)).collect()
    assert {r["record_type"] for r in found if r["payload_bytes"] < 5} == {"response"} and "revisit" in {r["record_type"] for r in found}


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 50_000)
    pages = spark.createDataFrame([(i, "http://a.org/", f"{i} " + "é" * 10_000) for i in range(9)] + [(9, None, None)], "page_id long, url string, html string").coalesce(1)
    found = read_warc(spark, write_warc(pages, F.timestamp_seconds(F.lit(0)))).collect()
    held = Counter(r["archive"] for r in found)
    assert len(found) == 10 and max(held.values()) == 2 and {r["payload_bytes"] for r in found} == {0, 20_002}


def test_cut_archive_raises():
    with pytest.raises(ValueError, match="cut short"):
        list(records(io.BufferedReader(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))))
