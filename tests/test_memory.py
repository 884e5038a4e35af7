from __future__ import annotations

import json
import threading
import tracemalloc
from dataclasses import replace
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chatloom import config as settings
from chatloom.clients import Client, ServiceError
from chatloom.config import Config, Roles, Service, System
from chatloom.functions import facts as facts_
from chatloom.functions.facts import parse_list
from chatloom.functions.text import month, truncate
from chatloom.functions.tokens import encoding
from chatloom.operators import conversations as V
from chatloom.operators import memory as M
from chatloom.operators.sequence import token_windows
from chatloom.plans import commands
from chatloom.sources.export import memory_line, read_clean

FENCE = "`" * 3


@pytest.mark.parametrize(
    ("answer", "expected"),
    [
        ('["Lives in a town", "Works with wood"]', ["Lives in a town", "Works with wood"]),
        (f"{FENCE}json\n[«Lives in a town», “Works with wood”]\n{FENCE}", ["Lives in a town", "Works with wood"]),
        ('["", "[", "Likes green tea", "ab"]', ["Likes green tea"]),
        ('["Likes green tea", "likes GREEN tea"]', ["Likes green tea"]),
        ('["Likes green tea", 1]', ["Likes green tea"]),
        ("- Likes green tea\n2. Lives in a town\n12345678", ["Likes green tea", "Lives in a town"]),
        ("", []),
        (None, []),
    ],
)
def test_parse_list(answer, expected):
    assert parse_list(answer) == expected


def test_parse_lists_holds_few_strings():
    """Of a batch of over 25 MB, the strings of about 1 MB at a time; one text beyond that stands alone."""
    facts = [f"Fact number {i} of them" for i in range(20_000)]
    answers = [json.dumps(facts[i * 7 : i * 7 + 400]) for i in range(2500)] + [None, "", "\n".join(facts * 8), None, "- Likes green tea"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(answers))), pa.array(answers)], names=["id", "answer"])
    assert batch.nbytes > 25 << 20
    at, peaks = 0, []
    tracemalloc.start()
    try:
        for part in facts_._parsed(iter([batch])):
            peaks.append(tracemalloc.get_traced_memory()[1])
            ids, found = part.columns
            assert ids.to_pylist() == list(range(at, at + part.num_rows))
            assert found.to_pylist() == [parse_list(x) for x in answers[at : at + part.num_rows]]
            at += part.num_rows
            tracemalloc.reset_peak()
    finally:
        tracemalloc.stop()
    assert at == len(answers) and sorted(peaks)[len(peaks) // 2] < 8 << 20 and max(peaks) < batch.nbytes


@pytest.mark.parametrize("size", ["1", "10000"])
def test_parse_lists(spark, size):
    answers = ['["Likes green tea", "Lives in a town"]', None, "", "«Works with wood»", "- Has a large dog\n2. Lives in a town", "ab"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        rows = spark.createDataFrame([(x, i, "s") for i, x in enumerate(answers)], "answer string, id long, facts_of string")
        found = facts_.parse_lists(rows, "answer", "facts")
        assert found.columns == ["id", "facts_of", "facts"]
        assert sorted(map(tuple, found.collect())) == [(i, "s", parse_list(x)) for i, x in enumerate(answers)]
        assert facts_.parse_lists(rows.filter("id < 0"), "answer", "facts").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def messages(spark, n, sender="a"):
    return spark.createDataFrame([(i, 100 - i // 3, sender, sender, "x" * (i % 5), i) for i in range(n)], "id long, date long, from_id string, `from` string, text string, ord long")


@pytest.mark.parametrize("limit", [0, 1, 7])
def test_token_windows(spark, limit):
    rows = messages(spark, 40)
    ordered = sorted(range(40), key=lambda i: (100 - i // 3, i))
    expected, window, count, size = {}, 0, 0, 0
    for i in ordered:
        if count and size + i % 5 > limit:
            window, count, size = window + 1, 0, 0
        expected[i], count, size = window, count + 1, size + i % 5
    assert {r["ord"]: r["win"] for r in token_windows(rows.repartition(7), F.char_length("text"), limit).collect()} == expected


def test_facts_keep_first(spark):
    rows = spark.createDataFrame([(0, 10, ["Likes tea", " "]), (1, 20, ["likes TEA ", "Has a cat"])], "key long, date long, facts array<string>")
    assert [(r["text"], r["date"]) for r in M.facts(rows).orderBy("ord").collect()] == [("Likes tea", 10), ("Has a cat", 20)]


def test_memory_run(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def ask():
        return lambda _, content: json.dumps([f"Fact number {line}" for line in content.split("\n") if line])

    def merge():
        return lambda _, content: json.dumps(sorted({line.split("] ")[1] for line in content.split("\n") if line})[:2])

    config = Config(workers=1, roles=Roles("a", "u"))
    config = replace(config, memory=replace(config.memory, window_tokens=12, consolidate=replace(config.memory.consolidate, batch_size=3)))
    found = commands.memory(spark, messages(spark, 30), config, str(tmp_path / "m"), F.char_length("text"), ask, merge, lambda: lambda t: [float(len(t))])
    rows = found.orderBy("ord").collect()
    assert rows and all(r["embedding"] == [len(r["text"])] for r in rows)
    assert len({r["text"] for r in rows}) == len(rows) <= 4


def test_extraction_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    from chatloom.plans import answers

    monkeypatch.setattr(answers, "WAVE", 2)
    calls = tmp_path / "calls"

    def ask(broken):
        def call(_, content):
            if broken and calls.exists() and len(calls.read_text().splitlines()) >= 5:
                raise RuntimeError("service is down")
            with calls.open("a") as f:
                f.write(repr(content) + "\n")
            return json.dumps([f"Fact number {line}" for line in content.split("\n") if line])

        return lambda: call

    rows = spark.createDataFrame([(i, i, "a", "a", f"{i:04}", i) for i in range(24)], "id long, date long, from_id string, `from` string, text string, ord long")
    config = Config(workers=1, roles=Roles("a", "u"))
    config = replace(config, memory=replace(config.memory, workers=1, window_tokens=8, do_consolidate=False, do_embeddings=False))
    run = lambda broken: commands.memory(spark, rows, config, str(tmp_path / "m"), F.char_length("text"), ask(broken))
    with pytest.raises(Exception, match="service is down"):
        run(True)
    asked = calls.read_text().splitlines()
    assert len(asked) == 5
    found = [r["text"] for r in run(False).orderBy("ord").collect()]
    assert found == [f"Fact number {i:04}" for i in range(24)]
    again = calls.read_text().splitlines()[5:]
    assert len(again) == 8 and len({*asked, *again}) == 12  # two waves of two are kept, the fifth call's was lost
    assert [r["text"] for r in run(True).orderBy("ord").collect()] == found and len(calls.read_text().splitlines()) == 13
    assert not (tmp_path / "m" / "memory_facts.json.lacking").exists()


def test_consolidation_order(spark):
    texts = ["", "a", "ab", "aé", "a\U0001f600", "a\uffff", "b", "abcd", "abca", "ab", "é", "\U0001f600", "zz"]
    rows = [(t, (i * 7919) % 5 * 86_400 + i % 2, i) for i, t in enumerate(texts)] + [(None, None, 99)]
    table = spark.createDataFrame(rows, "text string, date long, ord long").repartition(3)
    for even, key in ((True, lambda r: (r[0] is not None, (r[0] or "").encode(), r[2])), (False, lambda r: (r[1] is not None, r[1] or 0, r[2]))):
        found = M.consolidation_batches(table, 4, even).orderBy("position").select("text", "date", "ord", "position", "batch").collect()
        assert [tuple(r) for r in found] == [(*r, i, i // 4) for i, r in enumerate(sorted(rows, key=key))]


def test_records_and_display(spark):
    rows = spark.createDataFrame([("a", [1.5]), ("b", []), ("c", None)], "t string, e array<double>")
    assert [r[0] for r in rows.select(memory_line(F.col("t"), F.col("e"))).collect()] == ['{"text":"a","embedding":[1.5]}', '{"text":"b"}', '{"text":"c"}']
    shown = spark.createDataFrame([("é" * 241, 0), ("é" * 240, 86_400 * 40)], "t string, d long").select(truncate(F.col("t")), month(F.col("d"))).collect()
    assert [tuple(r) for r in shown] == [("é" * 240 + "…", "?"), ("é" * 240, "1970-02")]


def test_clean_lines(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"id":1,"date":2,"from_id":"a","text":"x"}\n\n{"id":3}\n')
    assert [tuple(r) for r in read_clean(spark, str(tmp_path / "c.jsonl")).orderBy("id").collect()] == [(1, 2, "a", "", "x", 1), (3, 0, "", "", "", 3)]
    (tmp_path / "d.jsonl").write_text('{"id":1}\n{"id":\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_clean(spark, str(tmp_path / "d.jsonl")).collect()


def test_unknown_encoding():
    with pytest.raises(ValueError):
        encoding("no-such-encoding")


class Mock(BaseHTTPRequestHandler):
    calls: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Mock.calls.append((self.path, body))
        answers = {
            "/chat/completions": {"choices": [{"message": {"content": f"prompt {len(Mock.calls)}"}}]},
            "/api/chat": {"message": {"content": "local"}},
            "/embeddings": {"data": [{"embedding": [1.0, 2.0]}]},
            "/api/embeddings": {"embedding": []},
        }
        self.send_response(400 if body.get("model") == "bad" else 200)
        self.end_headers()
        self.wfile.write(json.dumps(answers[self.path]).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    Mock.calls = []
    own = HTTPServer(("127.0.0.1", 0), Mock)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}/"
    own.shutdown()


def test_clients(server):
    assert Client(Service(api_base=server, model="m")).generate("i", "c") == "prompt 1"
    assert Client(Service(api_base=server, api_style="ollama", model="m")).generate("i", "c") == "local"
    assert Client(Service(api_base=server, model="m")).embed("t") == [1.0, 2.0]
    with pytest.raises(ServiceError):
        Client(Service(api_base=server, api_style="ollama", model="m")).embed("t")
    with pytest.raises(ServiceError):
        Client(Service(api_base=server, model="bad")).generate("i", "c")
    with pytest.raises(ServiceError):
        Client(Service(api_base="https://example.com", model="m"))


def test_generated_prompts_are_kept(spark, tmp_path, server):
    rows = spark.createDataFrame([(i, [("user", "q"), ("assistant", f"t{i}")]) for i in range(5)], "conv_ord long, turns array<struct<role:string,content:string>>")
    service = Service(api_base=server, model="m", batch_size=2, context_samples=20)
    config = Config(workers=1, roles=Roles("a", "u"), build=replace(settings.Build(), system=System(mode="generated", generated=service)))
    prompts = commands.asked_prompts(str(tmp_path / "cache"), service)
    contexts = V.batch_contexts(rows, 2, 20)
    first = sorted(map(tuple, V.with_system(rows, config, prompts(contexts)).select("conv_ord", "system").collect()))
    assert len(Mock.calls) == 3 and len({s for _, s in first}) == 3
    assert sorted(map(tuple, V.with_system(rows, config, prompts(contexts)).select("conv_ord", "system").collect())) == first
    assert len(Mock.calls) == 3


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"roles": {"assistant_id": "a", "user_id": "u"}, "build": {"max_turns": 8, "system": {"pool": ["p"]}}, "workers": 0, "other": 1}')
    loaded = settings.load(str(path))
    assert (loaded.build.max_turns, loaded.build.max_chars, loaded.build.system.pool) == (8, 6000, ("p",)) and loaded.workers >= 1
    loaded.validate()
    changed = settings.override(loaded, system="be kind", val_ratio=0.5, strip_links=False, gap=None)
    assert (changed.build.system.mode, changed.build.system.fixed, changed.build.val_ratio, changed.clean.strip_links, changed.build.session_gap_minutes) == ("fixed", "be kind", 0.5, False, 180)
    for bad in ({"val_ratio": 1.0}, {"format": "x"}, {"system_mode": "x"}, {"assistant_id": ""}, {"system_mode": "generated"}):
        with pytest.raises(ValueError):
            settings.override(loaded, **bad).validate() if bad != {"system_mode": "generated"} else settings.overlay(loaded, {"build": {"system": {"mode": "generated", "generated": {"batch_size": 0}}}}).validate()


def test_memory_dry_run_and_workers(tmp_path, monkeypatch, capsys, spark):
    from chatloom import cli
    from chatloom.plans import commands

    source = tmp_path / "clean.jsonl"
    source.write_text("".join(f'{{"id": {i}, "date": {i}, "from_id": "{who}", "from": "x", "text": "hello"}}\n' for i, who in enumerate(["a", "u", "a"])))
    config = tmp_path / "config.json"
    config.write_text('{"roles": {"assistant_id": "a", "user_id": "u"}}')
    asked = {}

    def memory(spark, messages, config, folder, allow_remote=False):
        asked.update(workers=config.memory.workers, allow_remote=allow_remote)
        return spark.createDataFrame([], "text string, embedding array<double>, ord long")

    monkeypatch.setattr(commands, "memory", memory)
    given = ["memory", "--in", str(source), "--config", str(config), "--workers", "7", "--allow-remote"]
    assert cli.main([*given, "--dry-run"]) == 0 and not asked
    assert "messages of the assistant's person: 2" in capsys.readouterr().out
    assert sorted(p.name for p in tmp_path.iterdir()) == ["clean.jsonl", "config.json"]
    assert cli.main([*given, "--out", str(tmp_path / "facts.jsonl")]) == 0 and asked == {"workers": 7, "allow_remote": True}
