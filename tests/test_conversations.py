from __future__ import annotations

import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chatloom.config import Build, Config, Roles, System
from chatloom.operators import conversations as V
from chatloom.operators import sequence as S
from chatloom.plans import commands
from chatloom.sources import export

BASE = Config(workers=1, roles=Roles("a", "u"), build=Build(max_chars=0))
SCHEMA = "id long, date long, from_id string, `from` string, text string, ord long"


def rules(**changes):
    return replace(BASE, build=replace(BASE.build, **changes))


def chat(spark, rows):
    """Rows of (sender, date, text)."""
    return spark.createDataFrame([(i, d, s, s, t, i) for i, (s, d, t) in enumerate(rows)], SCHEMA)


def made(spark, rows, config):
    found = V.ordered(V.build(chat(spark, rows), config)).orderBy("conv_ord").collect()
    return [[(t["role"], t["content"]) for t in r["turns"]] for r in found]


def test_bursts_and_roles(spark):
    assert made(spark, [("u", 0, "a"), ("u", 1, "b"), ("a", 2, "c")], BASE) == [[("user", "a\nb"), ("assistant", "c")]]


def test_session_gap(spark):
    rows = [("u", 0, "x"), ("a", 10, "y"), ("u", 10_000, "x"), ("a", 10_010, "y")]
    assert len(made(spark, rows, rules(session_gap_minutes=1))) == 2


@pytest.mark.parametrize(("gap", "expected"), [(60, [0, 0, 1, 1]), (59, [0, 1, 2, 2]), (0, [0, 1, 2, 2]), (-1, [0, 1, 2, 3])])
def test_gap_is_strict(spark, gap, expected):
    rows = chat(spark, [("u", 0, ""), ("u", 60, ""), ("u", 121, ""), ("u", 121, "")])
    assert [r["session"] for r in S.sessions(rows, gap).orderBy("ord").collect()] == expected


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_sessions_over_days(spark, partitions):
    random.seed(3)
    dates = sorted(random.choice([random.randint(-400_000, 900_000), 86_400 * random.randint(-3, 9)]) for _ in range(300))
    expected, session = [], 0
    for i, d in enumerate(dates):
        session += i > 0 and d - dates[i - 1] > 4000
        expected.append(session)
    rows = chat(spark, [("u", d, "") for d in dates]).repartition(partitions)
    assert [r["session"] for r in S.sessions(rows, 4000).orderBy("ord").collect()] == expected


def test_sessions_by_chat(spark):
    rows = chat(spark, [("u", 0, ""), ("a", 500, ""), ("u", 600, ""), ("a", 600, "")])
    found = S.sessions(rows, 450, ["from_id"]).orderBy("ord").collect()
    assert [r["session"] for r in found] == [0, 0, 1, 0]


def test_ties_keep_input_order(spark):
    rows = spark.createDataFrame([(1, 5, "u", "u", t, i) for i, t in enumerate("abc")] + [(1, 6, "a", "a", "z", 3)], SCHEMA)
    found = V.build(rows.repartition(3), BASE).collect()
    assert found[0]["turns"][0]["content"] == "a\nb\nc"


def test_max_turns(spark):
    rows = [("ua"[i % 2], i, "t") for i in range(8)]
    assert len(made(spark, rows, rules(max_turns=2))) == 4


def greedy(sizes, max_turns, max_size):
    out, window, count, size = [], 0, 0, 0
    for n in sizes:
        if count and (max_turns > 0 and count >= max_turns or max_size > 0 and size + n > max_size):
            window, count, size = window + 1, 0, 0
        out.append(window)
        count, size = count + 1, size + n
    return out


@pytest.mark.parametrize("limits", [(0, 0), (3, 0), (0, 10), (3, 10), (-1, 1)])
def test_windows(spark, limits):
    random.seed(1)
    sessions = [[random.randint(0, 14) for _ in range(random.randint(1, 40))] for _ in range(9)]
    turns = spark.createDataFrame([(s, i, "user", "x" * n) for s, sizes in enumerate(sessions) for i, n in enumerate(sizes)], "session long, turn_idx long, role string, content string")
    found = S.windows(turns.repartition(5), F.char_length("content"), *limits).orderBy("session", "turn_idx").collect()
    assert [r["win"] for r in found] == [w for sizes in sessions for w in greedy(sizes, *limits)]


def test_trimming_and_filters(spark):
    rows = [("a", 0, "x"), ("u", 1, "q"), ("a", 2, "ok"), ("u", 3, "z")]
    assert made(spark, rows, BASE) == [[("user", "q"), ("assistant", "ok")]]
    assert made(spark, rows, rules(start_with_user=False, require_assistant=False)) == [[("assistant", "x"), ("user", "q"), ("assistant", "ok"), ("user", "z")]]
    assert made(spark, rows, rules(min_assistant_runes=3)) == []
    assert made(spark, rows, rules(min_turns=3)) == []
    assert made(spark, [("u", 0, "x"), ("u", 1, "y")], BASE) == []
    assert made(spark, [("a", 0, "x")], rules(min_turns=0, require_assistant=False)) == [[]]


def test_unknown_sender_in_build(spark):
    found = V.build(chat(spark, [("u", 0, "q"), ("x", 1, "?"), ("a", 2, "r")]), BASE)
    assert [t["role"] for t in found.first()["turns"]] == ["user", "", "assistant"]
    line = json.loads(found.select(V.encode(F.col("turns"), F.lit(""), "sharegpt")).first()[0])
    assert [t["from"] for t in line["conversations"]] == ["human", "human", "gpt"]


def conversations(spark, texts):
    return spark.createDataFrame([(i, [("user", t), ("assistant", "ok")]) for i, t in enumerate(texts)], "conv_ord long, turns array<struct<role:string,content:string>>")


def test_dedup_keeps_first(spark):
    assert [r["conv_ord"] for r in V.dedup(conversations(spark, "aba").repartition(3)).orderBy("conv_ord").collect()] == [0, 1]


def test_encode(spark):
    rows = spark.createDataFrame([([("user", '<"é&>'), ("assistant", "b")], "s"), ([], "")], "turns array<struct<role:string,content:string>>, system string")
    lines = [r[0] for r in rows.select(V.encode(F.col("turns"), F.col("system"), "openai")).collect()]
    assert lines[0] == '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"<\\"é&>"},{"role":"assistant","content":"b"}]}'
    assert lines[1] == '{"messages":null}'


def test_system_modes(spark):
    rows = conversations(spark, map(str, range(20)))
    pool = rules(system=System(mode="pool", pool=("p", "q", "r")), seed=7)
    picked = [[r["system"] for r in V.with_system(rows.repartition(n), pool).orderBy("conv_ord").collect()] for n in (1, 4, 17)]
    assert picked[0] == picked[1] == picked[2] and set(picked[0]) <= {"p", "q", "r"} and len(set(picked[0])) > 1
    assert {r["system"] for r in V.with_system(rows, rules(system=System(mode="fixed", fixed="f"))).collect()} == {"f"}
    assert {r["system"] for r in V.with_system(rows, BASE).collect()} == {""}


def test_split(spark):
    rows = conversations(spark, map(str, range(100)))
    parts = [{r["conv_ord"]: (r["part"], r["rank"]) for r in V.split(rows.repartition(n), 0.29, seed).collect()} for n, seed in ((1, 42), (17, 42), (4, 43))]
    assert parts[0] == parts[1] != parts[2]
    assert sum(p == "val" for p, _ in parts[0].values()) == 28
    assert sorted(r for _, r in parts[0].values()) == list(range(100))
    assert {r["part"] for r in V.split(rows, 0, 42).collect()} == {"train"}


def test_batches_and_sample(spark):
    rows = conversations(spark, map(str, range(5)))
    assert [r["batch"] for r in V.batch_contexts(rows, 2, 20).orderBy("batch").collect()] == [0, 1, 2]
    assert V.sample(rows, 2).count() == 2 and V.sample(rows, 0).count() == 5


def test_paths():
    assert export.split_paths("out.jsonl") == ("out.train.jsonl", "out.val.jsonl")
    assert export.split_paths("out") == ("out.train", "out.val")
    assert export.split_paths("dir.v1/out") == ("dir.train.v1/out", "dir.val.v1/out")


def test_end_to_end(spark, tmp_path):
    raw = [{"id": i, "type": "message", "from_id": "ua"[i % 2], "date_unixtime": str(i // 2 * 8000 + i % 2), "text": f"t{i}"} for i in range(40)]
    (tmp_path / "e.json").write_text(json.dumps({"messages": raw}))
    out = str(tmp_path / "set.jsonl")
    sizes = commands.everything(export.read_export(spark, str(tmp_path / "e.json")), rules(val_ratio=0.25, session_gap_minutes=60), out)
    written = {part: spark.read.text(path).count() for part, path in zip(("train", "val"), export.split_paths(out), strict=True)}
    assert sizes == written and sizes["val"] == int(sum(sizes.values()) * 0.25) > 0


def test_turns_of_long_sessions(spark):
    rng = random.Random(4)
    rows = []
    for chat in ("x", "y", None):
        at = 0
        for i in range(200):
            at += rng.choice([0, 60, 1800, 3000, 9000])
            rows.append((chat, at, i, i, rng.choice("uua"), f"{i}"))
    table = spark.createDataFrame(rows, "chat string, date long, id long, ord long, role string, text string").repartition(5)
    expected, state = {}, {}
    for chat, at, _, i, role, _ in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2], r[3])):
        last, session, turn, said = state.get(chat, (at, 0, 0, role))
        session, turn = (session + 1, 0) if at - last > 4000 else (session, turn + (said != role))
        state[chat] = at, session, turn, role
        expected.setdefault((chat, session, turn), (role, []))[1].append(str(i))
    found = S.bursts(S.sessions(table, 4000, ["chat"]), F.col("role"), " ", ["chat"]).collect()
    assert {(r["chat"], r["session"], r["turn_idx"]): (r["role"], r["content"].split(" ")) for r in found} == expected
    assert len(found) == len(expected) > 100
