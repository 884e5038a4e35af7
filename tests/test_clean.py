from __future__ import annotations

import json
from dataclasses import replace

import pytest

from chatloom.config import Clean, Config, Roles
from chatloom.operators.clean import histogram, messages, with_reason
from chatloom.operators.inspect import media, participants
from chatloom.sources import export

BASE = Config(workers=1, roles=Roles("a", "u"))


def entity(kind, text):
    return {"type": kind, "text": text}


def read(spark, tmp_path, rows):
    path = tmp_path / "export.json"
    path.write_text(json.dumps({"name": "chat", "messages": [{"type": "message", "from_id": "u", "date_unixtime": "5"} | r for r in rows]}))
    return export.read_export(spark, str(path))


CASES = [
    ({"type": "service"}, {}, "service", None),
    ({"from_id": "x", "text": "hello"}, {}, "unknown_sender", None),
    ({"media_type": "sticker", "sticker_emoji": "🙂"}, {}, "kept", "🙂"),
    ({"media_type": "sticker", "sticker_emoji": "🙂"}, {"stickers_to_emoji": False}, "media", None),
    ({"media_type": "sticker"}, {}, "media", None),
    ({"media_type": "video_file"}, {}, "media", None),
    ({"text_entities": [entity("plain", "call "), entity("phone", "+100")]}, {"redact_pii": True}, "kept", "call"),
    ({"text_entities": [entity("plain", "see "), entity("link", "http://x"), entity("plain", " now")]}, {}, "kept", "see now"),
    ({"text_entities": [entity("plain", "see "), entity("link", "http://x"), entity("plain", " now")]}, {"strip_links": False}, "kept", "see http://x now"),
    ({"text_entities": [entity("text_link", "anchor")]}, {}, "kept", "anchor"),
    ({"text": [{"type": "bold", "text": "deep"}, ""]}, {}, "kept", "deep"),
    ({"text": '["a"]'}, {}, "kept", '["a"]'),
    ({"text": ["a", None, 5, ["b"], {"type": "bold"}, {"text": 7}, {"text": "c"}]}, {}, "kept", "ac"),
    ({"text": {"type": "bold", "text": "x"}}, {}, "empty", None),
    ({"text": "shown", "text_entities": [entity("link", "http://x")]}, {}, "empty", None),
    ({"text": "hi", "forwarded_from": ""}, {}, "forwarded", None),
    ({"text": "hi", "forwarded_from": None}, {}, "kept", "hi"),
    ({"text": "hi", "forwarded_from": "n"}, {"drop_forwarded": False}, "kept", "hi"),
    ({"text": "hi", "via_bot": "b"}, {}, "via_bot", None),
    ({"text": "hi", "via_bot": "b", "forwarded_from": "x", "from_id": "x"}, {}, "unknown_sender", None),
    ({"text": "hi"}, {"min_runes": 3}, "short", None),
    ({"text": "🙂🙂🙂"}, {"min_runes": 3}, "kept", "🙂🙂🙂"),
    ({"text": " a 　b\u0085c \n"}, {}, "kept", "a b c"),
    ({}, {}, "empty", None),
]


@pytest.mark.parametrize("given", {tuple(sorted(c[1].items())) for c in CASES}, ids=str)
def test_reasons(spark, tmp_path, given):
    cases = [c for c in CASES if tuple(sorted(c[1].items())) == given]
    config = replace(BASE, clean=replace(Clean(), **dict(given)))
    reasoned = with_reason(read(spark, tmp_path, [c[0] | {"id": i} for i, c in enumerate(cases)]), config)
    assert [r["reason"] for r in reasoned.orderBy("ord").collect()] == [c[2] for c in cases]
    assert [r["text"] for r in messages(reasoned).orderBy("ord").collect()] == [c[3] for c in cases if c[2] == "kept"]
    assert sum(r["n"] for r in histogram(reasoned).collect()) == len(cases)


def test_epoch(spark, tmp_path):
    dates = ["12", " 12 ", "1.5", "", "99999999999999999999", "-99999999999999999999", "+7"]
    rows = read(spark, tmp_path, [{"id": i, "text": "hi", "date_unixtime": d} for i, d in enumerate(dates)])
    found = [r["date"] for r in messages(with_reason(rows, BASE)).orderBy("ord").collect()]
    assert found == [12, 0, 0, 0, 2**63 - 1, -(2**63), 7]


def test_equal_roles_are_assistant(spark, tmp_path):
    rows = read(spark, tmp_path, [{"id": 1, "text": "hi", "from_id": "a"}])
    assert with_reason(rows, replace(BASE, roles=Roles("a", "a"))).first()["reason"] == "kept"


def test_malformed_export_raises(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"messages": [{"id": "x"}]}')
    with pytest.raises(Exception, match="(?i)malformed|cannot|parse"):
        export.read_export(spark, str(path)).collect()


def test_nested_export_is_empty(spark, tmp_path):
    path = tmp_path / "full.json"
    path.write_text('{"chats": {"messages": [{"id": 1}]}}')
    assert export.read_export(spark, str(path)).count() == 0


def test_inspect(spark, tmp_path):
    rows = read(spark, tmp_path, [{"from": None}, {"from": "U"}, {"from_id": "b", "from": "B", "media_type": "photo"}, {"from_id": ""}])
    assert [tuple(r) for r in participants(rows).collect()] == [("u", "", 2), ("b", "B", 1)]
    assert [tuple(r) for r in media(rows).collect()] == [("photo", 1)]


def test_stream_equals_batch(spark, tmp_path):
    from chatloom.streaming.clean import clean_stream, read_stream

    (tmp_path / "in").mkdir()
    for k in range(3):
        lines = [{"id": 10 * k + i, "type": "message", "from_id": "u", "text": [f"t{i}"], "date_unixtime": str(i)} for i in range(4)]
        (tmp_path / "in" / f"{k}.jsonl").write_text("\n".join(map(json.dumps, lines)))
    clean_stream(read_stream(spark, str(tmp_path / "in"), 1), BASE, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = messages(with_reason(export.read_raw_lines(spark, str(tmp_path / "in")), BASE))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert batch.count() == 12
