"""Queries over the operators, each with SQL that gives the same rows.

Tables stand in for a chat: ``conversations`` as messages of two roles, ``events``
as messages of several, ``documents`` as texts.  Every query runs over its whole
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.config import Build, Clean, Config, Roles, System
from chatloom.functions import facts as facts_
from chatloom.functions import text as T
from chatloom.operators import clean as C
from chatloom.operators import conversations as V
from chatloom.operators import inspect as I
from chatloom.operators import memory as M
from chatloom.operators import sequence as S
from chatloom.sources.export import memory_line

ROLES = Roles("assistant", "user")
POOL = ("Answer as this person would.", "Keep to their tone.", "Write in their voice.")
SEED, RATIO = 42, 0.29
MAX_TURNS, MAX_CHARS = 4, 1200
GAP = 300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as one timeline: gaps between conversations exceed three hours."""
    rows = table(spark, sf_dir, "conversations").filter("role <> 'system'")
    key = F.col("conv_id") * 1000 + F.col("turn")
    return rows.select(key.alias("id"), (F.col("conv_id") * 100_000 + F.col("turn") * 60).alias("date"), F.col("role").alias("from_id"), F.col("role").alias("from"), "text", key.alias("ord"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session, turn_idx, role, content) of each conversation, without system rows."""
    return S.bursts(S.sessions(messages(spark, sf_dir), 180 * 60), C.role_of(F.col("from_id"), ROLES), "\n")


def built(spark: SparkSession, sf_dir: str, rules: Build) -> DataFrame:
    return V.ordered(V.build(messages(spark, sf_dir), Config(workers=1, roles=ROLES, build=rules)))


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversation per ``conv_id``: all turns, in order."""
    return built(spark, sf_dir, Build(max_turns=0, max_chars=0))


def event_messages(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """``events`` as messages on whole seconds; ``coarse`` cuts them to hours and repeats ids, for ties."""
    rows = table(spark, sf_dir, "events")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    date = F.floor(seconds / 3600) * 3600 if coarse else seconds
    key = F.floor(F.col("event_id") / 3) if coarse else F.col("event_id")
    return rows.select(key.alias("id"), date.alias("date"), F.col("event_type").alias("from_id"), F.col("event_id").cast("string").alias("text"), F.col("event_id").alias("ord"))


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as raw messages with every drop reason, by the document's number."""
    n = F.col("doc_id")
    short = F.when(n % 13 == 0, F.lit("ok")).when(n % 17 == 0, F.lit("  ")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        n.alias("id"), n.alias("ord"),
        F.when(n % 5 == 0, "service").otherwise("message").alias("type"),
        F.when(n % 7 == 0, "other").when(n % 2 == 0, "assistant").otherwise("user").alias("from_id"),
        F.lit("").alias("from"), n.cast("string").alias("date_unixtime"),
        F.to_variant_object(F.array(F.lit("unused"))).alias("text"),
        F.array(F.struct(F.lit("plain").alias("type"), short.alias("text"), F.lit("").alias("href"))).alias("text_entities"),
        F.when(n % 17 == 0, F.when(n % 2 == 0, "video_file").otherwise("")).alias("media_type"),
        F.lit("").alias("sticker_emoji"),
        F.when(n % 11 == 0, "").alias("forwarded_from"),
        F.when(n % 19 == 0, "bot").otherwise("").alias("via_bot"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, at, line) of every document's lines."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))


def inspect_participants(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("role").alias("from_id"), F.col("text").alias("from"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"))
    return I.participants(rows)


def inspect_media(spark, sf_dir):
    return I.media(table(spark, sf_dir, "events").select(F.col("event_type").alias("media_type")))


def clean_reason_histogram(spark, sf_dir):
    return C.histogram(C.with_reason(raw_documents(spark, sf_dir), Config(workers=1, roles=ROLES, clean=Clean(min_runes=3))))


def clean_messages(spark, sf_dir):
    kept = C.messages(C.with_reason(raw_documents(spark, sf_dir), Config(workers=1, roles=ROLES, clean=Clean(min_runes=3))))
    return kept.select("id", "date", "from_id", "text")


def flatten_entities(spark, sf_dir):
    """Lines as entities, every third a link."""
    parts = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.when(i % 3 == 2, "link").otherwise("plain").alias("type"), x.alias("text"), F.lit("").alias("href")))
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", T.collapse(T.entity_text(parts, True, False)).alias("text"))


def collapse_min_runes(spark, sf_dir):
    text = T.collapse(F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("　 \t")), F.lit("\n")))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text")).filter(F.char_length("text") >= 300)


def sessions_by_gap(spark, sf_dir):
    return S.sessions(event_messages(spark, sf_dir), GAP).select(F.col("ord").alias("event_id"), "session")


def burst_merge(spark, sf_dir):
    rows = S.sessions(event_messages(spark, sf_dir, coarse=True), 7200)
    return S.bursts(rows, F.col("from_id"), "+").select("session", "turn_idx", "role", "content")


def window_by_turns(spark, sf_dir):
    return S.windows(turns(spark, sf_dir), F.char_length("content"), MAX_TURNS, 0).groupBy("session", "win").agg(F.count(F.lit(1)).alias("n"))


def window_by_chars(spark, sf_dir):
    made = S.windows(turns(spark, sf_dir), F.char_length("content"), 0, MAX_CHARS)
    return made.groupBy("session", "win").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("content")).alias("size"))


def conversation_build(spark, sf_dir):
    """Sessions, bursts, windows under both limits, trimming: the flagship."""
    made = built(spark, sf_dir, Build(max_turns=MAX_TURNS, max_chars=MAX_CHARS))
    return made.select(
        "conv_ord", "session", "win", F.size("turns").cast("long").alias("n_turns"),
        V.assistant_runes(F.col("turns")).cast("long").alias("assistant_runes"),
        F.md5(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("="), t["content"])), "|")).alias("digest"),
    )


def dedup_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_ord"), F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("turns"))
    return V.dedup(rows).select(F.col("conv_ord").alias("doc_id"))


def _encoded(spark, sf_dir, style: str) -> DataFrame:
    made = whole(spark, sf_dir).withColumn("system", F.when(F.col("session") % 2 == 0, "Be brief.").otherwise(""))
    return made.select("session", V.encode(F.col("turns"), F.col("system"), style).alias("line"))


def encode_openai(spark, sf_dir):
    return _encoded(spark, sf_dir, "openai")


def encode_sharegpt(spark, sf_dir):
    return _encoded(spark, sf_dir, "sharegpt")


def _with_system(spark, sf_dir, system: System) -> DataFrame:
    config = Config(workers=1, roles=ROLES, build=Build(system=system, seed=SEED))
    return V.with_system(whole(spark, sf_dir), config).select("conv_ord", "system")


def system_fixed(spark, sf_dir):
    return _with_system(spark, sf_dir, System(mode="fixed", fixed=POOL[0]))


def system_pool(spark, sf_dir):
    return _with_system(spark, sf_dir, System(mode="pool", pool=POOL))


def train_val_split(spark, sf_dir):
    return V.split(whole(spark, sf_dir), RATIO, SEED).select("conv_ord", "rank", "part")


def prompt_batches(spark, sf_dir):
    return V.batch_contexts(whole(spark, sf_dir), 10, 5)


def memory_windows(spark, sf_dir):
    own = M.assistant_messages(messages(spark, sf_dir), "assistant")
    made = M.window_texts(own, F.char_length("text"), 3000)
    return made.select("win", F.md5("content").alias("content"), "date")


def fact_dedup(spark, sf_dir):
    rows = lines(spark, sf_dir).select(F.col("doc_id").alias("key"), (F.col("doc_id") % 500).alias("date"), F.col("at"), F.col("line"))
    answered = rows.groupBy("key", "date").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]).alias("facts"))
    return M.facts(answered).select("ord", "date", F.md5("text").alias("text"))


def consolidate_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text", F.col("n_chars").alias("date"), F.col("doc_id").alias("ord"))
    out = [M.consolidation_batches(rows, 40, even).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("latest"), F.sum("ord").alias("ids")).withColumn("pass", F.lit(int(not even))) for even in (True, False)]
    return out[0].unionByName(out[1])


def memory_records(spark, sf_dir):
    """Vectors in thousandths; the product is of single precision, as in the SQL: a whole number would make it one of doubles."""
    thousand = F.lit(1000).cast("float")
    vector = F.when(F.col("vec_id") % 4 == 0, F.array().cast("array<bigint>")).otherwise(F.transform("embedding", lambda x: F.floor(x * thousand)))
    return table(spark, sf_dir, "embeddings").select("vec_id", memory_line(F.concat(F.lit("fact "), F.col("vec_id").cast("string")), vector).alias("line"))


def display_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate(F.col("text")).alias("text"))


def month_labels(spark, sf_dir):
    rows = event_messages(spark, sf_dir).withColumn("date", F.when(F.col("ord") % 10 == 0, F.lit(0)).otherwise(F.col("date")))
    return rows.groupBy(T.month(F.col("date")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


def text_variant_fallback(spark, sf_dir):
    """The polymorphic field over every conversation text, in each of its shapes."""
    n = F.col("turn") % 4
    part = F.to_json(F.struct(F.lit("bold").alias("type"), F.col("text").alias("text")))
    link = F.lit('{"type":"link","text":"http://x"}')
    quoted = F.substring_index(F.to_json(F.struct(F.col("text").alias("t"))), '{"t":', -1)
    quoted = F.regexp_replace(quoted, r"\}\z", "")
    shaped = F.when(n == 0, quoted).when(n == 1, F.concat(F.lit("["), quoted, F.lit(","), link, F.lit(","), part, F.lit(',null,5,["x"],{"type":"bold"},{"text":7}]'))).when(n == 2, part).otherwise("17")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.collapse(T.raw_text(F.parse_json(shaped), True, False)).alias("text"))


def parse_list(spark, sf_dir):
    """Answers made of each document's lines, as JSON arrays, quoted items or plain lines."""
    n, items = F.col("doc_id") % 3, F.split("text", "\n")
    answer = F.when(n == 0, F.concat(F.lit("```json\n"), F.to_json(items), F.lit("\n```"))).when(n == 1, F.concat_ws(" ", F.transform(items, lambda x: F.concat(F.lit("«"), x, F.lit("»"))))).otherwise(F.concat_ws("\n- ", items))
    found = facts_.parse_lists(table(spark, sf_dir, "documents").select("doc_id", answer.alias("answer")), "answer", "facts")
    return found.select("doc_id", F.size("facts").cast("long").alias("n"), F.md5(F.array_join("facts", "|")).alias("digest"))


def drop_report(spark, sf_dir):
    return C.report(clean_reason_histogram(spark, sf_dir))


def sticker_emoji(spark, sf_dir):
    """Every event a sticker without text, some without an emoji, some no sticker."""
    n = F.col("event_id")
    raw = table(spark, sf_dir, "events").select(
        n.alias("id"), n.alias("ord"), F.lit("message").alias("type"), F.lit("user").alias("from_id"), F.lit("").alias("from"),
        n.cast("string").alias("date_unixtime"), F.to_variant_object(F.array(F.lit(""))).alias("text"),
        F.array(F.struct(F.lit("plain").alias("type"), F.when(n % 7 == 0, "said").otherwise(" ").alias("text"), F.lit("").alias("href"))).alias("text_entities"),
        F.when(n % 3 == 0, "voice").when(n % 3 == 1, "sticker").alias("media_type"), F.when(n % 2 == 0, F.col("event_type")).alias("sticker_emoji"),
        F.lit(None).cast("string").alias("forwarded_from"), F.lit("").alias("via_bot"),
    )
    reasoned = C.with_reason(raw, Config(workers=1, roles=ROLES, clean=Clean(min_runes=1, stickers_to_emoji=True)))
    return reasoned.select("id", "clean_text", "reason")


def epoch_parse(spark, sf_dir):
    """Seconds as text: plain, signed, padded, with a fraction, empty, beyond 64 bits."""
    digits, shape = F.col("event_id").cast("string"), F.col("event_id") % 8
    text = digits
    for i, other in enumerate([F.concat(F.lit("-"), digits), F.concat(F.lit("+00"), digits), F.concat(F.lit(" "), digits), F.concat(digits, F.lit(".5")), F.lit(""), F.lit("99999999999999999999"), F.lit("-99999999999999999999")]):
        text = F.when(shape == i + 1, other).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", T.epoch(text).alias("date"))


def no_split(spark, sf_dir):
    return V.split(whole(spark, sf_dir), 0.0, SEED).select("conv_ord", "rank", "part")


def system_generated(spark, sf_dir):
    """Each conversation's prompt is that of its batch; a digest of the batch's context stands for an answer."""
    made, rules = whole(spark, sf_dir), System(mode="generated")
    prompts = V.batch_contexts(made, rules.generated.batch_size, 5).select("batch", F.md5("context").alias("prompt"))
    config = Config(workers=1, roles=ROLES, build=Build(system=rules, seed=SEED))
    return V.with_system(made, config, prompts).select("conv_ord", "system")


def dry_run_preview(spark, sf_dir):
    """The first conversations with turns cut for display, as a dry run shows them."""
    shown = V.sample(whole(spark, sf_dir), 3)
    return shown.select("conv_ord", F.array_join(F.transform("turns", lambda t: F.concat(F.lit("["), t["role"], F.lit("] "), T.truncate(t["content"], 40))), " / ").alias("preview"))


NAMES = """inspect_participants inspect_media clean_reason_histogram clean_messages flatten_entities collapse_min_runes sessions_by_gap burst_merge
window_by_turns window_by_chars conversation_build dedup_conversations encode_openai encode_sharegpt system_fixed system_pool train_val_split
prompt_batches memory_windows fact_dedup consolidate_batches memory_records display_truncate month_labels text_variant_fallback parse_list
drop_report sticker_emoji epoch_parse no_split system_generated dry_run_preview"""
QUERIES = {name: globals()[name] for name in NAMES.split()}

_MESSAGES = "m AS (SELECT conv_id AS session_key, conv_id * 1000 + turn AS id, conv_id * 100000 + turn * 60 AS date, role, text FROM conversations WHERE role <> 'system')"
_SESSIONS = f"""{_MESSAGES},
    b AS (SELECT *, CASE WHEN date - lag(date) OVER (ORDER BY date, id) > 10800 THEN 1 ELSE 0 END AS brk FROM m),
    s AS (SELECT *, CAST(sum(brk) OVER (ORDER BY date, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM b),
    c AS (SELECT *, CASE WHEN role <> lag(role) OVER (PARTITION BY session ORDER BY date, id) THEN 1 ELSE 0 END AS chg FROM s),
    i AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY session ORDER BY date, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS turn_idx FROM c),
    t AS (SELECT session, turn_idx, any_value(role) AS role, string_agg(text, chr(10) ORDER BY date, id) AS content FROM i GROUP BY ALL)"""


def _folded(max_turns: int, max_size: int) -> str:
    over = []
    if max_turns > 0:
        over.append(f"f.k >= {max_turns}")
    if max_size > 0:
        over.append(f"f.sz + length(t.content) > {max_size}")
    cut = " OR ".join(over) or "FALSE"
    return f"""f(session, turn_idx, win, k, sz) AS (
        SELECT session, turn_idx, CAST(0 AS BIGINT), 1, CAST(length(content) AS BIGINT) FROM t WHERE turn_idx = 0
        UNION ALL
        SELECT t.session, t.turn_idx, CASE WHEN {cut} THEN f.win + 1 ELSE f.win END, CASE WHEN {cut} THEN 1 ELSE f.k + 1 END,
               CASE WHEN {cut} THEN CAST(length(t.content) AS BIGINT) ELSE f.sz + length(t.content) END
        FROM f JOIN t ON t.session = f.session AND t.turn_idx = f.turn_idx + 1),
    w AS (SELECT t.*, f.win FROM t JOIN f USING (session, turn_idx))"""


_TRIMMED = """e AS (SELECT session, win, min(turn_idx) FILTER (role = 'user') AS a, max(turn_idx) FILTER (role = 'assistant') AS z FROM w GROUP BY ALL),
    x AS (SELECT w.* FROM w JOIN e USING (session, win) WHERE turn_idx BETWEEN a AND z),
    y AS (SELECT session, win, count(*) AS n_turns, CAST(sum(CASE WHEN role = 'assistant' THEN length(content) ELSE 0 END) AS BIGINT) AS assistant_runes,
                 list({'role': role, 'content': content} ORDER BY turn_idx) AS turns
          FROM x GROUP BY ALL HAVING count(*) >= 2),
    v AS (SELECT *, row_number() OVER (ORDER BY session, win) - 1 AS conv_ord FROM y)"""


def _conversations(max_turns: int = 0, max_size: int = 0) -> str:
    return f"WITH RECURSIVE {_SESSIONS}, {_folded(max_turns, max_size)}, {_TRIMMED}"


_PROMPT = "CASE WHEN session %% 2 = 0 THEN [{'%s': 'system', '%s': 'Be brief.'}] ELSE [] END"
_EVENTS = "CAST(floor(epoch(ts)) AS BIGINT)"
_RAW = """r AS (
        SELECT doc_id AS n, CASE WHEN doc_id % 13 = 0 THEN 'ok' WHEN doc_id % 17 = 0 THEN '' ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END AS flat,
               CASE WHEN doc_id % 7 = 0 THEN 'other' WHEN doc_id % 2 = 0 THEN 'assistant' ELSE 'user' END AS sender FROM documents),
    k AS (
        SELECT *, CASE WHEN n % 5 = 0 THEN 'service' WHEN sender = 'other' THEN 'unknown_sender' WHEN n % 11 = 0 THEN 'forwarded' WHEN n % 19 = 0 THEN 'via_bot'
                       WHEN n % 17 = 0 AND n % 2 = 0 AND flat = '' THEN 'media' WHEN flat = '' THEN 'empty' WHEN length(flat) < 3 THEN 'short' ELSE 'kept' END AS reason FROM r)"""

_EDGES = "'" + facts_.EDGES.replace("'", "''") + "'"

SQL = {
    "inspect_participants": """
        SELECT role AS from_id, arg_min(text, conv_id * 1000 + turn) AS name, count(*) AS messages FROM conversations GROUP BY role""",
    "inspect_media": "SELECT event_type AS media_type, count(*) AS n FROM events WHERE event_type <> '' GROUP BY event_type",
    "clean_reason_histogram": f"WITH {_RAW} SELECT reason, count(*) AS n FROM k GROUP BY reason",
    "clean_messages": f"WITH {_RAW} SELECT n AS id, n AS date, sender AS from_id, flat AS text FROM k WHERE reason = 'kept'",
    "flatten_entities": """
        SELECT conv_id, turn, trim(regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: i % 3 <> 0), ''), '\\s+', ' ', 'g')) AS text
        FROM conversations""",
    "collapse_min_runes": "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents WHERE length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) >= 300",
    "sessions_by_gap": f"""
        WITH e AS (SELECT event_id, {_EVENTS} AS d FROM events),
        b AS (SELECT *, CASE WHEN d - lag(d) OVER (ORDER BY d, event_id) > {GAP} THEN 1 ELSE 0 END AS brk FROM e)
        SELECT event_id, CAST(sum(brk) OVER (ORDER BY d, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM b""",
    "burst_merge": f"""
        WITH e AS (SELECT event_id, event_type AS role, {_EVENTS} // 3600 * 3600 AS d, event_id // 3 AS id FROM events),
        b AS (SELECT *, CASE WHEN d - lag(d) OVER (ORDER BY d, id, event_id) > 7200 THEN 1 ELSE 0 END AS brk FROM e),
        s AS (SELECT *, CAST(sum(brk) OVER (ORDER BY d, id, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM b),
        c AS (SELECT *, CASE WHEN role <> lag(role) OVER (PARTITION BY session ORDER BY d, id, event_id) THEN 1 ELSE 0 END AS chg FROM s),
        i AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY session ORDER BY d, id, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS turn_idx FROM c)
        SELECT session, turn_idx, any_value(role) AS role, string_agg(CAST(event_id AS VARCHAR), '+' ORDER BY d, id, event_id) AS content FROM i GROUP BY ALL""",
    "window_by_turns": f"WITH {_SESSIONS} SELECT session, turn_idx // {MAX_TURNS} AS win, count(*) AS n FROM t GROUP BY ALL",
    "window_by_chars": f"WITH RECURSIVE {_SESSIONS}, {_folded(0, MAX_CHARS)} SELECT session, win, count(*) AS n, CAST(sum(length(content)) AS BIGINT) AS size FROM w GROUP BY ALL",
    "conversation_build": f"""{_conversations(MAX_TURNS, MAX_CHARS)}
        SELECT conv_ord, session, win, n_turns, assistant_runes, md5(array_to_string(list_transform(turns, lambda u: u.role || '=' || u.content), '|')) AS digest FROM v""",
    "dedup_conversations": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",
    "encode_openai": f"""{_conversations()}
        SELECT session, CAST(to_json({{'messages': list_concat({_PROMPT % ("role", "content")}, turns)}}) AS VARCHAR) AS line FROM v""",
    "encode_sharegpt": f"""{_conversations()}
        SELECT session, CAST(to_json({{'conversations': list_concat({_PROMPT % ("from", "value")},
               list_transform(turns, lambda u: {{'from': CASE WHEN u.role = 'assistant' THEN 'gpt' ELSE 'human' END, 'value': u.content}}))}}) AS VARCHAR) AS line FROM v""",
    "system_fixed": f"{_conversations()} SELECT conv_ord, '{POOL[0]}' AS system FROM v",
    "system_pool": f"""{_conversations()}
        SELECT conv_ord, ['{"', '".join(POOL)}'][CAST(('0x' || substr(md5('{SEED}:' || conv_ord), 1, 15))::BIGINT % {len(POOL)} + 1 AS INT)] AS system FROM v""",
    "train_val_split": f"""{_conversations()},
        h AS (SELECT conv_ord, row_number() OVER (ORDER BY md5('{SEED}:' || conv_ord), conv_ord) - 1 AS rank, count(*) OVER () AS n FROM v)
        SELECT conv_ord, rank, CASE WHEN rank < CAST(trunc(CAST(n AS DOUBLE) * {RATIO}) AS BIGINT) THEN 'val' ELSE 'train' END AS part FROM h""",
    "prompt_batches": f"""{_conversations()},
        u AS (SELECT conv_ord // 10 AS batch, conv_ord, unnest(turns) AS one, unnest(range(len(turns))) AS pos FROM v),
        h AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY md5((batch + 1) || ':' || conv_ord || ':' || pos), conv_ord, pos) AS r FROM u WHERE one.role = 'assistant')
        SELECT batch, string_agg(one.content, chr(10) ORDER BY r) AS context FROM h WHERE r <= 5 GROUP BY batch""",
    "memory_windows": f"""
        WITH RECURSIVE {_MESSAGES},
        a AS (SELECT date, text, length(text) AS n, row_number() OVER (ORDER BY date, id) AS pos FROM m WHERE role = 'assistant'),
        f(pos, win, sz) AS (
            SELECT pos, CAST(0 AS BIGINT), CAST(n AS BIGINT) FROM a WHERE pos = 1
            UNION ALL
            SELECT a.pos, CASE WHEN f.sz + a.n > 3000 THEN f.win + 1 ELSE f.win END, CASE WHEN f.sz + a.n > 3000 THEN CAST(a.n AS BIGINT) ELSE f.sz + a.n END
            FROM f JOIN a ON a.pos = f.pos + 1)
        SELECT win, md5(string_agg(text || chr(10), '' ORDER BY a.pos)) AS content, max(date) AS date FROM a JOIN f USING (pos) GROUP BY win""",
    "fact_dedup": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
        k AS (SELECT *, lower(trim(line)) AS key FROM l WHERE trim(line) <> ''),
        f AS (SELECT doc_id, pos, trim(line) AS text FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) = 1)
        SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS ord, doc_id % 500 AS date, md5(text) AS text FROM f""",
    "consolidate_batches": """
        WITH p AS (
            SELECT doc_id, n_chars, (row_number() OVER (ORDER BY text, doc_id) - 1) // 40 AS batch, 0 AS pass FROM documents
            UNION ALL SELECT doc_id, n_chars, (row_number() OVER (ORDER BY n_chars, doc_id) - 1) // 40, 1 FROM documents)
        SELECT batch, count(*) AS n, max(n_chars) AS latest, CAST(sum(doc_id) AS BIGINT) AS ids, pass FROM p GROUP BY batch, pass""",
    "memory_records": """
        SELECT vec_id, '{"text":"fact ' || vec_id || '"' || CASE WHEN vec_id % 4 = 0 THEN '' ELSE ',"embedding":[' ||
               array_to_string(list_transform(embedding, lambda x: CAST(floor(x * CAST(1000 AS FLOAT)) AS BIGINT)), ',') || ']' END || '}' AS line FROM embeddings""",
    "display_truncate": "SELECT doc_id, CASE WHEN length(text) > 240 THEN substr(text, 1, 240) || '…' ELSE text END AS text FROM documents",
    "month_labels": f"SELECT CASE WHEN event_id % 10 = 0 THEN '?' ELSE strftime(to_timestamp({_EVENTS}), '%Y-%m') END AS month, count(*) AS n FROM events GROUP BY ALL",
    "text_variant_fallback": """
        SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN one WHEN 1 THEN trim(regexp_replace(text || text, '\\s+', ' ', 'g')) ELSE '' END AS text
        FROM (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS one FROM conversations)""",
    "parse_list": rf"""
        WITH a AS (
            SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '```json' || chr(10) || CAST(to_json(ls) AS VARCHAR) || chr(10) || '```'
                                WHEN 1 THEN array_to_string(list_transform(ls, lambda x: '«' || x || '»'), ' ') ELSE array_to_string(ls, chr(10) || '- ') END AS answer
            FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
        u AS (SELECT doc_id, translate(regexp_replace(trim(answer), '(?s)^```[^\n]*\n(.*)```$', '\1'), '«»„“”', repeat('"', 5)) AS t FROM a),
        j AS (SELECT doc_id, t, regexp_extract(t, '(?s)\[.*\]') AS listed, regexp_extract_all(t, '(?s)"((?:[^"\\]|\\.)*)"', 1) AS quoted FROM u),
        i AS (SELECT doc_id, CASE WHEN listed <> '' AND json_valid(listed) THEN from_json(listed, '["VARCHAR"]') WHEN len(quoted) > 0 THEN quoted ELSE string_split(t, chr(10)) END AS items FROM j),
        c AS (SELECT doc_id, list_transform(items, lambda x: trim(trim(ltrim(regexp_replace(x, '^\s+|\s+$', '', 'g'), '{facts_.MARKERS}'), {_EDGES}))) AS items FROM i),
        f AS (SELECT doc_id, list_filter(items, lambda x: length(x) >= {facts_.MIN_RUNES} AND regexp_matches(x, '\pL')) AS items FROM c),
        d AS (SELECT doc_id, list_filter(items, lambda x, k: list_position(list_transform(items, lambda y: lower(y)), lower(x)) = k) AS items FROM f)
        SELECT doc_id, CAST(len(items) AS BIGINT) AS n, md5(array_to_string(items, '|')) AS digest FROM d""",
    "drop_report": f"""
        WITH {_RAW} SELECT 0 AS place, 'read' AS label, count(*) AS n FROM k
        UNION ALL SELECT CASE reason {" ".join(f"WHEN '{r}' THEN {i + 1}" for i, r in enumerate(["kept", *C.REASONS]))} END,
                         CASE reason WHEN 'kept' THEN 'kept' {" ".join(f"WHEN '{r}' THEN '{label}'" for r, label in C.REASONS.items())} END, count(*) FROM k GROUP BY reason""",
    "sticker_emoji": """
        SELECT id, clean_text, CASE WHEN clean_text = '' THEN CASE WHEN id % 3 < 2 THEN 'media' ELSE 'empty' END ELSE 'kept' END AS reason
        FROM (SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN 'said' WHEN event_id % 6 = 4 THEN event_type ELSE '' END AS clean_text FROM events)""",
    "epoch_parse": """
        SELECT event_id, CASE event_id % 8 WHEN 0 THEN event_id WHEN 1 THEN -event_id WHEN 2 THEN event_id WHEN 6 THEN 9223372036854775807
                         WHEN 7 THEN CAST('-9223372036854775808' AS BIGINT) ELSE 0 END AS date FROM events""",
    "no_split": f"{_conversations()} SELECT conv_ord, conv_ord AS rank, 'train' AS part FROM v",
    "system_generated": f"""{_conversations()},
        u AS (SELECT conv_ord // {System().generated.batch_size} AS batch, conv_ord, unnest(turns) AS one, unnest(range(len(turns))) AS pos FROM v),
        h AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY md5((batch + 1) || ':' || conv_ord || ':' || pos), conv_ord, pos) AS r FROM u WHERE one.role = 'assistant'),
        p AS (SELECT batch, md5(string_agg(one.content, chr(10) ORDER BY r)) AS system FROM h WHERE r <= 5 GROUP BY batch)
        SELECT conv_ord, system FROM v JOIN p ON conv_ord // {System().generated.batch_size} = batch""",
    "dry_run_preview": f"""{_conversations()}
        SELECT conv_ord, array_to_string(list_transform(turns, lambda u: '[' || u.role || '] ' || CASE WHEN length(u.content) > 40 THEN substr(u.content, 1, 40) || '…' ELSE u.content END), ' / ') AS preview
        FROM v WHERE conv_ord < 3""",
}
