"""Conversations: trimming, dedup, prompts, split, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatloom.config import Build, Config
from chatloom.operators.clean import role_of
from chatloom.operators.sequence import bursts, numbered, sessions, windows

#: Sessions numbered together.
BUCKET = 4096


def trimmed(turns: Column, rules: Build) -> Column:
    """From the first user turn to the last assistant turn, as the rules ask."""
    roles, size = F.transform(turns, lambda t: t["role"]), F.size(turns)
    first = F.array_position(roles, "user") if rules.start_with_user else F.lit(1)
    back = F.array_position(F.reverse(roles), "assistant") if rules.require_assistant else F.lit(1)
    last = F.when(back > 0, size - back + 1).otherwise(0)
    inside = (first >= 1) & (last >= first)
    return F.when(inside, F.slice(turns, F.when(inside, first).otherwise(1).cast("int"), F.when(inside, last - first + 1).otherwise(0).cast("int"))).otherwise(F.slice(turns, 1, 0))


def assistant_runes(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0), lambda n, t: n + F.when(t["role"] == "assistant", F.char_length(t["content"])).otherwise(0))


def finalize(windowed: DataFrame, rules: Build) -> DataFrame:
    """(session, win, turns): each window trimmed; those too short or without assistant go."""
    listed = F.array_sort(F.collect_list(F.struct("turn_idx", "role", "content")))
    made = windowed.groupBy("session", "win").agg(F.transform(listed, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns"))
    made = made.withColumn("turns", trimmed(F.col("turns"), rules))
    if rules.require_assistant:
        made = made.filter(F.exists("turns", lambda t: t["role"] == "assistant"))
    return made.filter((F.size("turns") >= rules.min_turns) & (assistant_runes(F.col("turns")) >= rules.min_assistant_runes))


def ordered(conversations: DataFrame) -> DataFrame:
    """With ``conv_ord``, the dense position by (session, win)."""
    return numbered(conversations, F.floor(F.col("session") / BUCKET), ["session", "win"], "conv_ord")


def build(messages: DataFrame, config: Config, size: Column | None = None) -> DataFrame:
    """(session, win, turns) from clean messages; ``size`` measures ``content`` (code points by default)."""
    rules = config.build
    limit = rules.max_tokens if rules.max_tokens > 0 else rules.max_chars
    split = sessions(messages, rules.session_gap_minutes * 60)
    turns = bursts(split, role_of(F.col("from_id"), config.roles), rules.burst_separator)
    return finalize(windows(turns, F.char_length("content") if size is None else size, rules.max_turns, limit), rules)


def fingerprint(turns: Column) -> Column:
    """Role, unit separator, content, record separator of each turn; hashed to keep the key small."""
    return F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\x1f"), t["content"], F.lit("\x1e"))), ""), 256)


def dedup(conversations: DataFrame, order: str = "conv_ord") -> DataFrame:
    """Keeps the first of equal conversations, found by partial aggregation of the least position."""
    firsts = conversations.groupBy(fingerprint(F.col("turns")).alias("_print")).agg(F.min(order).alias(order)).select(order)
    return conversations.join(firsts, order, "left_semi")


def seeded(seed: int, *parts: Column | str) -> Column:
    """A hash text that depends on the seed and the parts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]))


def pick(pool: tuple[str, ...], seed: int, order: str = "conv_ord") -> Column:
    """An entry of the pool, settled by seed and position."""
    number = F.conv(F.substring(seeded(seed, order), 1, 15), 16, 10).cast("long")
    return F.element_at(F.array(*[F.lit(p) for p in pool]), (F.pmod(number, F.lit(len(pool))) + 1).cast("int"))


def with_system(conversations: DataFrame, config: Config, prompts: DataFrame | None = None) -> DataFrame:
    """With ``system``: empty, fixed, picked from the pool, or of the conversation's batch in ``prompts`` (batch, prompt)."""
    system, seed = config.build.system, config.build.seed
    if system.mode == "fixed":
        return conversations.withColumn("system", F.lit(system.fixed))
    if system.mode == "pool":
        return conversations.withColumn("system", pick(system.pool, seed))
    if system.mode == "generated" and prompts is not None:
        own = conversations.withColumn("batch", F.floor(F.col("conv_ord") / system.generated.batch_size).cast("long"))
        return own.join(prompts.select("batch", F.col("prompt").alias("system")), "batch", "left").drop("batch")
    return conversations.withColumn("system", F.lit(""))


def split(conversations: DataFrame, ratio: float, seed: int) -> DataFrame:
    """With ``part`` (train or val) and ``rank`` in seeded order; the first trunc(n * ratio) are val.

    Without a ratio all is train, in the original order.
    """
    if ratio <= 0:
        return conversations.withColumn("rank", F.col("conv_ord")).withColumn("part", F.lit("train"))
    shuffled = conversations.withColumn("_hash", seeded(seed, "conv_ord"))
    shuffled = numbered(shuffled, F.substring("_hash", 1, 4), ["_hash", "conv_ord"], "rank").drop("_hash")
    wanted = (F.col("_all").cast("double") * ratio).cast("long")
    total = conversations.agg(F.count(F.lit(1)).alias("_all"))
    return shuffled.join(F.broadcast(total)).withColumn("part", F.when(F.col("rank") < wanted, "val").otherwise("train")).drop("_all")


def encode(turns: Column, system: Column, style: str) -> Column:
    """One JSON line; no turns and no prompt give ``null``, as there is nothing to list."""
    if style == "sharegpt":
        names, head = ("from", "value", "conversations"), "system"
        role = lambda r: F.when(r == "assistant", "gpt").otherwise("human")
    else:
        names, head = ("role", "content", "messages"), "system"
        role = lambda r: r
    listed = F.transform(turns, lambda t: F.struct(role(t["role"]).alias(names[0]), t["content"].alias(names[1])))
    prompt = F.array(F.struct(F.lit(head).alias(names[0]), system.alias(names[1])))
    everything = F.when(system != "", F.concat(prompt, listed)).otherwise(listed)
    return F.to_json(F.struct(F.when(F.size(everything) > 0, everything).alias(names[2])), {"ignoreNullFields": "false"})


def batch_contexts(conversations: DataFrame, batch_size: int, samples: int) -> DataFrame:
    """(batch, context): assistant texts of each batch in seeded order, at most ``samples`` (all if 0)."""
    rows = conversations.select(F.floor(F.col("conv_ord") / batch_size).cast("long").alias("batch"), "conv_ord", F.posexplode("turns").alias("turn", "t"))
    rows = rows.filter("t.role = 'assistant'").select("batch", "conv_ord", "turn", F.col("t.content").alias("content"))
    rows = rows.withColumn("_hash", F.md5(F.concat_ws(":", (F.col("batch") + 1).cast("string"), F.col("conv_ord").cast("string"), F.col("turn").cast("string"))))
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("batch").orderBy("_hash", "conv_ord", "turn")))
    if samples > 0:
        rows = rows.filter(F.col("_rank") <= samples)
    return rows.groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "content"))), lambda r: r["content"]), "\n").alias("context"))


def sample(conversations: DataFrame, n: int) -> DataFrame:
    """The first ``n`` in order; all if ``n`` is 0 or less."""
    rows = conversations.orderBy("conv_ord")
    return rows.limit(n) if n > 0 else rows
