"""The five commands as plans over DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.clients import Client
from chatloom.config import Config, Service, require_roles
from chatloom.functions.facts import parse_list
from chatloom.functions.tokens import measure
from chatloom.operators import clean as C
from chatloom.operators import conversations as V
from chatloom.operators import inspect as I
from chatloom.operators import memory as M
from chatloom.plans.answers import below, digest, kept_answers, removed
from chatloom.sources import export

PERSONA = "These are messages one person wrote in a private chat. In one or two sentences, tell an assistant how to answer in this person's voice. Give the instruction alone."
EXTRACT = "List the lasting facts about the author that these messages state, each a short sentence that stands alone. Answer with a JSON array of strings."
CONSOLIDATE = "These are dated facts about one person. Merge repeats; where facts disagree keep the most recent. Answer with a JSON array of strings, without dates."
PLACEHOLDER = "(generated prompt)"


def inspect(raw: DataFrame) -> tuple[int, DataFrame, DataFrame]:
    """Messages in all, participants, media."""
    return raw.count(), I.participants(raw), I.media(raw)


def clean(raw: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Clean messages, and the histogram of drop reasons."""
    require_roles(config)
    reasoned = C.with_reason(raw, config)
    return C.messages(reasoned), C.histogram(reasoned)


def conversations(messages: DataFrame, config: Config, prompts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(conv_ord, turns, system): built, ordered, deduplicated and given prompts.

    ``prompts`` answers (batch, context) with (batch, prompt) in generated mode;
    without it a placeholder stands in, as for a dry run.
    """
    config.validate()
    rules = config.build
    made = V.ordered(V.build(messages, config, measure(F.col("content"), rules.max_tokens, rules.token_encoding)))
    if rules.dedup:
        made = V.ordered(V.dedup(made).drop("conv_ord"))
    answered = None
    if rules.system.mode == "generated":
        contexts = V.batch_contexts(made, rules.system.generated.batch_size, rules.system.generated.context_samples)
        answered = prompts(contexts) if prompts else contexts.select("batch", F.lit(PLACEHOLDER).alias("prompt"))
    return V.with_system(made, config, answered).select("conv_ord", "turns", "system")


def asked_prompts(cache: str, service: Service, allow_remote: bool = False) -> Callable[[DataFrame], DataFrame]:
    """Prompts from a service, kept wave by wave in a Parquet table at ``cache`` under a digest of all that they depend on."""

    def prompts(contexts: DataFrame) -> DataFrame:
        instruction = service.instruction.strip() or PERSONA

        def ask() -> Callable[[str], str]:
            client = Client(service, allow_remote)
            return lambda context: client.generate(instruction, context)

        keyed = contexts.select("batch", F.col("context").alias("content"), digest(service, instruction, "context").alias("digest"))
        return keyed.join(kept_answers(keyed, "batch", cache, ask, "prompt string"), "digest").select("batch", "prompt")

    return prompts


def write_dataset(made: DataFrame, config: Config, out: str) -> dict[str, int]:
    """Writes one file folder, or train and val; returns their sizes.

    The rows are computed once, into a table beside ``out`` that is removed in the end.
    """
    spark, rules, stage = made.sparkSession, config.build, f"{out}.stages"
    parts = V.split(made, rules.val_ratio, rules.seed).withColumn("line", V.encode(F.col("turns"), F.col("system"), rules.format))
    paths = dict(zip(("train", "val"), export.split_paths(out), strict=True)) if rules.val_ratio > 0 else {"train": out}
    parts.select("part", "rank", "line").write.mode("overwrite").partitionBy("part").parquet(stage)
    parts = spark.read.schema("rank bigint, line string, part string").parquet(stage)
    sizes = {}
    for part, path in paths.items():
        rows = parts.filter(F.col("part") == part)
        export.write_lines(rows, F.col("line"), path, ["rank"])
        sizes[part] = rows.count()
    removed(spark, stage)
    return sizes


def everything(raw: DataFrame, config: Config, out: str, prompts=None) -> dict[str, int]:
    """``clean`` and ``build`` in one plan."""
    return write_dataset(conversations(clean(raw, config)[0], config, prompts), config, out)


def memory(spark: SparkSession, messages: DataFrame, config: Config, folder: str, size=None, extract=None, merge=None, embed=None, allow_remote: bool = False) -> DataFrame:
    """(text, embedding, ord) of the facts about the assistant's person.

    ``extract``, ``merge`` and ``embed`` make a partition's callable; by default
    they are the configured services, which are asked away from this machine only
    with ``allow_remote``.  Tables between stages go to ``folder``, and so does the
    table of extracted facts, ``cache_file``, unless its path is absolute: a rerun
    asks only for windows that it lacks.  Without a ``cache_file`` all are asked.
    """
    require_roles(config)
    rules = config.memory

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    own = M.assistant_messages(messages, config.roles.assistant_id)
    size = measure(F.col("text"), 1, rules.token_encoding) if size is None else size
    requests = M.window_texts(own, size, rules.window_tokens).withColumnRenamed("win", "key")
    requests = keep(requests.repartition(max(1, rules.workers)), "windows")
    ask, instruction = extract or (lambda: Client(rules.extract, allow_remote).generate), rules.extract.instruction.strip() or EXTRACT
    if rules.cache_file:
        keyed = requests.withColumn("digest", digest(rules.extract, instruction, "content"))

        def listed() -> Callable[[str], list[str]]:
            call = ask()
            return lambda content: parse_list(call(instruction, content))

        known = kept_answers(keyed, "key", below(folder, rules.cache_file), listed, "facts array<string>", rules.workers)
        answered = keyed.join(known, "digest").select("key", "date", "facts")
    else:
        answered = keep(M.answers(requests, ask, instruction), "answers")
    found = keep(M.facts(answered), "facts")
    if rules.do_consolidate:
        ask = merge or (lambda: Client(rules.consolidate, allow_remote).generate)
        found = M.consolidate(found, ask, rules.consolidate.instruction.strip() or CONSOLIDATE, rules.consolidate.batch_size, rules.consolidate_passes, keep)
    if rules.do_embeddings:
        return keep(M.embeddings(found, embed or (lambda: Client(rules.embeddings, allow_remote).embed)), "embeddings")
    return found.select("text", F.lit(None).cast("array<double>").alias("embedding"), "ord")
