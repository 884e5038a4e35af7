"""Command line: inspect, clean, build, all, memory."""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chatloom import config as settings
from chatloom.functions.text import truncate
from chatloom.operators import clean as C
from chatloom.operators.conversations import sample
from chatloom.operators.memory import assistant_messages
from chatloom.plans import commands
from chatloom.sources import export

FLAGS = {"int": ("min_runes", "gap", "max_turns", "max_chars", "max_tokens", "min_turns", "seed", "min_assistant_runes"), "float": ("val_ratio",), "bool": ("strip_links", "stickers_emoji", "drop_forwarded", "drop_via_bot", "redact_pii", "start_with_user", "require_assistant", "dedup")}


def _flag(text: str) -> bool:
    if text.lower() not in ("true", "false", "1", "0"):
        raise argparse.ArgumentTypeError("true or false")
    return text.lower() in ("true", "1")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chatloom", description="Chat exports to training data")
    commands_ = top.add_subparsers(dest="command", required=True)
    for name in ("inspect", "clean", "build", "all", "memory"):
        sub = commands_.add_parser(name)
        sub.add_argument("--in", dest="source", required=True)
        if name == "inspect":
            continue
        sub.add_argument("--out")
        sub.add_argument("--config")
        sub.add_argument("--workers", type=int)
        sub.add_argument("--dry-run", action="store_true")
        sub.add_argument("--sample", type=int, default=3)
        sub.add_argument("--allow-remote", action="store_true", help="let private text leave this machine, for generated prompts and memory")
        if name != "memory":
            for flag in settings.OVERRIDES:
                kind = next((k for k, names in FLAGS.items() if flag in names), "str")
                sub.add_argument("--" + flag.replace("_", "-"), dest=flag, type={"int": int, "float": float, "bool": _flag, "str": str}[kind], **({"nargs": "?", "const": True} if kind == "bool" else {}))
    return top


def main(argv: list[str] | None = None) -> int:
    given = parser().parse_args(argv)
    spark = SparkSession.builder.appName("chatloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "inspect":
        total, people, media = commands.inspect(export.read_export(spark, given.source))
        print(f"messages: {total}")
        people.show(50, False)
        media.show(50, False)
        return 0
    config = settings.load(given.config)
    if given.workers and given.workers > 0:
        config = replace(config, workers=given.workers, memory=replace(config.memory, workers=given.workers))
    config = settings.override(config, **{k: getattr(given, k) for k in settings.OVERRIDES if hasattr(given, k)})
    if given.command in ("build", "all"):
        config.validate()
    settings.require_roles(config)
    if not given.out and not given.dry_run:
        raise SystemExit("--out is needed unless --dry-run is given")
    if given.command in ("clean", "all"):
        reasoned = C.with_reason(export.read_export(spark, given.source, config.workers), config)
        (_, _, read), *counts = sorted(tuple(r) for r in C.report(C.histogram(reasoned)).collect())
        kept = next((n for place, _, n in counts if place == 1), 0)
        print(f"read {read}, kept {kept}")
        for place, label, n in counts:
            if place > 1:
                print(f"  {label}: {n}")
        messages = C.messages(reasoned)
        if given.command == "clean":
            if not given.dry_run:
                export.write_lines(messages, F.to_json(F.struct("id", "date", "from_id", "from", "text", "ord")), given.out, ["ord"])
            return 0
    else:
        messages = export.read_clean(spark, given.source)
    if given.command == "memory":
        if given.dry_run:
            print(f"messages of the assistant's person: {assistant_messages(messages, config.roles.assistant_id).count()}")
            return 0
        found = commands.memory(spark, messages, config, f"{given.out}.stages", allow_remote=given.allow_remote)
        export.write_lines(found, export.memory_line(F.col("text"), F.col("embedding")), given.out, ["ord"])
        return 0
    service = config.build.system.generated
    prompts = None if given.dry_run or config.build.system.mode != "generated" else commands.asked_prompts(service.cache_file, service, given.allow_remote)
    made = commands.conversations(messages, config, prompts)
    if given.dry_run:
        print(f"conversations: {made.count()}")
        for row in sample(made, given.sample).select(F.transform("turns", lambda t: F.concat(F.lit("["), t["role"], F.lit("] "), truncate(t["content"]))).alias("t")).toLocalIterator():
            print(json.dumps(row["t"], ensure_ascii=False, indent=1))
        return 0
    print(commands.write_dataset(made, config, given.out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
