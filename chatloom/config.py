"""Settings, their defaults, JSON overlay, overrides and validation."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    assistant_id: str = ""
    user_id: str = ""


@dataclass(frozen=True)
class Clean:
    strip_links: bool = True
    stickers_to_emoji: bool = True
    drop_forwarded: bool = True
    drop_via_bot: bool = True
    redact_pii: bool = False
    min_runes: int = 1


@dataclass(frozen=True)
class Service:
    """A chat or embedding endpoint."""

    api_base: str = ""
    api_style: str = ""
    api_key_env: str = ""
    model: str = ""
    batch_size: int = 0
    context_samples: int = 0
    temperature: float = 0.0
    instruction: str = ""
    cache_file: str = ""


LOCAL = Service(api_base="http://localhost:11434", api_style="ollama", model="qwen3.5:9b")


@dataclass(frozen=True)
class System:
    mode: str = "empty"
    fixed: str = ""
    pool: tuple[str, ...] = ()
    generated: Service = Service("https://api.openai.com/v1", "", "OPENAI_API_KEY", "gpt-4o-mini", 100, 20, 0.8, "", "system_prompts.json")


@dataclass(frozen=True)
class Build:
    session_gap_minutes: int = 180
    max_turns: int = 20
    max_chars: int = 6000
    max_tokens: int = 0
    token_encoding: str = "cl100k_base"
    min_turns: int = 2
    format: str = "openai"
    system: System = System()
    start_with_user: bool = True
    require_assistant: bool = True
    burst_separator: str = "\n"
    val_ratio: float = 0.0
    seed: int = 42
    dedup: bool = True
    min_assistant_runes: int = 0


@dataclass(frozen=True)
class Memory:
    window_tokens: int = 1500
    token_encoding: str = "cl100k_base"
    workers: int = 4
    cache_file: str = "memory_facts.json"
    extract: Service = dataclasses.replace(LOCAL, temperature=0.2)
    do_consolidate: bool = True
    consolidate_passes: int = 2
    consolidate: Service = dataclasses.replace(LOCAL, temperature=0.3, batch_size=40)
    do_embeddings: bool = True
    embeddings: Service = dataclasses.replace(LOCAL, model="nomic-embed-text")


@dataclass(frozen=True)
class Config:
    workers: int = field(default_factory=lambda: os.cpu_count() or 1)
    roles: Roles = Roles()
    clean: Clean = Clean()
    build: Build = Build()
    memory: Memory = Memory()

    def validate(self) -> None:
        """Raises ValueError for settings that ``build`` and ``all`` can't work with."""
        require_roles(self)
        system, made = self.build.system, self.build.system.generated
        faults = [
            (self.build.format not in ("openai", "sharegpt"), f"unknown build.format {self.build.format!r}"),
            (not 0 <= self.build.val_ratio < 1, "build.val_ratio must be in [0, 1)"),
            (system.mode not in ("", "empty", "fixed", "pool", "generated"), f"unknown build.system.mode {system.mode!r}"),
            (system.mode == "pool" and not system.pool, "build.system.pool must not be empty in pool mode"),
        ]
        if system.mode == "generated":
            faults += [
                (not (made.api_base and made.model), "build.system.generated needs api_base and model"),
                (made.batch_size < 1, "build.system.generated.batch_size must be 1 or more"),
                (made.api_style not in ("", "openai", "ollama"), f"unknown api_style {made.api_style!r}"),
            ]
        for fault, message in faults:
            if fault:
                raise ValueError(message)


def require_roles(config: Config) -> None:
    if not (config.roles.assistant_id and config.roles.user_id):
        raise ValueError("roles.assistant_id and roles.user_id must be set; `inspect` lists the participants")


def overlay(value, given: dict):
    """``value`` with what ``given`` names; keys it doesn't know are ignored."""
    known = {f.name: getattr(value, f.name) for f in dataclasses.fields(value)}
    changes = {}
    for name, new in given.items():
        if name in known:
            old = known[name]
            changes[name] = overlay(old, new) if dataclasses.is_dataclass(old) else tuple(new) if isinstance(old, tuple) else new
    return dataclasses.replace(value, **changes)


def load(path: str | None = None) -> Config:
    """The defaults, overlaid with the JSON file at ``path``."""
    config = Config()
    if not path:
        return config
    with open(path, encoding="utf-8") as f:
        config = overlay(config, json.load(f))
    return config if config.workers >= 1 else dataclasses.replace(config, workers=os.cpu_count() or 1)


#: Command-line flag -> where it goes.
OVERRIDES = {
    "assistant_id": ("roles", "assistant_id"), "user_id": ("roles", "user_id"),
    "strip_links": ("clean", "strip_links"), "stickers_emoji": ("clean", "stickers_to_emoji"), "drop_forwarded": ("clean", "drop_forwarded"),
    "drop_via_bot": ("clean", "drop_via_bot"), "redact_pii": ("clean", "redact_pii"), "min_runes": ("clean", "min_runes"),
    "gap": ("build", "session_gap_minutes"), "max_turns": ("build", "max_turns"), "max_chars": ("build", "max_chars"), "max_tokens": ("build", "max_tokens"),
    "token_encoding": ("build", "token_encoding"), "min_turns": ("build", "min_turns"), "format": ("build", "format"), "system": ("build", "system", "fixed"),
    "system_mode": ("build", "system", "mode"), "start_with_user": ("build", "start_with_user"), "require_assistant": ("build", "require_assistant"),
    "burst_sep": ("build", "burst_separator"), "val_ratio": ("build", "val_ratio"), "seed": ("build", "seed"), "dedup": ("build", "dedup"),
    "min_assistant_runes": ("build", "min_assistant_runes"),
}


def override(config: Config, **given) -> Config:
    """Applies the flags that were given (not None); ``system`` also sets the mode to fixed."""
    for name, value in given.items():
        if value is None:
            continue
        change: dict = {}
        at = change
        *outer, last = OVERRIDES[name]
        for key in outer:
            at = at.setdefault(key, {})
        at[last] = value
        if name == "system":
            at["mode"] = "fixed"
        config = overlay(config, change)
    return config
