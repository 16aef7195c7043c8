"""Profiles of model stages: configuration checked by a table of field rules and resolved to typed settings."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields
from typing import Any

STAGES = ("user_simulation", "answer", "judge")
# Request keys that the options of a provider can't set.
RESERVED = frozenset("model messages response_format temperature max_tokens provider".split())


@dataclass(frozen=True)
class Profile:
    stage: str
    profile_name: str
    backend: str
    model: str
    batch_size: int
    max_attempts: int
    timeout_sec: int
    temperature: float | None = None
    max_output_tokens: int | None = None
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    """What a field at a dotted path may be; a rule that says ``only`` holds for one backend, and forbids the field to others."""

    path: str
    kind: str
    good: Callable[[Any], bool]
    needed: bool = True
    only: str | None = None


def _text(v: Any) -> bool:
    return isinstance(v, str) and bool(v.strip())


def _count(v: Any) -> bool:
    return type(v) is int and v > 0


def _warmth(v: Any) -> bool:
    return type(v) in (int, float) and 0 <= v <= 2


def _free_options(v: Any) -> bool:
    return isinstance(v, dict) and not RESERVED & v.keys()


BACKENDS = ("cli", "http")
RULES = (
    Rule("profile_name", "text", _text),
    Rule("model", "text", _text),
    Rule("backend", f"one of {', '.join(BACKENDS)}", BACKENDS.__contains__),
    Rule("batch_size", "a count from 1", _count),
    Rule("max_attempts", "a count from 1", _count),
    Rule("timeout_sec", "a count from 1", _count),
    Rule("temperature", "a number from 0 to 2", _warmth, needed=False, only="http"),
    Rule("max_output_tokens", "a count from 1", _count, needed=False, only="http"),
    Rule("cli", "a section", lambda v: isinstance(v, dict), only="cli"),
    Rule("cli.reasoning_effort", "text", _text, only="cli"),
    Rule("cli.sandbox", "text", _text, only="cli"),
    Rule("http", "a section", lambda v: isinstance(v, dict), only="http"),
    Rule("http.api_base", "text", _text, only="http"),
    Rule("http.api_key_env", "text", _text, only="http"),
    Rule("http.provider_options", f"options without {', '.join(sorted(RESERVED))}", _free_options, needed=False, only="http"),
)


def _value(stage: Any, path: str) -> Any:
    for key in path.split("."):
        stage = stage.get(key) if isinstance(stage, dict) else None
    return stage


def faults(stage: Any) -> Iterator[str]:
    """What is wrong with one stage."""
    if not isinstance(stage, dict):
        yield "the stage is no section"
        return
    backend = stage.get("backend")
    for rule in RULES:
        value = _value(stage, rule.path)
        if rule.only not in (None, backend):
            if value is not None and "." not in rule.path:
                yield f"{rule.path} is foreign to {backend}"
        elif value is None:
            if rule.needed:
                yield f"{rule.path} is missing"
        elif not rule.good(value):
            yield f"{rule.path} isn't {rule.kind}"


def _sets(config: dict) -> Iterator[tuple[str, str, Any]]:
    sets = config.get("profile_sets")
    if config.get("version") != 1 or not isinstance(sets, dict) or not sets:
        raise ValueError("a configuration has version 1 and at least one profile set")
    for name, content in sets.items():
        stages = content.get("stages") if isinstance(content, dict) else None
        for stage, settings in (stages or {"": None}).items():
            yield name, stage, settings


def resolve(config: dict, name: str, check_env: bool = False) -> dict[str, Profile]:
    """The profiles of a set, a stage each; an error names everything that is wrong in any set."""
    wrong, mine = [], {}
    for set_name, stage, settings in _sets(config):
        if stage not in STAGES:
            wrong.append(f"{set_name}: no stage is called {stage!r}")
            continue
        wrong += [f"{set_name}.{stage}: {fault}" for fault in faults(settings)]
        if set_name == name:
            mine[stage] = settings
    if not wrong:
        wrong = [f"{name}: stage {s} isn't configured" for s in STAGES if s not in mine]
    if not wrong and check_env:
        wrong = [f"{name}.{s}: the environment lacks {env}" for s, raw in mine.items() if (env := _value(raw, "http.api_key_env")) and raw["backend"] == "http" and not os.environ.get(env)]
    if wrong:
        raise ValueError("; ".join(wrong))
    plain = [f.name for f in fields(Profile) if f.name not in ("stage", "options")]
    return {s: Profile(s, **{k: mine[s].get(k) for k in plain}, options=dict(mine[s][mine[s]["backend"]])) for s in STAGES}


@dataclass(frozen=True)
class Runtime:
    """Settings of one stage as a run uses them."""

    provider: str
    mode: str
    model: str
    batch_size: int
    max_attempts: int
    timeout_sec: int
    profile_name: str | None = None


#: How rows name what made them, by backend.
PROVIDERS = {"cli": ("local_cli", "cli_batch"), "http": ("chat_endpoint", "http_batch")}


def runtime(profile: Profile | None, flags: dict[str, Any], defaults: dict[str, Any]) -> Runtime:
    """A stage's settings from its profile, or from flags over defaults; both at once are an error."""
    given = {k: v for k, v in flags.items() if v is not None}
    if profile is not None and given:
        raise ValueError(f"a profile is set, so these flags can't be: {', '.join(sorted(given))}")
    use = {f.name: getattr(profile, f.name) for f in fields(Profile)} if profile else defaults | given
    if use["backend"] not in PROVIDERS:
        raise ValueError(f"no backend is called {use['backend']!r}")
    provider, mode = PROVIDERS[use["backend"]]
    return Runtime(provider, mode, use["model"], use["batch_size"], use["max_attempts"], use["timeout_sec"], use.get("profile_name"))


def preflight(config: dict, name: str) -> str:
    """A profile set as lines of text, once it resolves."""
    return "\n".join(f"{s}: {p.profile_name} ({p.backend}, {p.model}), {p.batch_size} a call, {p.max_attempts} attempts of {p.timeout_sec} s" for s, p in resolve(config, name).items())
