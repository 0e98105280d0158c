"""Configuration of sources, extraction targets and rules: read once on the driver, typed, and refused if anything is amiss.

Files are YAML or JSON. A wrong key, a pattern that doesn't compile or one that captures nothing stops a run before its first job.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation
from pathlib import Path

from ..operators.quality import Rule, RuleError, load_rules
from .http import Policy


class ConfigError(ValueError):
    pass


def read_mapping(path: str | Path) -> dict:
    """The mapping in a YAML or JSON file."""
    file = Path(path)
    if not file.is_file():
        raise ConfigError(f"{file}: there is no such file")
    text = file.read_text(encoding="utf-8")
    try:
        if file.suffix == ".json":
            out = json.loads(text)
        else:
            try:
                import yaml
            except ImportError as e:
                raise ConfigError(f"{file}: YAML can't be read here, give JSON") from e
            try:
                out = yaml.safe_load(text)
            except yaml.YAMLError as e:
                raise ConfigError(f"{file}: {e}") from e
    except json.JSONDecodeError as e:
        raise ConfigError(f"{file}: {e}") from e
    if not isinstance(out or {}, dict):
        raise ConfigError(f"{file}: holds no mapping")
    return out or {}


def _need(block: Mapping, key: str, where: str, kind: type = str) -> object:
    value = block.get(key)
    if value is None:
        raise ConfigError(f"{where}: {key} is missing")
    try:
        return kind(str(value)) if kind is Decimal else kind(value)
    except (TypeError, ValueError, InvalidOperation) as e:
        raise ConfigError(f"{where}: {key} is no {kind.__name__}: {value!r}") from e


@dataclass(frozen=True)
class Source:
    state: str
    adapter: str
    plan_year: int
    market: str
    options: Mapping


@dataclass(frozen=True)
class Sources:
    policy: Policy
    by_state: Mapping[str, Source]

    def chosen(self, states: Sequence[str] | None = None) -> list[Source]:
        """The sources of the states named, or all; a state that isn't configured is an error, not a new source."""
        wanted = list(self.by_state) if states is None else [s.upper() for s in states]
        unknown = sorted(set(wanted) - set(self.by_state))
        if unknown:
            raise ConfigError(f"not configured: {', '.join(unknown)}; there are {', '.join(sorted(self.by_state))}")
        return [self.by_state[s] for s in wanted]


def load_sources(config: Mapping | str | Path, contact: str | None = None, where: str = "sources") -> Sources:
    """Network policy and sources. The user agent's {contact} is the argument, INGEST_CONTACT, or the file's own contact."""
    raw = config if isinstance(config, Mapping) else read_mapping(config)
    defaults, blocks = raw.get("defaults") or {}, raw.get("sources") or {}
    if not blocks:
        raise ConfigError(f"{where}: no sources")
    who = contact or os.environ.get("INGEST_CONTACT") or defaults.get("contact") or "contact not given"
    agent = str(_need(defaults, "user_agent_template", where)).format(contact=who.strip())
    try:
        policy = Policy(
            agent,
            interval=_need(defaults, "min_request_interval_seconds", where, float),
            attempts=_need(defaults, "max_attempts", where, int),
            backoff=_need(defaults, "backoff_base_seconds", where, float),
            timeout=_need(defaults, "timeout_seconds", where, float),
            respect_robots=bool(defaults.get("respect_robots", True)),
        )
    except ConfigError:
        raise
    except ValueError as e:
        raise ConfigError(f"{where}: {e}") from e
    out = {}
    for state, block in blocks.items():
        block, at = dict(block or {}), f"{where}.{state}"
        adapter = _need(block, "adapter", at)
        rest = {k: v for k, v in block.items() if k not in ("adapter", "plan_year", "market")}
        out[state] = Source(state, adapter, _need(defaults | block, "plan_year", at, int), _need(defaults | block, "market", at), rest)
    return Sources(policy, out)


@dataclass(frozen=True)
class ModelPrices:
    id: str
    effort: str
    max_tokens: int
    price_in: Decimal
    price_out: Decimal
    write_factor: Decimal
    read_factor: Decimal


@dataclass(frozen=True)
class Targets:
    """What to look for in the documents of a state and role. Patterns are lists, in order of preference."""

    version: int
    model: ModelPrices
    max_window_tokens: int
    max_window_pages: int
    identity_scan_pages: int | None
    anchors: Mapping = field(default_factory=dict)
    cross_checks: Mapping = field(default_factory=dict)
    sections: Mapping = field(default_factory=dict)
    identity_windows: Mapping = field(default_factory=dict)
    plan_tables: Mapping = field(default_factory=dict)
    skip_roles: Mapping[str, str] = field(default_factory=dict)

    def of(self, kind: str, state: str, role: str) -> Mapping:
        return getattr(self, kind).get(state, {}).get(role, {})


def _patterns(raw: Mapping, kind: str, where: str, captures: bool) -> dict:
    """state -> role -> field -> patterns; fields without patterns and patterns that don't compile are refused."""
    out: dict = {}
    for state, roles in (raw.get(kind) or {}).items():
        for role, fields in (roles or {}).items():
            for name, patterns in (fields or {}).items():
                at = f"{where}: {kind}.{state}.{role}.{name}"
                if not patterns:
                    raise ConfigError(f"{at} has no patterns")
                for p in patterns:
                    try:
                        n = re.compile(p).groups
                    except re.error as e:
                        raise ConfigError(f"{at}: {p!r} doesn't compile: {e}") from e
                    if captures and not n:
                        raise ConfigError(f"{at}: {p!r} captures nothing, so it could find no value")
                out.setdefault(state, {}).setdefault(role, {})[name] = list(patterns)
    return out


def _windows(raw: Mapping, kind: str, where: str, numbers: Mapping[str, int]) -> dict:
    """state -> role -> anchors and the numbers given for them, or their defaults."""
    out: dict = {}
    for state, roles in (raw.get(kind) or {}).items():
        for role, block in (roles or {}).items():
            block = block or {}
            try:
                for p in block.get("anchors") or ():
                    re.compile(p)
            except re.error as e:
                raise ConfigError(f"{where}: {kind}.{state}.{role}: {e}") from e
            out.setdefault(state, {})[role] = {"anchors": list(block.get("anchors") or ())} | {k: int(block.get(k, d)) for k, d in numbers.items()}
    return out


def load_targets(config: Mapping | str | Path, where: str = "targets") -> Targets:
    raw = config if isinstance(config, Mapping) else read_mapping(config)
    model, limits = (dict(_need(raw, k, where, dict)) for k in ("model", "limits"))
    scan = limits.get("identity_scan_pages")
    prices = ModelPrices(
        _need(model, "id", where),
        str(model.get("effort", "high")),
        int(model.get("max_tokens", 16000)),
        _need(model, "input_price_per_mtok", where, Decimal),
        _need(model, "output_price_per_mtok", where, Decimal),
        Decimal(str(model.get("cache_write_multiplier", "1.25"))),
        Decimal(str(model.get("cache_read_multiplier", "0.1"))),
    )
    return Targets(
        int(raw.get("version", 1)),
        prices,
        _need(limits, "max_window_tokens", where, int),
        _need(limits, "max_window_pages", where, int),
        None if scan is None else int(scan),
        _patterns(raw, "anchors", where, True),
        _patterns(raw, "cross_check_anchors", where, False),
        _patterns(raw, "sections", where, False),
        _windows(raw, "identity_windows", where, {"pages_after": 6, "fallback_pages": 8}),
        _windows(raw, "plan_tables", where, {"min_plan_ids_per_page": 2}),
        dict(raw.get("skip_roles") or {}),
    )


@dataclass(frozen=True)
class RuleSet:
    rules: list[Rule]
    reasons: Mapping[str, str]
    sources: Mapping[str, Sequence[str]]


def load_rule_set(config: Mapping | str | Path, where: str = "rules") -> RuleSet:
    """Rules, the rules that adopted reasons map to, and the roles that each grain counts on. A file may list params beside the
    rule's own keys or under params."""
    raw = config if isinstance(config, Mapping) else read_mapping(config)
    own = {"id", "check", "grain", "severity", "kind", "scope", "on_cell_error", "params", "description", "rationale"}
    entries = [{**{k: v for k, v in e.items() if k in own}, "params": {**{k: v for k, v in e.items() if k not in own}, **(e.get("params") or {})}} for e in raw.get("rules") or ()]
    if not entries:
        raise ConfigError(f"{where}: no rules")
    reasons = dict(raw.get("adopted_reasons") or {})
    try:
        rules = load_rules(entries, raw.get("cell_error_fields") or (), raw.get("sources_at_grain"), reasons)
    except RuleError as e:
        raise ConfigError(f"{where}: {e}") from e
    return RuleSet(rules, reasons, dict(raw.get("sources") or {}))
