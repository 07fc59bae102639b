"""Event types and their cleaning rules, loaded from YAML."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from eventlake.functions.preprocess import Preprocess, get_preprocess

log = logging.getLogger(__name__)

CONFIG_FILE = Path(__file__).parent.parent / "config" / "event_types.yml"
_REQUIRED = ("event_type", "event_filter", "silver_table")


@dataclass(frozen=True)
class EventType:
    event_type: str
    event_filter: str
    silver_table: str
    rules: list[Mapping[str, Any]] = field(default_factory=list)
    preprocess: Preprocess | None = None


def load_rules(path: str | Path) -> list[Mapping[str, Any]]:
    """Rules of one YAML file; an unreadable or invalid file yields no rules."""
    try:
        document = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as error:
        log.error("cannot load rules from %s: %s", path, error)
        return []
    return (document or {}).get("transformations") or []


def load_event_types(path: str | Path = CONFIG_FILE) -> list[EventType]:
    """Read the event-type registry.

    Each entry carries its cleaning rules inline under ``transformations`` or names a
    rule file, relative to the registry, under ``rules_file``.
    """
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"event type registry not found: {path}")
    try:
        document = yaml.safe_load(path.read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ValueError(f"invalid YAML in {path}: {error}") from error
    if not document or "events" not in document:
        raise ValueError(f"{path} must have the key 'events'")

    event_types = []
    for entry in document["events"]:
        absent = [name for name in _REQUIRED if name not in entry]
        if absent:
            raise ValueError(f"event type {entry} lacks {absent}")
        rules = entry.get("transformations") or []
        if "rules_file" in entry:
            rules = load_rules(path.parent / entry["rules_file"])
        event_types.append(
            EventType(
                **{name: entry[name] for name in _REQUIRED},
                rules=rules,
                preprocess=get_preprocess(entry.get("preprocessing")),
            )
        )
    return event_types


def default_event_types() -> dict[str, EventType]:
    """The shipped event types by silver table name."""
    return {event_type.silver_table: event_type for event_type in load_event_types()}
