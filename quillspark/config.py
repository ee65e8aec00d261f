"""The relevance lens: facets, how they combine, and which document kinds are noise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    """A configuration that can't be used, said in a sentence."""


@dataclass(frozen=True)
class Lens:
    """facets: name to pattern, in declaration order. A record is core if at least min_topics facets match, all of
    `require` among them, and its kind is not noise."""

    facets: Mapping[str, str]
    require: Sequence[str] = ()
    min_topics: int = 1
    noise_doctypes: Sequence[str] = ()
    concept_areas: Sequence[str] = field(default_factory=tuple)
    leaks: Sequence[tuple[str, str]] = ()  # pattern and name of what notes should not say; none: the usual ones
    verification: str = "Citation check"  # the heading of verification records, as a pattern

    def __post_init__(self) -> None:
        unknown = [f for f in self.require if f not in self.facets]
        if unknown:
            raise ConfigError(f"required facets that aren't declared: {', '.join(unknown)}; declared: {', '.join(self.facets)}")
        if not self.min_topics:
            object.__setattr__(self, "min_topics", 1)


def require_field(entry: Mapping[str, Any], name: str, where: str) -> Any:
    value = entry.get(name)
    if value in (None, ""):
        raise ConfigError(f"{where}: the field '{name}' is missing")
    return value


def load_yaml(path: str | Path) -> dict[str, Any]:
    """A YAML file as a dict; an empty file is an empty dict."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def lens_from(objective: Mapping[str, Any]) -> Lens:
    """The lens of an objective mapping: relevance.topics, require, min_topics, noise_doctypes; concept_areas."""
    relevance = require_field(objective, "relevance", "objective")
    return Lens(require_field(relevance, "topics", "relevance"), tuple(relevance.get("require") or ()), int(relevance.get("min_topics") or 1), tuple(relevance.get("noise_doctypes") or ()), tuple(objective.get("concept_areas") or ()), tuple((p, n) for n, p in (objective.get("leaks") or {}).items()), objective.get("verification") or "Citation check")


def by_slug(registry: Mapping[str, Mapping[str, Any]], slug: str) -> tuple[str, Mapping[str, Any]]:
    """The entry of a registry whose slug (or whose name, where it has none) is this one."""
    for name, entry in registry.items():
        if (entry or {}).get("slug", name) == slug:
            return name, entry or {}
    raise ConfigError(f"no entry with the slug '{slug}'; there are: {', '.join(sorted((e or {}).get('slug', n) for n, e in registry.items()))}")
