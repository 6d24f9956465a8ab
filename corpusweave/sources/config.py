"""Options of a run: hierarchy, lists that aren't published, and predicates. Read and checked on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

# Spellings of the relation names.
RELATION_ALIASES = {
    "includes": ["includes", "include", "codelistItemIncludes", "CodelistItemIncludes", "Includes", "codelistItemInclude"],
    "includesAlso": ["includesAlso", "includeAlso", "codelistItemIncludesAlso", "CodelistItemIncludesAlso", "IncludesAlso", "codelistItemIncludeAlso"],
    "excludes": ["excludes", "exclude", "codelistItemExcludes", "CodelistItemExcludes", "Excludes", "codelistItemExclude"],
}
# Predicates unless configured.
DEFAULT_PREDICATES = {"includes": {"predicate": "skos:broader", "inversePredicate": "skos:narrower"}}
DEFAULT_EXTERNAL = {"https://data.gov.sk/id/legal-subject/": {"includes": "skos:broader"}}
_NESTED = ("relationPredicates", "relation_predicates", "relationMap")
_EXTERNAL = ("externalRelationPredicates", "external_relation_predicates", "externalPredicates")


def relation_key(name: str) -> str:
    """The usual spelling of a relation; an unknown one stays, its first letter lower-cased if that helps."""
    known = {a: k for k, names in RELATION_ALIASES.items() for a in names}
    name = name.strip()
    return known.get(name) or known.get(name[:1].lower() + name[1:]) or name


def is_uri(value: str) -> bool:
    return value.startswith(("http://", "https://"))


def base(value: str) -> str:
    return value.strip().rstrip("/") + "/"


@dataclass(frozen=True)
class Config:
    hierarchy: dict[str, str] = field(default_factory=dict)
    ignore: dict[str, dict] = field(default_factory=dict)
    relations: dict[str, dict[str, str]] = field(default_factory=lambda: {k: dict(v) for k, v in DEFAULT_PREDICATES.items()})
    external: dict[str, str | dict[str, str]] = field(default_factory=lambda: dict(DEFAULT_EXTERNAL))


def _mapping(value, what: str) -> dict:
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise ValueError(f"{what} must be an object")
    return value


def _first(raw: dict, names) -> dict:
    return next((raw[n] for n in names if raw.get(n)), {})


def parse(raw: dict) -> Config:
    """Spaces and slashes are tidied; predicates given override the defaults field by field; one relation under two spellings, or a
    section of the wrong shape, is an error."""
    raw = _mapping(raw, "config")
    tidy = lambda v: base(v) if is_uri(v.strip()) else v.strip()
    hierarchy = {k.strip(): tidy(v) for k, v in _mapping(raw.get("hierarchy"), "hierarchy").items() if k.strip() and str(v).strip()}
    relations, seen = {k: dict(v) for k, v in DEFAULT_PREDICATES.items()}, {}
    for name, given in _mapping(_first(raw, _NESTED), "relationPredicates").items():
        key = relation_key(name)
        if key in seen:
            raise ValueError(f"Relation {key} is configured twice: {seen[key]}, {name}")
        seen[key] = name
        given = {"predicate": given} if isinstance(given, str) else _mapping(given, name)
        relations.setdefault(key, {}).update({f: v.strip() for f, v in given.items() if f in ("predicate", "inversePredicate") and isinstance(v, str) and v.strip()})
    for key, names in RELATION_ALIASES.items():
        for f, endings in (("predicate", ("Predicate", "_predicate")), ("inversePredicate", ("InversePredicate", "PredicateInverse", "_inverse_predicate", "_predicate_inverse"))):
            flat = next((raw[n + e].strip() for n in names for e in endings if isinstance(raw.get(n + e), str) and raw[n + e].strip()), None)
            if flat:
                relations.setdefault(key, {})[f] = flat
    external: dict = dict(DEFAULT_EXTERNAL)
    for name, given in _mapping(_first(raw, _EXTERNAL), "externalRelationPredicates").items():
        if isinstance(given, str):
            external[base(name)] = given.strip()
            continue
        own: dict[str, str] = {}
        for rel, p in _mapping(given, name).items():
            key = rel if rel == "default" else relation_key(rel)
            if key in own:
                raise ValueError(f"Relation {key} is configured twice for {name}")
            own[key] = p.strip()
        external[base(name)] = own
    return Config(hierarchy, _mapping(raw.get("ignore"), "ignore"), relations, external)


def load(path: str | Path | None) -> Config:
    """The configuration of a JSON file; defaults if there is none."""
    if path is None or not Path(path).exists():
        return Config()
    return parse(json.loads(Path(path).read_text(encoding="utf-8")))


def predicate(config: Config, relation: str, inverse: bool = False) -> str | None:
    return config.relations.get(relation_key(relation), {}).get("inversePredicate" if inverse else "predicate")


def external_predicate(config: Config, uri: str, relation: str) -> str | None:
    """By the longest base that begins the URI: the relation's own, else the default."""
    for b in sorted((b for b in config.external if base(uri).startswith(b)), key=len, reverse=True):
        v = config.external[b]
        found = v if isinstance(v, str) else v.get(relation_key(relation), v.get("default"))
        if found:
            return found
    return None
