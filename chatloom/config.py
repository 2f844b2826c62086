"""Configuration files (YAML), each with a default beside this module.

The folder in CHATLOOM_CONFIG overrides defaults file by file. Files are read on the driver and
remembered by folder; operators take the objects made of them as parameters.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import lru_cache
from pathlib import Path
from typing import Any

from chatloom.functions.lexicon import DOMAINS, KEYWORDS, LANGUAGES, REGIONS, Domains, LanguageProfile, RegionProfile

DEFAULTS = Path(__file__).resolve().parent / "defaults"
VARIABLE = "CHATLOOM_CONFIG"


def folder() -> Path | None:
    """The folder of overrides, if one is set."""
    return Path(os.environ[VARIABLE]) if os.environ.get(VARIABLE) else None


@lru_cache(maxsize=64)
def _read(path: Path) -> Any:
    try:
        import yaml
    except ImportError as e:
        raise ImportError("configuration files need PyYAML") from e
    return yaml.safe_load(path.read_text(encoding="utf-8")) or {}


def load(name: str, needed: bool = True) -> Any:
    """The content of NAME.yaml: the override's, else the default's; {} for an empty one.

    A file that is in neither place is an error, or {} where it isn't needed.
    """
    for place in (folder(), DEFAULTS):
        if place is not None and (path := place / f"{name}.yaml").exists():
            return _read(path)
    if needed:
        raise FileNotFoundError(f"no {name}.yaml in {folder() or DEFAULTS}")
    return {}


def forget() -> None:
    """Read files anew from now on."""
    _read.cache_clear()


def fact_schema() -> dict[str, Any]:
    """What is extracted from chunks: `prompt_intro`, `prompt_rules`, `categories` with `field` and `fields`."""
    return load("fact_schema")


def fact_categories(schema: Mapping[str, Any] | None = None) -> list[str]:
    return [c["field"] for c in (fact_schema() if schema is None else schema).get("categories", [])]


def retrieval_queries(language: str) -> dict[str, str]:
    """Retrieval queries by name for a language, those of English where it has none."""
    every = load("queries")
    return every.get(language, every.get("en", {}))


def brand_patterns() -> dict[str, str]:
    """Label -> pattern of the brand audit; case is ignored."""
    return load("brand_patterns")


def labels() -> dict[str, str]:
    """Section -> title on the dashboard."""
    return load("labels").get("titles", {})


def domains() -> Domains:
    """The default domains, with the categories by host and lists that domains.yaml changes."""
    told = load("domains", needed=False)
    by_host = dict(DOMAINS.by_host) | {k: tuple(v) for k, v in told.items() if k not in ("official", "impersonator")}
    return Domains(tuple(told.get("impersonator", DOMAINS.impersonator)), tuple(told.get("official", DOMAINS.official)), tuple(by_host.items()))


def keywords() -> dict[str, dict[str, tuple[str, ...]]]:
    """The default keyword labels; a category in keywords.yaml replaces the default one."""
    told = load("keywords", needed=False)
    return KEYWORDS | {category: {label: tuple(words) for label, words in some.items()} for category, some in told.items()}


def languages() -> dict[str, LanguageProfile]:
    """The default language profiles and those of languages.yaml (ranges or stopwords, threshold)."""
    told = load("languages", needed=False)
    made = {code: LanguageProfile(code, tuple(tuple(r) for r in x.get("ranges", ())), float(x.get("threshold", 0.3)), frozenset(x.get("stopwords", ()))) for code, x in told.items()}
    return LANGUAGES | made


def regions() -> dict[str, RegionProfile]:
    """The default regions and those of regions.yaml (hours as name -> [first, last], shadow, providers)."""
    told = load("regions", needed=False)
    made = {
        code: RegionProfile(code, tuple((n, int(a), int(b)) for n, (a, b) in x.get("hours", {}).items()), {k: tuple(v) for k, v in x.get("shadow", {}).items()}, frozenset(x.get("providers", ())))
        for code, x in told.items()
    }
    return REGIONS | made


def numbered(lines: Sequence[str]) -> str:
    return "\n".join(f"- {line}" for line in lines)


def extraction_prompt(schema: Mapping[str, Any], language: str) -> str:
    """what a model is asked to extract from a chunk, before the chunk's messages."""
    shapes = ",\n".join(f'  "{c["field"]}": [{{' + ", ".join(f'"{k}": {v}' for k, v in c.get("fields", {}).items()) + "}]" for c in schema.get("categories", []))
    return (
        f"The lines below are part of the chat of a product's community, mostly in {language}. {schema.get('prompt_intro', '').strip()}\n\n"
        f"{{\n{shapes}\n}}\n\nRules:\n{numbered(schema.get('prompt_rules', []))}\n\nMESSAGES:\n"
    )
