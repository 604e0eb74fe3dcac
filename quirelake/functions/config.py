"""Profiles from a YAML file, so that lists, patterns and thresholds change without code."""

from __future__ import annotations

import dataclasses

from quirelake.functions import patterns as P


def load(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("a YAML configuration needs PyYAML") from e
    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    if not isinstance(found, dict):
        raise ValueError(f"{path} isn't a mapping")
    return found


def _get(tree: dict, *keys, default=None):
    for k in keys:
        tree = tree.get(k, {}) if isinstance(tree, dict) else {}
    return tree if tree not in ({}, None) else default


def rules_of(config: dict, name: str) -> P.Rules:
    """Rules of a profile of a configuration; what it doesn't say is as in the built-in profile of that name."""
    profiles = config.get("profiles", {})
    if name not in profiles and name not in P.PROFILES:
        raise KeyError(f"no profile {name!r}; there are {', '.join(sorted({*profiles, *P.PROFILES}))}")
    base, prof = P.PROFILES.get(name, P.GENERIC), profiles.get(name, {})
    heads = lambda key, old: tuple((h["level"], h["pattern"]) for h in prof[key]) if key in prof else old
    pre = ("preserve",)
    return dataclasses.replace(
        base, name=name, label=prof.get("label", base.label),
        case_suffixes=tuple(_get(config, *pre, "case_suffixes", default=base.case_suffixes)), known_suffixes=tuple(_get(config, *pre, "known_suffixes", default=base.known_suffixes)),
        year_min=int(_get(config, *pre, "year_min", default=base.year_min)), year_max=int(_get(config, *pre, "year_max", default=base.year_max)),
        token_min=int(_get(config, *pre, "mnemonic", "token_min", default=base.token_min)), token_max=int(_get(config, *pre, "mnemonic", "token_max", default=base.token_max)),
        max_tokens=int(_get(config, *pre, "mnemonic", "max_tokens", default=base.max_tokens)), mnemonic_max=int(_get(config, *pre, "mnemonic", "max_total_len", default=base.mnemonic_max)),
        deny_words=tuple(_get(config, *pre, "mnemonic", "deny_words", default=base.deny_words)), stars=tuple(_get(config, *pre, "star", "chars", default=base.stars)), star_gap=int(_get(config, *pre, "star", "max_gap", default=base.star_gap)),
        note_min=int(_get(config, *pre, "footnote", "number_min", default=base.note_min)), note_max=int(_get(config, *pre, "footnote", "number_max", default=base.note_max)),
        tail_lines=int(_get(config, *pre, "footnote", "markdown_tail_lines", default=base.tail_lines)), inline_refs=bool(_get(config, *pre, "footnote", "inline_ref_from_numbers", default=base.inline_refs)),
        date_hangul=_get(config, "normalize", "date_trailing_hangul", default=base.date_hangul), join=_get(config, "paragraph", "join", default=base.join),
        century=int(_get(config, "legend", "exam_year", "century_split", default=base.century)), bonus_lines=int(_get(config, "legend", "bonus", "max_lines", default=base.bonus_lines)),
        side_tolerance=float(_get(config, "legend", "sidenote", "match_tolerance", default=base.side_tolerance)),
        headings=heads("headings", base.headings), answer_headings=heads("answer_headings", base.answer_headings), section_item=prof.get("section_item", base.section_item), section_max=int(prof.get("section_max_len", base.section_max)),
        problem=prof.get("problem", base.problem), score=prof.get("score", base.score), score_max=float(prof.get("score_max", base.score_max)), flush_level=int(prof.get("footnote_flush_level", base.flush_level)),
        split=prof.get("split", base.split), split_max_bytes=int(prof.get("split_max_bytes", base.split_max_bytes)), prompt_words=tuple(prof.get("prompt_markers", base.prompt_words)), answer_words=tuple(prof.get("answer_markers", base.answer_words)),
    )
