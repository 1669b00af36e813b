"""Additive scoring rules, compiled once from a config into columns.

The breakdown is a struct with a null entry for each rule that did not fire,
so its JSON form holds only the rules that did.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIORITIES = ("high", "medium", "low")
ENTITY_TYPES = ("individual", "business", "estate", "unknown")

# The default scoring rules.
DEFAULT_RULES: dict[str, Any] = {
    "amount_tiers": [
        {"min": 25000, "points": 35, "label": "tier_25k_plus"},
        {"min": 10000, "points": 25, "label": "tier_10k"},
        {"min": 5000, "points": 18, "label": "tier_5k"},
        {"min": 1000, "points": 10, "label": "tier_1k"},
        {"min": 100, "points": 4, "label": "tier_100"},
    ],
    "entity_type": {"estate": 18, "business": 8, "individual": 5, "unknown": 0},
    "keywords": {
        "heir": 15,
        "deceased": 12,
        "estate": 8,
        "trust": 6,
        "beneficiary": 8,
    },
    "age_years": [
        {"min": 10, "points": 10},
        {"min": 5, "points": 6},
        {"min": 2, "points": 2},
    ],
    "has_address": 5,
    "priority_thresholds": {"high": 50, "medium": 25},
}

# Joins keywords for one lower-casing pass; not a character of any keyword.
_JOINER = "\x01"


def load_rules(path: str | Path | None = None) -> dict[str, Any]:
    """Rules from a YAML or JSON file, or the defaults; must be a mapping."""
    if path is None:
        return DEFAULT_RULES
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix == ".json":
        rules = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading YAML rules needs PyYAML; use JSON") from missing
        rules = yaml.safe_load(text) or {}
    if not isinstance(rules, Mapping):
        raise ValueError(f"scoring rules at {path} must be a mapping")
    return dict(rules)


def _whole(points: Any) -> int:
    if isinstance(points, bool) or int(points) != points:
        raise ValueError(f"points must be whole numbers, got {points!r}")
    return int(points)


def _ladder(value: Column, tiers: list[Mapping[str, Any]], entry) -> Column:
    """Entry of the first tier, in list order, whose minimum is reached."""
    ladder: Column | None = None
    for tier in tiers:
        reached = value >= F.lit(tier["min"])
        result = entry(tier)
        ladder = F.when(reached, result) if ladder is None else ladder.when(reached, result)
    return ladder


def amount_entry(amount: Column, rules: Mapping[str, Any]) -> Column | None:
    tiers = rules.get("amount_tiers") or []
    if not tiers:
        return None
    return _ladder(
        amount,
        tiers,
        lambda tier: F.struct(
            F.lit(tier["label"]).alias("matched"),
            F.lit(_whole(tier["points"])).alias("points"),
        ),
    )


def entity_entry(entity_type: Column, rules: Mapping[str, Any]) -> Column | None:
    ladder: Column | None = None
    for name, value in (rules.get("entity_type") or {}).items():
        points = _whole(value)
        if not points:
            continue
        result = F.struct(
            F.lit(name).alias("matched"), F.lit(points).alias("points")
        )
        matches = entity_type == F.lit(name)
        ladder = F.when(matches, result) if ladder is None else ladder.when(matches, result)
    return ladder


def keyword_entry(keywords: Column, rules: Mapping[str, Any]) -> Column | None:
    """Sum over every found keyword, repeats included; matches listed once.

    ``array_remove`` and ``array_intersect`` keep this inside generated code,
    which the higher-order array functions would leave.
    """
    points = {
        str(word).lower(): _whole(value)
        for word, value in (rules.get("keywords") or {}).items()
    }
    if not points:
        return None
    found = F.split(F.lower(F.array_join(keywords, _JOINER)), _JOINER)
    matched = F.array_intersect(found, F.array(*[F.lit(word) for word in points]))
    total = F.lit(0)
    for word, value in points.items():
        repeats = F.size(found) - F.size(F.array_remove(found, word))
        total = total + repeats * F.lit(value)
    return F.when(
        F.size(matched) > 0,
        F.struct(matched.alias("matched"), total.alias("points")),
    )


def age_entry(age: Column, rules: Mapping[str, Any]) -> Column | None:
    tiers = rules.get("age_years") or []
    if not tiers:
        return None
    return _ladder(
        age,
        tiers,
        lambda tier: F.struct(
            F.lit(int(tier["min"])).alias("matched_min"),
            F.lit(_whole(tier["points"])).alias("points"),
        ),
    )


def address_entry(parts: list[Column], rules: Mapping[str, Any]) -> Column | None:
    points = _whole(rules.get("has_address") or 0)
    if not points:
        return None
    present = F.concat_ws("", *parts) != ""
    return F.when(present, F.struct(F.lit(points).alias("points")))


# Entry names in breakdown order with the type used where a rule is not configured.
_ENTRY_TYPES = {
    "amount_tier": "struct<matched:string,points:int>",
    "entity_type": "struct<matched:string,points:int>",
    "keywords": "struct<matched:array<string>,points:int>",
    "age_years": "struct<matched_min:int,points:int>",
    "has_address": "struct<points:int>",
}


def rule_entries(rules: Mapping[str, Any]) -> dict[str, Column]:
    """One nullable struct column per rule, over the normalized columns."""
    entries = {
        "amount_tier": amount_entry(F.col("claim_amount"), rules),
        "entity_type": entity_entry(F.col("entity_type"), rules),
        "keywords": keyword_entry(F.col("keywords_found"), rules),
        "age_years": age_entry(F.col("record_age_years"), rules),
        "has_address": address_entry(
            [F.col(name) for name in ("address_line1", "city", "state", "zip")], rules
        ),
    }
    return {
        name: (F.lit(None) if entry is None else entry).cast(_ENTRY_TYPES[name])
        for name, entry in entries.items()
    }


def total_points(entries: Mapping[str, Column]) -> Column:
    total = F.lit(0)
    for entry in entries.values():
        total = total + F.coalesce(entry["points"], F.lit(0))
    return total


def priority_of(score: Column, rules: Mapping[str, Any]) -> Column:
    """High, medium or low; a threshold that is not configured is skipped."""
    thresholds = rules.get("priority_thresholds") or {}
    ladder: Column | None = None
    for name in ("high", "medium"):
        if thresholds.get(name) is None:
            continue
        reached = score >= F.lit(thresholds[name])
        ladder = F.when(reached, name) if ladder is None else ladder.when(reached, name)
    return F.lit("low") if ladder is None else ladder.otherwise("low")
