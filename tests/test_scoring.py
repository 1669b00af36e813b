"""Scoring rules."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leadmill.functions.rules import DEFAULT_RULES, load_rules
from leadmill.operators import scoring

RULES = {
    "amount_tiers": [
        {"min": 8000, "points": 21, "label": "large"},
        {"min": 600, "points": 9, "label": "middling"},
    ],
    "entity_type": {"estate": 16, "business": 7, "individual": 3, "unknown": 0},
    "keywords": {"heir": 11, "deceased": 13},
    "age_years": [{"min": 12, "points": 9}, {"min": 4, "points": 5}],
    "has_address": 4,
    "priority_thresholds": {"high": 35, "medium": 18},
}
_SCHEMA = (
    "at INT, id STRING, owner_name_normalized STRING, entity_type STRING,"
    " claim_amount DECIMAL(14,2), record_age_years INT, keywords_found ARRAY<STRING>,"
    " address_line1 STRING, city STRING, state STRING, zip STRING"
)


def _score(spark, records, rules=RULES):
    blank = {
        "entity_type": "individual", "claim_amount": None, "record_age_years": None,
        "keywords_found": [], "address_line1": None, "city": None, "state": None,
        "zip": None,
    }
    data = [
        (at, str(at), "X", *[{**blank, **record}[name] for name in blank])
        for at, record in enumerate(records)
    ]
    rows = scoring.apply_rules(spark.createDataFrame(data, _SCHEMA), rules)
    got = rows.orderBy("at").select(
        "score", "priority", F.to_json("score_breakdown").alias("text")
    )
    return [(row.score, row.priority, json.loads(row.text)) for row in got.collect()]


def test_amount_tiers(spark):
    amounts = [Decimal(12345), Decimal(777), None, Decimal(41), Decimal(8000), Decimal("7999.99")]
    got = _score(spark, [{"claim_amount": amount} for amount in amounts])
    large = {"matched": "large", "points": 21}
    middling = {"matched": "middling", "points": 9}
    assert [entry[2].get("amount_tier") for entry in got] == [
        large, middling, None, None, large, middling]


def test_tiers_go_by_list_order(spark):
    rules = {"amount_tiers": [{"min": 1, "points": 1, "label": "low"},
                              {"min": 100, "points": 9, "label": "high"}]}
    assert _score(spark, [{"claim_amount": Decimal(500)}], rules) == [
        (1, "low", {"amount_tier": {"matched": "low", "points": 1}, "total": 1})]


def test_entity_keywords_age_and_address(spark):
    got = _score(spark, [
        {"entity_type": "estate"}, {"entity_type": "unknown"},
        {"keywords_found": ["HEIR", "else"]}, {"keywords_found": ["heir", "deceased"]},
        {"keywords_found": ["nothing"]}, {"keywords_found": ["heir", "Heir"]},
        {"keywords_found": None}, {"record_age_years": 14}, {"record_age_years": 4},
        {"city": "Averton"}, {"zip": "", "state": ""},
    ])
    parts = [entry[2] for entry in got]
    assert parts[0]["entity_type"] == {"matched": "estate", "points": 16}
    assert parts[1] == {"total": 0}
    assert parts[2]["keywords"] == {"matched": ["heir"], "points": 11}
    assert parts[3]["keywords"] == {"matched": ["heir", "deceased"], "points": 24}
    assert "keywords" not in parts[4]
    assert parts[5]["keywords"] == {"matched": ["heir"], "points": 22}
    assert "keywords" not in parts[6]
    assert parts[7]["age_years"] == {"matched_min": 12, "points": 9}
    assert parts[8]["age_years"] == {"matched_min": 4, "points": 5}
    assert parts[9]["has_address"] == {"points": 4}
    assert "has_address" not in parts[10]
    assert all(score == part["total"] for score, _, part in got)


def test_priority(spark):
    got = _score(spark, [
        {"claim_amount": Decimal(9100), "entity_type": "estate", "city": "Averton"},
        {"claim_amount": Decimal(640), "entity_type": "business", "city": "Averton"},
        {"claim_amount": Decimal(640)},
    ])
    assert [entry[:2] for entry in got] == [
        (21 + 16 + 4, "high"), (9 + 7 + 4, "medium"), (9 + 3, "low")]


def test_missing_sections_and_thresholds(spark):
    record = [{"claim_amount": Decimal(15000), "entity_type": "estate", "city": "B"}]
    assert _score(spark, record, {}) == [(0, "low", {"total": 0})]
    only_medium = {"has_address": 5, "priority_thresholds": {"medium": 5}}
    assert _score(spark, record, only_medium)[0][:2] == (5, "medium")
    only_high = {"has_address": 5, "priority_thresholds": {"high": 5}}
    assert _score(spark, record, only_high)[0][:2] == (5, "high")


def test_rules_files(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(RULES))
    assert load_rules(path) == RULES
    path.write_text("[1, 2]")
    with pytest.raises(ValueError):
        load_rules(path)
    assert load_rules() is DEFAULT_RULES
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yaml"
    path.write_text("has_address: 5\n")
    assert load_rules(path) == {"has_address": 5}


def test_points_must_be_whole(spark):
    with pytest.raises(ValueError):
        _score(spark, [{}], {"has_address": 1.5})


def test_business_is_never_high_by_default_without_keywords(spark):
    got = _score(spark, [
        {"claim_amount": Decimal(10**9), "entity_type": "business", "city": "B"},
        {"claim_amount": Decimal(10**9), "entity_type": "individual", "city": "B"},
    ], DEFAULT_RULES)
    assert [entry[:2] for entry in got] == [(48, "medium"), (45, "medium")]


def test_counts_fill_missing_priorities(spark):
    rows = spark.createDataFrame([("low",), ("low",)], "priority STRING")
    counts = scoring.count_by_priority(rows).collect()
    assert [tuple(row) for row in counts] == [("high", 0), ("medium", 0), ("low", 2)]
    assert scoring.score_summary(rows.limit(0)).first().processed == 0
