"""Signals read from an owner's name: entity type and keywords."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole words that mark a business, the word that marks a trust,
# the opening that marks an estate, and the keywords searched in raw names.
BUSINESS_WORDS = (
    "LLC",
    "L.L.C.",
    "INC",
    "INC.",
    "CORP",
    "CORP.",
    "CO.",
    "LP",
    "L.P.",
    "LLP",
    "L.L.P.",
    "PARTNERS",
    "FUND",
    "ASSOCIATES",
    "ASSOC",
    "COMPANY",
    "HOLDINGS",
    "GROUP",
    "ENTERPRISES",
    "SOLUTIONS",
    "SERVICES",
)
TRUST_WORD = "TRUST"
ESTATE_OPENING = "ESTATE OF "
NAME_KEYWORDS = ("estate", "trust", "heir", "deceased", "beneficiary")


def detect_entity_type(name: Column) -> Column:
    """Entity type of an already normalized name.

    The order decides: estate opening, business word, trust word, individual.
    """
    padded = F.concat(F.lit(" "), name, F.lit(" "))
    business = " (?:" + "|".join(map(re.escape, BUSINESS_WORDS)) + ") "
    return (
        F.when(F.coalesce(name, F.lit("")) == "", "unknown")
        .when(F.startswith(name, F.lit(ESTATE_OPENING)), "estate")
        .when(padded.rlike(business), "business")
        .when(padded.contains(f" {TRUST_WORD} "), "estate")
        .otherwise("individual")
    )


def find_name_keywords(name: Column) -> Column:
    """Keywords contained anywhere in the raw name, in list order.

    Built from ``array`` and ``array_remove`` so that it stays inside generated
    code; a higher-order ``filter`` would leave it.
    """
    lowered = F.lower(F.coalesce(name, F.lit("")))
    hits = [
        F.when(F.contains(lowered, F.lit(word)), word).otherwise("")
        for word in NAME_KEYWORDS
    ]
    return F.array_remove(F.array(*hits), "")
