"""From raw rows of many sources to the common listing columns.

A source is registered as ``{source: mapping}``. Most sources only rename cells:
they use ``KeyMapping``, and all of them together become one lookup per column
whose key depends on the source. Any other callable from the ``raw_data`` column
to common columns works too.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.functions.amounts import lower_bound_of_stripped, lower_bound_text
from leadmill.functions.names import find_name_keywords
from leadmill.functions.text import null_if_empty, strip

SourceMapping = Callable[[Column], Mapping[str, Column]]
Registry = Mapping[str, SourceMapping]

TEXT_COLUMNS = (
    "owner_name",
    "address_line1",
    "city",
    "state",
    "zip",
    "claim_amount_text",
    "property_type",
)
COMMON_COLUMNS = (*TEXT_COLUMNS, "keywords_found")

# Raw columns that stay with a row through normalization.
RAW_KEYS = ("id", "source", "ingested_at", "origin", "ingest_seq")


def no_keywords() -> Column:
    return F.array().cast("array<string>")


@dataclass(frozen=True)
class KeyMapping:
    """Mapping by key lookup; a key that is not given leaves its column null.

    ``amount_ranges`` reduces a worded amount to its lower bound, and
    ``name_keywords`` searches the raw owner name for keywords.
    """

    owner_name: str | None = None
    address_line1: str | None = None
    city: str | None = None
    state: str | None = None
    zip: str | None = None
    claim_amount_text: str | None = None
    property_type: str | None = None
    amount_ranges: bool = False
    name_keywords: bool = False

    def __call__(self, raw_data: Column) -> dict[str, Column]:
        columns = {
            name: F.try_element_at(raw_data, F.lit(getattr(self, name)).cast("string"))
            for name in TEXT_COLUMNS
        }
        if self.name_keywords:
            columns["keywords_found"] = find_name_keywords(columns["owner_name"])
        if self.amount_ranges:
            columns["claim_amount_text"] = lower_bound_text(columns["claim_amount_text"])
        return columns


# The common state-holder report layout.
LISTING = KeyMapping(
    owner_name="owner_name",
    address_line1="owner_address",
    city="owner_city",
    state="owner_state",
    zip="owner_zip",
    claim_amount_text="claim_amount",
    property_type="property_type_description",
    amount_ranges=True,
    name_keywords=True,
)

# Fixed value: the source id that layout is registered under.
DEFAULT_REGISTRY: Registry = {"sample_us_unclaimed": LISTING}


def fingerprint(registry: Registry) -> str:
    """Changes when a source or the columns its mapping gives change."""
    described = {
        source: {name: str(column) for name, column in mapping(F.col("raw_data")).items()}
        for source, mapping in registry.items()
    }
    text = json.dumps(described, sort_keys=True)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def registered(raw: DataFrame, registry: Registry) -> DataFrame:
    return raw.where(F.col("source").isin(*registry))


def unregistered(raw: DataFrame, registry: Registry) -> DataFrame:
    return raw.where(~F.col("source").isin(*registry))


def _choose(choices: Mapping[object, list[str]]) -> Column:
    """The value whose list of sources has the row's source; a single one as is."""
    if len(choices) == 1:
        return F.lit(next(iter(choices)))
    ladder: Column | None = None
    for value, sources in choices.items():
        hit = F.col("source").isin(*sources)
        ladder = (
            F.when(hit, F.lit(value)) if ladder is None else ladder.when(hit, F.lit(value))
        )
    return ladder


def _extract_by_keys(
    raw: DataFrame, mappings: Mapping[str, KeyMapping], extra: tuple[str, ...]
) -> DataFrame:
    def chosen(field: str) -> Column:
        choices: dict[object, list[str]] = {}
        for source, mapping in mappings.items():
            choices.setdefault(getattr(mapping, field), []).append(source)
        return _choose(choices)

    cells = raw.where(F.col("source").isin(*mappings)).select(
        *RAW_KEYS,
        *extra,
        *[
            F.try_element_at("raw_data", chosen(name).cast("string")).alias(name)
            for name in TEXT_COLUMNS
        ],
        chosen("amount_ranges").alias("ranges"),
        chosen("name_keywords").alias("keywords"),
    )
    # A column of its own for each step, as an expression used in several places
    # of the next one would be evaluated in each of them.
    amount = F.col("claim_amount_text")
    stripped = cells.withColumn(
        "claim_amount_text",
        F.when(F.col("ranges"), null_if_empty(strip(amount))).otherwise(amount),
    )
    return stripped.select(
        *RAW_KEYS,
        *extra,
        *[name for name in TEXT_COLUMNS if name != "claim_amount_text"],
        F.when(F.col("ranges"), lower_bound_of_stripped(amount))
        .otherwise(amount)
        .alias("claim_amount_text"),
        F.when(F.col("keywords"), find_name_keywords(F.col("owner_name")))
        .otherwise(no_keywords())
        .alias("keywords_found"),
    )


def _extract_by_callable(
    raw: DataFrame, sources: list[str], mapping: SourceMapping, extra: tuple[str, ...]
) -> DataFrame:
    given = dict(mapping(F.col("raw_data")))
    unknown = set(given) - set(COMMON_COLUMNS)
    if unknown:
        raise ValueError(f"mapping returns unknown columns {sorted(unknown)}")
    texts = [
        given.get(name, F.lit(None)).cast("string").alias(name) for name in TEXT_COLUMNS
    ]
    keywords = F.coalesce(given.get("keywords_found", no_keywords()), no_keywords())
    return raw.where(F.col("source").isin(*sources)).select(
        *RAW_KEYS, *extra, *texts, keywords.alias("keywords_found")
    )


def extract(raw: DataFrame, registry: Registry, *extra: str) -> DataFrame:
    """Rows of registered sources in the common shape.

    The keys of the raw row and any ``extra`` columns are kept. All key mappings
    share one pass; each other mapping reads its own sources, which partitioning
    by source keeps apart.
    """
    by_keys = {s: m for s, m in registry.items() if isinstance(m, KeyMapping)}
    by_callable: dict[SourceMapping, list[str]] = {}
    for source, mapping in registry.items():
        if source not in by_keys:
            by_callable.setdefault(mapping, []).append(source)
    if not registry:
        raise ValueError("no source is registered")

    parts = [_extract_by_keys(raw, by_keys, extra)] if by_keys else []
    parts += [
        _extract_by_callable(raw, sources, mapping, extra)
        for mapping, sources in by_callable.items()
    ]
    return reduce(DataFrame.unionByName, parts)
