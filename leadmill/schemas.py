"""Columns of the stored layers."""

from __future__ import annotations

RAW = """
    id STRING, source STRING, raw_data MAP<STRING, STRING>, ingested_at TIMESTAMP,
    file_batch_id STRING, origin STRING, ingest_seq BIGINT
"""

NORMALIZED = """
    id STRING, raw_record_id STRING, owner_name_normalized STRING,
    entity_type STRING, address_line1 STRING, city STRING, state STRING, zip STRING,
    claim_amount DECIMAL(14,2), property_type STRING, record_age_years INT,
    keywords_found ARRAY<STRING>, source STRING, dedup_hash STRING,
    created_at TIMESTAMP
"""

# The hash of every normalized row that has one, with the row's id.
HASHES = "dedup_hash STRING, id STRING"

BREAKDOWN = """
    STRUCT<
        amount_tier: STRUCT<matched: STRING, points: INT>,
        entity_type: STRUCT<matched: STRING, points: INT>,
        keywords: STRUCT<matched: ARRAY<STRING>, points: INT>,
        age_years: STRUCT<matched_min: INT, points: INT>,
        has_address: STRUCT<points: INT>,
        total: INT>
"""

SCORED = f"""
    id STRING, normalized_record_id STRING, score INT, priority STRING,
    score_breakdown {BREAKDOWN}, exported_to_crm BOOLEAN, exported_at TIMESTAMP,
    crm_record_id STRING, created_at TIMESTAMP
"""

LEADS = f"""
    {SCORED}, raw_record_id STRING, owner_name STRING, entity_type STRING,
    address_line1 STRING, city STRING, state STRING, zip STRING,
    claim_amount DECIMAL(14,2), property_type STRING, keywords_found ARRAY<STRING>,
    source STRING, dedup_hash STRING
"""

# How many leads of a priority have a score and begin their id alike.
RANKS = "priority STRING, score INT, slice STRING, leads_in BIGINT"

# One row per lead of a pushed export batch.
EXPORT_RESULTS = """
    lead_id STRING, external_id STRING, ok BOOLEAN, exported_at TIMESTAMP
"""
