"""DuckDB SQL for the queries of the catalog, over the same tables."""

from __future__ import annotations

from leadmill.functions.names import BUSINESS_WORDS
from leadmill.operators.export import PAYLOAD_COLUMNS

_NUMBER = r"\s*\$?\s*([0-9][0-9,]*(?:\.\d+)?)"
_FREEFORM = r"^(.*?),\s*([^,]+),\s*([A-Za-z]{2})\s+(\d{5}(?:-\d{4})?)$"
_KEYS = ",".join(["export_batch", "position", "lead_id", *PAYLOAD_COLUMNS])
_CUTOFF = "TIMESTAMP '1997-01-01 00:00:00'"


def _uuid(text: str) -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({text}), {at}, {n})" for at, n in cuts)


def _squash(value: str) -> str:
    return rf"regexp_replace(trim({value}), '\s+', ' ', 'g')"


def _address_part(position: int) -> str:
    return f"nullif(regexp_extract(line0, '{_FREEFORM}', {position}), '')"


_LISTINGS = """
listing0 AS (
  SELECT o_orderkey * 2 AS seq,
    CASE o_orderkey % 3 WHEN 0 THEN 'src_a' WHEN 1 THEN 'src_b'
         ELSE 'src_unregistered' END AS source,
    o_orderdate AS listed_at,
    'P-' || CAST(o_orderkey AS VARCHAR) AS property_id,
    CASE o_custkey % 10
      WHEN 0 THEN 'estate of ' || c_name WHEN 1 THEN c_name || ' LLC'
      WHEN 2 THEN c_name || '  family   trust' WHEN 3 THEN 'heir of ' || c_name
      WHEN 4 THEN c_name || ' Co.' WHEN 5 THEN c_name || ',' WHEN 6 THEN '  '
      ELSE c_name END AS owner_name,
    CAST(o_custkey % 97 AS VARCHAR) || ' ' || c_mktsegment || ' St' AS street,
    CASE n_regionkey WHEN 0 THEN 'tx' WHEN 1 THEN ' ny ' ELSE 'CA' END AS st,
    lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS zip5,
    o_custkey % 13 AS form, o_custkey, n_name,
    CAST(CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CASE o_orderkey % 5
      WHEN 0 THEN CAST('1' AS DECIMAL(5,4)) WHEN 1 THEN CAST('0.05' AS DECIMAL(5,4))
      WHEN 2 THEN CAST('0.01' AS DECIMAL(5,4)) WHEN 3 THEN CAST('0.002' AS DECIMAL(5,4))
      ELSE CAST('0.0002' AS DECIMAL(5,4)) END AS DECIMAL(14,2)) AS VARCHAR) AS number,
    o_orderkey % 8 AS wording,
    ' ' || o_orderpriority AS property_type,
    CAST(year(o_orderdate) AS VARCHAR) AS reported_year,
    o_orderkey % 23 = 0 AS repeated
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey),
listing1 AS (
  SELECT seq, source, listed_at, property_id, owner_name,
    CASE WHEN form IN (0, 2)
           THEN street || ', ' || n_name || ', ' || trim(st) || ' ' || zip5
         WHEN form = 1 THEN 'PO Box ' || CAST(o_custkey AS VARCHAR)
         WHEN form > 3 THEN street END AS owner_address,
    CASE WHEN form > 3 OR form = 2 THEN n_name END AS owner_city,
    CASE WHEN form > 3 THEN st END AS owner_state,
    CASE WHEN form > 3 THEN zip5 END AS owner_zip,
    CASE wording WHEN 0 THEN ''
      WHEN 1 THEN 'AMOUNT INDICATED IS AT LEAST $' || number
      WHEN 2 THEN 'BETWEEN $' || number || ' AND $9'
      WHEN 3 THEN '$' || number WHEN 4 THEN 'n/a' ELSE number END AS claim_amount,
    property_type, reported_year, repeated
  FROM listing0),
listings AS (
  SELECT * EXCLUDE (repeated) FROM listing1
  UNION ALL
  SELECT * EXCLUDE (repeated) REPLACE (seq + 1 AS seq, 'src_b' AS source)
  FROM listing1 WHERE repeated)
"""

_RAW = f"""
raw0 AS (
  SELECT *, 9 AS cells FROM listings
  UNION ALL
  SELECT s_suppkey * 2, 'src_s', TIMESTAMP '1999-01-01 00:00:00', NULL,
    s_name || ' Holdings', NULL, n_name, 'ny', NULL,
    CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS VARCHAR), NULL, NULL, 4
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
raw1 AS (
  SELECT *, source || ':' || CAST(year(listed_at) AS VARCHAR)
    || '0101T000000Z:00000000' AS file_batch_id FROM raw0),
raw AS (
  SELECT *, {_uuid("source || '|' || file_batch_id || '||' || CAST(seq AS VARCHAR)")}
    AS id FROM raw1)
"""

_ROWS = rf"""
field0 AS (
  SELECT *,
    CASE WHEN source = 'src_s' THEN claim_amount ELSE coalesce(
      nullif(regexp_extract(claim_amount, '(?i)\bAT\s+LEAST{_NUMBER}', 1), ''),
      nullif(regexp_extract(claim_amount, '(?i)BETWEEN{_NUMBER}', 1), ''),
      nullif(trim(claim_amount), '')) END AS amount_text,
    CASE WHEN source = 'src_s' THEN CAST([] AS VARCHAR[]) ELSE
      list_filter(['estate', 'trust', 'heir', 'deceased', 'beneficiary'],
        lambda k: contains(lower(owner_name), k)) END AS keywords
  FROM raw WHERE source IN ('src_a', 'src_b', 'src_s')),
field1 AS (
  SELECT *,
    nullif(rtrim(upper({_squash("owner_name")}), ',.'), '') AS name,
    nullif({_squash("owner_address")}, '') AS line0,
    nullif({_squash("owner_city")}, '') AS city0,
    substr(nullif(upper(trim(owner_state)), ''), 1, 8) AS state0,
    nullif(trim(owner_zip), '') AS zip0,
    nullif({_squash("property_type")}, '') AS kind,
    TRY_CAST(replace(replace(replace(trim(amount_text), '$', ''), ',', ''), ' ', '')
      AS DECIMAL(14,2)) AS amount
  FROM field0),
field2 AS (
  SELECT *, line0 IS NOT NULL AND (city0 IS NULL OR state0 IS NULL OR zip0 IS NULL)
    AND regexp_matches(line0, '{_FREEFORM}') AS splits FROM field1),
field3 AS (
  SELECT *,
    CASE WHEN splits THEN coalesce({_address_part(1)}, line0) ELSE line0 END AS line1,
    CASE WHEN splits THEN coalesce(city0, {_address_part(2)}) ELSE city0 END AS city,
    CASE WHEN splits THEN coalesce(state0, upper({_address_part(3)}))
      ELSE state0 END AS state,
    CASE WHEN splits THEN coalesce(zip0, {_address_part(4)}) ELSE zip0 END AS zip
  FROM field2),
rows0 AS (
  SELECT *,
    CASE WHEN name IS NULL THEN 'unknown'
      WHEN starts_with(name, 'ESTATE OF ') THEN 'estate'
      WHEN {" OR ".join(f"contains(' ' || name || ' ', ' {m} ')" for m in BUSINESS_WORDS)}
        THEN 'business'
      WHEN contains(' ' || name || ' ', ' TRUST ') THEN 'estate'
      ELSE 'individual' END AS entity_type,
    coalesce(trim(name), '') || '|' || coalesce(trim(upper(line1)), '') || '|'
      || coalesce(CAST(amount AS VARCHAR), '') AS payload
  FROM field3),
rows1 AS (
  SELECT *, CASE WHEN payload <> '||' THEN sha256(payload) END AS dedup_hash
  FROM rows0),
rows2 AS (
  SELECT *, {_uuid("'normalized|' || id")} AS record_id,
    coalesce(dedup_hash, '#' || id) AS group_key FROM rows1)
"""

_KEPT = """
kept AS (
  SELECT * FROM rows2
  QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY listed_at, seq) = 1)
"""

_EARLY = f"""
early AS (
  SELECT * FROM rows2 WHERE listed_at < {_CUTOFF}
  QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY listed_at, seq) = 1),
pending AS (
  SELECT * FROM raw WHERE id NOT IN (SELECT id FROM early)),
pending_rows AS (
  SELECT *, dedup_hash IS NOT NULL
    AND dedup_hash IN (SELECT dedup_hash FROM early WHERE dedup_hash IS NOT NULL) AS known,
    row_number() OVER (PARTITION BY group_key ORDER BY listed_at, seq) AS nth
  FROM rows2 WHERE id NOT IN (SELECT id FROM early))
"""

_KEYWORD_POINTS = "(" + " + ".join(
    f"CASE WHEN list_contains(keywords, '{word}') THEN {points} ELSE 0 END"
    for word, points in (
        ("heir", 15),
        ("deceased", 12),
        ("estate", 8),
        ("trust", 6),
        ("beneficiary", 8),
    )
) + ")"

_LEADS = f"""
points AS (
  SELECT *, {_uuid("'lead|' || record_id")} AS lead_id,
    CASE WHEN amount >= 25000 THEN 'tier_25k_plus' WHEN amount >= 10000 THEN 'tier_10k'
      WHEN amount >= 5000 THEN 'tier_5k' WHEN amount >= 1000 THEN 'tier_1k'
      WHEN amount >= 100 THEN 'tier_100' END AS amount_label,
    CASE WHEN amount >= 25000 THEN 35 WHEN amount >= 10000 THEN 25
      WHEN amount >= 5000 THEN 18 WHEN amount >= 1000 THEN 10
      WHEN amount >= 100 THEN 4 END AS amount_points,
    CASE entity_type WHEN 'estate' THEN 18 WHEN 'business' THEN 8
      WHEN 'individual' THEN 5 END AS entity_points,
    CASE WHEN len(keywords) > 0 THEN {_KEYWORD_POINTS} END AS keyword_points,
    CASE WHEN coalesce(line1, city, state, zip) IS NOT NULL THEN 5 END AS address_points
  FROM kept),
scores AS (
  SELECT *, coalesce(amount_points, 0) + coalesce(entity_points, 0)
    + coalesce(keyword_points, 0) + coalesce(address_points, 0) AS score FROM points),
leads AS (
  SELECT *, CASE WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'medium'
    ELSE 'low' END AS priority, score % 3 = 0 AS exported FROM scores)
"""

_BATCHED = """
waiting AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, lead_id) AS position
  FROM leads WHERE NOT exported),
batched AS (SELECT *, (position - 1) // 10 AS export_batch FROM waiting)
"""

_PARTS = {
    "listings": [_LISTINGS],
    "raw": [_LISTINGS, _RAW],
    "rows": [_LISTINGS, _RAW, _ROWS],
    "kept": [_LISTINGS, _RAW, _ROWS, _KEPT],
    "early": [_LISTINGS, _RAW, _ROWS, _EARLY],
    "both": [_LISTINGS, _RAW, _ROWS, _KEPT, _EARLY],
    "leads": [_LISTINGS, _RAW, _ROWS, _KEPT, _LEADS],
    "batched": [_LISTINGS, _RAW, _ROWS, _KEPT, _LEADS, _BATCHED],
}


def _over(part: str, select: str, *more: str) -> str:
    return "WITH " + ",".join([*_PARTS[part], *more]) + "\n" + select


_SUMMARY = """SELECT lead_id AS id, name AS owner_name, entity_type, city, state,
  CAST(amount AS DOUBLE) AS claim_amount, score, priority, exported AS exported_to_crm
FROM leads"""

_POINT_COLUMNS = """amount_label, amount_points, entity_points,
  CASE WHEN keyword_points IS NOT NULL THEN array_to_string(keywords, ',') END
    AS keywords_matched,
  keyword_points, CAST(NULL AS INTEGER) AS age_min, CAST(NULL AS INTEGER) AS age_points,
  address_points, score AS total_points"""

_DETAIL = f"""SELECT lead_id AS id, name AS owner_name, entity_type, city, state,
  CAST(amount AS DOUBLE) AS claim_amount, score, priority, exported AS exported_to_crm,
  line1 AS address_line1, zip, kind AS property_type,
  array_to_string(keywords, ',') AS keywords_found, source,
  '2000-01-01 00:00:00' AS created_at, {_POINT_COLUMNS}
FROM leads"""


def _money(decimals: int) -> str:
    rounded = f"round(abs(amount), {decimals})"
    shape = "{:,.2f}" if decimals else "{:,.0f}"
    return (
        f"CASE WHEN coalesce(amount, 0) = 0 THEN '—' ELSE "
        f"(CASE WHEN amount < 0 THEN '-$' ELSE '$' END) || "
        f"format('{shape}', CAST({rounded} AS DOUBLE)) END AS amount"
    )


_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_AGE = "2004 - TRY_CAST(reported_year AS INTEGER)"

_CUSTOM_POINTS = f"""
custom0 AS (
  SELECT *, {_AGE} AS age, {_uuid("'lead|' || record_id")} AS lead_id,
    CASE WHEN amount >= 100 THEN 3 END AS a_points,
    CASE entity_type WHEN 'business' THEN 7 WHEN 'estate' THEN 9 END AS e_points,
    list_filter(keywords, lambda k: k IN ('heir', 'trust')) AS matched
  FROM kept),
custom1 AS (
  SELECT *,
    CASE WHEN len(matched) > 0 THEN
      (CASE WHEN list_contains(matched, 'heir') THEN 11 ELSE 0 END)
      + (CASE WHEN list_contains(matched, 'trust') THEN 2 ELSE 0 END) END AS k_points,
    CASE WHEN age >= 8 THEN 8 WHEN age >= 6 THEN 6 END AS age_min,
    CASE WHEN age >= 8 THEN 6 WHEN age >= 6 THEN 4 END AS age_points
  FROM custom0),
custom AS (
  SELECT *, coalesce(a_points, 0) + coalesce(e_points, 0) + coalesce(k_points, 0)
    + coalesce(age_points, 0) AS points FROM custom1)
"""

_AUDITS = {
    "raw": {
        **{f"{name} missing": f"{name} IS NULL" for name in ("id", "source")},
        "raw_data missing": "cells IS NULL",
        "ingested_at missing": "listed_at IS NULL",
        "source over 128": "length(source) > 128",
        "file_batch_id over 128": "length(file_batch_id) > 128",
    },
    "normalized": {
        "id missing": "record_id IS NULL",
        "raw_record_id missing": "id IS NULL",
        "entity_type missing": "entity_type IS NULL",
        "keywords_found missing": "keywords IS NULL",
        "source missing": "source IS NULL",
        "owner_name_normalized over 512": "length(name) > 512",
        "address_line1 over 512": "length(line1) > 512",
        "city over 128": "length(city) > 128",
        "state over 8": "length(state) > 8",
        "zip over 16": "length(zip) > 16",
        "property_type over 128": "length(kind) > 128",
        "source over 128": "length(source) > 128",
        "dedup_hash over 64": "length(dedup_hash) > 64",
        "entity_type outside domain": "entity_type NOT IN "
        "('individual', 'business', 'estate', 'unknown')",
    },
    "scored": {
        "id missing": "lead_id IS NULL",
        "normalized_record_id missing": "record_id IS NULL",
        "score missing": "score IS NULL",
        "priority missing": "priority IS NULL",
        "score_breakdown missing": "score IS NULL",
        "exported_to_crm missing": "exported IS NULL",
        "crm_record_id over 64": "false",
        "priority outside domain": "priority NOT IN ('high', 'medium', 'low')",
    },
    "strict": {
        "dedup_hash missing": "dedup_hash IS NULL",
        "state missing": "state IS NULL",
        "owner_name_normalized over 22": "length(name) > 22",
        "entity_type outside domain": "entity_type NOT IN ('individual', 'business')",
    },
}
_AUDITED = {"raw": "raw", "normalized": "rows2", "scored": "leads", "strict": "rows2"}


def _audit() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{check}' AS \"check\", "
        f"count(*) FILTER ({breach}) AS breaches FROM {_AUDITED[layer]}"
        for layer, checks in _AUDITS.items()
        for check, breach in checks.items()
    )


def _cascade() -> str:
    tables = (("raw", "raw"), ("normalized", "kept"), ("scored", "leads"))
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{side}' AS side, "
        f"count(*) FILTER (source {test} 'src_b') AS records FROM {table}"
        for layer, table in tables
        for side, test in (("left", "<>"), ("removed", "="))
    )


_CELLS = (
    "property_id",
    "owner_name",
    "owner_address",
    "owner_city",
    "owner_state",
    "owner_zip",
    "claim_amount",
)

_STAGED = f"""
run1 AS (SELECT * FROM rows2 WHERE listed_at < {_CUTOFF}),
run2 AS (SELECT * FROM rows2 WHERE listed_at >= {_CUTOFF}),
kept1 AS (
  SELECT * FROM run1
  QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY listed_at, seq) = 1),
kept2 AS (
  SELECT * FROM run2 WHERE group_key NOT IN (SELECT group_key FROM kept1)
  QUALIFY row_number() OVER (PARTITION BY group_key ORDER BY listed_at, seq) = 1),
sizes AS (
  SELECT (SELECT count(*) FROM raw WHERE listed_at < {_CUTOFF}) AS raw1,
    (SELECT count(*) FROM raw) AS raw_all,
    (SELECT count(*) FROM raw WHERE source = 'src_unregistered'
       AND listed_at < {_CUTOFF}) AS un1,
    (SELECT count(*) FROM raw WHERE source = 'src_unregistered') AS un_all,
    (SELECT count(*) FROM kept1) AS k1, (SELECT count(*) FROM kept2) AS k2)
"""

ORACLES: dict[str, str] = {
    "s1_csv_source": _over(
        "listings",
        "SELECT "
        + ", ".join(f"coalesce({name}, '') AS {name}" for name in _CELLS)
        + ", property_type AS property_type_description, reported_year FROM listings",
    ),
    "s1_csv_by_header": _over(
        "listings",
        "SELECT "
        + ", ".join(f"coalesce({name}, '') AS {name}" for name in _CELLS)
        + ", property_type AS property_type_description, reported_year, '' AS line"
        " FROM listings UNION ALL BY NAME SELECT "
        + ", ".join(
            f"'' AS {name}" for name in _CELLS if name not in ("property_id", "owner_name")
        )
        + """, '' AS property_type_description, '' AS reported_year,
        s_name AS owner_name, CAST(s_suppkey AS VARCHAR) AS property_id,
        s_name || ',' || CAST(s_suppkey AS VARCHAR) || ',more' AS line FROM supplier""",
    ),
    "s1_multi_line_csv": """
        SELECT property_id, rtrim(note, chr(10)) AS note,
          CAST(length(note) AS INTEGER) AS n_chars, 2 AS cells FROM (
          SELECT 'P-' || CAST(o_orderkey AS VARCHAR) AS property_id,
            'said "' || o_orderpriority || '",' || chr(10) || chr(10) || '"'
              || o_orderstatus || chr(10) AS note FROM orders
          UNION ALL
          SELECT 'S-' || CAST(s_suppkey AS VARCHAR),
            s_name || chr(10) || ',' || chr(10) || repeat('more' || chr(10), 50)
          FROM supplier)""",
    "s2_raw_records": _over(
        "raw",
        f"""SELECT id, source, {_STAMP.format("listed_at")} AS ingested_at, file_batch_id,
        seq AS ingest_seq, cells, owner_name AS owner_cell FROM raw""",
    ),
    "s2_json_records": f"""SELECT file_batch_id, event_id AS ingest_seq, cell,
        {_uuid("'events|' || file_batch_id || '||' || CAST(event_id AS VARCHAR)")} AS id
        FROM (SELECT event_id, json_extract_string(props, '$.k') AS cell,
          'events:' || strftime(ts, '%Y%m') || '01T000000Z:00000000' AS file_batch_id
          FROM events)""",
    "s3_batch_ids": _over(
        "listings",
        """SELECT source || ':' || strftime(listed_at, '%Y%m%d') || 'T000000Z:'
        || substr(md5(source), 1, 8) AS file_batch_id, count(*) AS records
        FROM listings GROUP BY 1""",
    ),
    "s4_committed_batches": _over(
        "raw", "SELECT source, count(*) AS records FROM raw GROUP BY source"
    ),
    "s5_s6_s8_stored_layers": _over(
        "leads",
        """SELECT record_id AS normalized_record_id, score, false AS exported_to_crm,
        source, CAST(amount AS DOUBLE) AS claim_amount FROM leads""",
    ),
    "s7_p6_crm_payload": _over(
        "batched",
        f"""SELECT export_batch, position, lead_id, name AS "Name",
        entity_type AS "Entity Type", line1 AS "Address Line 1", city AS "City",
        state AS "State", zip AS "Zip", CAST(amount AS DOUBLE) AS "Claim Amount",
        source AS "Source", priority AS "Priority", score AS "Score",
        score AS breakdown_total, '{_KEYS}' AS keys FROM batched""",
    ),
    "p1_extract": _over(
        "rows",
        """SELECT id, owner_name, coalesce(owner_address, '') AS address_line1,
        coalesce(owner_city, '') AS city, coalesce(owner_state, '') AS state,
        coalesce(owner_zip, '') AS zip, coalesce(amount_text, '') AS claim_amount_text,
        coalesce(property_type, '') AS property_type,
        array_to_string(keywords, ',') AS keywords_found FROM field0""",
    ),
    "p2_registry_dispatch": _over(
        "raw",
        """SELECT source, source <> 'src_unregistered' AS known, count(*) AS records
        FROM raw GROUP BY 1, 2""",
    ),
    "p3_normalized": _over(
        "rows",
        """SELECT record_id AS id, id AS raw_record_id, name AS owner_name_normalized,
        entity_type, line1 AS address_line1, city, state, zip,
        CAST(amount AS DOUBLE) AS claim_amount, kind AS property_type,
        CAST(NULL AS INTEGER) AS record_age_years,
        array_to_string(keywords, ',') AS keywords_found, source, dedup_hash
        FROM rows2""",
    ),
    "p3_record_age": _over(
        "rows",
        f"""SELECT age AS record_age_years, count(*) AS records,
        CAST(sum(CASE WHEN age >= 10 THEN 10 WHEN age >= 5 THEN 6 WHEN age >= 2 THEN 2
          ELSE 0 END) AS BIGINT) AS points
        FROM (SELECT {_AGE} AS age FROM rows2) GROUP BY age""",
    ),
    "p4_lead_summary": _over("leads", _SUMMARY),
    "p5_lead_detail": _over("leads", _DETAIL),
    "p7_f14_display_rows": _over(
        "leads",
        f"""SELECT lead_id AS id, coalesce(name, '(unnamed)') AS owner, entity_type,
        coalesce(nullif(concat_ws(', ', city, state), ''), '—') AS place,
        {_money(0)}, score, priority,
        CASE WHEN exported THEN 'exported' ELSE 'pending' END AS crm FROM leads""",
    ),
    "p7_f14_display_details": _over(
        "leads",
        f"""SELECT lead_id AS id, coalesce(name, '(unnamed)') AS owner, entity_type,
        coalesce(nullif(concat_ws(', ', line1, city, state, zip), ''), '—') AS address,
        {_money(2)}, coalesce(kind, '—') AS property_type, source,
        coalesce(nullif(array_to_string(keywords, ', '), ''), '—') AS keywords,
        CASE WHEN exported THEN 'exported' ELSE 'pending export' END AS crm
        FROM leads""",
    ),
    "p7_display_stats": _over(
        "leads",
        """SELECT count(*) AS total_leads, count(*) FILTER (priority = 'high') AS high,
        CASE WHEN sum(amount) < 0 THEN '-$' ELSE '$' END
          || format('{:,}', CAST(abs(round(coalesce(sum(amount), 0), 0)) AS BIGINT))
          AS amount,
        count(*) FILTER (NOT exported) AS pending_export FROM leads
        UNION ALL SELECT 0, 0, '$0', 0""",
    ),
    "p8_page_ranges": _over(
        "leads",
        """SELECT state, total, CASE WHEN total = 0 THEN 0 ELSE 26 END AS start,
        least(50, total) AS "end", true AS has_prev, 50 < total AS has_next
        FROM (SELECT state, count(*) AS total FROM leads GROUP BY state)""",
    ),
    "w1_by_priority": _over("leads", f"{_SUMMARY} WHERE priority = 'high'"),
    "w2_by_state": _over("leads", f"{_SUMMARY} WHERE state = 'TX'"),
    "w3_by_amount": _over("leads", f"{_SUMMARY} WHERE amount >= 0"),
    "w4_w8_combined": _over(
        "leads",
        f"{_SUMMARY} WHERE priority = 'medium' AND state = 'NY' AND amount >= 1000",
    ),
    "w5_pending": _over("leads", f"{_SUMMARY} WHERE NOT exported"),
    "w6_exported_count": _over(
        "leads", "SELECT count(*) FILTER (exported) AS exported FROM leads"
    ),
    "w7_lookup": _over(
        "leads",
        f"{_DETAIL} WHERE source = 'src_s' AND name = (SELECT upper(s_name) || ' HOLDINGS'"
        " FROM supplier WHERE s_suppkey = 0)",
    ),
    "w9_j4_of_batch": _over(
        "leads",
        """SELECT file_batch_id, lead_id AS id, name AS owner_name, score, priority
        FROM leads WHERE file_batch_id = 'src_a:19960101T000000Z:00000000'""",
    ),
    "j1_not_yet_normalized": _over(
        "early", "SELECT id, source, seq AS ingest_seq FROM pending"
    ),
    "j2_c10_not_yet_scored": _over(
        "leads",
        """SELECT lead_id AS id, record_id AS normalized_record_id, score, priority
        FROM leads WHERE id NOT IN (SELECT id FROM early)""",
        _EARLY,
    ),
    "j3_p4_scored_with_records": _over(
        "leads", _SUMMARY.replace("exported AS", "false AS")
    ),
    "j4_three_layers": _over(
        "leads",
        """SELECT file_batch_id, priority, count(*) AS leads, max(score) AS best
        FROM leads GROUP BY 1, 2""",
    ),
    "j5_a3_claim_total": _over(
        "leads",
        """SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_claim_amount
        FROM leads""",
    ),
    "j6_new_hashes": _over(
        "early",
        """SELECT record_id AS id, id AS raw_record_id, dedup_hash, source
        FROM pending_rows WHERE NOT known AND nth = 1""",
    ),
    "j7_cascade": _over("leads", _cascade()),
    "j7_removed_and_loaded_again": _over(
        "leads",
        """SELECT step, layer, CAST(CASE
          WHEN layer = 'pending' AND step <> 'again' THEN 0
          WHEN layer = 'pending' THEN gone_kept
          WHEN layer = 'raw' THEN all_raw - CASE step WHEN 'removed' THEN gone_raw ELSE 0 END
          ELSE all_kept - CASE step WHEN 'removed' THEN gone_kept ELSE 0 END
          END AS BIGINT) AS records
        FROM (SELECT count(*) AS all_raw, count(*) FILTER (source = 'src_s') AS gone_raw
              FROM raw),
          (SELECT count(*) AS all_kept, count(*) FILTER (source = 'src_s') AS gone_kept
           FROM kept),
          (VALUES ('exported'), ('removed'), ('again')) AS s(step),
          (VALUES ('raw'), ('normalized'), ('scored'), ('pending')) AS l(layer)""",
    ),
    "a1_a4_stats": _over(
        "leads",
        """SELECT count(*) AS total_leads, count(*) FILTER (priority = 'high') AS high,
        count(*) FILTER (priority = 'medium') AS medium,
        count(*) FILTER (priority = 'low') AS low,
        CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_claim_amount,
        count(*) FILTER (exported) AS exported,
        count(*) FILTER (NOT exported) AS pending_export FROM leads""",
    ),
    "a2_count_by_priority": _over(
        "leads",
        """SELECT p.rules, p.priority, count(l.lead_id) AS leads
        FROM (SELECT * FROM (VALUES ('high'), ('medium'), ('low')) AS v(priority),
              (VALUES ('default'), ('strict')) AS r(rules)) AS p
        LEFT JOIN leads AS l ON p.priority = CASE
          WHEN p.rules = 'strict' AND l.priority = 'high' THEN 'medium'
          ELSE l.priority END
        GROUP BY p.rules, p.priority""",
    ),
    "a5_filtered_count": _over(
        "leads",
        "SELECT count(*) AS total FROM leads WHERE state = 'CA' AND amount >= 5000",
    ),
    "a6_normalize_summary": _over(
        "early",
        """SELECT (SELECT count(*) FROM pending_rows WHERE NOT known AND nth = 1)
          AS processed,
        (SELECT count(*) FROM pending WHERE source = 'src_unregistered')
          AS skipped_no_normalizer,
        (SELECT count(*) FROM pending_rows WHERE known OR nth > 1) AS skipped_duplicate,
        (SELECT count(*) FROM pending) AS total_seen""",
    ),
    "a7_score_summary": _over(
        "leads",
        """SELECT count(*) AS processed, count(*) FILTER (priority = 'high') AS high,
        count(*) FILTER (priority = 'medium') AS medium,
        count(*) FILTER (priority = 'low') AS low FROM leads""",
    ),
    "a8_export_summary": _over(
        "batched",
        """SELECT count(*) FILTER (export_batch % 3 <> 1) AS exported,
        count(*) FILTER (export_batch % 3 = 1) AS failed, count(*) AS total_seen
        FROM batched""",
    ),
    "a9_ingest_count": _over(
        "raw", "SELECT file_batch_id, count(*) AS records FROM raw GROUP BY 1"
    ),
    "n1_keep_first": _over(
        "kept",
        "SELECT record_id AS id, id AS raw_record_id, dedup_hash, source FROM kept",
    ),
    "n2_duplicate_tags": _over(
        "early",
        """SELECT id AS raw_record_id, dedup_hash, CASE WHEN known THEN 'dup_existing'
        WHEN nth = 1 THEN 'kept' ELSE 'dup_in_run' END AS outcome FROM pending_rows""",
    ),
    "n3_e2_batches": _over(
        "batched", "SELECT lead_id AS id, score, position, export_batch FROM batched"
    ),
    "o1_o2_page": _over(
        "leads", f"{_SUMMARY} ORDER BY score DESC, lead_id LIMIT 50 OFFSET 100"
    ),
    "o2_page_after": _over(
        "leads",
        f"""{_SUMMARY} WHERE score < 30 OR score = 30 AND lead_id > '8'
        ORDER BY score DESC, lead_id LIMIT 50""",
    ),
    "o3_page_with_total": _over(
        "leads",
        """SELECT string_agg(lead_id, ',' ORDER BY score DESC, lead_id) AS ids,
        (SELECT count(*) FROM leads WHERE priority = 'medium') AS total,
        25 AS "limit", 25 AS "offset"
        FROM (SELECT * FROM leads WHERE priority = 'medium'
              ORDER BY score DESC, lead_id LIMIT 25 OFFSET 25)""",
    ),
    "o4_work_order": _over(
        "raw",
        f"""SELECT id, {_STAMP.format("listed_at")} AS ingested_at,
        row_number() OVER (ORDER BY listed_at, seq, source) AS position FROM raw""",
    ),
    "f1_f6_clean_fields": _over(
        "rows",
        """SELECT id, name, CAST(amount AS DOUBLE) AS amount, kind AS property_type,
        state0 AS state, zip0 AS zip FROM field1""",
    ),
    "f2_entity_types": _over(
        "rows",
        """SELECT entity_type, count(*) AS records, count(name) AS named
        FROM rows0 GROUP BY entity_type""",
    ),
    "f7_split_address": _over(
        "rows",
        f"""SELECT id,
        CASE WHEN regexp_matches(line0, '{_FREEFORM}') THEN {_address_part(1)}
          ELSE nullif(trim(owner_address), '') END AS address_line1,
        {_address_part(2)} AS city, {_address_part(3)} AS state,
        {_address_part(4)} AS zip FROM field1""",
    ),
    # The parts that the forms were made of; nothing is parsed here.
    "f7_freeform_addresses": """
        SELECT o_orderkey,
          CASE WHEN form IN (5, 6) THEN CASE form WHEN 5 THEN 'PO Box ' ELSE 'P.O. Box ' END
              || unit
            WHEN form = 3 THEN street || ' Apt ' || unit || 'B'
            WHEN form = 4 THEN street || ', Ste ' || unit
            WHEN form = 7 THEN street || ' NW # ' || unit
            ELSE street END AS address_line1,
          CASE WHEN form <> 9 THEN town END AS city,
          CASE WHEN form < 8 THEN st END AS state,
          CASE WHEN form IN (1, 8, 9) THEN NULL WHEN form = 7 THEN zip || '-0001'
            ELSE zip END AS zip
        FROM (SELECT o_orderkey, o_orderkey % 10 AS form,
            CAST(o_custkey % 97 + 1 AS VARCHAR) || ' ' || c_mktsegment[1:1]
              || lower(c_mktsegment[2:]) || ' St' AS street,
            array_to_string([upper(w[1:1]) || lower(w[2:])
              FOR w IN string_split(translate(n_name, '0123456789_', 'abcdefghij '), ' ')], ' ')
              AS town,
            CASE n_regionkey WHEN 0 THEN 'TX' ELSE 'NY' END AS st,
            lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS zip,
            CAST(o_orderkey % 40 AS VARCHAR) AS unit
          FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey)""",
    "f8_merged_address": _over(
        "rows",
        "SELECT id AS raw_record_id, line1 AS address_line1, city, state, zip FROM field3",
    ),
    "f9_dedup_hashes": _over(
        "rows",
        """SELECT id, CASE WHEN text <> '||' THEN sha256(text) END AS dedup_hash
        FROM (SELECT id, coalesce(upper(trim(owner_name)), '') || '|'
          || coalesce(upper(trim(owner_address)), '') || '|'
          || coalesce(CAST(amount AS VARCHAR), '') AS text FROM field1)""",
    ),
    "f10_amount_ranges": _over(
        "listings",
        rf"""SELECT seq, coalesce(
        nullif(regexp_extract(claim_amount, '(?i)\bAT\s+LEAST{_NUMBER}', 1), ''),
        nullif(regexp_extract(claim_amount, '(?i)BETWEEN{_NUMBER}', 1), ''),
        nullif(trim(claim_amount), '')) AS amount_text FROM listings""",
    ),
    "f11_f12_keywords": _over(
        "listings",
        f"""SELECT seq, array_to_string(keywords, ',') AS keywords_found,
        CASE WHEN len(keywords) > 0 THEN array_to_string(keywords, ',') END AS matched,
        CASE WHEN len(keywords) > 0 THEN {_KEYWORD_POINTS} END AS points
        FROM (SELECT seq, list_filter(
            ['estate', 'trust', 'heir', 'deceased', 'beneficiary'],
            lambda k: contains(lower(owner_name), k)) AS keywords FROM listings)""",
    ),
    "f13_breakdown_text": _over(
        "leads",
        """SELECT lead_id AS id, score AS total, amount_points IS NOT NULL AS has_amount,
        keyword_points IS NOT NULL AS has_keywords, false AS has_age FROM leads""",
    ),
    "c1_c8_scores": _over(
        "leads",
        f"SELECT lead_id AS id, score, priority, {_POINT_COLUMNS} FROM leads",
    ),
    "c4_c9_custom_rules": _over(
        "kept",
        """SELECT record_id AS id, points AS score,
        CASE WHEN points >= 12 THEN 'medium' ELSE 'low' END AS priority,
        CASE WHEN a_points IS NOT NULL THEN 'some' END AS amount_label,
        a_points AS amount_points, e_points AS entity_points,
        CASE WHEN k_points IS NOT NULL THEN array_to_string(matched, ',') END
          AS keywords_matched,
        k_points AS keyword_points, age_min, age_points,
        CAST(NULL AS INTEGER) AS address_points, points AS total_points FROM custom""",
        _CUSTOM_POINTS,
    ),
    "c11_rescore": _over(
        "leads",
        """SELECT p.priority, count(l.lead_id) AS leads
        FROM (VALUES ('high'), ('medium'), ('low')) AS p(priority)
        LEFT JOIN (SELECT lead_id, CASE WHEN score >= 30 THEN 'high'
          WHEN score >= 15 THEN 'medium' ELSE 'low' END AS priority FROM leads) AS l
          ON l.priority = p.priority GROUP BY p.priority""",
    ),
    "e1_o5_pending_by_score": _over(
        "leads", "SELECT lead_id AS id, score FROM leads WHERE NOT exported"
    ),
    "e3_payload_batches": _over(
        "batched",
        """SELECT export_batch, count(*) AS leads,
        string_agg(lead_id, ',' ORDER BY position) AS ids
        FROM batched GROUP BY export_batch""",
    ),
    "e4_applied_results": _over(
        "leads",
        """SELECT id, ok AS exported_to_crm,
        CASE WHEN ok THEN '2000-01-01 00:00:00' END AS exported_at,
        CASE WHEN ok THEN 'rec' || id END AS crm_record_id
        FROM (SELECT lead_id AS id, ((row_number() OVER (ORDER BY score DESC, lead_id)
          - 1) // 10) % 3 <> 1 AS ok FROM leads)""",
    ),
    "e4_folded_results": _over(
        "leads",
        """SELECT id, ok AS exported_to_crm, ok AS has_time,
        CASE WHEN ok THEN 'rec' || id END AS crm_record_id
        FROM (SELECT lead_id AS id, ((row_number() OVER (ORDER BY score DESC, lead_id)
          - 1) // 10) % 3 <> 1 AS ok FROM leads)""",
    ),
    "a1_a4_stored_stats": _over(
        "leads",
        """SELECT count(*) AS total_leads, count(*) FILTER (priority = 'high') AS high,
        count(*) FILTER (priority = 'medium') AS medium,
        count(*) FILTER (priority = 'low') AS low,
        CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_claim_amount,
        count(*) FILTER (ok) AS exported, count(*) FILTER (NOT ok) AS pending_export
        FROM (SELECT *, ((row_number() OVER (ORDER BY score DESC, lead_id)
          - 1) // 10) % 3 <> 1 AS ok FROM leads)""",
    ),
    "o2_o3_stored_page": _over(
        "leads",
        """SELECT id, owner_name, entity_type, city, state, claim_amount, score, priority,
        ok AS exported_to_crm, total
        FROM (SELECT lead_id AS id, name AS owner_name, entity_type, city, state,
          CAST(amount AS DOUBLE) AS claim_amount, score, priority,
          ((row_number() OVER (ORDER BY score DESC, lead_id) - 1) // 10) % 3 <> 1 AS ok,
          count(*) FILTER (priority = 'low') OVER () AS total FROM leads)
        WHERE priority = 'low' ORDER BY score DESC, id LIMIT 200 OFFSET 1500""",
    ),
    "j6_n1_stored_hashes": _over(
        "kept", "SELECT dedup_hash FROM kept WHERE dedup_hash IS NOT NULL"
    ),
    "e5_next_export": _over(
        "batched",
        """SELECT id, position, (position - 1) // 10 AS export_batch
        FROM (SELECT lead_id AS id,
          row_number() OVER (ORDER BY score DESC, lead_id) AS position
          FROM batched WHERE export_batch % 3 = 1)""",
    ),
    "k1_column_audit": _over("leads", _audit()),
    "k2_repeated_hashes": _over(
        "rows",
        """SELECT dedup_hash, count(*) AS copies FROM rows2
        WHERE dedup_hash IS NOT NULL GROUP BY dedup_hash HAVING count(*) > 1""",
    ),
    "k2_new_repeated_hashes": _over(
        "rows",
        f"""SELECT dedup_hash, CAST(2 AS BIGINT) AS copies FROM rows2
        WHERE dedup_hash IS NOT NULL GROUP BY dedup_hash
        HAVING min(listed_at) < {_CUTOFF} AND max(listed_at) >= {_CUTOFF}""",
    ),
    "k2_repeated_scores": _over(
        "kept",
        """SELECT record_id AS normalized_record_id, CAST(2 AS BIGINT) AS copies
        FROM kept WHERE source = 'src_s'""",
    ),
    "k3_orphans": _over(
        "kept",
        f"""SELECT source, count(*) AS orphans FROM kept
        WHERE listed_at >= {_CUTOFF} GROUP BY source""",
    ),
    "m1_stream": _over(
        "leads",
        _SUMMARY.replace("exported AS", "false AS"),
    ),
    "m1_two_runs": _over(
        "rows",
        """SELECT 'first' AS run, k1 AS processed, un1 AS skipped_no_normalizer,
          raw1 - un1 - k1 AS skipped_duplicate, raw1 AS total_seen, k1 AS scored
        FROM sizes
        UNION ALL
        SELECT 'second', k2, un_all, raw_all - un_all - k1 - k2, raw_all - k1, k2
        FROM sizes
        UNION ALL
        SELECT 'third', 0, un_all, raw_all - un_all - k1 - k2, raw_all - k1 - k2, 0
        FROM sizes""",
        _STAGED,
    ),
    "top_leads": _over("leads", f"{_SUMMARY} ORDER BY score DESC, lead_id LIMIT 50"),
}
