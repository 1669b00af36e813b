"""Listing, paging and looking up leads."""

from __future__ import annotations

from decimal import Decimal
from uuid import UUID, uuid5

import pytest

from leadmill.operators import leads

_SCHEMA = (
    "id STRING, owner_name STRING, entity_type STRING, city STRING, state STRING,"
    " claim_amount DECIMAL(14,2), score INT, priority STRING, exported_to_crm BOOLEAN,"
    " address_line1 STRING, zip STRING, property_type STRING,"
    " keywords_found ARRAY<STRING>, source STRING, score_breakdown STRUCT<total: INT>,"
    " created_at TIMESTAMP"
)
_SPACE = UUID(int=7)


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for n in range(60):
        score = n % 7
        amount = None if n % 5 == 0 else Decimal(n * 1000)
        data.append((
            str(uuid5(_SPACE, str(n))), f"OWNER {n}", "individual", "C",
            ("TX", "NY")[n % 2], amount, score, ("low", "medium", "high")[score // 3],
            n % 4 == 0, None, None, None, None, "s", (score,), None))
    return spark.createDataFrame(data, _SCHEMA).cache()


def test_pages_are_ordered_and_disjoint(rows):
    first = leads.list_leads(rows, page=leads.Page(5, 0)).collect()
    second = leads.list_leads(rows, page=leads.Page(5, 5)).collect()
    order = [(-row.score, row.id) for row in first + second]
    assert order == sorted(order) and len(set(order)) == 10
    assert len(leads.list_leads(rows).collect()) == 50
    assert leads.list_leads(rows, page=leads.Page(200, 58)).count() == 2
    assert tuple(first[0].asDict()) == leads.SUMMARY_COLUMNS


def test_filters(rows):
    def listed(**where):
        return leads.list_leads(
            rows, leads.LeadFilter(**where), leads.Page(200)).collect()

    assert all(row.state == "TX" for row in listed(state="tx")) and listed(state="tx")
    assert len(listed(state="")) == 60
    assert listed(state=" TX") == []
    assert {row.priority for row in listed(priority="high")} == {"high"}
    assert all(row.claim_amount >= 10000 for row in listed(min_amount="10000"))
    assert len(listed(min_amount=0)) == 48
    both = listed(state="NY", min_amount=30000, priority="low")
    assert both and all(
        row.state == "NY" and row.claim_amount >= 30000 and row.priority == "low"
        for row in both)


def test_page_with_total(rows):
    where = leads.LeadFilter(priority="low")
    page = leads.lead_page(rows, where, leads.Page(4, 2)).first()
    plain = leads.list_leads(rows, where, leads.Page(4, 2)).collect()
    assert [item.id for item in page["items"]] == [row.id for row in plain]
    assert page.total == rows.where("priority = 'low'").count()
    assert (page.limit, page.offset) == (4, 2)
    empty = leads.lead_page(rows, leads.LeadFilter(state="ZZ")).first()
    assert (empty["items"], empty.total) == ([], 0)


def test_detail(rows):
    wanted = leads.list_leads(rows, page=leads.Page(1)).first().id
    found = leads.lead_detail(rows, wanted).collect()
    assert [row.id for row in found] == [wanted]
    assert found[0].keywords_found == [] and found[0].score_breakdown.total == 6
    assert leads.lead_detail(rows, str(UUID(int=1))).count() == 0
    with pytest.raises(ValueError):
        leads.lead_detail(rows, "not-a-uuid")


def test_stats(rows, spark):
    stats = leads.stats(rows).first()
    assert stats.total_leads == 60
    assert stats.high + stats.medium + stats.low == 60
    assert stats.exported + stats.pending_export == 60
    assert stats.total_claim_amount > 0
    assert leads.stats(rows.limit(0)).first().total_claim_amount == 0
    assert leads.exported_count(rows).first().exported == stats.exported
    assert leads.pending(rows).count() == stats.pending_export


@pytest.mark.parametrize("bad", [
    {"priority": "urgent"}, {"state": "TOOLONGXX"}, {"min_amount": -1},
    {"min_amount": "NaN"},
])
def test_bad_filters_are_refused(bad):
    with pytest.raises(ValueError):
        leads.LeadFilter(**bad)


@pytest.mark.parametrize("bad", [(0, 0), (201, 0), (5, -1)])
def test_bad_pages_are_refused(bad):
    with pytest.raises(ValueError):
        leads.Page(*bad)
