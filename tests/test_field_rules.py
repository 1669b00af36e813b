"""Field rules on single values."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leadmill.functions import address, amounts, identity, names, text
from leadmill.functions.names import BUSINESS_WORDS
from leadmill.operators import display


def test_names_are_upper_cased_squashed_and_stripped_of_end_marks(apply):
    given = [
        "  tessa   marlow  ", "Tessa Marlow,", "Tessa Marlow.", None, "", "   ",
        "marlow ,", "\tann  lee ", ",.,", "o'dell & co.,", "straße",
    ]
    assert apply(text.normalize_name, given) == [
        "TESSA MARLOW", "TESSA MARLOW", "TESSA MARLOW", None, None, None,
        "MARLOW ", "ANN LEE", None, "O'DELL & CO", "STRASSE",
    ]


def test_all_unicode_space_is_stripped(apply):
    spaces = [chr(point) for point in text.SPACE_CODE_POINTS]
    assert apply(text.strip, [f"{s}a{s}b{s}" for s in spaces]) == [
        f"a{s}b" for s in spaces
    ]
    assert apply(text.squash, [f"{s}a{s}{s}b{s}" for s in spaces]) == ["a b"] * len(spaces)
    assert all(s.isspace() for s in spaces)
    assert sum(chr(point).isspace() for point in range(0x110000)) == len(spaces)


def test_entity_types(apply):
    cases = {
        "NIMBUS LLC": "business", "ZEAL INC.": "business", "KITE HOLDINGS": "business",
        "ORBIT CORP": "business", "ESTATE OF UNA BRANDT": "estate",
        "UNA BRANDT TRUST": "estate", "TESSA MARLOW": "individual", None: "unknown",
        "": "unknown",
        # An end dot is gone by now, so the dotted form no longer matches.
        "NIMBUS L.L.C": "individual", "NIMBUS L.L.C. WEST": "business",
        "WILLOW BEND CO": "individual", "A CO. B": "business",
        "X TRUST COMPANY": "business", "ESTATE OF NIMBUS LLC": "estate",
        "THE ESTATE OF X": "individual", "TRUSTEE JOHN": "individual",
        "LLCX": "individual", "INC": "business", "NIMBUS LXLXC. Y": "individual",
    }
    assert apply(names.detect_entity_type, list(cases)) == list(cases.values())
    every = [f"A {word} B" for word in BUSINESS_WORDS]
    assert set(apply(names.detect_entity_type, every)) == {"business"}


def test_keywords_are_substrings_in_list_order(apply):
    assert apply(
        names.find_name_keywords,
        ["TESSA MARLOW", None, "ESTATE OF UNA BRANDT", "HEIR OF DECEASED ESTATE",
         "Their Trustee", "beneficiary"],
    ) == [[], [], ["estate"], ["estate", "heir", "deceased"], ["trust", "heir"],
          ["beneficiary"]]


def test_amounts(apply):
    cases = {
        "1234.56": "1234.56", "$1,234.56": "1234.56", "  $9,999.00  ": "9999.00",
        "0.00": "0.00", None: None, "": None, "   ": None, "not a number": None,
        "1e5": "100000.00", "NaN": None, "Infinity": None, "1_000": None,
        "1234567890123": None, "999999999999.99": "999999999999.99", "-5": "-5.00",
        "1.005": "1.01", "1 000": "1000.00", " $7 ": "7.00",
    }
    money = apply(lambda c: amounts.to_money(amounts.parse_amount(c)), list(cases))
    assert money == [None if v is None else Decimal(v) for v in cases.values()]


def test_worded_amounts_give_their_lower_bound(apply):
    cases = {
        "3247.55": "3247.55", "  100.00 ": "100.00", "$1,250.75": "$1,250.75",
        None: None, "": None, "   ": None,
        "AMOUNT INDICATED IS AT LEAST $100.00": "100.00", "AT LEAST $50": "50",
        "BETWEEN $50.00 AND $99.99": "50.00", "between $1,000 and $5,000": "1,000",
        "BETWEEN $5 AND AT LEAST $7": "7", "WHAT LEAST $5": "WHAT LEAST $5",
        "at\tleast 3.5": "3.5", "tbd": "tbd",
    }
    assert apply(amounts.lower_bound_text, list(cases)) == list(cases.values())


def test_state_zip_and_text(apply):
    assert apply(text.clean_state, ["ny", " wa ", "CA", None, "", "  ", "california"]) == [
        "NY", "WA", "CA", None, None, None, "CALIFORN"]
    assert apply(text.clean_zip, [" 02101 ", "02101-1234", None, "", " "]) == [
        "02101", "02101-1234", None, None, None]
    assert apply(text.clean_text, ["  hello   world  ", None, ""]) == [
        "hello world", None, None]


def _expected_hash(name, line, amount):
    payload = f"{name}|{line}|{amount}"
    return hashlib.sha256(payload.encode()).hexdigest()


def test_dedup_hash(spark):
    given = [
        ("tessa marlow", " 1 Main St ", "100.00"), ("TESSA MARLOW ", "1 MAIN ST", "100"),
        (None, None, None), ("", "", None), ("  ", "  ", None), ("A", None, "1.005"),
        ("A", None, "1.015"), (None, "X", None), ("A", "", "2.00"), ("Mara Quill",
        "12 Fernlane Rd", "2210.40"),
    ]
    rows = spark.createDataFrame(given, "name STRING, line STRING, amount STRING")
    hashed = rows.select(
        identity.dedup_hash(
            F.col("name"), F.col("line"), F.col("amount").cast("decimal(38,18)")
        )
    )
    assert [row[0] for row in hashed.collect()] == [
        _expected_hash("TESSA MARLOW", "1 MAIN ST", "100.00"),
        _expected_hash("TESSA MARLOW", "1 MAIN ST", "100.00"),
        None, None, None,
        _expected_hash("A", "", "1.00"),
        _expected_hash("A", "", "1.02"),
        _expected_hash("", "X", ""),
        _expected_hash("A", "", "2.00"),
        hashlib.sha256(b"MARA QUILL|12 FERNLANE RD|2210.40").hexdigest(),
    ]


def test_address_split(apply):
    given = ["123 Main St, Boston, MA 02101", "1 A St, Apt 4,  New  York, ny 10001-2345",
             "PO Box 12", " no commas here ", ", Boston, MA 02101", "1 A, B, MA 2101", ""]
    got = apply(lambda c: address.split_address(c), given)
    assert [tuple(part) for part in got] == [
        ("123 Main St", "Boston", "MA", "02101"),
        ("1 A St, Apt 4", "New York", "ny", "10001-2345"),
        ("PO Box 12", None, None, None),
        ("no commas here", None, None, None),
        (None, "Boston", "MA", "02101"),
        ("1 A, B, MA 2101", None, None, None),
        (None, None, None, None),
    ]


@pytest.mark.parametrize(
    "given, want",
    [
        ("12 Elm St, Marlow, VT", ("12 Elm St", "Marlow", "VT", None)),
        ("12 Elm St Marlow VT 05671", ("12 Elm St", "Marlow", "VT", "05671")),
        ("12 Elm St, Marlow VT 05671", ("12 Elm St", "Marlow", "VT", "05671")),
        ("12 N Elm St W New Marlow, VT, 05671", ("12 N Elm St W", "New Marlow", "VT", "05671")),
        ("12 Elm St Apt 4B, Marlow, VT 05671", ("12 Elm St Apt 4B", "Marlow", "VT", "05671")),
        ("12 Elm St, Apt. 4B, Marlow, VT", ("12 Elm St, Apt. 4B", "Marlow", "VT", None)),
        ("12 Elm St, Apt 4B Marlow VT 05671", ("12 Elm St, Apt 4B", "Marlow", "VT", "05671")),
        ("12 Elm St # 7 Marlow VT 05671-1234", ("12 Elm St # 7", "Marlow", "VT", "05671-1234")),
        ("12 Elm St #7 Marlow vt 05671", ("12 Elm St #7", "Marlow", "vt", "05671")),
        ("PO Box 33 Marlow VT 05671", ("PO Box 33", "Marlow", "VT", "05671")),
        ("P.O. Box 33, Marlow, VT", ("P.O. Box 33", "Marlow", "VT", None)),
        ("P O Box 33, New Marlow VT", ("P O Box 33", "New Marlow", "VT", None)),
        ("12 St Louis Ave Saint Louis MO 63101", ("12 St Louis Ave", "Saint Louis", "MO", "63101")),
        ("12 Elm St, Marlow", ("12 Elm St", "Marlow", None, None)),
        ("12 Elm St, Marlow 05671", ("12 Elm St", "Marlow", None, "05671")),
        ("12 Elm St, VT 05671", ("12 Elm St", None, "VT", "05671")),
        ("Old Mill House, 12 Elm St, Marlow, VT 05671",
         ("Old Mill House, 12 Elm St", "Marlow", "VT", "05671")),
        # What stays whole.
        ("12 Elm Ct", ("12 Elm Ct", None, None, None)),
        ("12 Elm St", ("12 Elm St", None, None, None)),
        ("PO Box 05671", ("PO Box 05671", None, None, None)),
        ("12 Elm St Apt 05671", ("12 Elm St Apt 05671", None, None, None)),
        ("Elm House, Marlow", ("Elm House, Marlow", None, None, None)),
        ("1 A, B, MA 2101", ("1 A, B, MA 2101", None, None, None)),
        (", , ,", (", , ,", None, None, None)),
        ("VT 05671", ("VT 05671", None, None, None)),
        ("x " * 5000 + "St, Marlow, VT", None),
    ],
)
def test_addresses_of_other_forms(apply, given, want):
    (got,) = apply(lambda c: address.split_address(c), [given])
    assert tuple(got) == (want or (given.strip(), None, None, None))


def test_address_merge_keeps_given_parts(spark):
    line = "5 Elm St, Salem, or 97301"
    given = [
        (line, None, None, None), (line, "Given", None, None),
        (line, "C", "ST", "1"), (", Salem, OR 97301", None, None, None),
        (None, None, "TX", None), ("PO Box 3", None, "TX", None),
    ]
    rows = spark.createDataFrame(given, "line STRING, city STRING, state STRING, zip STRING")
    parts = [F.col(name) for name in ("line", "city", "state", "zip")]
    split = rows.withColumn("pieces", address.address_pieces(*parts))
    merged = address.merge_address(F.col("pieces"), *parts)
    got = split.select(*[column.alias(name) for name, column in merged.items()])
    assert [tuple(row) for row in got.collect()] == [
        ("5 Elm St", "Salem", "OR", "97301"), ("5 Elm St", "Given", "OR", "97301"),
        (line, "C", "ST", "1"), (", Salem, OR 97301", "Salem", "OR", "97301"),
        (None, None, "TX", None), ("PO Box 3", None, "TX", None),
    ]


def test_money_display(apply):
    given = [Decimal("1234.50"), Decimal("1235.49"), Decimal("-2.50"), Decimal(0), None]
    whole = apply(lambda c: amounts.show_money(c, 0), given, "DECIMAL(14,2)")
    exact = apply(lambda c: amounts.show_money(c, 2), given, "DECIMAL(14,2)")
    assert whole == ["$1,235", "$1,235", "-$3", "—", "—"]
    assert exact == ["$1,234.50", "$1,235.49", "-$2.50", "—", "—"]


def test_page_ranges(spark):
    totals = spark.createDataFrame([(0,), (10,), (25,), (60,)], "total BIGINT")
    first = display.page_ranges(totals, F.lit(0)).collect()
    assert [tuple(row)[1:] for row in first] == [
        (0, 0, False, False), (1, 10, False, False), (1, 25, False, False),
        (1, 25, False, True)]
    last = display.page_ranges(totals.where("total = 60"), F.lit(50)).first()
    assert tuple(last)[1:] == (51, 60, True, False)


def test_display_falls_back_on_blanks(spark):
    rows = spark.createDataFrame(
        [("1", None, "unknown", None, "", None, "", None, None, 3, "low", False, [], "s")],
        "id STRING, owner_name STRING, entity_type STRING, address_line1 STRING,"
        " city STRING, state STRING, zip STRING, claim_amount DECIMAL(14,2),"
        " property_type STRING, score INT, priority STRING, exported_to_crm BOOLEAN,"
        " keywords_found ARRAY<STRING>, source STRING",
    )
    assert tuple(display.display_rows(rows).first()) == (
        "1", "(unnamed)", "unknown", "—", "—", 3, "low", "pending")
    assert tuple(display.display_details(rows).first()) == (
        "1", "(unnamed)", "unknown", "—", "—", "—", "s", "—", "pending export")
