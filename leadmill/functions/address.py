"""Splitting a freeform address into line, city, state and ZIP.

Text of the plain form ``line, City, ST 12345`` is split by one pattern. Other text is read
token by token: its tail gives ZIP and state, and an automaton labels the tokens before as
number and street, unit, box or city. Text that ends in no sensible state stays whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import (
    clean_state,
    clean_text,
    clean_zip,
    null_if_empty,
    squash,
    strip,
)

FREEFORM = r"^(.*?),\s*([^,]+),\s*([A-Za-z]{2})\s+(\d{5}(?:-\d{4})?)$"
# Counts as whitespace, so squashed text never holds it.
_MARK = "\x1f"


# Postal codes of states, districts and territories.
STATES = (
    "AK AL AR AS AZ CA CO CT DC DE FL GA GU HI IA ID IL IN KS KY LA MA MD ME MI MN MO MP MS"
    " MT NC ND NE NH NJ NM NV NY OH OK OR PA PR RI SC SD TN TX UT VA VI VT WA WI WV WY"
).split()
# Words that end the name of a street, directions, and words for a unit.
STREET_TYPES = (
    "ST STREET AVE AVENUE RD ROAD DR DRIVE LN LANE BLVD BOULEVARD CT COURT PL PLACE WAY TER"
    " TERRACE CIR CIRCLE PKWY PARKWAY HWY HIGHWAY SQ SQUARE TRL TRAIL LOOP RUN ROW ALY ALLEY"
).split()
DIRECTIONS = "N S E W NE NW SE SW NORTH SOUTH EAST WEST".split()
UNITS = "APT APARTMENT UNIT STE SUITE RM ROOM FL FLOOR BLDG BUILDING LOT TRLR #".split()

# More tokens than these are no address; it also bounds the work on one text.
MOST_TOKENS = 40
# What the automaton has read: a street without and with its type, the word for a unit or
# the beginning of a box whose id must follow, an id, a comma, and a city.
_STREET, _TYPED, _UNIT, _BOX, _ID, _COMMA, _CITY = (
    "street", "typed", "unit", "box", "id", "comma", "city"
)


def _step(at: Column, token: Column) -> Column:
    """The automaton's state after one more token."""
    mode, line, city = at["mode"], at["line"], at["city"]
    word = F.upper(F.translate(token, ".", ""))
    is_unit = word.isin(UNITS)
    marked = word.rlike("^#.")
    starts_box = (line == "") & word.isin("PO", "P", "POBOX")
    # A type follows a number and a name: "12 St Louis Ave" has one type.
    is_type = word.isin(STREET_TYPES) & line.contains(" ")
    before_city = mode.isin(_TYPED, _ID, _COMMA)

    def to(name: str, more: Column, rest: Column = city) -> Column:
        return F.struct(F.lit(name).alias("mode"), more.alias("line"), rest.alias("city"))

    longer = F.concat_ws(" ", F.nullif(line, F.lit("")), token)
    beside = F.concat_ws(" ", F.nullif(city, F.lit("")), token)
    # A comma behind a city makes that a further part of the line.
    joined = F.concat_ws(", ", F.nullif(line, F.lit("")), F.nullif(city, F.lit("")))
    after_comma = F.when(mode == _COMMA, F.concat(line, F.lit(", "), token)).otherwise(longer)
    return (
        F.when(token == ",", to(_COMMA, joined, F.lit("")))
        .when((mode == _BOX) & word.isin("O", "BOX"), to(_BOX, longer))
        .when(mode.isin(_UNIT, _BOX), to(_ID, longer))
        .when((mode == _STREET) & starts_box, to(_BOX, longer))
        .when((mode == _STREET) & is_type, to(_TYPED, longer))
        .when((mode != _CITY) & (line != "") & is_unit & (before_city | line.contains(" ")),
              to(_UNIT, after_comma))
        .when((mode != _CITY) & (line != "") & marked, to(_ID, after_comma))
        .when((mode == _TYPED) & word.isin(DIRECTIONS), to(_TYPED, longer))
        .when(mode == _STREET, to(_STREET, longer))
        .otherwise(to(_CITY, line, beside))
    )


def _with(value: Column, rule: Callable[[Column], Column]) -> Column:
    """A rule over a value that is computed once, however often the rule names it."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


_ZIP, _STATE = r"[ ,]+(\d{5}(?:-\d{4})?)$", r"(?:^|[ ,]+)([A-Za-z]{2})$"


def _labelled(squashed: Column) -> Column:
    """Four parts of which some may be null, or null for text that makes no sense."""

    def without_zip(text: Column) -> Column:
        zip_ = F.regexp_extract(text, _ZIP, 1)
        before = F.rtrim(F.regexp_replace(text, _ZIP, ""), F.lit(" ,"))
        return F.struct(before.alias("text"), F.nullif(zip_, F.lit("")).alias("zip"))

    def without_state(tail: Column) -> Column:
        text = tail["text"]
        state = F.regexp_extract(text, _STATE, 1)
        # Without a ZIP, a state follows a comma; "5 Elm Ct" ends in a street type.
        told = tail["zip"].isNotNull() | text.rlike(", ?[A-Za-z]{2}$|,.* [A-Z]{2}$")
        found = F.upper(state).isin(STATES) & told
        before = F.rtrim(F.regexp_replace(text, _STATE, ""), F.lit(" ,"))
        return F.struct(
            F.when(found, before).otherwise(text).alias("text"),
            F.when(found, state).alias("state"),
            tail["zip"].alias("zip"),
        )

    def read(tail: Column) -> Column:
        tokens = F.filter(
            F.split(F.regexp_replace(tail["text"], ",", " , "), " +"), lambda t: t != ""
        )
        start = F.struct(
            F.lit(_STREET).alias("mode"), F.lit("").alias("line"), F.lit("").alias("city")
        )
        labelled = F.when(
            F.size(tokens) <= MOST_TOKENS, F.aggregate(tokens, start, _step)
        )
        return F.struct(labelled.alias("read"), tail["state"], tail["zip"])

    def judged(found: Column) -> Column:
        mode, line = found["read"]["mode"], found["read"]["line"]
        city, state = F.nullif(found["read"]["city"], F.lit("")), found["state"]
        zip_ = found["zip"]
        # A city has no digits, and without a state or ZIP it must follow a numbered line.
        sensible = ~mode.isin(_UNIT, _BOX) & (
            F.when(city.isNull(), state.isNotNull() & zip_.isNotNull() & (line != ""))
            .when(city.rlike(r"\d"), False)
            .otherwise(state.isNotNull() | zip_.isNotNull() | line.rlike(r"^\d|^(?i)p\.?o"))
        )
        return F.when(sensible, F.array(line, city, state, zip_))

    return _with(_with(_with(_with(squashed, without_zip), without_state), read), judged)


def _pieces(squashed: Column) -> Column:
    """Four pieces when the text can be split, else one."""
    marked = F.regexp_replace(squashed, FREEFORM, _MARK.join(("$1", "$2", "$3", "$4")))

    def other(plain: Column) -> Column:
        return F.when(F.size(plain) == 4, plain).otherwise(
            F.coalesce(_labelled(F.get(plain, F.lit(0))), plain)
        )

    return _with(F.split(marked, _MARK), other)


def split_address(text: Column) -> Column:
    """Struct of ``address_line1, city, state, zip``.

    Parts that the text lacks are null. Text that cannot be split comes back whole as the
    line, the rest null.
    """
    pieces = _pieces(squash(text))
    line = F.when(F.size(pieces) == 4, F.get(pieces, F.lit(0))).otherwise(strip(text))
    return F.struct(
        null_if_empty(line).alias("address_line1"),
        F.get(pieces, F.lit(1)).alias("city"),
        F.get(pieces, F.lit(2)).alias("state"),
        F.get(pieces, F.lit(3)).alias("zip"),
    )


def address_pieces(line1: Column, city: Column, state: Column, zip_: Column) -> Column:
    """Pieces of a cleaned ``line1`` where other parts are missing, else null."""
    incomplete = line1.isNotNull() & (
        city.isNull() | state.isNull() | zip_.isNull()
    )
    return F.when(incomplete, _pieces(line1))


def merge_address(
    pieces: Column, line1: Column, city: Column, state: Column, zip_: Column
) -> dict[str, Column]:
    """Address columns after the conditional split; given parts win."""
    found = F.size(pieces) == 4

    def piece(position: int) -> Column:
        return F.get(pieces, F.lit(position))

    return {
        "address_line1": F.when(
            found, F.coalesce(null_if_empty(piece(0)), line1)
        ).otherwise(line1),
        "city": F.coalesce(city, clean_text(piece(1))),
        "state": F.coalesce(state, clean_state(piece(2))),
        "zip": F.coalesce(zip_, clean_zip(piece(3))),
    }
