"""Text clean-up rules as column expressions.

Every rule treats a missing and a blank value alike and returns null for both.
Trimming uses an explicit character set because Spark's plain ``trim`` removes
only U+0020 while listings carry tabs and no-break spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as whitespace in listing text.
SPACE_CODE_POINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
_SPACES = "".join(chr(point) for point in SPACE_CODE_POINTS)
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Longest state code kept, and punctuation dropped after a name.
STATE_LENGTH = 8
NAME_TAIL = ",."


def null_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def strip(value: Column) -> Column:
    """Remove whitespace, Unicode included, from both ends."""
    return F.btrim(value, F.lit(_SPACES))


def squash(value: Column) -> Column:
    """Strip, then turn each inner run of whitespace into one space."""
    return F.regexp_replace(strip(value), _SPACE_RUN, " ")


def clean_text(value: Column) -> Column:
    return null_if_empty(squash(value))


def clean_state(value: Column) -> Column:
    return F.substring(null_if_empty(F.upper(strip(value))), 1, STATE_LENGTH)


def clean_zip(value: Column) -> Column:
    """Strip only; a ZIP+4 stays whole."""
    return null_if_empty(strip(value))


def normalize_name(value: Column) -> Column:
    """Upper-case, squash, and drop the run of commas and dots at the end.

    A space left in front of that run stays, so ``'SMITH ,'`` gives ``'SMITH '``.
    """
    return null_if_empty(F.rtrim(F.upper(squash(value)), F.lit(NAME_TAIL)))
