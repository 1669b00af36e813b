"""Claim amounts: reading them from text and showing them as money.

A parsed amount stays a wide decimal until the duplicate key is computed,
because the key rounds half to even and the stored column rounds half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.text import null_if_empty, strip

WIDE_TYPE = "decimal(38,18)"
MONEY_TYPE = "decimal(14,2)"

# How a listing words an amount range; group 1 is the lower bound.
AT_LEAST = r"(?iU)\bAT\s+LEAST\s*\$?\s*([0-9][0-9,]*(?:\.\d+)?)"
BETWEEN = r"(?iU)BETWEEN\s*\$?\s*([0-9][0-9,]*(?:\.\d+)?)"
NO_VALUE = "—"


def lower_bound_text(text: Column) -> Column:
    """Text of the amount; a range is reduced to its lower bound."""
    return lower_bound_of_stripped(null_if_empty(strip(text)))


def lower_bound_of_stripped(text: Column) -> Column:
    """Both range wordings hold a T, so plain numbers skip the patterns."""
    worded = text.contains("T") | text.contains("t")
    bound = F.coalesce(
        null_if_empty(F.regexp_extract(text, AT_LEAST, 1)),
        null_if_empty(F.regexp_extract(text, BETWEEN, 1)),
    )
    return F.coalesce(F.when(worded, bound), text)


def wide_amount(text: Column) -> Column:
    """Decimal of ``$1,234.56``-like text, null if it is not a finite number."""
    return wide_amount_of_stripped(strip(text))


def wide_amount_of_stripped(text: Column) -> Column:
    return F.translate(text, "$, ", "").try_cast(WIDE_TYPE)


def parse_amount(text: Column) -> Column:
    """Wide decimal of the text, null also where the stored column cannot hold it."""
    wide = wide_amount(text)
    return F.when(to_money(wide).isNotNull(), wide)


def to_money(amount: Column) -> Column:
    return amount.try_cast(MONEY_TYPE)


def amount_key(amount: Column) -> Column:
    """Two-decimal text of an amount, rounded half to even."""
    return F.bround(amount, 2).cast("string")


def format_money(amount: Column, decimals: int) -> Column:
    """``$1,234`` or ``$1,234.56``; null stays null."""
    digits = F.format_number(F.abs(F.round(amount, decimals)), decimals)
    sign = F.when(amount < 0, "-$").otherwise("$")
    return F.concat(sign, digits)


def show_money(amount: Column, decimals: int) -> Column:
    """An amount as shown for one lead: a missing or zero one is a dash."""
    return F.when(
        F.coalesce(amount, F.lit(0)) != 0, format_money(amount, decimals)
    ).otherwise(NO_VALUE)
