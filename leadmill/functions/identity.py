"""Keys: the duplicate hash and the record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.amounts import amount_key
from leadmill.functions.text import strip

# The first byte of packed text says what the others are.
_TEXT, _HEX, _UUID = (bytearray([kind]) for kind in range(3))


def dedup_hash(name: Column, line1: Column, amount: Column) -> Column:
    """SHA-256 of ``NAME|LINE1|amount``; null when all three are blank.

    ``amount`` is the unrounded amount. City, state, ZIP and source take no part.
    """
    return hash_of_upper(F.upper(name), F.upper(line1), amount)


def hash_of_upper(name: Column, line1: Column, amount: Column) -> Column:
    """``dedup_hash`` of text that is in upper case already."""
    blank = F.lit("")
    payload = F.concat(
        F.coalesce(strip(name), blank),
        F.lit("|"),
        F.coalesce(strip(line1), blank),
        F.lit("|"),
        F.coalesce(amount_key(amount), blank),
    )
    return F.when(payload != "||", F.sha2(payload, 256))


def record_id(*parts: Column) -> Column:
    """Deterministic id in UUID form, evenly spread over its hex prefixes."""
    digest = F.md5(F.concat_ws("|", *parts))
    groups = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in groups])


def packed(text: Column) -> Column:
    """Text as bytes, for a shuffle: hex digits, such as of ids and hashes, take half.

    ``unpacked`` gives the text back, whatever it is; different texts stay different.
    """
    digits = F.replace(text, F.lit("-"), F.lit(""))
    uuid = text.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\\z")
    plain = text.rlike("^([0-9a-f]{2})+\\z")
    return (
        F.when(uuid, F.concat(F.lit(_UUID), F.unhex(digits)))
        .when(plain, F.concat(F.lit(_HEX), F.unhex(text)))
        .when(text.isNotNull(), F.concat(F.lit(_TEXT), text.cast("binary")))
    )


def unpacked(data: Column) -> Column:
    kind, rest = F.substring(data, 1, 1), F.substring(data, 2, 2**31 - 1)
    # Cut as bytes, so that each is made into digits once.
    parts = ((2, 4), (6, 2), (8, 2), (10, 2), (12, 6))
    uuid = F.concat_ws("-", *[F.hex(F.substring(data, at, size)) for at, size in parts])
    return (
        F.when(kind == F.lit(_UUID), F.lower(uuid))
        .when(kind == F.lit(_HEX), F.lower(F.hex(rest)))
        .otherwise(rest.cast("string"))
    )


def normalized_id(raw_id: Column) -> Column:
    return record_id(F.lit("normalized"), raw_id)


def lead_id(normalized_record_id: Column) -> Column:
    return record_id(F.lit("lead"), normalized_record_id)
