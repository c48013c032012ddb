"""Format and range predicates. Each gives true/false, and false for null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted formats.
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"
EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+\z"
SPOTIFY_ID = r"^[0-9a-zA-Z]{10,30}\z"
SPOTIFY_ID_LENGTH = 22
DIGEST = r"^[0-9a-f]{64}\z"


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_uuid(c: Column) -> Column:
    return _sure(c.rlike(UUID))


def is_email(c: Column) -> Column:
    return _sure(c.rlike(EMAIL))


def is_spotify_id(c: Column) -> Column:
    return _sure(c.rlike(SPOTIFY_ID))


def is_genius_id(c: Column) -> Column:
    """A positive whole number, as a number or as text."""
    n = c.cast("string").try_cast("double")
    return _sure((n > 0) & (n == F.floor(n)))


def is_url(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("PROTOCOL")).isNotNull()


def is_date(c: Column) -> Column:
    return c.cast("string").try_cast("timestamp").isNotNull()


def in_enum(c: Column, allowed) -> Column:
    return _sure(c.isin(list(allowed)))


def packed(c: Column) -> Column:
    """A text id in as few bytes as hold it, for shuffles: a digest of 64 hex digits, which no codec of theirs makes shorter, in 33."""
    return F.when(c.rlike(DIGEST), F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpacked(c: Column) -> Column:
    """The id that ``packed`` was given."""
    rest = F.substr(c, F.lit(2))
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def array_any(c: Column, allowed) -> Column:
    """``value = ANY(list)``: null stays null, as in SQL."""
    return c.isin(list(allowed))


def check_string(c: Column, min_length=None, max_length=None, pattern=None) -> Column:
    ok = c.isNotNull()
    if min_length is not None:
        ok = ok & (F.length(c) >= min_length)
    if max_length is not None:
        ok = ok & (F.length(c) <= max_length)
    if pattern is not None:
        ok = ok & c.rlike(pattern)
    return _sure(ok)


def check_number(c: Column, min_value=None, max_value=None) -> Column:
    ok = c.isNotNull() & ~F.isnan(c.cast("double"))
    if min_value is not None:
        ok = ok & (c >= min_value)
    if max_value is not None:
        ok = ok & (c <= max_value)
    return _sure(ok)


def check_boolean(c: Column) -> Column:
    """Text holding a JSON boolean."""
    return _sure(c.cast("string").isin("true", "false"))


def check_array(c: Column, min_size=None, max_size=None, item=None) -> Column:
    ok = c.isNotNull()
    if min_size is not None:
        ok = ok & (F.size(c) >= min_size)
    if max_size is not None:
        ok = ok & (F.size(c) <= max_size)
    if item is not None:
        ok = ok & F.forall(c, item)
    return _sure(ok)
