"""Cleansing rules of the silver layer, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a code is trimmed.
WHITESPACE = (
    "\t\n\u000b\f\r\u001c\u001d\u001e\u001f \u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)


def text(c: Column) -> Column:
    return c.cast("string")


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def upper(c: Column) -> Column:
    return F.upper(c.cast("string"))


def code(c: Column) -> Column:
    """A code list value: trimmed and in upper case."""
    return F.upper(trimmed(c))


def money(c: Column) -> Column:
    return F.coalesce(c.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


def real(c: Column) -> Column:
    return c.cast("double")


def whole(c: Column) -> Column:
    return c.cast("bigint")


def flag(c: Column) -> Column:
    return c.cast("boolean")


def day(c: Column) -> Column:
    return c.cast("date")


def moment(c: Column) -> Column:
    """Event time without a zone; zoned input is read in UTC (the session zone)."""
    return c.cast("timestamp_ntz")


def hash_pii(c: Column) -> Column:
    """SHA-256 of the text form, as upper-case hex. NULL stays NULL."""
    return F.upper(F.sha2(c.cast("string"), 256))
