"""Security identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes that name no country.
SUPRANATIONAL = ("XS", "XA", "XB", "XC", "XD", "XF", "XK", "EU", "QS", "QT")


def normalise(raw: Column) -> Column:
    """Without separators, in upper case; blank is null."""
    return F.nullif(F.upper(F.regexp_replace(raw.cast("string"), r"[\s\-._/]+", "")), F.lit(""))


def check_digit(body: Column) -> Column:
    """The ISO 6166 digit of an 11-character body: letters as two digits, every other digit from the right doubled."""
    digits = F.array_join(F.transform(F.split(body, ""), lambda c: F.conv(c, 36, 10)), "")
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * (2 - i % 2))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.floor(d / 10).cast("int") + d % 10)
    return F.pmod(-total, F.lit(10))


def is_valid(code: Column) -> Column:
    """True or false; null codes are not valid."""
    shaped = F.coalesce(code.rlike("^[A-Z]{2}[A-Z0-9]{9}[0-9]$"), F.lit(False))
    return F.when(shaped, check_digit(F.substring(code, 1, 11)) == F.substring(code, 12, 1).cast("int")).otherwise(F.lit(False))


def valid_or_null(raw: Column) -> Column:
    code = normalise(raw)
    return F.when(is_valid(code), code)


def require(raw: Column) -> Column:
    """The normalised code; the query fails on one that is not valid."""
    code = normalise(raw)
    return F.when(is_valid(code), code).otherwise(F.raise_error(F.concat(F.lit("invalid ISIN: "), F.coalesce(raw.cast("string"), F.lit("null")))))


def country(raw: Column) -> Column:
    code = valid_or_null(raw)
    return F.when(~F.substring(code, 1, 2).isin(*SUPRANATIONAL), F.substring(code, 1, 2))


def surrogate_key(mic: Column, ticker: Column) -> Column:
    return F.concat(F.lit("US:"), mic, F.lit(":"), ticker)


def is_surrogate(key: Column) -> Column:
    return F.coalesce(key.startswith("US:"), F.lit(False))


def key(raw: Column) -> Column:
    """A surrogate as it is, else the valid code, else null."""
    return F.when(is_surrogate(raw), raw).otherwise(valid_or_null(raw))


def bucket(code: Column, n: int = 64) -> Column:
    """Stable over processes and runs."""
    return F.pmod(F.xxhash64(code), F.lit(n)).cast("short")
