"""Column expressions for strict parsing of landing text (money, timestamps, integers, missingness)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the landing rules.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
ZERO_PATTERN = r"^[+-]?(0+(\.0*)?|\.0+)([eE][+-]?\d+)?\z"
# Without an exponent only zeros behind the second fraction digit; with one (down to -9) up to nine fraction digits.
MONEY_PATTERN = (r"^[+-]?((\d+(\.\d{0,2}0*)?|\.\d{1,2}0*)"
                 r"|(\d{1,20}(\.\d{0,9})?|\.\d{1,9})[eE](\+?0*\d{1,2}|-0*\d))\z")
POSITIVE_INT_PATTERN = r"^[1-9][0-9]*\z"
# Up to 13 integer digits: x*100 < 2^53, so rounding the parsed double to cents is exact.
PLAIN_MONEY_PATTERN = r"^[0-9]{1,13}(\.[0-9]{0,2})?\z"
MAX_INT = 2**31 - 1
MAX_CENTS = 2**63 - 1


def trimmed(c: Column) -> Column:
    """Strip all leading/trailing whitespace (``trim`` alone keeps tabs)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def is_missing(c: Column) -> Column:
    """Missing = NULL, empty or whitespace only; 'NA', 'null', '0' are values."""
    return F.coalesce(trimmed(c), F.lit("")) == ""


def strict_timestamp(c: Column) -> Column:
    """Exact ``YYYY-MM-DD HH:MM:SS`` text -> timestamp_ntz (no zone); impossible dates -> NULL."""
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))


def _general_cents(c: Column) -> Column:
    """Cents of decimal text, NULL where it is no number, finer than cents or beyond BIGINT. The pattern lets no text
    through that has more fraction digits than the cast keeps, so nothing is rounded away."""
    t = trimmed(c)
    x = F.when(t.rlike(MONEY_PATTERN), t.try_cast("decimal(38,18)"))
    whole = x.cast("decimal(22,2)")
    cents = (whole * 100).cast("decimal(38,0)")
    return F.when(t.rlike(ZERO_PATTERN), F.lit(0).cast("bigint")).when((whole.cast("decimal(38,18)") == x) & (F.abs(cents) <= F.lit(MAX_CENTS)), cents.cast("bigint"))


def _general_valid(c: Column, allow_negative: bool) -> Column:
    cents = _general_cents(c)
    return cents.isNotNull() if allow_negative else F.coalesce(cents >= 0, F.lit(False))


def _plain_cents(c: Column) -> Column:
    """'123', '123.4', '123.45' (<= 13 integer digits) -> exact cents via a double parse and rounding."""
    return F.round(c.cast("double") * 100).cast("bigint")


def money_valid(c: Column, allow_negative: bool = False) -> Column:
    """Decimal text, finite, at most two fraction digits after scaling, fits BIGINT cents (>= 0 unless allowed).
    Plain text takes a shorter path with the same answer; other forms (sign, exponent, spaces) are cast to a wide decimal."""
    return F.when(c.rlike(PLAIN_MONEY_PATTERN), F.lit(True)).otherwise(_general_valid(c, allow_negative))


def money_cents(c: Column, allow_negative: bool = False) -> Column:
    """Exact cents (BIGINT) of valid money text, NULL otherwise."""
    return (F.when(c.rlike(PLAIN_MONEY_PATTERN), _plain_cents(c))
            .when(_general_valid(c, allow_negative), _general_cents(c)))


def positive_int_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(POSITIVE_INT_PATTERN) & (c.try_cast("bigint") <= MAX_INT), F.lit(False))
