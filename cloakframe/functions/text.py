"""Text and number helpers shared by the operators. All are built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that trimming removes at both ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A plain decimal number: optional sign before or after, thousands commas, no exponent.
_UNSIGNED = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)"
_PAD = r"[\t-\r ]*"
NUMBER = rf"^{_PAD}(?:[+-]?{_UNSIGNED}{_PAD}|{_UNSIGNED}{_PAD}[+-]{_PAD})$"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_any(text: Column, parts: tuple[str, ...]) -> Column:
    return any_of([text.contains(p) for p in parts])


def is_blank(text: Column) -> Column:
    """Empty or only white space."""
    return ~text.rlike(r"(?U)\S")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def digits_of(text: Column) -> Column:
    """All decimal digits of the text, in order."""
    return F.regexp_replace(text, r"\P{Nd}+", "")


def one_line(text: Column, max_chars: int | None = None) -> Column:
    """Carriage return, line feed and tab become spaces; then, if asked, the first ``max_chars`` characters."""
    line = F.translate(text, "\r\n\t", "   ")
    return line if max_chars is None else F.left(line, F.lit(max_chars))


def hash_text(value: Column) -> Column:
    """A binary hash as ``0x…`` text."""
    return F.concat(F.lit("0x"), F.hex(value))


def has_text(text: Column) -> Column:
    """Length above zero, trailing spaces not counted."""
    return F.length(F.rtrim(text)) > 0


def number_body(text: Column) -> Column:
    """Digits and the decimal point of a text that is a plain number."""
    return F.regexp_replace(text, "[^0-9.]+", "")


def parse_decimal(text: Column, precision: int = 38, scale: int = 10) -> Column:
    """Plain decimal number as DECIMAL, else NULL. Exponents are not numbers here."""
    signed = F.concat(F.when(text.contains("-"), F.lit("-")).otherwise(F.lit("")), number_body(text))
    return F.when(text.rlike(NUMBER), signed.try_cast(f"decimal({precision},{scale})"))


def plain_number(value: Column, plain_below: float = 1e15) -> Column:
    """A float as text without exponent from 0.0001 up to ``plain_below``: ``12345678.9``, not ``1.23456789E7``.
    Beyond, the exponent has a sign and two digits: ``1E+20``."""
    text = value.cast("string")
    # The shortest text has all digits; with an exponent, the point is moved.
    sign = F.when(text.startswith("-"), "-").otherwise("")
    first = F.regexp_extract(text, r"^-?([0-9])\.[0-9]+E", 1)
    more = F.regexp_replace(F.regexp_extract(text, r"\.([0-9]+)E", 1), "0+$", "")
    exponent = F.coalesce(F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), first, more)
    whole = F.rpad(F.concat(first, F.substring(more, F.lit(1), exponent)), exponent + 1, "0")
    rest = F.substr(more, exponent + 1)
    large = F.when(F.length(rest) > 0, F.concat(whole, F.lit("."), rest)).otherwise(whole)
    moved = F.concat(sign, F.when(exponent < 0, small).otherwise(large))
    shown = F.when(text.contains("E"), moved).otherwise(F.regexp_replace(text, r"\.0$", ""))
    signed = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E([0-9])", "E+$1")
    padded = F.regexp_replace(signed, r"E([+-])([0-9])$", "E$10$2")
    fits = (F.abs(value) >= 1e-4) & (F.abs(value) < plain_below) | (value == 0)
    return F.when(fits, shown).otherwise(padded)


def decimal_ratio(numerator: Column, denominator: Column, scale: int, precision: int = 18) -> Column:
    """Exact decimal division of two whole numbers, rounded half up."""
    wide = "decimal(20,0)"
    return (numerator.cast(wide) / denominator.cast(wide)).cast(f"decimal({precision},{scale})")


def or_zero(value: Column, data_type: str) -> Column:
    """NULL becomes 0; anything else is converted to the narrower type."""
    return F.coalesce(value.cast(data_type), F.lit(0).cast(data_type))
