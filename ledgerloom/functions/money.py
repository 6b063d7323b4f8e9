"""Amounts as text and as decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_amount(c: Column) -> Column:
    """Amount text without currency signs and thousands marks; a space before one or two last digits is a decimal point.
    Parentheses are not understood and stay, so such amounts are invalid."""
    s = strip(F.translate(c, "£$€, Â�", ""))
    s = F.regexp_replace(s, r"(\d) (?=\d{3}(?:\s|$))", "$1")
    s = F.regexp_replace(s, r"(\d) (\d{1,2})$", "$1.$2")
    return F.replace(s, F.lit(" "), F.lit(""))


def is_number(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMBER), F.lit(False))


def number(c: Column, kind: str = "decimal(18,2)") -> Column:
    return F.when(is_number(c), c.try_cast("decimal(38,6)")).cast(kind)


def round2(c: Column) -> Column:
    """Two decimals, decided on the decimal value, as a double."""
    return F.round(c.cast("decimal(28,6)"), 2).cast("double")


def resolve_amount(amount: Column, left: Column, right: Column, gross: Column, vat: Column) -> Column:
    """Amount text: as given; else left - right (an invalid right is 0); else gross - vat."""
    n = lambda c: number(clean_amount(c), "decimal(38,6)")
    two = lambda c: F.round(c, 2).cast("decimal(18,2)").cast("string")
    return F.coalesce(amount, two(n(left) - F.coalesce(n(right), F.lit(0))), two(n(gross) - F.coalesce(n(vat), F.lit(0))))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)
