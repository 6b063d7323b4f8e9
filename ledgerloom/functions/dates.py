"""Dates as text, as publishers write them, and their parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import values as V
from .text import let, link_text, strip

_NAMES = "|".join(sorted(V.MONTHS, key=len, reverse=True))


def month_number(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in V.MONTHS.items() for x in (k, v)])
    return F.try_element_at(table, F.lower(name))


def four_digit_year(y: Column) -> Column:
    return F.when(y >= 100, y).when(y < 50, 2000 + y).otherwise(1900 + y)


def _text(day: Column, month: Column, year: Column) -> Column:
    ok = month.between(1, 12) & day.between(1, 31) & year.between(1900, 2100)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(ok, F.concat_ws("/", pad(day, 2), pad(month, 2), pad(year, 4)))


def standard_date(raw: Column) -> Column:
    """``DD/MM/YYYY`` of a date in any known form, else null. Only ranges are checked, so 31/02/2024 stays; use typed_date."""
    return let(strip(raw), _standard)


def _standard(s: Column) -> Column:
    """A pattern is tried once a row; its parts are taken out only where it matches."""
    part = lambda p, i: F.regexp_extract(s, p, i)
    number = lambda p, i: part(p, i).cast("int")
    text = lambda day, month, year: let(F.struct(day.alias("d"), month.alias("m"), year.alias("y")), lambda x: _text(x["d"], x["m"], x["y"]))
    rules = []
    for p in (r"^(\d{4})-(\d{2})-(\d{2})(?:[T\s]+\d{2}:\d{2}:\d{2}.*)?$", r"^(\d{4})(\d{2})(\d{2})$"):
        rules.append(F.when(s.rlike(p), text(number(p, 3), number(p, 2), number(p, 1))))
    for p in (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:\s+\d{2}:\d{2}(?::\d{2}.*)?)?$", r"^(\d{1,2})/(\d{1,2})/(\d{2})$", r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", r"^(\d{1,2})-(\d{1,2})-(\d{4})$", r"^(\d{1,2})\s+(\d{1,2})\s+(\d{4}|\d{2})$"):
        rules.append(F.when(s.rlike(p), text(number(p, 1), number(p, 2), let(number(p, 3), four_digit_year))))
    for p in (r"^(\d{1,2})-([A-Za-z]+)-(\d{4}|\d{2})$", r"^(\d{1,2})/([A-Za-z]+)/(\d{4}|\d{2})$", r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4}|\d{2})$"):
        rules.append(F.when(s.rlike(p), text(number(p, 1), let(part(p, 2), month_number), let(number(p, 3), four_digit_year))))
    serial = r"^(\d{5})$"
    rules.append(F.when(s.rlike(serial) & (number(serial, 1) >= 1), F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), number(serial, 1)), "dd/MM/yyyy")))
    return F.coalesce(*rules)


def year_of(date_text: Column) -> Column:
    return F.substring(date_text, 7, 4)


def typed_date(date_text: Column) -> Column:
    return F.try_to_timestamp(date_text, F.lit("dd/MM/yyyy")).cast("date")


def month_of(date_text: Column) -> Column:
    """Month of a strict DD/MM/YYYY date, null where the day does not exist."""
    return F.month(typed_date(F.when(date_text.rlike(r"^\d{2}/\d{2}/\d{4}$"), date_text)))


def date_in_filename(filename: Column) -> Column:
    """First of the month that a file name tells, as DD/MM/YYYY."""
    rules = [
        (rf"(?i)({_NAMES})[\s/\\\-_](\d{{2,4}})\b", 1, 2), (rf"(?i)({_NAMES})(\d{{4}})(?!\d)", 1, 2), (rf"(?i)({_NAMES})(\d{{2}})(?!\d)", 1, 2),
        (rf"(?i)\b(\d{{4}})[\s/\\\-_]({_NAMES})", 2, 1), (rf"(?i)\b(\d{{4}})({_NAMES})", 2, 1),
    ]

    def first(name: Column) -> Column:
        parts = [(p, F.struct(F.regexp_extract(name, p, m).alias("m"), F.regexp_extract(name, p, y).cast("int").alias("y"))) for p, m, y in rules]
        return F.coalesce(*[F.when(name.rlike(p), let(x, lambda x: _text(F.lit(1), month_number(x["m"]), four_digit_year(x["y"])))) for p, x in parts])

    return let(F.regexp_replace(filename, r"\.[^.]*$", ""), first)


def period_month(raw: Column) -> Column:
    """``01/MM/YYYY`` of a period YYYYMM; other text unchanged."""
    s = F.regexp_replace(F.coalesce(raw, F.lit("")), r"[,£$€\s]", "")
    ok = s.rlike(r"^20\d{2}(?:0[1-9]|1[0-2])$")
    return F.when(ok, F.concat(F.lit("01/"), F.substring(s, 5, 2), F.lit("/"), F.substring(s, 1, 4))).otherwise(raw)


def months_covered(text: Column) -> Column:
    """First days of the months that a link text covers: a fiscal quarter (Q1 is April to June; Q4 lies in the next
    year), a quarter in words, a range of months (which may cross the year), one month, or a year."""
    s = F.lower(text)
    x = lambda p, i: F.regexp_extract(s, p, i)
    day = lambda y, m: F.make_date(y, m, F.lit(1))
    seq = lambda a, b: F.when(a.isNotNull() & b.isNotNull() & (a <= b) & (F.months_between(b, a) < 24), F.sequence(F.coalesce(a, b), F.greatest(F.coalesce(b, a), F.coalesce(a, b)), F.expr("interval 1 month")))
    quarter = r"\b(?:q|quarter\s*)([1-4])\b.*?\b(20\d{2})"
    q, qy = x(quarter, 1).cast("int"), x(quarter, 2).cast("int")
    named = r"\b(first|second|third|fourth)\s+quarter\b.*?\b(20\d{2})"
    nq, ny = F.array_position(F.array(*[F.lit(w) for w in ("first", "second", "third", "fourth")]), x(named, 1)).cast("int"), x(named, 2).cast("int")
    fiscal = lambda n, y: seq(day(F.when(n == 4, y + 1).otherwise(y), F.when(n == 4, 1).otherwise(n * 3 + 1)), day(F.when(n == 4, y + 1).otherwise(y), F.when(n == 4, 3).otherwise(n * 3 + 3)))
    cross = rf"\b({_NAMES})\s+(20\d{{2}})\s*(?:-|–|to)\s*({_NAMES})\s+(20\d{{2}})"
    within = rf"\b({_NAMES})\s*(?:-|–|to)\s*({_NAMES})\s+(20\d{{2}})"
    wa, wb, wy = month_number(x(within, 1)), month_number(x(within, 2)), x(within, 3).cast("int")
    single, year = rf"\b({_NAMES})[\s_-]+(20\d{{2}})", r"\b(20\d{2})\b"
    y = x(year, 1).cast("int")
    return F.coalesce(
        F.when(s.rlike(quarter), fiscal(q, qy)), F.when(s.rlike(named), fiscal(nq, ny)),
        F.when(s.rlike(cross), seq(day(x(cross, 2).cast("int"), month_number(x(cross, 1))), day(x(cross, 4).cast("int"), month_number(x(cross, 3))))),
        F.when(s.rlike(within), seq(day(F.when(wa > wb, wy - 1).otherwise(wy), wa), day(wy, wb))),
        F.when(s.rlike(single), F.array(day(x(single, 2).cast("int"), month_number(x(single, 1))))),
        F.when(s.rlike(year), seq(day(y, F.lit(4)), day(y + 1, F.lit(3)))),
        F.array().cast("array<date>"),
    )


def period_kind(text: Column) -> Column:
    """quarterly, monthly or annual, by what a sample link text names."""
    s = F.lower(text)
    return F.when(s.rlike(r"\bq[1-4]\b|quarter") | s.rlike(rf"\b(?:{_NAMES})\s*(?:-|–|to)\s*(?:{_NAMES})\b"), "quarterly").when(s.rlike(rf"\b(?:{_NAMES})"), "monthly").when(s.rlike(r"20\d{2}"), "annual")


def period_pattern(text: Column) -> Column:
    """A pattern for the link texts of the same series as a sample: its own words, with months, years and quarters open.

    Null where the sample names no period; a year counts as one only if it is the whole text. Match it ignoring case.
    """
    s = F.lower(link_text(text))
    kind = period_kind(s)
    plain = F.regexp_replace(s, r"([^\w\s])", r"\\$1")
    months = F.regexp_replace(plain, rf"\b(?:{_NAMES})\b", r"[a-z]{3,9}")
    years = F.regexp_replace(months, r"\b20\d{2}\b", r"20\\d{2}")
    halves = F.regexp_replace(years, r"(20\\d\{2\}\\[/-])\d{2}\b", r"$1\\d{2}")
    quarters = F.regexp_replace(F.regexp_replace(halves, r"\bq[1-4]\b", "q[1-4]"), r"\bquarter\s+\w+", r"quarter \\w+")
    open_ = F.regexp_replace(quarters, r"\s+", r"\\s+")
    return F.when(kind.isin("quarterly", "monthly") | ((kind == "annual") & s.rlike(r"^\d{4}$")), F.concat(F.lit("(?i)"), open_))


def looks_like_date(c: Column) -> Column:
    return standard_date(c).isNotNull()
