"""Column expressions over amounts, counts, dates and ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from girolens.functions.text import text

#: up to 18 integer digits, or up to 5 decimals; 18 digits in total are allowed
MONEY = "decimal(23,5)"
MONEY_SUM = "decimal(38,5)"
#: a digit behind the fifth decimal, which a cast would round away
_TOO_FINE = r"\.\d{5}\d*[1-9]"


def amount(raw: Column) -> Column:
    """Amount text as an exact decimal; unparsable text, and more than five decimals, become NULL."""
    clean = text(raw)
    return F.when(~clean.rlike(_TOO_FINE), clean.try_cast(MONEY))


def control_sum(raw: Column) -> Column:
    return text(raw).try_cast("decimal(38,17)")


def count_text(raw: Column) -> Column:
    """Declared count; anything but plain digits becomes NULL."""
    clean = text(raw)
    return F.when(clean.rlike("^[0-9]+$"), clean.try_cast("bigint"))


def iso_date(raw: Column) -> Column:
    clean = text(raw)
    return F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}$"), clean.try_cast("date"))


def plain(number: Column) -> Column:
    """Decimal without trailing zeros, with at least one digit after the point."""
    shown = F.regexp_replace(number.cast("string"), "0+$", "")
    return F.when(shown.endswith("."), F.concat(shown, F.lit("0"))).otherwise(shown)


def money_sum(value: Column, digits: int = 2) -> Column:
    """Exact decimal sum, rounded and shown as DOUBLE."""
    return F.round(F.sum(value).cast("double"), digits)


def money_avg(value: Column, digits: int = 2) -> Column:
    """Mean from an exact sum, so that it does not depend on the row order."""
    return F.round(F.sum(value).cast("double") / F.count(value), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded percentage; NULL when there is nothing to divide by."""
    return F.round(
        F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits
    )


def count_if(condition: Column) -> Column:
    """``COUNT(*) FILTER (WHERE condition)``."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ladder(value: Column, steps: list[tuple[int, str]], top: str) -> Column:
    """Label of the first bound that the value stays below."""
    bound, name = steps[0]
    chain = F.when(value < bound, name)
    for bound, name in steps[1:]:
        chain = chain.when(value < bound, name)
    return chain.otherwise(top)


# Bucket labels of the two reports.
CREDIT_STEPS = [(100, "< 100"), (1_000, "100 – 999"), (10_000, "1k – 9,999"),
                (100_000, "10k – 99,999"), (1_000_000, "100k – 999,999")]
CREDIT_TOP = "≥ 1M"
REPORT_STEPS = [(1_000, "< 1,000"), (10_000, "1k – 9,999"), (100_000, "10k – 99,999"),
                (1_000_000, "100k – 999,999")]
REPORT_TOP = "1M – 10M"
REPORT_RANGE = (0, 10_000_000)
