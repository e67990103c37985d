"""Money, sizes, prices and their display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierweave.fixed.sources import TC_FUNDING
from tierweave.functions.base import col, computed_once, group, lookup, strip

# Funding round -> display name, funding round -> badge class.
ROUND_NAMES = {
    "pre-seed": "Pre-Seed", "seed": "Seed", "series-a": "Series A", "series-b": "Series B",
    "series-c": "Series C", "series-d": "Series D", "series-e": "Series E",
    "series-f": "Series F", "growth": "Growth", "ipo": "IPO", "unknown": "Unknown",
}
ROUND_BADGES = {
    "pre-seed": "default", "seed": "default", "series-a": "primary", "series-b": "primary",
    "series-c": "primary", "series-d": "success", "series-e": "success",
    "series-f": "success", "growth": "warning", "ipo": "warning",
}


def money_value(raw: Column) -> Column:
    """Number of an amount like ``1,200.5M``; the suffix must be upper case."""
    def value(digits: Column) -> Column:
        suffix = F.right(digits, F.lit(1))
        factor = (
            F.when(suffix == "T", 1e12).when(suffix == "B", 1e9).when(suffix == "M", 1e6)
            .when(suffix == "K", 1e3).otherwise(1.0)
        )
        bare = F.when(suffix.isin("T", "B", "M", "K"), F.substr(digits, F.lit(1), F.length(digits) - 1)).otherwise(digits)
        return F.when(bare.rlike(r"^(\d+\.?\d*|\.\d+)$"), bare.try_cast("double")) * factor

    return computed_once(F.replace(strip(raw), F.lit(","), F.lit("")), value)


def parse_money(text: Column | str, pattern: str) -> Column:
    """Amount captured by the first match of ``pattern``."""
    return money_value(group(text, pattern))


def funding_amount(title: Column | str) -> Column:
    """USD amount of a funding headline."""
    raw = F.replace(group(title, TC_FUNDING, 1), F.lit(","), F.lit(""))
    number = F.when(raw.rlike(r"^(\d+\.?\d*|\.\d+)$"), raw.try_cast("double"))
    unit = F.lower(group(title, TC_FUNDING, 2))
    return number * F.when(unit.isin("billion", "b"), 1e9).otherwise(1e6)


def funding_round(title: Column | str) -> Column:
    """Round of a funding headline, as a slug."""
    return F.replace(F.lower(strip(group(title, TC_FUNDING, 3))), F.lit(" "), F.lit("-"))


def employee_range(text: Column | str) -> Column:
    """Standard range by the upper bound; text without a dash stays as it is."""
    def standard(raw: Column) -> Column:
        parts = F.split(raw, "-")
        low = parts[0].try_cast("int")
        high = F.rtrim(parts[1], F.lit("+")).try_cast("int")
        ranged = (
            F.when(low.isNull() | high.isNull(), raw)
            .when(high <= 10, "1-10").when(high <= 50, "11-50").when(high <= 200, "51-200")
            .when(high <= 500, "201-500").when(high <= 1000, "501-1000")
            .when(high <= 5000, "1001-5000").otherwise("5001+")
        )
        return F.when(raw.contains("-"), ranged).otherwise(raw)

    return computed_once(strip(F.replace(col(text), F.lit(","), F.lit(""))), standard)


def team_size_range(size: Column | str) -> Column:
    n = col(size)
    return (
        F.when(n <= 10, "1-10").when(n <= 50, "11-50").when(n <= 200, "51-200")
        .when(n <= 500, "201-500").when(n <= 1000, "501-1000")
        .when(n.isNotNull(), "1001-5000")
    )


def format_param_count(total: Column | str) -> Column:
    n = col(total)

    def short(unit: float, letter: str) -> Column:
        text = F.format_string(f"%.1f{letter}", n.cast("double") / unit)
        return F.replace(text, F.lit(f".0{letter}"), F.lit(letter))

    millions = F.bround(n.cast("double") / 1e6, 0).cast("long").cast("string")
    return (
        F.when(n >= 10**12, short(1e12, "T")).when(n >= 10**9, short(1e9, "B"))
        .when(n >= 10**6, F.concat(millions, F.lit("M"))).otherwise(n.cast("string"))
    )


def rounded(value: Column, places: int) -> Column:
    """Rounded half up as doubles are in SQL: scaled, cut to a whole number, scaled back.

    ``F.round`` goes by the shortest decimal form of a double: it makes 128.61 of 128.605, which times
    100 is less than 12860.5.
    """
    return F.round(value * 10.0**places, 0) / 10.0**places


def format_currency(amount: Column | str) -> Column:
    """Short dollar form: ``$1.2B``, ``$3M``, ``$45K``, ``$678``."""
    a = col(amount).cast("double")

    def whole(unit: float) -> Column:
        return F.round(a / unit, 0).cast("long").cast("string")

    billions = rounded(a / 1e9, 1).cast("decimal(20,1)").cast("string")
    plain = F.when(a == F.floor(a), a.cast("long").cast("string")).otherwise(a.cast("string"))
    return (
        F.when(a >= 1e9, F.concat(F.lit("$"), billions, F.lit("B")))
        .when(a >= 1e6, F.concat(F.lit("$"), whole(1e6), F.lit("M")))
        .when(a >= 1e3, F.concat(F.lit("$"), whole(1e3), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), plain))
    )


def format_round(name: Column | str) -> Column:
    return lookup(name, ROUND_NAMES, col(name))


def round_badge(name: Column | str) -> Column:
    return lookup(name, ROUND_BADGES, "default")


def price(text: Column | str) -> Column:
    """Positive per-token price, else NULL."""
    p = col(text).try_cast("double")
    return F.when(p > 0, p)


def price_per_million(text: Column | str) -> Column:
    p = price(text)
    return F.when(p.isNotNull(), F.format_string("%.4f", p * 1e6))


def pricing_model(prompt: Column | str, completion: Column | str) -> Column:
    free = price(prompt).isNull() & price(completion).isNull()
    return F.when(free, "free").otherwise("usage-based")


def chart_scale(amount: Column | str) -> Column:
    """Amount in billions."""
    return col(amount).cast("double") / 1e9


def clean_founded_year(year: Column | str, as_of: Column) -> Column:
    """NULL for the current year, before 1900 or in the future."""
    y = col(year)
    return F.when((y >= 1900) & (y < F.year(as_of)), y)


def year_of(text: Column | str, as_of: Column) -> Column:
    """Leading four digits as a year between 1900 and now."""
    y = F.substring(col(text), 1, 4).try_cast("int")
    return F.when(y.between(1900, F.year(as_of)), y)

