"""Listing extraction from page bodies, with native regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.fixed import sources as S
from tierweave.functions.base import computed_once, strip
from tierweave.functions.text import is_table_header, looks_like_salary

#: Places of one page; pages are numbered below 2**31.
POSITIONS = 1 << 32


def matches(body: Column, pattern: str, groups: int) -> Column:
    """Array of structs g1..gn, one per match; a group that took no part is ''."""
    parts = [F.regexp_extract_all(body, F.lit(pattern), F.lit(g)) for g in range(1, groups + 1)]
    return F.transform(F.arrays_zip(*[p.alias(f"a{i}") for i, p in enumerate(parts)]), lambda z: F.struct(*[
        strip(z[f"a{i}"]).alias(f"g{i + 1}") for i in range(groups)
    ]))


def with_fallback(first: Column, second: Column, fewer_than: int, replace: bool = False) -> Column:
    """``first``, extended (or replaced) by ``second`` when it has too few entries."""
    return computed_once(first, lambda found: F.when(
        F.size(found) < fewer_than, second if replace else F.concat(found, second)
    ).otherwise(found))


def explode_entries(landed: DataFrame, entries: Column) -> DataFrame:
    """One row per entry, with its place in arrival order."""
    return landed.select("seq", "url", F.posexplode(entries).alias("pos", "e")).select(
        (F.col("seq") * POSITIONS + F.col("pos")).alias("seq"), F.col("url").alias("page_url"), "e.*"
    )


def page_slug(url: str = "url") -> Column:
    """Last path part of the page address."""
    return F.element_at(F.split(F.rtrim(F.col(url), F.lit("/")), "/"), -1)


def nav_links(pages: DataFrame, nav_words=S.TAAFT_NAV) -> DataFrame:
    """(page_id, pos, href, name) of the list links of a page that are no navigation words."""
    from tierweave.functions.text import is_listing_name

    links = matches(F.col("html"), r'<li><a href="([^"]*)">([^<]*)</a></li>', 2)
    return pages.select("page_id", F.posexplode(links).alias("pos", "e")).select(
        "page_id", "pos", F.col("e.g1").alias("href"), F.col("e.g2").alias("name")
    ).filter(is_listing_name(F.col("name"), nav_words))


# ---------------------------------------------------------------- job pages


def _job(title: Column, company: Column, extra1: Column, extra2: Column) -> Column:
    """Fields of one advert; NULL for navigation."""
    def pick(test_first: Column, test_second: Column) -> Column:
        return F.coalesce(F.when(test_first, extra1), F.when(test_second, extra2), F.lit(""))

    pay1, pay2 = looks_like_salary(extra1), looks_like_salary(extra2)
    ok = (F.length(company) >= 2) & ~company.isin(*S.JOB_NAV) & ~title.isin(*S.JOB_NAV)
    salary = F.coalesce(F.when(pay2, extra2), F.when(pay1, extra1), F.lit(""))
    location = pick((extra1 != "") & ~pay1, (extra2 != "") & ~pay2)
    return F.when(ok, F.struct(
        company.alias("company_name"), location.alias("location"), title.alias("job_title"), salary.alias("salary"),
    ))


def job_listings(landed: DataFrame) -> DataFrame:
    """Adverts of job pages: headings, then tables, then cards while fewer than three."""
    body = F.col("body")
    none = F.lit("")
    headings = F.array_compact(F.transform(matches(body, S.JOB_HEADING, 4), lambda m: _job(m["g1"], m["g2"], m["g3"], m["g4"])))
    tables = F.transform(
        F.filter(matches(body, S.JOB_TABLE, 3), lambda m: ~is_table_header(m["g1"], m["g2"])),
        lambda m: F.struct(m["g2"].alias("company_name"), m["g3"].alias("location"), m["g1"].alias("job_title"), F.lit("").alias("salary")),
    )
    cards = F.array_compact(F.transform(matches(body, S.JOB_CARD, 3), lambda m: _job(m["g1"], m["g2"], m["g3"], none)))
    # not a column of its own: Spark would also filter by its size, and run every pattern again for that
    return explode_entries(landed, with_fallback(with_fallback(headings, tables, 3), cards, 3))



