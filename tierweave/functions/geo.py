"""Places, categories, trust and model facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierweave.fixed import geo, scoring, sources, taxonomy
from tierweave.functions.base import (
    blank_to_null, col, first_match, lookup, strings, strip, truthy,
)
from tierweave.functions.text import slugify


def normalize_country(country: Column | str) -> Column:
    """Canonical country name, else the trimmed input; NULL for NULL or ''."""
    c = col(country)
    known = lookup(strip(F.lower(c)), geo.COUNTRY_NAMES)
    return F.when(truthy(c), F.coalesce(known, strip(c)))


def country_code(country: Column | str) -> Column:
    return lookup(normalize_country(country), geo.COUNTRY_CODES)


def normalize_category(category: Column | str, valid=taxonomy.CATEGORY_IDS) -> Column:
    slug = slugify(category)
    known = lookup(slug, taxonomy.CATEGORY_ALIASES, slug)
    return F.when(known.isin(*valid), known)


def headquarters_city(text: Column | str) -> Column:
    return strip(F.split(col(text), ",")[0])


def headquarters_country(text: Column | str) -> Column:
    parts = F.split(col(text), ",")
    return F.when(F.size(parts) > 1, strip(F.element_at(parts, -1)))


def format_location(city, state, country) -> Column:
    return F.concat_ws(", ", col(city), blank_to_null(state), col(country))


def trust_score(tier: Column | str) -> Column:
    t = col(tier)
    return F.coalesce(*[F.when(t == k, F.lit(v)) for k, v in scoring.TRUST.items()])


def guess_org(name: Column | str, table, mode: str) -> Column:
    """Organisation of the first fragment, in table order, found in the lower-cased name."""
    return first_match(F.lower(col(name)), table, mode)


def likely_open_source(name: Column | str, license_name: Column | str) -> Column:
    low, lic = F.lower(col(name)), F.lower(col(license_name))
    return (
        F.when(_starts(low, sources.CLOSED_PREFIXES), F.lit(False))
        .when(truthy(lic) & ~lic.isin("proprietary", "unknown"), F.lit(True))
        .when(_starts(low, sources.OPEN_PREFIXES), F.lit(True))
    )


def _starts(text: Column, prefixes) -> Column:
    return text.rlike("^(" + "|".join(p.replace(".", r"\.") for p in prefixes) + ")")


def parse_modalities(text: Column | str) -> Column:
    """Sorted known modalities of ``a+b->c``; text when there is none."""
    parts = F.transform(
        F.split(F.replace(col(text), F.lit("->"), F.lit("+")), r"\+"),
        lambda p: F.lower(strip(p)),
    )
    known = F.array_sort(F.array_distinct(F.filter(parts, lambda p: p.isin(*sources.KNOWN_MODALITIES))))
    return F.when(truthy(text) & (F.size(known) > 0), known).otherwise(strings(["text"]))


def task_modalities(task: Column | str) -> Column:
    t = col(task)
    out = F.coalesce(
        *[F.when(t.isin(*tasks), strings(mods)) for mods, tasks in sources.TASK_MODALITIES]
    )
    return F.coalesce(out, strings([]))


def architecture_tags(tags: Column) -> Column:
    lows = F.transform(tags, lambda t: F.lower(t))
    return F.filter(lows, lambda t: t.isin(*sources.ARCHITECTURE_NAMES))


def license_spdx(card_license: Column | str, tags: Column) -> Column:
    known = F.filter(tags, lambda t: t.isin(*sources.LICENSES))
    chosen = F.coalesce(blank_to_null(card_license), F.try_element_at(known, F.lit(1)))
    return lookup(chosen, sources.LICENSES, chosen)
