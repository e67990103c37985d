"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierweave.functions.base import blank_to_null, col, group, strings, strip, truthy
from tierweave.fixed.scoring import AGGREGATOR_HOSTS

_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def _netloc(url: Column) -> Column:
    return F.regexp_extract(url, _NETLOC, 1)


def _path(url: Column) -> Column:
    """Path part: scheme, authority, query and fragment removed."""
    rest = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?", "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def normalize_url(url: Column | str) -> Column:
    """Trim, cut the fragment, drop trailing slashes."""
    return F.rtrim(F.split_part(strip(url), F.lit("#"), F.lit(1)), F.lit("/"))


def extract_domain(url: Column | str) -> Column:
    """Authority (or, without one, the path), a literal leading ``www.`` off, lower-cased."""
    u = col(url)
    raw = F.coalesce(blank_to_null(_netloc(u)), _path(u))
    return F.lower(F.regexp_replace(raw, r"^www\.", ""))


def host_for_policy(url: Column | str) -> Column:
    """Lower-cased host without user info, port and leading ``www.``."""
    host = F.lower(F.regexp_extract(_netloc(col(url)), r"^(?:.*@)?([^:@]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def is_aggregator(url: Column | str) -> Column:
    return host_for_policy(url).isin(*AGGREGATOR_HOSTS)


def is_web_url(url: Column | str) -> Column:
    return col(url).rlike("^https?://")


def search_url(query: Column) -> Column:
    return F.concat(F.lit("https://www.bing.com/search?q="), F.url_encode(query))


def company_url(website, wikipedia, company_name, name) -> Column:
    """Website, else encyclopedia page, else a web search for the company."""
    title = F.coalesce(blank_to_null(company_name), col(name))
    return F.coalesce(
        blank_to_null(website), blank_to_null(wikipedia),
        F.concat(search_url(title), F.lit("+AI")),
    )


def migrated_company_url(website, crunchbase, linkedin, github, name) -> Column:
    """Website, else the first social page, else a web search."""
    return F.coalesce(
        *[blank_to_null(strip(c)) for c in (website, crunchbase, linkedin, github)],
        search_url(F.concat(col(name), F.lit(" AI"))),
    )


def resolve_url(base: str, href: Column | str, icon: bool = False) -> Column:
    """Absolute form of ``href``; a relative icon without a leading slash is dropped."""
    h = col(href)
    bare = F.lit(None).cast("string") if icon else F.concat(F.lit(base + "/"), h)
    return (
        F.when(h.startswith("http"), h)
        .when(h.startswith("/"), F.concat(F.lit(base), h))
        .when(truthy(h), bare)
    )


def icon_candidates(url: Column | str) -> Column:
    """Four icon addresses by preference; empty when there is no domain."""
    u = col(url)
    domain = F.coalesce(
        blank_to_null(_netloc(u)), blank_to_null(F.split_part(_path(u), F.lit("/"), F.lit(1)))
    )
    found = F.array(
        F.concat(F.lit("https://"), domain, F.lit("/favicon.ico")),
        F.concat(F.lit("https://"), domain, F.lit("/apple-touch-icon.png")),
        F.concat(F.lit("https://logo.clearbit.com/"), domain),
        F.concat(F.lit("https://www.google.com/s2/favicons?domain="), domain, F.lit("&sz=128")),
    )
    return F.when(domain.isNotNull(), found).otherwise(strings([]))


def company_logo_candidates(website: Column | str, name: Column | str) -> Column:
    """Icon addresses of the website, or guesses from the name when there is none."""
    stem = F.regexp_replace(F.lower(col(name)), "[ -]", "")
    guesses = F.transform(
        strings([".com", ".ai", ".io"]),
        lambda tld: F.concat(F.lit("https://logo.clearbit.com/"), stem, tld),
    )
    return (
        F.when(truthy(website), icon_candidates(website))
        .when(truthy(name), guesses)
        .otherwise(strings([]))
    )


def date_from_url(url: Column | str) -> Column:
    """Date of a ``/yyyy/mm/dd/`` path."""
    day = group(url, r"/(\d{4}/\d{2}/\d{2})/")
    return F.try_to_date(day, "yyyy/MM/dd")


def repo_url(project_urls: Column) -> Column:
    """First known key whose link points to a code host."""
    from tierweave.fixed.sources import REPO_KEYS

    def hit(key):
        u = F.try_element_at(project_urls, F.lit(key))
        return F.when(u.contains("github.com") | u.contains("gitlab.com"), u)

    return F.coalesce(*[hit(k) for k in REPO_KEYS])
