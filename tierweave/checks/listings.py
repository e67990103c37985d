"""Extraction of listings from the page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave.checks.registry import in_list, query
from tierweave.fixed.sources import TAAFT_NAV
from tierweave.sources.extract import matches, nav_links

LINKS = """(SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS href, trim(unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2))) AS name FROM pages)"""


@query("x4_listing_links", f"SELECT page_id, href, name FROM {LINKS}")
def _(t):
    links = matches(F.col("html"), r'<li><a href="([^"]*)">([^<]*)</a></li>', 2)
    return t.pages.select("page_id", F.explode(links).alias("e")).select("page_id", F.col("e.g1").alias("href"), F.col("e.g2").alias("name"))


@query("p7_listing_filter", f"SELECT page_id, href, name FROM {LINKS} WHERE length(name) BETWEEN 2 AND 80 AND trim(lower(name)) NOT IN {in_list(TAAFT_NAV)} AND NOT regexp_matches(trim(lower(name)), '^(http|www\\.|#|/)')")
def _(t):
    return nav_links(t.pages).select("page_id", "href", "name")
