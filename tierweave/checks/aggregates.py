"""Counts, leaderboards, first-seen, limits and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave.bindings import CATALOG, LISTINGS
from tierweave.checks.functions import DOMAIN_SQL, as_of
from tierweave.checks.registry import bound, query
from tierweave.fixed.taxonomy import TAGS
from tierweave.operators import index, normalize, quota, resolve, stats
from tierweave.session import cut_lineage, spread

WITH = "WITH " + bound(CATALOG, "c") + " "
FILE = "slug || '.json'"
TAG_ROWS = "(VALUES " + ", ".join(f"('{d}', '{t}')" for d, t, *_ in TAGS) + ") AS v(dimension, tag)"
UNNESTED = "(SELECT slug, unnest(string_split(tags_text, '|')) AS tag FROM c WHERE tags_text <> '')"


@query("a1_count_by_category", WITH + "SELECT category AS label, count(*) AS count FROM c WHERE category IS NOT NULL GROUP BY 1")
def _(t):
    return stats.count_by(t.catalog, F.col("category"))


@query("a1_count_by_status", WITH + "SELECT status AS label, count(*) AS count FROM c WHERE status IS NOT NULL GROUP BY 1")
def _(t):
    return stats.count_by(t.catalog, F.col("status"))


@query("a2_count_by_country", WITH + "SELECT country AS label, count(*) AS count FROM c WHERE country <> '' GROUP BY 1")
def _(t):
    return stats.count_by_country(t.catalog)


@query("a3_count_by_tag_dimension", WITH + f"SELECT dimension, tag, count(*) AS count FROM {UNNESTED} JOIN {TAG_ROWS} USING (tag) GROUP BY ALL")
def _(t):
    return stats.count_by_tag_dimension(t.catalog, t.tags)


@query("j17_tag_to_dimension", WITH + f"SELECT slug, dimension, tag FROM {UNNESTED} JOIN {TAG_ROWS} USING (tag)")
def _(t):
    long = t.catalog.select("slug", F.explode("tags").alias("tag"))
    return long.join(F.broadcast(t.tags.withColumnRenamed("tag_id", "tag")), "tag").select("slug", "dimension", "tag")


@query("a4_total_funding", WITH + "SELECT CAST(sum(coalesce(CAST(total_raised_usd AS DECIMAL(30,2)), 0)) AS DOUBLE) AS total_funding_usd FROM c")
def _(t):
    return stats.total_funding(t.catalog)


@query("a5_totals", WITH + "SELECT count(*) AS total_products, count(*) FILTER (WHERE open_source) AS open_source_count, CAST(sum(CAST(total_raised_usd AS DECIMAL(30,2))) AS DOUBLE) AS total_funding_usd FROM c")
def _(t):
    return stats.totals(t.catalog)


@query("a6_stats", WITH + f"""SELECT 'total' AS metric, 'products' AS label, count(*) AS count, CAST(sum(CAST(total_raised_usd AS DECIMAL(30,2))) AS DOUBLE) AS amount FROM c
 UNION ALL SELECT 'by_category', category, count(*), NULL FROM c WHERE category IS NOT NULL GROUP BY category
 UNION ALL SELECT 'by_status', status, count(*), NULL FROM c WHERE status IS NOT NULL GROUP BY status
 UNION ALL SELECT 'by_country', country, count(*), NULL FROM c WHERE country <> '' GROUP BY country
 UNION ALL SELECT 'open_source', 'true', count(*), NULL FROM c WHERE open_source
 UNION ALL SELECT 'tag:' || dimension, tag, count(*), NULL FROM {UNNESTED} JOIN {TAG_ROWS} USING (tag) GROUP BY 1, 2""")
def _(t):
    return stats.stats(t.catalog, t.tags)


@query("a7_tab_counts", WITH + "SELECT category, count(*) AS count FROM c WHERE category IS NOT NULL GROUP BY 1 UNION ALL SELECT 'All', count(*) FROM c")
def _(t):
    return index.tab_counts(index.index_projection(t.catalog))


@query("a8_country_facets", WITH + "SELECT DISTINCT country FROM c WHERE country <> ''")
def _(t):
    return index.country_facets(index.index_projection(t.catalog))


@query("a9_leaderboard_fold", """SELECT model_key, array_to_string(list_sort(list(benchmark || '=' || score)), ',') AS scores, min(first_paper) AS paper_url FROM (
  SELECT DISTINCT l_partkey AS model_key, l_returnflag AS benchmark,
   first_value(CAST(l_quantity AS VARCHAR)) OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS score,
   first_value(CASE WHEN l_linenumber % 2 = 0 THEN '/paper/' || l_orderkey END IGNORE NULLS) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_paper
  FROM lineitem) GROUP BY model_key""")
def _(t):
    entries = t.lineitem.select(
        F.col("l_shipdate").alias("page"), F.struct("l_orderkey", "l_linenumber").alias("pos"), F.col("l_partkey").cast("string").alias("model"),
        F.col("l_returnflag").alias("benchmark"), F.col("l_quantity").cast("string").alias("score"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("/paper/"), "l_orderkey")).alias("paper_url"))
    out = resolve.fold_leaderboard(entries)
    pairs = F.array_sort(F.transform(F.map_entries("benchmarks"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select(F.col("model_key").cast("bigint").alias("model_key"), F.array_join(pairs, ",").alias("scores"), "paper_url")


L = "WITH " + bound(LISTINGS, "l") + ", k AS (SELECT *, CASE WHEN company_website <> '' THEN " + DOMAIN_SQL.format("company_website") + " ELSE trim(lower(name)) END AS entity FROM l) "
_first = "arg_min({0}, seq) FILTER (WHERE {1})"


@query("a10_collapse_listings", L + f"""SELECT entity, min(seq) AS seq, arg_min(name, seq) AS name, arg_min(source, seq) AS source,
  coalesce({_first.format('description', "description <> ''")}, arg_min_null(description, seq)) AS description,
  coalesce({_first.format('company_founded_year', 'company_founded_year <> 0')}, arg_min_null(company_founded_year, seq)) AS founded,
  coalesce({_first.format('open_source', 'open_source')}, arg_min_null(open_source, seq)) AS open_source, any_value(tags) AS tags
  FROM k JOIN (SELECT entity, string_agg(tag, '|' ORDER BY pos) AS tags FROM (SELECT entity, tag, min(pos) AS pos FROM (
     SELECT entity, string_split(tags_text, '|')[1] AS tag, seq * 2 AS pos FROM k UNION ALL SELECT entity, string_split(tags_text, '|')[2], seq * 2 + 1 FROM k) GROUP BY ALL) GROUP BY entity) g USING (entity)
  GROUP BY entity""")
def _(t):
    out = resolve.collapse_listings(t.listings)
    return out.select(resolve.collapse_key().alias("entity"), "seq", "name", "source", "description", F.col("company_founded_year").alias("founded"), "open_source", F.array_join("tags", "|").alias("tags"))


def _judged(t):
    # read by every step of resolving
    r = cut_lineage(normalize.with_issues(normalize.normalize(spread(t.incoming)), as_of()))
    found = resolve.resolve(r, t.catalog)
    return found.select("source", (F.size("issues") > 0).alias("rejected"), "match_slug")


@query("a13_run_summary")
def _(t):
    return stats.run_summary(_judged(t))


# ---------------------------------------------------------------- first seen, limits, quota


@query("w1_first_seen", "SELECT event_type, user_id, arg_min(event_id, ts) AS event_id FROM events GROUP BY ALL")
def _(t):
    return quota.first_seen(t.events.select("event_type", "user_id", "ts", "event_id"), "event_type", "user_id", order="ts").select("event_type", "user_id", "event_id")


@query("w2_limit_per_source", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 50")
def _(t):
    return quota.limit_per_source(t.events, 50, "event_type", "event_id").select("event_type", "event_id")


@query("w6_admit_daily", "SELECT event_id, CAST(ts AS DATE) AS day FROM events QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 100")
def _(t):
    return quota.admit_daily(t.events).select("event_id", F.to_date("ts").alias("day"))


@query("w6_daily_usage", "SELECT CAST(ts AS DATE) AS day, CAST(least(count(*), 100) AS BIGINT) AS used, CAST(greatest(100 - count(*), 0) AS BIGINT) AS remaining FROM events GROUP BY 1")
def _(t):
    return quota.daily_usage(t.events)


@query("o2_funding_leaderboard", WITH + f"SELECT slug, name, total_raised_usd, coalesce(valuation_usd, 0) AS valuation_usd FROM c WHERE total_raised_usd > 0 ORDER BY total_raised_usd DESC, {FILE} LIMIT 10")
def _(t):
    return stats.funding_leaderboard(t.catalog)


@query("o3_recently_added", WITH + f"SELECT slug, name, added_date FROM c ORDER BY added_date DESC, {FILE} LIMIT 5")
def _(t):
    return stats.recently_added(t.catalog)

