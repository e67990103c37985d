"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave.bindings import CATALOG
from tierweave.checks.registry import AS_OF, bound, case_map, first_hit, in_list, list_lit, lit, query
from tierweave.fixed import geo, migration, scoring, sources, taxonomy
from tierweave.functions import geo as G
from tierweave.functions import money as M
from tierweave.functions import text as X
from tierweave.functions import url as U
from tierweave.functions.money import ROUND_BADGES, ROUND_NAMES
from tierweave.functions.nested import get_json_nested, get_nested

def as_of():
    return F.lit(AS_OF).cast("date")

YEAR = AS_OF[:4]

SLUG_SQL = r"trim(regexp_replace(trim(regexp_replace(lower({0}), '[^a-z0-9_\s-]', '', 'g')), '[-\s]+', '-', 'g'), '-')"
SLUG_OK = r"regexp_full_match({0}, '[a-z0-9][a-z0-9-]*[a-z0-9]|[a-z0-9]')"


@query("f1_slugify", "SELECT p_partkey, " + SLUG_SQL.format("concat(p_name, ' & ', p_type, ' (', p_brand, ')')") + " AS slug FROM part")
def _(t):
    return t.part.select("p_partkey", X.slugify(F.concat("p_name", F.lit(" & "), "p_type", F.lit(" ("), "p_brand", F.lit(")"))).alias("slug"))


MIXED_SLUG = "CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', '-') WHEN 1 THEN p_name WHEN 2 THEN concat('-', p_type) WHEN 3 THEN '7' END"


@query("f2_valid_slug", f"SELECT p_partkey, coalesce({SLUG_OK.format(MIXED_SLUG)}, false) AS ok FROM part")
def _(t):
    return t.part.select("p_partkey", X.valid_slug(F.expr(MIXED_SLUG)).alias("ok"))


@query("f3_normalize_url", "SELECT page_id, rtrim(split_part(trim(url), '#', 1), '/') AS url FROM pages")
def _(t):
    return t.pages.select("page_id", U.normalize_url("url").alias("url"))


DOMAIN_SQL = r"lower(regexp_replace(coalesce(nullif(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), ''), regexp_extract({0}, '^([^?#]*)', 1)), '^www\.', ''))"


@query("f4_extract_domain", f"SELECT page_id, {DOMAIN_SQL.format('url')} AS domain, {DOMAIN_SQL.format(chr(39) + 'www.' + chr(39) + ' || split_part(url, ' + chr(39) + '//' + chr(39) + ', 2)')} AS bare FROM pages")
def _(t):
    return t.pages.select("page_id", U.extract_domain("url").alias("domain"), U.extract_domain(F.concat(F.lit("www."), F.split_part("url", F.lit("//"), F.lit(2)))).alias("bare"))


HOST_SQL = r"regexp_replace(lower(regexp_extract(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '^(?:.*@)?([^:@]*)', 1)), '^www\.', '')"


@query("f5_host_for_policy", "SELECT page_id, " + HOST_SQL.format("replace(url, 'example', 'user@Example')") + " AS host FROM pages")
def _(t):
    return t.pages.select("page_id", U.host_for_policy(F.replace("url", F.lit("example"), F.lit("user@Example"))).alias("host"))


@query("f6_get_nested", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.a.b') AS missing FROM events")
def _(t):
    return t.events.select("event_id", get_json_nested("props", "k").cast("bigint").alias("k"), get_json_nested("props", "a.b").alias("missing"))


@query("f6_get_nested_products", "WITH " + bound(CATALOG, "c") + " SELECT slug, city, company_website AS website, CAST(NULL AS INT) AS missing FROM c")
def _(t):
    c = t.catalog
    paths = {"city": "company.headquarters.city", "website": "company.website", "missing": "company.website.host"}
    return c.select("slug", *[get_nested(c.schema, p).cast("int" if n == "missing" else "string").alias(n) for n, p in paths.items()])


@query("f7_set_nested", "SELECT concat('part-', p_partkey) AS slug, 'Oslo' AS city FROM part")
def _(t):
    from tierweave.operators.merge import set_nested

    out = set_nested(t.part_catalog, "company.headquarters.city", F.lit("Oslo"))
    return out.select("slug", F.col("company.headquarters.city").alias("city"))


SUFFIXED = "concat('  ', c_name, CASE c_custkey % 7 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' ltd.' WHEN 3 THEN ' Corp' WHEN 4 THEN 'co' WHEN 5 THEN ' Co. Inc' ELSE '' END, ' ')"


@query("f8_normalize_name", rf"SELECT c_custkey, regexp_replace(trim({SUFFIXED}), '(?i)\s*(,?\s*(Inc\.?|LLC|Ltd\.?|Corp\.?|Co\.?))\s*$', '') AS name FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.normalize_name(F.expr(SUFFIXED)).alias("name"))


COUNTRY_IN = "CASE c_custkey % 9 WHEN 0 THEN ' USA ' WHEN 1 THEN 'uk' WHEN 2 THEN 'PRC' WHEN 3 THEN 'Atlantis ' WHEN 4 THEN '' WHEN 5 THEN 'Germany' WHEN 6 THEN 'kr' WHEN 7 THEN 'United States of America' END"
COUNTRY_SQL = f"CASE WHEN {COUNTRY_IN} <> '' THEN coalesce({case_map(f'lower(trim({COUNTRY_IN}))', geo.COUNTRY_NAMES)}, trim({COUNTRY_IN})) END"


@query("f9_normalize_country", f"SELECT c_custkey, {COUNTRY_SQL} AS country FROM customer")
def _(t):
    return t.customer.select("c_custkey", G.normalize_country(F.expr(COUNTRY_IN)).alias("country"))


@query("f10_country_code", f"SELECT c_custkey, {case_map(COUNTRY_SQL, geo.COUNTRY_CODES)} AS code FROM customer")
def _(t):
    return t.customer.select("c_custkey", G.country_code(F.expr(COUNTRY_IN)).alias("code"))


CATEGORY_IN = "CASE p_partkey % 6 WHEN 0 THEN 'AI App' WHEN 1 THEN 'ai-data' WHEN 2 THEN 'AI Foundation  Model' WHEN 3 THEN p_type WHEN 4 THEN 'ai_hardware' END"
_slug = SLUG_SQL.format(CATEGORY_IN)
_alias = case_map(_slug, taxonomy.CATEGORY_ALIASES, _slug)


@query("f11_normalize_category", f"SELECT p_partkey, CASE WHEN {_alias} IN {in_list(taxonomy.CATEGORY_IDS)} THEN {_alias} END AS category FROM part")
def _(t):
    return t.part.select("p_partkey", G.normalize_category(F.expr(CATEGORY_IN)).alias("category"))


@query("f14_company_url", "SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN 'https://a.example' WHEN c_custkey % 3 = 1 THEN '' END, ''), nullif(CASE WHEN c_custkey % 2 = 0 THEN 'https://w.example' END, ''), 'https://www.bing.com/search?q=' || replace(replace(c_name || ' ' || c_mktsegment, '#', '%23'), ' ', '+') || '+AI') AS url FROM customer")
def _(t):
    site = F.expr("CASE WHEN c_custkey % 3 = 0 THEN 'https://a.example' WHEN c_custkey % 3 = 1 THEN '' END")
    wiki = F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'https://w.example' END")
    return t.customer.select("c_custkey", U.company_url(site, wiki, F.lit(None).cast("string"), F.concat_ws(" ", "c_name", "c_mktsegment")).alias("url"))


@query("f15_migrated_company_url", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'https://a.example' WHEN 1 THEN 'https://cb.example' WHEN 2 THEN 'https://li.example' WHEN 3 THEN 'https://gh.example' ELSE 'https://www.bing.com/search?q=' || replace(c_name, '#', '%23') || '+AI' END AS url FROM customer")
def _(t):
    def when(i, v):
        return F.when(F.col("c_custkey") % 5 == i, F.lit(v)).otherwise(F.lit("  "))

    return t.customer.select("c_custkey", U.migrated_company_url(
        when(0, " https://a.example"), when(1, "https://cb.example"), when(2, "https://li.example "), when(3, "https://gh.example"), "c_name").alias("url"))


CLEAN_IN = "CASE doc_id % 4 WHEN 0 THEN concat('3 days ago, ', text, ' Apply Now;') WHEN 1 THEN concat('Actively Hiring - ', text) ELSE text END"


@query("f16_clean_text", f"SELECT doc_id, nullif(trim(trim(regexp_replace({CLEAN_IN}, '(?i)({migration.JOB_BOARD_PATTERN})', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)), ',;:- ' || chr(10) || chr(9)), '') AS cleaned FROM documents")
def _(t):
    return t.documents.select("doc_id", X.clean_text(F.expr(CLEAN_IN)).alias("cleaned"))


@query("f17_clean_founded_year", f"SELECT p_partkey, CASE WHEN 1880 + p_partkey % 160 >= 1900 AND 1880 + p_partkey % 160 < {YEAR} THEN 1880 + p_partkey % 160 END AS founded FROM part")
def _(t):
    return t.part.select("p_partkey", M.clean_founded_year(F.expr("1880 + p_partkey % 160"), as_of()).alias("founded"))


@query("f18_placeholder_description", "SELECT c_custkey, c_custkey % 3 <> 2 AS placeholder FROM customer")
def _(t):
    text = F.expr("CASE c_custkey % 3 WHEN 0 THEN concat(' ', c_name, ' is an AI company...') WHEN 1 THEN concat(c_name, ' is an AI company') ELSE concat(c_name, ' is a company') END")
    return t.customer.select("c_custkey", X.is_placeholder_description(text, "c_name").alias("placeholder"))


_old = list(migration.OLD_CATEGORY)
OLD_IN = "CASE p_partkey % {} {} END".format(len(_old) + 1, " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_old)))
STATUS_IN = "CASE p_partkey % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'acquired' WHEN 2 THEN 'shut-down' WHEN 3 THEN 'ipo' END"


@query("f19_old_value_maps", f"SELECT p_partkey, {case_map(STATUS_IN, migration.OLD_STATUS, lit('active'))} AS status, {case_map(OLD_IN, migration.OLD_CATEGORY, lit('ai-app'))} AS category, {case_map(OLD_IN, migration.OLD_SUB_CATEGORY)} AS sub_category, {case_map(OLD_IN, migration.OLD_PRODUCT_TYPE, lit('other'))} AS product_type FROM part")
def _(t):
    old, status = F.expr(OLD_IN), F.expr(STATUS_IN)
    return t.part.select("p_partkey", X.map_status(status).alias("status"), X.map_old_category(old).alias("category"), X.map_sub_category(old).alias("sub_category"), X.map_product_type(old).alias("product_type"))


MONEY_IN = "concat('Total Funding: $', CAST(o_orderkey % 5000 AS VARCHAR(20)), CASE o_orderkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'B' WHEN 2 THEN 'K' WHEN 3 THEN 'm' WHEN 4 THEN ',5.2.1M' ELSE '' END, ' raised')"


@query("f20_parse_money", "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderkey % 5000 AS DOUBLE) * 1e6 WHEN 1 THEN CAST(o_orderkey % 5000 AS DOUBLE) * 1e9 WHEN 2 THEN CAST(o_orderkey % 5000 AS DOUBLE) * 1e3 WHEN 5 THEN CAST(o_orderkey % 5000 AS DOUBLE) END AS usd FROM orders")
def _(t):
    return t.orders.select("o_orderkey", M.parse_money(F.expr(MONEY_IN), sources.CB_FUNDING).alias("usd"))


@query("f21_funding_title", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_orderkey % 900 + 1 AS DOUBLE) * CASE o_orderkey % 3 WHEN 0 THEN 1e6 ELSE 1e9 END END AS usd, CASE o_orderkey % 3 WHEN 0 THEN 'series-b' WHEN 1 THEN 'seed' END AS round FROM orders")
def _(t):
    title = F.expr("concat('Acme ', CASE o_orderkey % 3 WHEN 0 THEN concat('raises $', o_orderkey % 900 + 1, ' million in Series B funding') WHEN 1 THEN concat('secured ', o_orderkey % 900 + 1, 'B Seed round') ELSE 'launches a robot' END)")
    return t.orders.select("o_orderkey", M.funding_amount(title).alias("usd"), M.funding_round(title).alias("round"))


@query("f22_employee_range", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_size || '+' WHEN p_partkey % 4 = 1 THEN 'a-b' ELSE CASE WHEN p_size * 150 <= 10 THEN '1-10' WHEN p_size * 150 <= 50 THEN '11-50' WHEN p_size * 150 <= 200 THEN '51-200' WHEN p_size * 150 <= 500 THEN '201-500' WHEN p_size * 150 <= 1000 THEN '501-1000' WHEN p_size * 150 <= 5000 THEN '1001-5000' ELSE '5001+' END END AS employees FROM part")
def _(t):
    text = F.expr("CASE WHEN p_partkey % 4 = 0 THEN concat(p_size, '+') WHEN p_partkey % 4 = 1 THEN 'a-b' ELSE concat('1,0-', p_size * 150, '+') END")
    return t.part.select("p_partkey", M.employee_range(text).alias("employees"))


@query("f23_team_size_range", "SELECT p_partkey, CASE WHEN p_size * 30 <= 10 THEN '1-10' WHEN p_size * 30 <= 50 THEN '11-50' WHEN p_size * 30 <= 200 THEN '51-200' WHEN p_size * 30 <= 500 THEN '201-500' WHEN p_size * 30 <= 1000 THEN '501-1000' ELSE '1001-5000' END AS employees FROM part")
def _(t):
    return t.part.select("p_partkey", M.team_size_range(F.col("p_size") * 30).alias("employees"))


@query("f24_parse_headquarters", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE n_name || ' City' END AS city, CASE WHEN c_custkey % 2 = 1 THEN r_name END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(t):
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.expr("CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE concat(n_name, ' City , State,  ', r_name, ' ') END")
    return j.select("c_custkey", G.headquarters_city(text).alias("city"), G.headquarters_country(text).alias("country"))


COUNT_IN = "CASE o_orderkey % 4 WHEN 0 THEN o_orderkey * 1000000007 WHEN 1 THEN o_orderkey * 1000000 WHEN 2 THEN o_orderkey + 1 ELSE o_orderkey * 100000000000 END"


@query("f25_format_param_count", f"SELECT o_orderkey, CASE WHEN {COUNT_IN} >= 1000000000000 THEN replace(printf('%.1fT', {COUNT_IN} / 1e12), '.0T', 'T') WHEN {COUNT_IN} >= 1000000000 THEN replace(printf('%.1fB', {COUNT_IN} / 1e9), '.0B', 'B') WHEN {COUNT_IN} >= 1000000 THEN CAST(CAST(round_even({COUNT_IN} / 1e6, 0) AS BIGINT) AS VARCHAR) || 'M' ELSE CAST({COUNT_IN} AS VARCHAR) END AS size FROM orders WHERE o_orderkey % 20 <> 5 OR true")
def _(t):
    return t.orders.select("o_orderkey", M.format_param_count(F.expr(COUNT_IN)).alias("size"))


AMOUNT_IN = "o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 10000 ELSE 0.001 END"


@query("f26_format_currency", f"SELECT o_orderkey, CASE WHEN x >= 1e9 THEN '$' || CAST(CAST(round(x / 1e9, 1) AS DECIMAL(20,1)) AS VARCHAR) || 'B' WHEN x >= 1e6 THEN '$' || CAST(CAST(round(x / 1e6) AS BIGINT) AS VARCHAR) || 'M' WHEN x >= 1e3 THEN '$' || CAST(CAST(round(x / 1e3) AS BIGINT) AS VARCHAR) || 'K' ELSE '$' || CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE CAST(x AS VARCHAR) END END AS shown FROM (SELECT o_orderkey, CAST(round({AMOUNT_IN}, 2) AS DOUBLE) AS x FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", M.format_currency(M.rounded(F.expr(AMOUNT_IN).cast("double"), 2)).alias("shown"))


ROUND_IN = "CASE o_orderkey % 6 WHEN 0 THEN 'seed' WHEN 1 THEN 'series-c' WHEN 2 THEN 'ipo' WHEN 3 THEN 'bridge' WHEN 4 THEN 'unknown' ELSE 'growth' END"


@query("f27_format_round", f"SELECT o_orderkey, {case_map(ROUND_IN, ROUND_NAMES, ROUND_IN)} AS shown FROM orders")
def _(t):
    return t.orders.select("o_orderkey", M.format_round(F.expr(ROUND_IN)).alias("shown"))


@query("f28_round_badge", f"SELECT o_orderkey, {case_map(ROUND_IN, ROUND_BADGES, lit('default'))} AS badge FROM orders")
def _(t):
    return t.orders.select("o_orderkey", M.round_badge(F.expr(ROUND_IN)).alias("badge"))


ZH_IN = "CASE c_custkey % 3 WHEN 0 THEN concat('客户', c_custkey) WHEN 1 THEN '' END"


@query("f29_localized", f"SELECT c_custkey, coalesce(nullif({ZH_IN}, ''), c_name, '') AS zh, coalesce(c_name, '') AS en FROM customer")
def _(t):
    zh = F.expr(ZH_IN)
    return t.customer.select("c_custkey", X.localized("c_name", zh, "zh").alias("zh"), X.localized("c_name", zh, "en").alias("en"))


@query("f30_humanize_label", r"SELECT p_partkey, regexp_replace(replace(lower('ai-' || replace(p_name, ' ', '-') || '-main-ai'), '-', ' '), '\bai\b', 'AI', 'g') AS label FROM part")
def _(t):
    return t.part.select("p_partkey", X.humanize_label(F.lower(F.concat(F.lit("ai-"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-main-ai")))).alias("label"))


PRICE_IN = "CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN 'free' WHEN 3 THEN NULL ELSE CAST(l_tax AS VARCHAR(30)) END"


@query("f31_price_per_million", f"SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, CASE WHEN TRY_CAST({PRICE_IN} AS DOUBLE) > 0 THEN printf('%.4f', TRY_CAST({PRICE_IN} AS DOUBLE) * 1e6) END AS price FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", M.price_per_million(F.expr(PRICE_IN)).alias("price"))


@query("f32_pricing_model", "SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, CASE WHEN l_tax > 0 OR l_discount > 0 THEN 'usage-based' ELSE 'free' END AS model FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", M.pricing_model(F.col("l_tax").cast("string"), F.col("l_discount").cast("string")).alias("model"))


@query("f33_parse_modalities", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'image,text' WHEN 1 THEN 'audio,video' ELSE 'text' END AS modalities FROM part")
def _(t):
    text = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'text+Image ->text' WHEN 1 THEN 'video+file->audio' WHEN 2 THEN '' WHEN 3 THEN 'smell' END")
    return t.part.select("p_partkey", F.array_join(G.parse_modalities(text), ",").alias("modalities"))


_tasks = list(sources.TASK_SUB_CATEGORY)
TASK_IN = "CASE p_partkey % {} {} END".format(len(_tasks) + 2, " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_tasks)))
_mods = {task: ",".join(mods) for mods, tasks in sources.TASK_MODALITIES for task in tasks}


@query("f34_task_modalities", f"SELECT p_partkey, {case_map(TASK_IN, _mods, lit(''))} AS modalities, CASE WHEN p_partkey % 2 = 0 THEN 'transformer,moe' ELSE '' END AS architectures FROM part")
def _(t):
    tags = F.expr("CASE WHEN p_partkey % 2 = 0 THEN array('Transformer', 'pytorch', 'MoE') ELSE array('jax') END")
    return t.part.select("p_partkey", F.array_join(G.task_modalities(F.expr(TASK_IN)), ",").alias("modalities"), F.array_join(G.architecture_tags(tags), ",").alias("architectures"))


@query("f35_license_spdx", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'MIT' WHEN 1 THEN 'custom-1' WHEN 2 THEN 'Apache-2.0' END AS spdx FROM part")
def _(t):
    card = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'mit' WHEN 1 THEN 'custom-1' WHEN 2 THEN '' END")
    tags = F.expr("CASE WHEN p_partkey % 4 < 3 THEN array('en', 'apache-2.0', 'mit') ELSE array('en') END")
    return t.part.select("p_partkey", G.license_spdx(card, tags).alias("spdx"))


MODEL_IN = "concat(CASE p_partkey % 8 WHEN 0 THEN 'GPT-4o-' WHEN 1 THEN 'claude-3-opus-' WHEN 2 THEN 'Llama-3.1-' WHEN 3 THEN 'yi-' WHEN 4 THEN 'my-phi-' WHEN 5 THEN 'Qwen-' WHEN 6 THEN 'gemma-' ELSE 'unknown-' END, p_partkey)"


ORG_TABLES = {
    "arena": (sources.ARENA_ORGS, "prefix"), "paper": (sources.PAPER_ORGS, "contains"), "model": (sources.MODEL_PREFIX_ORGS, "prefix"),
    "router": (sources.ROUTER_ORGS, "prefix"), "provider": (sources.PROVIDERS, "contains"),
}
#: Every key of every table comes up, some behind other text or in upper case.
ORG_KEYS = sorted({k for table, _ in ORG_TABLES.values() for k in table} | set(sources.HUB_ORGS))
ORG_NAME = f"CASE p_partkey % 3 WHEN 0 THEN k || '-' || p_partkey WHEN 1 THEN upper(k) ELSE 'new ' || k END"
ORG_PARTS = f"(SELECT p_partkey, ({list_lit(ORG_KEYS)})[CAST(p_partkey % {len(ORG_KEYS)} AS INT) + 1] AS k FROM part)"


@query("f36_guess_org_tables", "SELECT p_partkey, name, " + ", ".join(f"{first_hit('lower(name)', table, mode)} AS {n}" for n, (table, mode) in ORG_TABLES.items())
       + f", coalesce({case_map('k', sources.HUB_ORGS)}, k) AS hub FROM (SELECT p_partkey, k, {ORG_NAME} AS name FROM {ORG_PARTS})")
def _(t):
    from tierweave.functions.base import lookup, strings

    keyed = t.part.select("p_partkey", F.get(strings(ORG_KEYS), (F.col("p_partkey") % len(ORG_KEYS)).cast("int")).alias("k"))
    named = keyed.select("p_partkey", "k", F.expr(ORG_NAME).alias("name"))
    return named.select("p_partkey", "name", *[G.guess_org("name", table, mode).alias(n) for n, (table, mode) in ORG_TABLES.items()], lookup("k", sources.HUB_ORGS, F.col("k")).alias("hub"))


@query("f36_guess_org", f"SELECT p_partkey, {first_hit(f'lower({MODEL_IN})', sources.ARENA_ORGS, 'prefix')} AS arena, {first_hit(f'lower({MODEL_IN})', sources.PAPER_ORGS, 'contains')} AS paper FROM part")
def _(t):
    return t.part.select("p_partkey", G.guess_org(F.expr(MODEL_IN), sources.ARENA_ORGS, "prefix").alias("arena"), G.guess_org(F.expr(MODEL_IN), sources.PAPER_ORGS, "contains").alias("paper"))


LICENSE_IN = "CASE p_partkey % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'Proprietary' END"


@query("f37_likely_open_source", f"SELECT p_partkey, CASE WHEN {' OR '.join(f'starts_with(lower({MODEL_IN}), {lit(p)})' for p in sources.CLOSED_PREFIXES)} THEN false WHEN p_partkey % 3 = 0 THEN true WHEN {' OR '.join(f'starts_with(lower({MODEL_IN}), {lit(p)})' for p in sources.OPEN_PREFIXES)} THEN true END AS open FROM part")
def _(t):
    return t.part.select("p_partkey", G.likely_open_source(F.expr(MODEL_IN), F.expr(LICENSE_IN)).alias("open"))


@query("f38_has_chinese", f"SELECT c_custkey, coalesce({ZH_IN}, c_name) <> '' AND c_custkey % 3 = 0 AS chinese FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.has_chinese(F.coalesce(F.expr(ZH_IN), "c_name")).alias("chinese"))


@query("f39_strip_html", "SELECT page_id, md5(trim(regexp_replace(html, '<[^>]+>', '', 'g'), ' ' || chr(9) || chr(10) || chr(13))) AS digest FROM pages")
def _(t):
    return t.pages.select("page_id", F.md5(X.strip_html("html")).alias("digest"))


LINKED = "concat('[', substr(text, 1, 40), '](http://x.y) **', text, '**')"


@query("f40_clean_description", rf"SELECT doc_id, CASE WHEN length(d) > 500 THEN substr(d, 1, 497) || '...' ELSE d END AS cleaned FROM (SELECT doc_id, trim(regexp_replace(regexp_replace({LINKED}, '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[*_]{{1,3}}', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS d FROM documents)")
def _(t):
    return t.documents.select("doc_id", X.clean_description(F.expr(LINKED)).alias("cleaned"))


HREF_IN = "CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN concat('/p/', page_id) WHEN 2 THEN concat('p/', page_id) END"


@query("f41_resolve_url", f"SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://b.example/p/' || page_id WHEN 2 THEN 'https://b.example/p/' || page_id END AS link, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://b.example/p/' || page_id END AS icon FROM pages")
def _(t):
    h = F.expr(HREF_IN)
    return t.pages.select("page_id", U.resolve_url("https://b.example", h).alias("link"), U.resolve_url("https://b.example", h, icon=True).alias("icon"))


@query("f42_repo_url", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'https://github.com/a/' || p_partkey WHEN 1 THEN 'https://gitlab.com/b' END AS repo FROM part")
def _(t):
    links = F.expr("CASE p_partkey % 3 WHEN 0 THEN map('Homepage', 'https://gitlab.com/z', 'Source', concat('https://github.com/a/', p_partkey)) WHEN 1 THEN map('Source', 'https://x.y', 'GitHub', 'https://gitlab.com/b') ELSE map('Docs', 'https://github.com/q') END")
    return t.part.select("p_partkey", U.repo_url(links).alias("repo"))


@query("f43_icon_candidates", "SELECT page_id, 'https://' || d || '/favicon.ico|https://' || d || '/apple-touch-icon.png|https://logo.clearbit.com/' || d || '|https://www.google.com/s2/favicons?domain=' || d || '&sz=128' AS icons FROM (SELECT page_id, split_part(split_part(url, '//', 2), '/', 1) AS d FROM pages)")
def _(t):
    return t.pages.select("page_id", F.array_join(U.icon_candidates("url"), "|").alias("icons"))


@query("f44_company_logo_candidates", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'https://a.b/favicon.ico|https://a.b/apple-touch-icon.png|https://logo.clearbit.com/a.b|https://www.google.com/s2/favicons?domain=a.b&sz=128' ELSE 'https://logo.clearbit.com/' || n || '.com|https://logo.clearbit.com/' || n || '.ai|https://logo.clearbit.com/' || n || '.io' END AS logos FROM (SELECT c_custkey, lower(c_name) || 'x' AS n FROM customer)")
def _(t):
    site = F.when(F.col("c_custkey") % 2 == 0, F.lit("https://a.b/c"))
    return t.customer.select("c_custkey", F.array_join(U.company_logo_candidates(site, F.concat("c_name", F.lit(" -X"))), "|").alias("logos"))


@query("f45_trust_score", "SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, CAST(CASE l_linenumber % 4 + 1 WHEN 1 THEN 0.95 WHEN 2 THEN 0.75 WHEN 3 THEN 0.5 ELSE 0.2 END AS DOUBLE) AS trust FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", G.trust_score(F.col("l_linenumber") % 4 + 1).cast("double").alias("trust"))


@query("f46_salary_and_header", "SELECT p_partkey, p_partkey % 4 < 3 AS salary, p_partkey % 2 = 0 AS header FROM part")
def _(t):
    pay = F.expr("CASE p_partkey % 4 WHEN 0 THEN '20k' WHEN 1 THEN '15-30' WHEN 2 THEN '面议' ELSE '北京' END")
    head = F.expr("CASE WHEN p_partkey % 2 = 0 THEN ' Company- ' ELSE p_name END")
    return t.part.select("p_partkey", X.looks_like_salary(pay).alias("salary"), X.is_table_header(F.col("p_name"), head).alias("header"))


@query("f48_format_location", "SELECT n_nationkey, n_name || CASE WHEN n_nationkey % 2 = 0 THEN ', State' ELSE '' END || ', ' || r_name AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", G.format_location("n_name", F.expr("CASE WHEN n_nationkey % 2 = 0 THEN 'State' ELSE '' END"), "r_name").alias("place"))


@query("f49_year_and_date", f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN year(o_orderdate) BETWEEN 1900 AND {YEAR} THEN CAST(year(o_orderdate) AS INTEGER) END AS founded, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def _(t):
    iso = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS STRING) END")
    link = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('https://n.example/', date_format(o_orderdate, 'yyyy/MM/dd'), '/story') ELSE 'https://n.example/2024/13/45/x' END")
    return t.orders.select("o_orderkey", M.year_of(iso, as_of()).alias("founded"), U.date_from_url(link).alias("day"))


@query("f50_chart_scale", "SELECT c_custkey, c_acctbal / 1e9 AS billions FROM customer")
def _(t):
    return t.customer.select("c_custkey", M.chart_scale("c_acctbal").alias("billions"))


@query("p8_aggregator_hosts", f"SELECT page_id, {HOST_SQL.format('u')} IN {in_list(scoring.AGGREGATOR_HOSTS)} AS listed FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://WWW.Toolify.ai:8080/x' WHEN 1 THEN 'https://sub.toolify.ai' ELSE url END AS u FROM pages)")
def _(t):
    u = F.expr("CASE page_id % 3 WHEN 0 THEN 'https://WWW.Toolify.ai:8080/x' WHEN 1 THEN 'https://sub.toolify.ai' ELSE url END")
    return t.pages.select("page_id", U.is_aggregator(u).alias("listed"))

