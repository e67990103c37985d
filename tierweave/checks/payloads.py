"""Source mappers over payloads that Spark builds from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.bindings import CATALOG, PART_CATALOG
from tierweave.checks.functions import as_of
from tierweave.checks.matching import near_description
from tierweave.checks.registry import bound, query
from tierweave.plans.enrich import enrich, requests
from tierweave.plans.ingest import ingest
from tierweave.session import spread
from tierweave.sources.extract import job_listings
from tierweave.sources.mappers import crawl_targets, discovered, discovered_to_records
from tierweave.sources.registry import map_sources, sources

def landed(df: DataFrame, seq: str, name: str, body: Column, url: Column | str = "https://feed.example/page", fmt: str = "json") -> DataFrame:
    # payloads outgrow the rows they are made of, so these are spread first
    return spread(df).select(
        F.col(seq).cast("bigint").alias("seq"), (F.lit(url) if isinstance(url, str) else url).alias("url"), F.lit(name).alias("source"),
        F.lit(fmt).alias("format"), body.alias("body"), F.lit(None).cast("timestamp").alias("fetched_at"))


def mapped(name: str, pages: DataFrame) -> DataFrame:
    return sources()[name].map(pages)


@query("m1_wikidata", "SELECT c_name AS name, 'https://www.wikidata.org/wiki/Q' || c_custkey AS source_url, CAST(1850 + c_custkey % 150 AS INTEGER) AS company_founded_year, 'Person ' || (c_custkey % 7) || ':Co-founder' AS people FROM customer WHERE 1850 + c_custkey % 150 >= 1900 UNION ALL SELECT c_name, 'https://www.wikidata.org/wiki/Q' || c_custkey, NULL, 'Person ' || (c_custkey % 7) || ':Co-founder' FROM customer WHERE 1850 + c_custkey % 150 < 1900")
def _(t):
    b = F.expr("concat('{\"results\":{\"bindings\":[{\"company\":{\"value\":\"http://w/entity/Q', c_custkey, '\"},\"companyLabel\":{\"value\":\"', c_name, '\"},\"inception\":{\"value\":\"', 1850 + c_custkey % 150, '-01-01T00:00:00Z\"}},{\"companyLabel\":{\"value\":\"', c_name, '\"}},{\"companyLabel\":{\"value\":\"\"}}]}}')")
    p = F.expr("concat('{\"results\":{\"bindings\":[{\"personLabel\":{\"value\":\"Person ', c_custkey % 7, '\"},\"isFounder\":{\"value\":\"true\"}},{\"personLabel\":{\"value\":\"Person ', c_custkey % 7, '\"}}]}}')")
    pages = landed(t.customer, "c_custkey", "wikidata", b, fmt="companies").unionByName(
        landed(t.customer, "c_custkey", "wikidata", p, F.concat(F.lit("wikidata/Q"), "c_custkey"), "people"))
    people = F.transform("key_people", lambda x: F.concat(x["name"], F.lit(":"), x["title"]))
    return mapped("wikidata", pages).select("name", "source_url", "company_founded_year", F.array_join(people, ",").alias("people"))


@query("m2_crunchbase", "SELECT 'Org ' || c_custkey AS name, CAST(c_custkey % 90 + 1 AS DOUBLE) * 1e6 AS raised, CASE WHEN c_custkey % 2 = 0 THEN 'series-b' END AS round, '51-200' AS employees, 'Oslo' AS city, 'Norway' AS country FROM customer")
def _(t):
    body = F.expr("concat('# Organisation page for the company\\nTotal Funding: $', c_custkey % 90 + 1, 'M\\n', CASE WHEN c_custkey % 2 = 0 THEN 'Last Funding Type: Series B\\n' ELSE '' END, 'Employees: 101-200\\nHeadquarters: Oslo, Viken, Norway\\nInvestors: A, B\\n')")
    pages = landed(t.customer, "c_custkey", "crunchbase", body, F.concat(F.lit("https://cb.example/organization/org-"), "c_custkey"))
    return mapped("crunchbase", pages).select("name", F.col("company_total_raised_usd").alias("raised"), F.col("company_last_round").alias("round"), F.col("company_employee_count_range").alias("employees"), F.col("company_headquarters_city").alias("city"), F.col("company_headquarters_country").alias("country"))


@query("m3_producthunt", "SELECT arg_min(p_name, p_partkey) AS name, arg_min(CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand END, p_partkey) AS description, 'Maker ' || min(p_partkey) AS maker FROM part GROUP BY lower(p_name)")
def _(t):
    body = F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(F.struct(
        F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise("").alias("tagline"), F.col("p_brand").alias("description"),
        F.array(F.struct(F.concat(F.lit("Maker "), "p_partkey").alias("name")), F.struct(F.lit("").alias("name"))).alias("makers"),
    ).alias("node"))).alias("edges")).alias("posts")).alias("data")))
    return mapped("producthunt", landed(t.part, "p_partkey", "producthunt", body)).select("name", "description", F.array_join(F.col("key_people.name"), ",").alias("maker"))


@query("m4_github", "SELECT 'org-' || (p_partkey % 40) AS name, 'About ' || any_value(p_partkey % 40) AS description FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1")
def _(t):
    body = F.to_json(F.struct(F.array(F.struct(
        F.col("p_name").alias("description"), F.struct(F.concat(F.lit("org-"), F.col("p_partkey") % 40).alias("login"), F.when(F.col("p_partkey") % 3 == 0, "User").otherwise("Organization").alias("type")).alias("owner"),
    )).alias("items")))
    org = F.to_json(F.struct(F.concat(F.lit("About "), "p_partkey").alias("description"), F.lit("").alias("name")))
    found = landed(t.part, "p_partkey", "github", body, fmt="search")
    orgs = landed(t.part, "p_partkey", "github", org, F.concat(F.lit("https://api.github.com/orgs/org-"), "p_partkey"), "org")
    return mapped("github", found.unionByName(orgs)).select("name", "description")


NAV = "concat('Intro line of the page that is long enough to be parsed at all, with filler words to pass the limit.\\n\\n', '[Home](https://x.example/h) nav\\nHome page text long\\n', '[', p_name, ' ', p_partkey, '](https://t.example/', p_partkey, ') 1.2M monthly visits\\nA tool for ', p_type, ' work\\n[Second ', p_partkey, '](https://t.example/s', p_partkey, ')\\nAnother helpful description\\n[Third ', p_partkey, '](https://t.example/t', p_partkey, ')\\nYet another description here\\n')"


@query("m5_toolify", "SELECT p_name || ' ' || p_partkey AS name, 'https://t.example/' || p_partkey AS product_url, 'A tool for ' || p_type || ' work' AS description, 'dev-tool' AS product_type FROM part UNION ALL SELECT 'Second ' || p_partkey, 'https://t.example/s' || p_partkey, 'Another helpful description', 'dev-tool' FROM part UNION ALL SELECT 'Third ' || p_partkey, 'https://t.example/t' || p_partkey, 'Yet another description here', 'dev-tool' FROM part")
def _(t):
    pages = landed(t.part, "p_partkey", "toolify", F.expr(NAV), "https://www.toolify.ai/category/ai-code")
    return mapped("toolify", pages).select("name", "product_url", "description", "product_type")


CARD = "concat('<html><body>', repeat('<p>filler text</p>', 20), '<a class=\"c\" href=\"/sites/', p_partkey, '.html\" {extra}title=\"', CASE WHEN p_partkey % 2 = 0 THEN '智能写作' ELSE 'Writes text' END, '\"><img src=\"/i/', p_partkey, '.png\"/><strong>', CASE WHEN p_partkey % 2 = 0 THEN '工具' ELSE 'Tool ' END, p_partkey, '</strong></a></body></html>')"


@query("m6_aibot", "SELECT CASE WHEN p_partkey % 2 = 0 THEN '工具' ELSE 'Tool ' END || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN '工具' || p_partkey END AS name_zh, 'https://ai-bot.cn/sites/' || p_partkey || '.html' AS product_url, 'https://ai-bot.cn/i/' || p_partkey || '.png' AS icon_url, 'dev-tool' AS product_type FROM part")
def _(t):
    pages = landed(t.part, "p_partkey", "aibot", F.expr(CARD.format(extra="")), "https://ai-bot.cn/favorites/ai-coding-tools/", "html")
    return mapped("aibot", pages).select("name", "name_zh", "product_url", "icon_url", "product_type")


@query("m7_ainav", "SELECT CASE WHEN p_partkey % 2 = 0 THEN '工具' ELSE 'Tool ' END || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN '智能写作' END AS description_zh, 'https://p.example/' || p_partkey AS product_url, 'ai-search' AS category FROM part")
def _(t):
    body = F.expr(CARD.format(extra="data-url=\"https://p.example/', p_partkey, '\" "))
    pages = landed(t.part, "p_partkey", "ainav", body, "https://www.ainav.cn/favorites/ai%E6%90%9C%E7%B4%A2%E5%BC%95%E6%93%8E", "html")
    return mapped("ainav", pages).select("name", "description_zh", "product_url", "category")


@query("m8_ycombinator", "SELECT c_name AS name, 'ycombinator|yc-w' || (c_custkey % 20) AS tags, CASE WHEN c_custkey % 3 = 0 THEN 'Canada' ELSE 'United States' END AS country, CASE WHEN c_custkey % 40 <= 10 THEN '1-10' ELSE '11-50' END AS employees FROM customer")
def _(t):
    body = F.to_json(F.struct(F.array(F.struct(
        F.col("c_name").alias("name"), F.concat(F.lit("W"), F.col("c_custkey") % 20).alias("batch"), F.when(F.col("c_custkey") % 3 == 0, "Canada").otherwise("").alias("country"), (F.col("c_custkey") % 40).alias("team_size"),
    )).alias("hits")))
    return mapped("ycombinator", landed(t.customer, "c_custkey", "ycombinator", body)).select("name", F.array_join("tags", "|").alias("tags"), F.col("company_headquarters_country").alias("country"), F.col("company_employee_count_range").alias("employees"))


@query("m9_techcrunch", "SELECT 'Acme' || o_orderkey AS name, CAST(o_orderkey % 90 + 1 AS DOUBLE) * 1e6 AS raised, 'series-a' AS round, CAST(o_orderdate AS DATE) AS release_date FROM orders")
def _(t):
    body = F.expr("concat(repeat('filler words of the page ', 10), '\\n[Acme', o_orderkey, ' raises $', o_orderkey % 90 + 1, 'M in Series A funding](https://techcrunch.com/', date_format(o_orderdate, 'yyyy/MM/dd'), '/story-', o_orderkey, ')\\n[Nothing to report about anything](https://techcrunch.com/2024/01/02/x)\\n')")
    return mapped("techcrunch", landed(t.orders, "o_orderkey", "techcrunch", body)).select("name", F.col("company_total_raised_usd").alias("raised"), F.col("company_last_round").alias("round"), "release_date")


@query("m10_huggingface", "SELECT 'model-' || p_partkey AS name, CASE p_partkey % 3 WHEN 0 THEN 'Meta' WHEN 1 THEN 'acme' END AS company_name, CASE WHEN p_partkey % 2 = 0 THEN 'Apache-2.0' ELSE 'MIT' END AS license, (p_size + 1) || 'B' AS parameter_count, 'model-' || p_partkey || coalesce(CASE p_partkey % 3 WHEN 0 THEN ' by Meta' WHEN 1 THEN ' by acme' END, '') || ' (' || (p_size + 1) || 'B parameters) — a text to image model on HuggingFace.' AS description, 'image,text' AS modalities FROM part")
def _(t):
    k = F.col("p_partkey")
    body = F.to_json(F.array(F.struct(
        F.concat(F.when(k % 3 == 0, "meta-llama/").when(k % 3 == 1, "acme/").otherwise(""), F.lit("model-"), k).alias("modelId"), F.lit("text-to-image").alias("pipeline_tag"),
        F.array(F.lit("x"), F.lit("apache-2.0"), F.lit("Diffusion")).alias("tags"), F.struct(F.when(k % 2 == 1, "mit").otherwise("").alias("license")).alias("cardData"),
        F.struct(((F.col("p_size") + 1).cast("bigint") * 1000000000).alias("total")).alias("safetensors"))))
    return mapped("huggingface", landed(t.part, "p_partkey", "huggingface", body)).select("name", "company_name", "license", "parameter_count", "description", F.array_join("modalities", ",").alias("modalities"))


@query("m11_lmsys", "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'gpt-4-' ELSE 'llama-3-' END || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'OpenAI' ELSE 'Meta' END AS company_name, p_partkey % 2 = 1 AS open_source, CAST(1000 + p_size AS VARCHAR) AS elo FROM part")
def _(t):
    k = F.col("p_partkey")
    row = F.struct(F.concat(F.when(k % 2 == 0, "gpt-4-").otherwise("llama-3-"), k).alias("Model"), (F.lit(1000) + F.col("p_size")).alias("rating"))
    body = F.to_json(F.struct(F.array(F.struct(row.alias("row"))).alias("rows")))
    return mapped("lmsys", landed(t.part, "p_partkey", "lmsys", body)).select("name", "company_name", "open_source", F.try_element_at("extra", F.lit("chatbot_arena_elo")).alias("elo"))


@query("m12_openrouter", "SELECT 'm' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'OpenAI' END AS company_name, CASE WHEN p_partkey % 3 = 0 THEN 'free' ELSE 'usage-based' END AS pricing_model, CASE WHEN p_partkey % 3 <> 0 THEN '2.5000' END AS price, 'image,text' AS modalities, CAST(p_size * 1000 AS BIGINT) AS context_window FROM part")
def _(t):
    k = F.col("p_partkey")
    body = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.when(k % 2 == 0, "openai/m").otherwise("other/m"), k).alias("id"), (F.col("p_size") * 1000).alias("context_length"),
        F.struct(F.when(k % 3 == 0, "0").otherwise("0.0000025").alias("prompt"), F.lit("0").alias("completion")).alias("pricing"), F.struct(F.lit("text+image->text").alias("modality")).alias("architecture"))).alias("data")))
    return mapped("openrouter", landed(t.part, "p_partkey", "openrouter", body)).select("name", "company_name", "pricing_model", F.try_element_at("extra", F.lit("input_price_per_1m_tokens")).alias("price"), F.array_join("modalities", ",").alias("modalities"), "context_window")


@query("m13_theresanaiforthat", "SELECT p_name || ' ' || p_partkey AS name, 'A tool for ' || p_type || ' work' AS description, 'hardware' AS product_type, 'robot' AS sub_category FROM part UNION ALL SELECT 'Second ' || p_partkey, 'Another helpful description', 'hardware', 'robot' FROM part UNION ALL SELECT 'Third ' || p_partkey, 'Yet another description here', 'hardware', 'robot' FROM part")
def _(t):
    pages = landed(t.part, "p_partkey", "theresanaiforthat", F.expr(NAV), "https://theresanaiforthat.com/s/robotics")
    return mapped("theresanaiforthat", pages).select("name", "description", "product_type", "sub_category")


@query("m14_artificial_analysis", "SELECT 'Model ' || p_partkey AS name, 'OpenAI' AS company_name, CAST(p_size AS VARCHAR) AS quality, '1200.5' AS speed, '3.5' AS price FROM part")
def _(t):
    body = F.expr("concat(repeat('filler words ', 12), '\\n| Model ', p_partkey, ' | OpenAI Inc | ', p_size, ' | 1,200.5 | $3.5 | 128k |\\n')")
    extra = lambda k: F.try_element_at("extra", F.lit(k))
    return mapped("artificial_analysis", landed(t.part, "p_partkey", "artificial_analysis", body)).select("name", "company_name", extra("aa_quality_score").alias("quality"), extra("aa_speed_tokens_per_sec").alias("speed"), extra("aa_price_per_1m_tokens").alias("price"))


@query("m15_papers_with_code", "SELECT 'Gpt Net ' || p_partkey AS name, 'OpenAI' AS company_name, CAST(p_size + 20 AS VARCHAR) AS mmlu, CAST(p_size AS VARCHAR) AS gsm8k, 'https://paperswithcode.com/paper/p' || p_partkey AS paper FROM part")
def _(t):
    def page(score: str, slug: str, link: str):
        body = F.expr(f"concat(repeat('filler words ', 12), '\\n| [Gpt Net ', p_partkey, ']{link} | ', {score}, ' |\\n')")
        return landed(t.part, "p_partkey", "papers_with_code", body, f"https://paperswithcode.com/sota/{slug}")

    pages = page("p_size + 10", "text-generation-on-mmlu", "").unionByName(page("p_size + 20", "multi-task-language-understanding-on-mmlu", "(/paper/p', p_partkey, ')")).unionByName(
        page("p_size", "math-word-problem-solving-on-gsm8k", ""))
    extra = lambda k: F.try_element_at("extra", F.lit(k))
    return mapped("papers_with_code", pages).select("name", "company_name", extra("benchmark_MMLU").alias("mmlu"), extra("benchmark_GSM8K").alias("gsm8k"), extra("paper_url").alias("paper"))


def _package(t, block: str):
    """Packages of the seed list met in the part table, by key."""
    names = F.array(*[F.lit(r[0]) for r in block])
    return t.part.groupBy((F.col("p_partkey") % F.size(names)).alias("k")).agg(F.sum("p_size").alias("n")).withColumn("package", F.get(names, F.col("k").cast("int")))


def _package_sql(block: str) -> str:
    rows = [(package, pos, product, org) for pos, (package, product, org) in enumerate(block)]
    values = ", ".join("({}, '{}', '{}')".format(i, product.replace("'", "''"), org.replace("'", "''")) for _, i, product, org in rows)
    return f"SELECT v.product AS name, v.org AS company_name, CAST(sum(p_size) AS VARCHAR) AS uses FROM part JOIN (VALUES {values}) v(i, product, org) ON p_partkey % {len(rows)} = v.i GROUP BY ALL"


from tierweave.fixed.sources import DOCKER_IMAGES, NPM_PACKAGES, PYPI_PACKAGES  # noqa: E402


@query("m16_pypi", _package_sql(PYPI_PACKAGES))
def _(t):
    p = _package(t, PYPI_PACKAGES)
    info = landed(p, "k", "pypi", F.lit('{"info":{"summary":"s","project_urls":{"Source":"https://github.com/a/b"}}}'), F.concat(F.lit("https://pypi.org/pypi/"), "package", F.lit("/json")), "info")
    stats = landed(p, "k", "pypi", F.concat(F.lit('{"data":{"last_month":'), "n", F.lit("}}")), F.concat(F.lit("https://pypistats.org/api/packages/"), "package", F.lit("/recent")), "stats")
    return mapped("pypi", info.unionByName(stats)).select("name", "company_name", F.try_element_at("extra", F.lit("pypi_monthly_downloads")).alias("uses"))


@query("m17_npm", _package_sql(NPM_PACKAGES))
def _(t):
    p = _package(t, NPM_PACKAGES)
    info = landed(p, "k", "npm", F.lit('{"description":"d","repository":{"url":"git+https://github.com/a/b.git"}}'), F.concat(F.lit("https://registry.npmjs.org/"), "package"), "info")
    stats = landed(p, "k", "npm", F.concat(F.lit('{"downloads":'), "n", F.lit("}")), F.concat(F.lit("https://api.npmjs.org/downloads/point/last-week/"), "package"), "stats")
    return mapped("npm", info.unionByName(stats)).select("name", "company_name", F.try_element_at("extra", F.lit("npm_weekly_downloads")).alias("uses"))


@query("m18_dockerhub", _package_sql(DOCKER_IMAGES))
def _(t):
    p = _package(t, DOCKER_IMAGES)
    pages = landed(p, "k", "dockerhub", F.concat(F.lit('{"pull_count":'), "n", F.lit("}")), F.concat(F.lit("https://hub.docker.com/v2/repositories/"), "package", F.lit("/")))
    return mapped("dockerhub", pages).select("name", "company_name", F.try_element_at("extra", F.lit("docker_pulls")).alias("uses"))


@query("m19_google_play", "SELECT 'App ' || p_partkey AS name, printf('%.1f', p_size / 10.0::DOUBLE) AS rating, CASE WHEN p_partkey % 2 = 0 THEN repeat('x', 497) || '...' ELSE p_name END AS description FROM part")
def _(t):
    k = F.col("p_partkey")
    app = F.struct(F.concat(F.lit("com.app.a"), k).alias("appId"), F.concat(F.lit(" App "), k).alias("title"), (F.col("p_size") / 10).alias("score"), F.when(k % 2 == 0, F.repeat(F.lit("x"), F.lit(600))).otherwise(F.col("p_name")).alias("summary"))
    skip = F.struct(F.lit("com.apple.mobilesafari").alias("appId"), F.lit("S").alias("title"), F.lit(1.0).alias("score"), F.lit("s").alias("summary"))
    return mapped("google_play", landed(t.part, "p_partkey", "google_play", F.to_json(F.struct(F.array(app, skip, app).alias("results"))))).select("name", F.try_element_at("extra", F.lit("google_play_rating")).alias("rating"), "description")


@query("m20_app_store", "SELECT p_name AS name, 'https://apps.apple.com/app/id' || p_partkey AS source_url, printf('%.1f', p_size / 10.0::DOUBLE) AS rating FROM part")
def _(t):
    app = F.struct(F.col("p_partkey").alias("trackId"), F.col("p_name").alias("trackName"), (F.col("p_size") / 10).alias("averageUserRating"))
    return mapped("app_store", landed(t.part, "p_partkey", "app_store", F.to_json(F.struct(F.array(app, app).alias("results"))))).select("name", "source_url", F.try_element_at("extra", F.lit("app_store_rating")).alias("rating"))


@query("m21_job_listings", "SELECT 'Firm ' || p_partkey AS company_name, '职位 | 公司 | 地点 |' AS location, '算法工程师' || p_partkey AS job_title, '' AS salary FROM part UNION ALL SELECT 'Co ' || p_partkey, '上海', 'Row job ' || p_partkey, '' FROM part UNION ALL SELECT 'Card firm ' || p_partkey, '深圳', 'Card job ' || p_partkey, '' FROM part")
def _(t):
    body = F.expr("concat(repeat('填充 ', 40), '\\n## 算法工程师', p_partkey, '\\nFirm ', p_partkey, '\\n\\n| 职位 | 公司 | 地点 |\\n| Row job ', p_partkey, ' | Co ', p_partkey, ' | 上海 |\\n\\n**Card job ', p_partkey, '**\\nCard firm ', p_partkey, ' · 深圳\\n')")
    return job_listings(landed(t.part, "p_partkey", "jobs", body)).select("company_name", "location", "job_title", "salary")


@query("m22_crawl_targets", "WITH " + bound(CATALOG, "c") + " SELECT name, 'https://www.crunchbase.com/organization/' || replace(lower(company_name), ' ', '-') AS url FROM c ORDER BY slug || '.json' LIMIT 100")
def _(t):
    return crawl_targets(t.catalog)


@query("m23_discovery", "SELECT p_name AS name, 'toolify' AS source, 2 AS source_tier, nullif(CASE WHEN p_partkey % 2 = 0 THEN 'https://x.example/' || p_partkey ELSE '' END, '') AS product_url FROM part")
def _(t):
    p = t.part.select(F.col("p_name").alias("name"), F.lit("x").alias("source"), F.lit("").alias("source_url"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("https://x.example/"), "p_partkey")).otherwise("").alias("product_url"))
    return discovered_to_records(discovered(p), "toolify", 2).select("name", "source", "source_tier", "product_url")


@query("m24_registry", "SELECT 'lmsys' AS source, 'm' || p_partkey AS name, row_number() OVER (ORDER BY p_partkey) AS seq FROM part UNION ALL SELECT 'app_store', p_name, (SELECT count(*) FROM part) + row_number() OVER (ORDER BY p_partkey) FROM part")
def _(t):
    app = F.struct(F.col("p_partkey").alias("trackId"), F.col("p_name").alias("trackName"))
    row = F.struct(F.struct(F.concat(F.lit("m"), "p_partkey").alias("key")).alias("row"))
    pages = landed(t.part, "p_partkey", "app_store", F.to_json(F.struct(F.array(app).alias("results")))).unionByName(
        landed(t.part, "p_partkey", "lmsys", F.to_json(F.struct(F.array(row).alias("rows")))))
    return map_sources(pages, "lmsys,app_store").select("source", "name", "seq")


@query("c7_ingest")
def _(t):
    # near copies of other products' descriptions among the records
    records = t.incoming.withColumn("description", F.when(F.col("seq") % 7 < 4, near_description(F.col("seq"))).otherwise(F.col("description")))
    return ingest(t.catalog, records, as_of()).catalog.select(
        "slug", "name", "product_url", "description", "category", F.array_join("tags", "|").alias("tags"), F.size("sources").alias("sources"),
    )


@query("c8_enrich_requests", "WITH " + bound(CATALOG, "c") + " SELECT count(*) AS n FROM c")
def _(t):
    return requests(t.catalog, 1.0).agg(F.count("*").alias("n"))


@query("c8_enrich", "WITH " + bound(PART_CATALOG, "p") + " SELECT slug, CASE WHEN coalesce(description, '') = '' AND (owner_tier IS NULL OR owner_tier > 3) AND CAST(substr(slug, 6) AS BIGINT) % 4 = 0 THEN 'About ' || name ELSE description END AS description FROM p")
def _(t):
    from tierweave.checks.catalog import _answers

    return enrich(t.part_catalog, _answers(t), as_of()).select("slug", "description")
