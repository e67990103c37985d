"""Source mappers: what each source's landed payloads say, as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.fixed import sources as S
from tierweave.functions import geo as G
from tierweave.functions import money as M
from tierweave.functions import text as X
from tierweave.functions import url as U
from tierweave.functions.base import blank_to_null, compact, group, lookup, strip, strings, truthy
from tierweave.operators.quota import first_seen
from tierweave.operators.resolve import fold_leaderboard
from tierweave.sources.extract import (
    POSITIONS, explode_entries, job_listings, matches, page_slug, with_fallback,
)
from tierweave.sources.registry import source



def _extra(**pairs: Column) -> Column:
    """Map of the pairs that hold a non-empty value."""
    entries = compact(*[
        F.when(truthy(v), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in pairs.items()
    ])
    return F.map_from_entries(entries)


def _json_items(landed: DataFrame, schema: str, path: str) -> DataFrame:
    """One row per element of the array at ``path``."""
    items = F.from_json("body", schema)
    for part in filter(None, path.split(".")):
        items = items[part]
    return landed.select("seq", "url", "fetched_at", F.posexplode(items).alias("pos", "i")).select(
        (F.col("seq") * POSITIONS + F.col("pos")).alias("seq"), F.col("url").alias("page_url"), "fetched_at", "i"
    )


def _fetched_on() -> Column:
    """Day a page was fetched; today where that is not known."""
    return F.coalesce(F.to_date("fetched_at"), F.current_date())


def _unique(records: DataFrame, key: Column) -> DataFrame:
    return first_seen(records.withColumn("_key", key), "_key").drop("_key")


# ---------------------------------------------------------------- factual sources


@source("wikidata", 1)
def wikidata(landed: DataFrame) -> DataFrame:
    """Company bindings, first per label, with the people bindings of the entity."""
    ddl = "results struct<bindings:array<map<string,struct<value:string>>>>"

    def val(key: str) -> Column:
        return blank_to_null(F.try_element_at("i", F.lit(key))["value"])

    rows = _json_items(landed.filter(F.col("format") == "companies"), ddl, "results.bindings").filter(val("companyLabel").isNotNull())
    entity = F.element_at(F.split(val("company"), "/"), -1)
    companies = _unique(rows.select(
        "seq", val("companyLabel").alias("name"), entity.alias("entity"), val("companyDescription").alias("description"),
        val("website").alias("company_website"), val("article").alias("company_wikipedia_url"),
        M.year_of(val("inception"), _fetched_on()).alias("company_founded_year"),
        val("hqLabel").alias("company_headquarters_city"), val("countryLabel").alias("company_headquarters_country"),
        val("countryCode").alias("company_headquarters_country_code"),
    ), F.col("name"))
    people_rows = _json_items(landed.filter(F.col("format") == "people"), ddl, "results.bindings").filter(val("personLabel").isNotNull())
    founder = F.coalesce(val("isFounder") == "true", F.lit(False))
    people = first_seen(people_rows.select(
        page_slug("page_url").alias("entity"), val("personLabel").alias("person"), "seq",
        F.struct(
            val("personLabel").alias("name"), F.coalesce(val("positionLabel"), F.when(founder, "Co-founder").otherwise("")).alias("title"),
            founder.alias("is_founder"), F.lit(None).cast("string").alias("profile_url"),
        ).alias("p"),
    ), "entity", "person").groupBy("entity").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "p"))), lambda x: x["p"]).alias("key_people")
    )
    return companies.join(people, "entity", "left").withColumns({
        "source_url": F.concat(F.lit("https://www.wikidata.org/wiki/"), "entity"),
        "product_url": F.col("company_website"), "company_name": F.col("name"), "status": F.lit("active"),
    })


def crunchbase_records(landed: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Organisation pages; ``targets(name, url)`` names the product each page is for."""
    body = F.col("body")
    if targets is not None:
        pages = landed.join(targets.select("name", "url"), "url")
    else:
        pages = landed.withColumn("name", F.initcap(F.replace(page_slug(), F.lit("-"), F.lit(" "))))
    found = F.struct(
        M.parse_money(body, S.CB_FUNDING).alias("company_total_raised_usd"),
        F.replace(F.lower(strip(group(body, S.CB_ROUND))), F.lit(" "), F.lit("-")).alias("company_last_round"),
        M.employee_range(group(body, S.CB_EMPLOYEES)).alias("company_employee_count_range"),
        group(body, S.CB_FOUNDED).cast("int").alias("year"), group(body, S.CB_HQ).alias("hq"),
        M.parse_money(body, S.CB_VALUATION).alias("worth"),
        F.array_join(F.filter(F.transform(F.split(group(body, S.CB_INVESTORS), ","), lambda i: strip(i)), lambda i: i != ""), ", ").alias("investors"),
    )
    # unfolded from an array, as a filter on columns would run every pattern again
    rows = pages.select("seq", "name", "url", "fetched_at", F.explode(F.array(found)).alias("f")).select("seq", "name", "url", "fetched_at", "f.*")
    rows = rows.withColumn("company_founded_year", F.when(F.col("year").between(1900, F.year(_fetched_on())), F.col("year")))
    raised = F.coalesce("company_total_raised_usd", F.lit(0.0)) != 0
    return rows.filter(raised | F.col("company_founded_year").isNotNull() | truthy("company_employee_count_range")).select(
        "seq", "name", F.col("url").alias("source_url"), F.col("name").alias("company_name"),
        "company_total_raised_usd", "company_last_round", "company_employee_count_range", "company_founded_year",
        G.headquarters_city("hq").alias("company_headquarters_city"),
        G.headquarters_country("hq").alias("company_headquarters_country"),
        F.lit("active").alias("status"),
        _extra(
            crunchbase_url=F.col("url"),
            crunchbase_valuation_usd=F.when(F.col("worth") != 0, F.col("worth").cast("bigint").cast("string")),
            crunchbase_investors=F.col("investors"),
        ).alias("extra"),
    )


@source("crunchbase", 1)
def crunchbase(landed: DataFrame) -> DataFrame:
    return crunchbase_records(landed)


def crawl_targets(catalog: DataFrame, limit: int = 100) -> DataFrame:
    """(name, url) of the organisation pages to fetch, first products by file name."""
    company = F.col("company.name")
    stem = F.btrim(F.regexp_replace(F.regexp_replace(strip(F.lower(company)), r"(?U)[^\w\s-]", ""), r"[-\s]+", "-"), F.lit("-"))
    built = F.when(truthy(company), F.concat(F.lit("https://www.crunchbase.com/organization/"), stem))
    url = F.coalesce(blank_to_null("company.social.crunchbase"), built)
    return catalog.select("slug", "name", url.alias("url")).filter(truthy("url") & truthy("name")).orderBy(
        F.concat("slug", F.lit(".json"))
    ).limit(limit).select("name", "url")


# ---------------------------------------------------------------- JSON sources


@source("producthunt", 2)
def producthunt(landed: DataFrame) -> DataFrame:
    node = "struct<name:string,tagline:string,description:string,url:string,website:string,makers:array<struct<name:string>>>"
    rows = _json_items(landed, f"data struct<posts:struct<edges:array<struct<node:{node}>>>>", "data.posts.edges").select("seq", "i.node.*")
    none = F.lit(None).cast("string")
    makers = F.transform(F.filter("makers", lambda m: truthy(m["name"])), lambda m: F.struct(
        m["name"].alias("name"), F.lit("Maker").alias("title"), F.lit(False).alias("is_founder"), none.alias("profile_url")))
    return _unique(rows.filter(truthy("name")).select(
        "seq", "name", F.coalesce("url", F.lit("")).alias("source_url"), F.col("website").alias("product_url"), F.col("website").alias("company_website"),
        F.coalesce(blank_to_null("tagline"), F.col("description")).alias("description"), makers.alias("key_people"),
        strings(["generative-ai"]).alias("tags"), F.lit("active").alias("status"),
    ), F.lower("name"))


@source("github", 2)
def github(landed: DataFrame) -> DataFrame:
    """Owning organisations of found repositories, with their details where landed."""
    repo = "struct<description:string,owner:struct<login:string,type:string>>"
    rows = _json_items(landed.filter(F.col("format") == "search"), f"items array<{repo}>", "items").select("seq", "i.*")
    owners = _unique(rows.filter(F.col("owner.type") == "Organization").select(
        "seq", F.col("owner.login").alias("login"), F.col("description").alias("repo_description")), F.col("login"))
    org = F.from_json("body", "name string, blog string, description string, location string, twitter_username string")
    details = landed.filter(F.col("format") == "org").select(page_slug().alias("login"), org.alias("o")).select("login", "o.*")
    link = F.concat(F.lit("https://github.com/"), "login")
    return owners.join(details, "login", "left").select(
        "seq", F.coalesce(blank_to_null("name"), "login").alias("name"), link.alias("source_url"),
        blank_to_null("blog").alias("company_website"),
        F.coalesce(blank_to_null("description"), "repo_description").alias("description"),
        F.col("location").alias("company_headquarters_city"), link.alias("repository_url"), F.lit(True).alias("open_source"),
        strings(["open-source"]).alias("tags"),
        _extra(twitter=F.when(truthy("twitter_username"), F.concat(F.lit("@"), "twitter_username"))).alias("extra"),
    )


@source("ycombinator", 2)
def ycombinator(landed: DataFrame) -> DataFrame:
    hit = "struct<name:string,slug:string,website:string,batch:string,one_liner:string,long_description:string,year_founded:int,city:string,country:string,team_size:int>"
    rows = _json_items(landed, f"hits array<{hit}>", "hits").select("seq", "i.*").filter(truthy("name"))
    batch = F.when(truthy("batch"), F.concat(F.lit("yc-"), F.lower("batch")))
    site = blank_to_null("website")
    return _unique(rows.select(
        "seq", "name", F.concat(F.lit("https://www.ycombinator.com/companies/"), F.coalesce("slug", F.lit(""))).alias("source_url"),
        site.alias("product_url"), F.coalesce(blank_to_null("one_liner"), "long_description").alias("description"),
        F.lit("ai-app").alias("category"), compact(F.lit("ycombinator"), batch).alias("tags"), F.col("name").alias("company_name"),
        site.alias("company_website"), F.col("year_founded").alias("company_founded_year"), F.col("city").alias("company_headquarters_city"),
        F.coalesce(blank_to_null("country"), F.lit("United States")).alias("company_headquarters_country"),
        M.team_size_range("team_size").alias("company_employee_count_range"), F.lit("active").alias("status"),
    ), F.lower("name"))


@source("huggingface", 2)
def huggingface(landed: DataFrame) -> DataFrame:
    model = "struct<modelId:string,id:string,pipeline_tag:string,tags:array<string>,cardData:struct<license:string>,safetensors:struct<total:bigint>,downloads:bigint>"
    items = F.from_json(F.concat(F.lit('{"m":'), "body", F.lit("}")), f"m array<{model}>")["m"]
    rows = landed.select("seq", F.posexplode(items).alias("pos", "i")).select((F.col("seq") * POSITIONS + F.col("pos")).alias("seq"), "i.*")
    full = F.coalesce(blank_to_null("modelId"), "id")
    slash = F.instr(F.col("full"), "/")
    rows = rows.withColumn("full", full).filter(truthy("full"))
    org = F.when(slash > 0, F.substr("full", F.lit(1), slash - 1))
    name = F.substr("full", slash + 1)
    task = F.coalesce("pipeline_tag", F.lit(""))
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    size = F.when(F.col("safetensors.total") > 0, M.format_param_count("safetensors.total"))
    company = F.when(truthy(org), lookup(org, S.HUB_ORGS, org))
    link = F.concat(F.lit("https://huggingface.co/"), "full")
    description = F.concat_ws(
        " ", name, F.concat(F.lit("by "), company), F.concat(F.lit("("), size, F.lit(" parameters)")),
        F.when(truthy(task), F.concat(F.lit("— a "), F.replace(task, F.lit("-"), F.lit(" ")), F.lit(" model"))), F.lit("on HuggingFace."))
    return rows.filter(F.length(name) >= 2).select(
        "seq", name.alias("name"), link.alias("source_url"), link.alias("product_url"), description.alias("description"),
        lookup(task, S.TASK_PRODUCT_TYPE, "other").alias("product_type"), F.lit("ai-model").alias("category"),
        lookup(task, S.TASK_SUB_CATEGORY).alias("sub_category"),
        F.concat(compact(F.lit("open-source"), blank_to_null(task)), G.architecture_tags(tags)).alias("tags"),
        G.task_modalities(task).alias("modalities"), F.lit(True).alias("open_source"),
        G.license_spdx(F.col("cardData.license"), tags).alias("license"), link.alias("repository_url"), size.alias("parameter_count"),
        company.alias("company_name"), F.lit(True).alias("api_available"), F.concat(link, F.lit("#how-to-use")).alias("api_docs_url"),
        F.lit("active").alias("status"),
        F.create_map(
            F.lit("huggingface_downloads"), F.coalesce("downloads", F.lit(0)).cast("string"), F.lit("huggingface_id"), F.col("full"),
            F.lit("pipeline_tag"), task).alias("extra"),
    )


@source("lmsys", 2)
def lmsys(landed: DataFrame) -> DataFrame:
    """Arena rows; columns go by several names."""
    rows = _json_items(landed, "rows array<struct<row:map<string,string>>>", "rows").select("seq", F.col("i.row").alias("r"))

    def val(*keys: str) -> Column:
        return F.coalesce(*[blank_to_null(F.try_element_at("r", F.lit(k))) for k in keys])

    name = strip(val("key", "model_name", "Model", "model"))
    elo = val("arena_score", "elo_rating", "Arena Elo (Avg)", "rating")
    license_name = val("license", "License")
    benchmarks = {c.lower().replace("-", "_"): F.try_element_at("r", F.lit(c)) for c in ("MT-bench", "MMLU", "coding", "math", "reasoning")}
    return rows.filter(truthy(name)).select(
        "seq", name.alias("name"), F.lit("https://huggingface.co/spaces/lmsys/chatbot-arena-leaderboard").alias("source_url"),
        F.concat(name, F.lit(" — ranked on the LMSYS Chatbot Arena leaderboard"), F.coalesce(F.concat(F.lit(" with Elo rating "), elo), F.lit("")), F.lit(".")).alias("description"),
        F.lit("llm").alias("product_type"), F.lit("ai-model").alias("category"), F.lit("text-generation").alias("sub_category"),
        strings(["llm", "benchmark", "chatbot-arena"]).alias("tags"),
        F.coalesce(val("organization", "Organization", "org"), G.guess_org(name, S.ARENA_ORGS, "prefix")).alias("company_name"),
        G.likely_open_source(name, license_name).alias("open_source"), license_name.alias("license"), F.lit("active").alias("status"),
        _extra(chatbot_arena_elo=elo, **benchmarks).alias("extra"),
    )


@source("openrouter", 2)
def openrouter(landed: DataFrame) -> DataFrame:
    model = "struct<id:string,description:string,context_length:bigint,pricing:struct<prompt:string,completion:string>,architecture:struct<modality:string>>"
    rows = _json_items(landed, f"data array<{model}>", "data").select("seq", "i.*").filter(truthy("id"))
    name = F.substr("id", F.instr("id", "/") + 1)
    link = F.concat(F.lit("https://openrouter.ai/models/"), "id")
    prompt, completion = F.col("pricing.prompt"), F.col("pricing.completion")
    model_price = M.pricing_model(prompt, completion)
    return rows.filter(truthy(name)).select(
        "seq", name.alias("name"), link.alias("source_url"), link.alias("product_url"),
        F.coalesce(blank_to_null("description"), F.concat(name, F.lit(" available on OpenRouter."))).alias("description"),
        F.lit("llm").alias("product_type"), F.lit("ai-model").alias("category"), F.lit("text-generation").alias("sub_category"),
        strings(["llm", "api-service"]).alias("tags"), G.parse_modalities("architecture.modality").alias("modalities"),
        F.col("context_length").alias("context_window"), G.guess_org("id", S.ROUTER_ORGS, "prefix").alias("company_name"),
        model_price.alias("pricing_model"), (model_price == "free").alias("has_free_tier"), F.lit(True).alias("api_available"),
        F.lit("https://openrouter.ai/docs").alias("api_docs_url"), F.lit("active").alias("status"),
        _extra(openrouter_id=F.col("id"), input_price_per_1m_tokens=M.price_per_million(prompt), output_price_per_1m_tokens=M.price_per_million(completion)).alias("extra"),
    )


# ---------------------------------------------------------------- listing pages


def _category_parts(slug: Column, table: dict) -> tuple[Column, Column, Column]:
    """Product type, category and sub-category of a listing slug."""
    def part(i: int) -> Column:
        return lookup(slug, {k: v[i] for k, v in table.items() if v[i] is not None})

    return F.coalesce(part(0), F.lit("app")), F.coalesce(part(1), F.lit("ai-app")), part(2)


def _directory(landed: DataFrame, entries: Column, table: dict, nav: tuple, visits: bool) -> DataFrame:
    rows = explode_entries(landed, entries)
    slug = page_slug("page_url")
    kind, category, sub = _category_parts(slug, table)
    kept = rows.filter(X.is_listing_name(F.col("g1"), nav))
    return _unique(kept.select(
        "seq", F.col("g1").alias("name"), F.col("page_url").alias("source_url"), blank_to_null("g2").alias("product_url"),
        F.when(truthy("desc"), X.clean_description("desc")).alias("description"), kind.alias("product_type"), category.alias("category"),
        sub.alias("sub_category"), F.array(F.replace(slug, F.lit("-"), F.lit(" "))).alias("tags"), F.lit("active").alias("status"),
        (_extra(toolify_monthly_visits=F.col("visits")) if visits else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("extra"),
    ), F.lower("name"))


def _headings(body: Column) -> Column:
    return F.filter(matches(body, S.HEADING_ENTRY, 3), lambda m: (m["g1"] != "") & (m["g3"] != ""))


@source("toolify", 2)
def toolify(landed: DataFrame) -> DataFrame:
    def shape(items: Column, visits, desc) -> Column:
        return F.transform(items, lambda m: F.struct(m["g1"].alias("g1"), m["g2"].alias("g2"), visits(m).alias("visits"), desc(m).alias("desc")))

    none = F.lit("")
    main = shape(matches(F.col("body"), S.TOOLIFY_ENTRY, 4), lambda m: m["g3"], lambda m: m["g4"])
    spare = shape(_headings(F.col("body")), lambda m: none, lambda m: m["g3"])
    return _directory(landed, with_fallback(main, spare, 3), S.TOOLIFY_CATEGORIES, S.TOOLIFY_NAV, True)


@source("theresanaiforthat", 2)
def theresanaiforthat(landed: DataFrame) -> DataFrame:
    def shape(items: Column) -> Column:
        return F.transform(items, lambda m: F.struct(m["g1"].alias("g1"), m["g2"].alias("g2"), m["g3"].alias("desc")))

    found = with_fallback(shape(matches(F.col("body"), S.TAAFT_ENTRY, 3)), shape(_headings(F.col("body"))), 3)
    long_enough = F.filter(found, lambda m: F.length(m["desc"]) >= 10)
    return _directory(landed, long_enough, S.TAAFT_CATEGORIES, S.TAAFT_NAV, False)


def _card_icon(card: Column) -> Column:
    return strip(F.regexp_extract(card, S.CARD_ICON, 1))


def _chinese_directory(rows: DataFrame, base: str, table: dict, product_url: Column) -> DataFrame:
    slug = F.url_decode(page_slug("page_url"))
    kind, category, sub = _category_parts(slug, table)
    zh = X.has_chinese("name")
    desc = blank_to_null("description")
    records = rows.filter((F.length("name") >= 2) & (F.length("name") <= 80)).select(
        "seq", "name", F.col("page_url").alias("source_url"), F.when(zh, F.col("name")).alias("name_zh"), blank_to_null(product_url).alias("product_url"),
        desc.alias("description"), F.when(X.has_chinese(desc), desc).alias("description_zh"), U.resolve_url(base, "icon", icon=True).alias("icon_url"),
        kind.alias("product_type"), category.alias("category"), sub.alias("sub_category"), F.array(slug).alias("tags"), F.lit("active").alias("status"),
    )
    return _unique(records, F.lower("name"))


def _first_per_link(rows: DataFrame) -> DataFrame:
    """First entry of every link of a page, entries without a name left out."""
    named = rows.withColumn("name", X.strip_html("name")).filter(truthy("name"))
    return first_seen(named, "page_url", "link")


@source("aibot", 2)
def aibot(landed: DataFrame) -> DataFrame:
    body = F.col("body")
    whole = F.regexp_extract_all(body, F.lit(S.AIBOT_CARD), F.lit(0))
    cards = F.zip_with(matches(body, S.AIBOT_CARD, 3), whole, lambda m, w: F.struct(
        m["g1"].alias("link"), m["g2"].alias("description"), m["g3"].alias("name"), _card_icon(w).alias("icon")))
    none = F.lit("")
    links = F.transform(matches(body, S.AIBOT_LINK, 2), lambda m: F.struct(
        m["g1"].alias("link"), none.alias("description"), m["g2"].alias("name"), none.alias("icon")))
    rows = _first_per_link(explode_entries(landed, with_fallback(cards, links, 1, replace=True)))
    base = "https://ai-bot.cn"
    return _chinese_directory(rows, base, S.AIBOT_CATEGORIES, U.resolve_url(base, "link"))


@source("ainav", 2)
def ainav(landed: DataFrame) -> DataFrame:
    body = F.col("body")
    whole = F.regexp_extract_all(body, F.lit(S.AINAV_CARD), F.lit(0))

    def icon(card: Column) -> Column:
        found = _card_icon(card)
        return F.when(found.contains("favicon.png") | found.contains("default"), "").otherwise(found)

    cards = F.zip_with(matches(body, S.AINAV_CARD, 4), whole, lambda m, w: F.struct(
        m["g1"].alias("link"), m["g2"].alias("site"), m["g3"].alias("description"), m["g4"].alias("name"), icon(w).alias("icon")))
    rows = _first_per_link(explode_entries(landed, cards))
    base = "https://www.ainav.cn"
    detail = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(F.concat(F.lit(base), "link"))
    return _chinese_directory(rows, base, S.AINAV_CATEGORIES, F.coalesce(blank_to_null("site"), detail))


@source("techcrunch", 2)
def techcrunch(landed: DataFrame) -> DataFrame:
    links = matches(F.col("body"), S.TC_LINK, 2)
    page = F.col("url")
    headings = F.transform(
        F.filter(matches(F.col("body"), S.TC_HEADING, 2), lambda m: F.length(m["g1"]) >= 10),
        lambda m: F.struct(m["g1"].alias("g1"), F.coalesce(blank_to_null(m["g2"]), page).alias("g2")),
    )
    rows = explode_entries(landed, with_fallback(links, headings, 3))
    company = strip(group("g1", S.TC_COMPANY))
    return _unique(rows.filter(F.length(company) >= 2).select(
        "seq", company.alias("name"), F.col("g2").alias("source_url"), F.col("g1").alias("description"), company.alias("company_name"),
        M.funding_amount("g1").alias("company_total_raised_usd"), M.funding_round("g1").alias("company_last_round"),
        U.date_from_url("g2").alias("release_date"), F.lit("active").alias("status"), _extra(techcrunch_article_url=F.col("g2")).alias("extra"),
    ), F.lower("name"))


@source("artificial_analysis", 2)
def artificial_analysis(landed: DataFrame) -> DataFrame:
    body = F.col("body")
    full = F.transform(
        F.filter(matches(body, S.AA_ROW, 5), lambda m: F.length(m["g1"]).between(2, 60)),
        lambda m: F.struct(
            m["g1"].alias("name"),
            F.coalesce(G.guess_org(m["g2"], S.PROVIDERS, "contains"), blank_to_null(m["g2"])).alias("company"),
            m["g3"].alias("quality"), F.replace(m["g4"], F.lit(","), F.lit("")).alias("speed"), m["g5"].alias("price")),
    )
    none = F.lit("")
    spare = F.transform(
        F.filter(matches(body, S.AA_SIMPLE, 2), lambda m: F.length(m["g1"]) >= 2),
        lambda m: F.struct(m["g1"].alias("name"), G.guess_org(m["g1"], S.MODEL_PREFIX_ORGS, "prefix").alias("company"), none.alias("quality"), m["g2"].alias("speed"), none.alias("price")),
    )
    rows = explode_entries(landed, with_fallback(full, spare, 3))
    return _unique(rows.select(
        "seq", "name", F.col("page_url").alias("source_url"), F.lit("llm").alias("product_type"), F.lit("ai-model").alias("category"),
        F.col("company").alias("company_name"), F.lit("active").alias("status"),
        _extra(aa_quality_score=F.col("quality"), aa_speed_tokens_per_sec=F.col("speed"), aa_price_per_1m_tokens=F.col("price")).alias("extra"),
    ), F.lower("name"))


@source("papers_with_code", 2)
def papers_with_code(landed: DataFrame) -> DataFrame:
    """Leaderboard pages folded to one record per model."""
    table = F.filter(matches(F.col("body"), S.PWC_ROW, 3), lambda m: F.length(m["g1"]) >= 2)
    listed = F.filter(matches(F.col("body"), S.PWC_ENTRY, 3), lambda m: F.length(m["g1"]) >= 2)
    slug = page_slug("page_url")
    pages = list(S.BENCHMARK_PAGES)
    rows = explode_entries(landed, with_fallback(table, listed, 3)).select(
        F.coalesce(F.array_position(strings(pages), slug), F.lit(0)).alias("page"), F.col("seq").alias("pos"), F.col("g1").alias("model"),
        lookup(slug, S.BENCHMARK_PAGES, slug).alias("benchmark"), F.col("g3").alias("score"), F.col("g2").alias("paper_url"), F.lower("g1").alias("key"),
    )
    # within a page the first row of a model counts
    entries = first_seen(rows, "page", "key", order="pos")
    models = fold_leaderboard(entries.drop("key"))
    order = entries.groupBy(F.btrim(F.lower("model")).alias("model_key")).agg(F.min("pos").alias("seq"))
    paper = F.when(F.col("paper_url").startswith("http"), F.col("paper_url")).otherwise(F.concat(F.lit("https://paperswithcode.com"), "paper_url"))
    scores = F.transform_keys("benchmarks", lambda k, v: F.concat(F.lit("benchmark_"), k))
    return models.join(order, "model_key").select(
        "seq", F.col("model").alias("name"), F.lit("https://paperswithcode.com/").alias("source_url"), F.lit("llm").alias("product_type"),
        F.lit("ai-model").alias("category"), G.guess_org("model", S.PAPER_ORGS, "contains").alias("company_name"), F.lit("active").alias("status"),
        F.map_concat(scores, _extra(paper_url=paper)).alias("extra"),
    )


# ---------------------------------------------------------------- registries and stores


def _seeded(landed: DataFrame, packages: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """The fixed package list, at most a few dozen rows."""
    listed = [(package, pos, product, org) for pos, (package, product, org) in enumerate(packages)]
    rows = landed.sparkSession.createDataFrame(listed, "package string, pos int, product string, org string")
    return F.broadcast(rows)


@source("pypi", 2)
def pypi(landed: DataFrame) -> DataFrame:
    info = F.from_json("body", "info struct<summary:string,description:string,home_page:string,project_url:string,project_urls:map<string,string>,license:string>")["info"]
    meta = landed.filter(F.col("format") == "info").select(F.regexp_extract("url", r"/pypi/(.+)/json", 1).alias("package"), info.alias("i")).filter(F.col("i").isNotNull())
    month = F.from_json("body", "data struct<last_month:bigint>")["data"]["last_month"]
    stats = landed.filter(F.col("format") == "stats").select(F.regexp_extract("url", r"/packages/(.+)/recent", 1).alias("package"), month.cast("string").alias("monthly"))
    page = F.concat(F.lit("https://pypi.org/project/"), "package", F.lit("/"))
    home = F.coalesce(blank_to_null("i.home_page"), blank_to_null("i.project_url"))
    return _seeded(landed, S.PYPI_PACKAGES).join(meta, "package").join(stats, "package", "left").select(
        F.col("pos").cast("bigint").alias("seq"), F.col("product").alias("name"), page.alias("source_url"), F.coalesce(home, page).alias("product_url"),
        F.coalesce(blank_to_null("i.summary"), F.substring(F.coalesce("i.description", F.lit("")), 1, 200)).alias("description"),
        F.lit("framework").alias("product_type"), F.lit("ai-dev-tool").alias("category"), F.lit("ai-framework").alias("sub_category"),
        strings(["python", "open-source"]).alias("tags"), F.col("org").alias("company_name"), F.lit(True).alias("open_source"),
        blank_to_null("i.license").alias("license"), U.repo_url(F.col("i.project_urls")).alias("repository_url"), strings(["api", "cli"]).alias("platforms"),
        F.lit("active").alias("status"), _extra(pypi_package=F.col("package"), pypi_monthly_downloads=F.col("monthly")).alias("extra"),
    )


@source("npm", 2)
def npm(landed: DataFrame) -> DataFrame:
    doc = F.from_json("body", "description string, homepage string, repository struct<url:string>, license string")
    meta = landed.filter(F.col("format") == "info").select(F.regexp_extract("url", r"registry\.npmjs\.org/(.+)$", 1).alias("package"), doc.alias("i")).filter(F.col("i").isNotNull())
    week = F.from_json("body", "downloads bigint")["downloads"]
    stats = landed.filter(F.col("format") == "stats").select(F.regexp_extract("url", r"/last-week/(.+)$", 1).alias("package"), week.cast("string").alias("weekly"))
    page = F.concat(F.lit("https://www.npmjs.com/package/"), "package")
    repo = F.regexp_replace(F.regexp_replace("i.repository.url", r"^git\+", ""), r"\.git$", "")
    return _seeded(landed, S.NPM_PACKAGES).join(meta, "package").join(stats, "package", "left").select(
        F.col("pos").cast("bigint").alias("seq"), F.col("product").alias("name"), page.alias("source_url"),
        F.coalesce(blank_to_null("i.homepage"), page).alias("product_url"), F.coalesce("i.description", F.lit("")).alias("description"),
        F.lit("framework").alias("product_type"), F.lit("ai-dev-tool").alias("category"), F.lit("ai-framework").alias("sub_category"),
        strings(["javascript", "open-source"]).alias("tags"), F.col("org").alias("company_name"), F.lit(True).alias("open_source"),
        blank_to_null("i.license").alias("license"), blank_to_null(repo).alias("repository_url"), strings(["api", "web"]).alias("platforms"),
        F.lit("active").alias("status"), _extra(npm_package=F.col("package"), npm_weekly_downloads=F.col("weekly")).alias("extra"),
    )


@source("dockerhub", 2)
def dockerhub(landed: DataFrame) -> DataFrame:
    doc = F.from_json("body", "pull_count bigint, star_count bigint, description string, full_description string")
    meta = landed.select(F.regexp_extract("url", r"/repositories/(.+?)/?$", 1).alias("package"), doc.alias("i")).filter(F.col("i").isNotNull())
    page = F.concat(F.lit("https://hub.docker.com/r/"), "package")
    zero = F.lit(0)
    return _seeded(landed, S.DOCKER_IMAGES).join(meta, "package").select(
        F.col("pos").cast("bigint").alias("seq"), F.col("product").alias("name"), page.alias("source_url"), page.alias("product_url"),
        F.coalesce(blank_to_null("i.description"), F.substring(F.coalesce("i.full_description", F.lit("")), 1, 200)).alias("description"),
        F.lit("framework").alias("product_type"), F.lit("ai-infrastructure").alias("category"), F.lit("inference-platform").alias("sub_category"),
        strings(["docker", "open-source", "infrastructure"]).alias("tags"), F.col("org").alias("company_name"), F.lit(True).alias("open_source"),
        strings(["api", "cli", "desktop"]).alias("platforms"), F.lit("active").alias("status"),
        F.create_map(
            F.lit("docker_image"), F.col("package"), F.lit("docker_pulls"), F.coalesce("i.pull_count", zero).cast("string"),
            F.lit("docker_stars"), F.coalesce("i.star_count", zero).cast("string")).alias("extra"),
    )


@source("google_play", 2)
def google_play(landed: DataFrame) -> DataFrame:
    app = "struct<appId:string,title:string,developer:string,score:double,realInstalls:string,installs:string,icon:string,summary:string,description:string>"
    rows = _json_items(landed, f"results array<{app}>", "results").select("seq", "i.*").filter(truthy("appId") & ~F.col("appId").isin(*S.SKIPPED_BUNDLES))
    first = _unique(rows, F.col("appId")).withColumn("title", strip("title")).filter(truthy("title"))
    link = F.concat(F.lit("https://play.google.com/store/apps/details?id="), "appId")
    about = F.coalesce(blank_to_null("summary"), blank_to_null("description"))
    return first.select(
        "seq", F.col("title").alias("name"), link.alias("source_url"), link.alias("product_url"), blank_to_null("icon").alias("icon_url"),
        X.truncate(about).alias("description"), F.lit("app").alias("product_type"), F.lit("ai-app").alias("category"),
        blank_to_null("developer").alias("company_name"), strings(["android"]).alias("platforms"), F.lit("active").alias("status"),
        _extra(google_play_app_id=F.col("appId"), google_play_rating=F.when(F.col("score").isNotNull(), F.format_string("%.1f", "score")),
               google_play_installs=F.coalesce(F.nullif(blank_to_null("realInstalls"), F.lit("0")), "installs")).alias("extra"),
    )


@source("app_store", 2)
def app_store(landed: DataFrame) -> DataFrame:
    app = "struct<trackId:string,trackName:string,artistName:string,averageUserRating:double,userRatingCount:bigint,artworkUrl512:string,artworkUrl100:string,description:string,trackViewUrl:string>"
    rows = _json_items(landed, f"results array<{app}>", "results").select("seq", "i.*").filter(truthy("trackId"))
    first = _unique(rows, F.col("trackId")).withColumn("trackName", strip("trackName")).filter(truthy("trackName"))
    page = blank_to_null("trackViewUrl")
    return first.select(
        "seq", F.col("trackName").alias("name"), F.coalesce(page, F.concat(F.lit("https://apps.apple.com/app/id"), "trackId")).alias("source_url"),
        page.alias("product_url"), F.coalesce(blank_to_null("artworkUrl512"), blank_to_null("artworkUrl100")).alias("icon_url"),
        X.truncate(blank_to_null("description")).alias("description"), F.lit("app").alias("product_type"), F.lit("ai-app").alias("category"),
        blank_to_null("artistName").alias("company_name"), strings(["ios"]).alias("platforms"), F.lit("active").alias("status"),
        _extra(app_store_track_id=F.col("trackId"), app_store_rating=F.when(F.col("averageUserRating").isNotNull(), F.format_string("%.1f", "averageUserRating")),
               app_store_rating_count=F.col("userRatingCount").cast("string")).alias("extra"),
    )


# ---------------------------------------------------------------- discovery


def discovered(records: DataFrame) -> DataFrame:
    """Records as discovery rows: name and links only."""
    return schemas.conform(records.select("name", "source", "source_url", "product_url"), schemas.DISCOVERED)


def discovered_to_records(found: DataFrame, name: str, tier: int) -> DataFrame:
    """Discovery rows as minimal records of one source."""
    rows = found.withColumns({"source": F.lit(name), "source_tier": F.lit(tier), "product_url": blank_to_null("product_url")})
    return schemas.conform(rows, schemas.RECORD)


__all__ = ["crawl_targets", "crunchbase_records", "discovered", "discovered_to_records", "job_listings"]
