"""Weights, tiers and field lists."""

# Source tier -> trust.
TRUST = {1: 0.95, 2: 0.75, 3: 0.50, 4: 0.20}

# Product field path -> weight in the quality score.
QUALITY_WEIGHTS = {
    "name": 3.0,
    "product_url": 3.0,
    "description": 3.0,
    "product_type": 2.0,
    "category": 2.0,
    "sub_category": 1.5,
    "icon_url": 1.0,
    "company.name": 2.0,
    "company.url": 2.0,
    "company.website": 1.5,
    "company.founded_year": 1.0,
    "company.headquarters": 1.0,
    "company.description": 0.5,
    "company.funding": 0.5,
    "architecture": 1.0,
    "modalities": 1.0,
    "platforms": 1.0,
    "api_available": 0.5,
    "open_source": 0.5,
    "repository_url": 0.5,
    "pricing": 1.0,
    "tags": 1.0,
    "keywords": 1.0,
    "key_people": 0.5,
    "sources": 1.0,
    "status": 1.0,
    "description_zh": 0.5,
}

# Scalar record column -> product path, in merge order.
SCALAR_PATHS = {
    "name_zh": "name_zh",
    "product_url": "product_url",
    "icon_url": "icon_url",
    "description": "description",
    "description_zh": "description_zh",
    "product_type": "product_type",
    "category": "category",
    "sub_category": "sub_category",
    "company_name": "company.name",
    "company_name_zh": "company.name_zh",
    "company_website": "company.website",
    "company_wikipedia_url": "company.wikipedia_url",
    "company_logo_url": "company.logo_url",
    "company_description": "company.description",
    "company_founded_year": "company.founded_year",
    "company_headquarters_city": "company.headquarters.city",
    "company_headquarters_country": "company.headquarters.country",
    "company_headquarters_country_code": "company.headquarters.country_code",
    "company_total_raised_usd": "company.funding.total_raised_usd",
    "company_last_round": "company.funding.last_round",
    "company_employee_count_range": "company.employee_count_range",
    "architecture": "architecture",
    "parameter_count": "parameter_count",
    "context_window": "context_window",
    "open_source": "open_source",
    "license": "license",
    "repository_url": "repository_url",
    "github_stars": "github_stars",
    "github_contributors": "github_contributors",
    "api_available": "api_available",
    "api_docs_url": "api_docs_url",
    "pricing_model": "pricing.model",
    "has_free_tier": "pricing.has_free_tier",
    "status": "status",
    "release_date": "release_date",
}

# Array record column -> product path.
ARRAY_PATHS = {
    "tags": "tags",
    "keywords": "keywords",
    "modalities": "modalities",
    "supported_languages": "supported_languages",
    "platforms": "platforms",
    "target_audience": "target_audience",
    "use_cases": "use_cases",
    "competitors": "competitors",
    "based_on": "based_on",
    "key_people": "key_people",
    "hiring_positions": "hiring.positions",
    "hiring_tech_stack": "hiring.tech_stack",
}

# The only paths an auxiliary (tier 4) source may write.
HIRING_PATHS = (
    "hiring.is_hiring", "hiring.total_positions", "hiring.positions", "hiring.tech_stack",
    "hiring.last_checked",
)

# Paths whose values must not belong to another product.
VALIDATED_PATHS = ("name", "name_zh", "description", "description_zh", "product_url")
CHECKED_AT_CREATE = ("name_zh", "description_zh", "product_url")

# Paths kept whole in provenance.
PROVENANCE_LEAVES = ("pricing", "company.funding", "company.headquarters", "company.social")

# Fields an answer may fill -> product path, in prompt order.
FILLABLE_PATHS = {
    "description": "description",
    "description_zh": "description_zh",
    "product_type": "product_type",
    "category": "category",
    "sub_category": "sub_category",
    "tags": "tags",
    "modalities": "modalities",
    "platforms": "platforms",
    "target_audience": "target_audience",
    "use_cases": "use_cases",
    "architecture": "architecture",
    "pricing_model": "pricing.model",
    "has_free_tier": "pricing.has_free_tier",
    "open_source": "open_source",
    "api_available": "api_available",
    "competitors": "competitors",
    "status": "status",
}

# Index columns copied as they are.
INDEX_COLUMNS = (
    "slug", "name", "name_zh", "description", "description_zh", "product_url", "icon_url",
    "product_type", "category", "tags", "keywords", "open_source", "status",
)

# Search key -> weight, and the score limit of a match.
SEARCH_WEIGHTS = {
    "name": 2.0,
    "name_zh": 1.5,
    "company_name": 1.0,
    "description": 1.0,
    "description_zh": 0.8,
    "category": 1.0,
    "product_type": 0.8,
    "tags": 0.8,
    "country": 0.5,
    "city": 0.5,
}
SEARCH_THRESHOLD = 0.4

# Similarity limits.
NAME_SIMILARITY = 0.85
DESCRIPTION_SIMILARITY = 0.90
MIN_COMPARED_DESCRIPTION = 20

# Daily limits.
DAILY_PAGE_QUOTA = 100
DAILY_API_QUOTA = 500
DAILY_CRAWL_QUOTA = 200

# Hosts that list products and are never a product's own site.
AGGREGATOR_HOSTS = (
    "ai-bot.cn", "ainav.cn", "theresanaiforthat.com", "toolify.ai", "futurepedia.io",
    "alternativeto.net", "producthunt.com", "crunchbase.com", "pitchbook.com",
    "ycombinator.com",
)
