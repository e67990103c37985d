"""Spark schemas of the record, product, landed-payload and violation tables."""

from pyspark.sql import types as T

_s, _i, _l, _d, _b = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(),
)
_strings = T.ArrayType(T.StringType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


PERSON = _struct(name=_s, title=_s, is_founder=_b, profile_url=_s)
POSITION = _struct(title=_s, location=_s, url=_s, source=_s)
PROVENANCE_ENTRY = _struct(source=_s, tier=_i, confidence=_d, updated_at=T.DateType())
SOURCE_ENTRY = _struct(url=_s, source_name=_s, scraped_at=T.DateType())

#: One flat record as a source reports it. ``seq`` is the arrival order.
RECORD = _struct(
    seq=_l, name=_s, source=_s, source_url=_s, source_tier=_i,
    name_zh=_s, product_url=_s, icon_url=_s, description=_s, description_zh=_s,
    product_type=_s, category=_s, sub_category=_s, tags=_strings, keywords=_strings,
    company_name=_s, company_name_zh=_s, company_website=_s, company_wikipedia_url=_s,
    company_logo_url=_s, company_description=_s, company_founded_year=_i,
    company_headquarters_city=_s, company_headquarters_country=_s,
    company_headquarters_country_code=_s, company_total_raised_usd=_d,
    company_last_round=_s, company_employee_count_range=_s,
    key_people=T.ArrayType(PERSON),
    architecture=_s, parameter_count=_s, context_window=_l, modalities=_strings,
    supported_languages=_strings, platforms=_strings, api_available=_b, api_docs_url=_s,
    open_source=_b, license=_s, repository_url=_s, github_stars=_l, github_contributors=_l,
    pricing_model=_s, has_free_tier=_b, target_audience=_strings, use_cases=_strings,
    competitors=_strings, based_on=_strings, status=_s, release_date=T.DateType(),
    hiring_positions=T.ArrayType(POSITION), hiring_tech_stack=_strings,
    extra=T.MapType(_s, _s),
)

HEADQUARTERS = _struct(city=_s, state=_s, country=_s, country_code=_s)
FUNDING = _struct(
    total_raised_usd=_d, last_round=_s, last_round_date=_s, valuation_usd=_d,
    investors=_strings,
)
SOCIAL = _struct(linkedin=_s, crunchbase=_s, twitter=_s, github=_s)
COMPANY = _struct(
    name=_s, name_zh=_s, url=_s, website=_s, wikipedia_url=_s, logo_url=_s, description=_s,
    founded_year=_i, headquarters=HEADQUARTERS, funding=FUNDING, employee_count_range=_s,
    social=SOCIAL,
)
PRICING = _struct(model=_s, has_free_tier=_b)
HIRING = _struct(
    is_hiring=_b, total_positions=_i, positions=T.ArrayType(POSITION), tech_stack=_strings,
    last_checked=T.DateType(),
)
META = _struct(
    added_date=T.DateType(), last_updated=T.DateType(), data_quality_score=_d,
    needs_review=_b, provenance=T.MapType(_s, PROVENANCE_ENTRY),
)

#: One catalog product, nested.
PRODUCT = _struct(
    slug=_s, name=_s, name_zh=_s, product_url=_s, icon_url=_s, description=_s,
    description_zh=_s, product_type=_s, category=_s, sub_category=_s, status=_s,
    release_date=T.DateType(), tags=_strings, keywords=_strings, modalities=_strings,
    platforms=_strings, supported_languages=_strings, target_audience=_strings,
    use_cases=_strings, integrations=_strings, competitors=_strings, based_on=_strings,
    used_by=_strings, architecture=_s, parameter_count=_s, context_window=_l,
    api_available=_b, api_docs_url=_s, open_source=_b, license=_s, repository_url=_s,
    github_stars=_l, github_contributors=_l, pricing=PRICING, company=COMPANY,
    key_people=T.ArrayType(PERSON), hiring=HIRING, sources=T.ArrayType(SOURCE_ENTRY),
    meta=META,
)

#: One fetched payload: what a crawler leaves in the landing table.
LANDED = _struct(seq=_l, url=_s, source=_s, format=_s, body=_s, fetched_at=T.TimestampType())

#: One found name, before it is scraped in full.
DISCOVERED = _struct(
    name=_s, source=_s, source_url=_s, product_url=_s, discovered_at=T.TimestampType(),
)


def field_type(schema: T.StructType, path: str) -> T.DataType:
    """Type at a dotted path."""
    node: T.DataType = schema
    for part in path.split("."):
        node = node[part].dataType
    return node


def conform(df, schema: T.StructType):
    """Project ``df`` onto ``schema``: missing columns become typed NULLs."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in schema.fields
        ]
    )
