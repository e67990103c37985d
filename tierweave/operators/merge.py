"""Tiered merge: many records per product folded into one document, in closed form.

For one product and one scalar field the record that ends up owning the field is the first
arrival of the lowest tier, provided that tier beats the tier already recorded. A tier-3
record additionally needs the old value to be empty. So the fold is a ``min_by`` per field
over the records alone, and the catalog joins once, on one row per product. Map-side partial
aggregation keeps a product that holds most of the records from becoming one big task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave import schemas
from tierweave.fixed.scoring import ARRAY_PATHS, HIRING_PATHS, PROVENANCE_LEAVES, SCALAR_PATHS
from tierweave.fixed.taxonomy import MAX_TAGS
from tierweave.functions.base import blank_to_null, computed_once, truthy
from tierweave.functions.geo import trust_score
from tierweave.functions.url import company_url

AUXILIARY, GENERATED = 4, 3


def field_allowed(path: Column | str, tier: Column | str) -> Column:
    """Auxiliary sources may write hiring paths only."""
    p = F.lit(path) if isinstance(path, str) else path
    t = F.col(tier) if isinstance(tier, str) else tier
    return (t != AUXILIARY) | p.isin(*HIRING_PATHS)


def _slot(path: str) -> str:
    return "w__" + path.replace(".", "__")


def _value(path: str) -> str:
    return "v__" + path.replace(".", "__")


def _unseen(path: str) -> str:
    return "u__" + path.replace(".", "__")


#: Bits of the arrival number in the key of a claim; the four tiers take the two above.
ARRIVAL_BITS = 61


def _claim_key() -> Column:
    """Tier and arrival in one long, so that the least key is the first arrival of the lowest tier."""
    seq = F.col("seq").cast("long")
    fits = (seq >= 0) & (seq < 1 << ARRIVAL_BITS) & F.col("source_tier").between(1, 4)
    key = F.shiftleft(F.col("source_tier").cast("long") - 1, ARRIVAL_BITS).bitwiseOR(seq)
    return F.when(fits, key).when(~fits, F.raise_error("records need a seq from 0 to 2**61 - 1 and a tier from 1 to 4").cast("long"))


def _arrival(key: Column) -> Column:
    return key.bitwiseAND((1 << ARRIVAL_BITS) - 1)


def _claimed() -> dict[str, Column]:
    """The value a record claims for each path; NULL where it claims none."""
    not_aux = F.col("source_tier") != AUXILIARY
    adverts = ~not_aux & (F.size("hiring_positions") > 0)
    return {
        **{p: F.when(not_aux, F.col(c).cast(schemas.field_type(schemas.PRODUCT, p))) for c, p in SCALAR_PATHS.items()},
        "hiring.is_hiring": F.when(adverts, F.lit(True)),
        "company.url": company_url("company_website", "company_wikipedia_url", "company_name", "name"),
    }


def _summarise_scalars(records: DataFrame) -> DataFrame:
    """Per product and path the winning claim: value, tier, source.

    Only keys are compared, by hash aggregation over longs. The values are fetched from the few
    records that won something, by a join on product and arrival that no hot product can skew.
    """
    claimed, key = _claimed(), _claim_key()
    least = records.groupBy("slug").agg(
        *[F.min(F.when(v.isNotNull(), key)).alias(_slot(p)) for p, v in claimed.items() if p != "company.url"],
        F.min("seq").cast("long").alias(_slot("company.url")),  # of any tier
    )
    slots = [_slot(p) for p in claimed]
    won = least.select("slug", F.explode(F.array_distinct(F.array_compact(F.array(*[_arrival(F.col(s)) for s in slots])))).alias("seq"))
    claim = F.struct(
        F.col("seq").cast("long").alias("seq"), F.col("source_tier").alias("tier"), F.col("source"),
        F.struct(*[v.alias(_slot(p)) for p, v in claimed.items()]).alias("values"),
    )
    # at most one record per path
    fetched = records.join(won, ["slug", "seq"]).select("slug", claim.alias("c")).groupBy("slug").agg(F.collect_list("c").alias("_claims"))

    def winner(slot: str) -> Column:
        at = _arrival(F.col(slot))
        own = F.transform(F.filter("_claims", lambda x: x["seq"] == at), lambda c: F.struct(
            c["values"][slot].alias("value"), c["tier"].alias("tier"), c["source"].alias("source")))
        return F.when(F.col(slot).isNotNull(), F.get(own, F.lit(0)))

    return least.join(fetched, "slug").select("slug", *[winner(s).alias(s) for s in slots])


def _items_long(records: DataFrame) -> DataFrame:
    """(slug, field, item, payload) rows of every array value and source link."""
    allowed = F.col("source_tier") != AUXILIARY

    def items_of(c: str, path: str) -> Column:
        is_struct = isinstance(schemas.RECORD[c].dataType.elementType, T.StructType)
        items = F.transform(c, lambda x: F.struct(
            F.lit(path).alias("field"), (F.to_json(x) if is_struct else x).alias("item")))
        return F.when(F.lit(path in HIRING_PATHS) | allowed, items)

    parts = [items_of(c, path) for c, path in ARRAY_PATHS.items()]
    link = F.array(F.struct(F.lit("sources").alias("field"), F.col("source_url").alias("item")))
    parts.append(F.when(truthy("source_url"), link))
    none = F.array().cast("array<struct<field:string,item:string>>")
    flat = F.flatten(F.array(*[F.coalesce(p, none) for p in parts]))
    return records.select("slug", "seq", "source_tier", "source", F.posexplode(flat).alias("pos", "x")).select(
        "slug", "x.field", "x.item",
        F.struct("seq", "pos", F.col("source_tier").alias("tier"), "source").alias("at"),
    ).filter(F.col("item").isNotNull())


def _summarise_arrays(records: DataFrame) -> DataFrame:
    """Per product a map field -> distinct items in first-seen order.

    Repeats collapse on (product, field, item) before anything is gathered per product, so
    what is gathered is never larger than the arrays the document has to hold.
    """
    distinct = _items_long(records).groupBy("slug", "field", "item").agg(
        F.min("at").alias("first"), F.max("at").alias("last")
    )
    per_field = distinct.groupBy("slug", "field").agg(
        F.array_sort(F.collect_list(F.struct("first", "item", "last"))).alias("items")
    )
    return per_field.groupBy("slug").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "items"))).alias("found")
    )


def _entry(source: Column, tier: Column, as_of: Column) -> Column:
    return F.struct(
        source.alias("source"), tier.cast("int").alias("tier"),
        trust_score(tier).cast("double").alias("confidence"), as_of.cast("date").alias("updated_at"),
    )


def _old(path: str) -> Column:
    node = F.col("p")
    for part in path.split("."):
        node = node[part]
    return node


def _old_tier(path: str) -> Column:
    return F.try_element_at(F.col("p.meta.provenance"), F.lit(path))["tier"]


def _set_scalars(as_of: Column) -> tuple[dict[str, Column], list[Column]]:
    """New value per scalar path and the provenance entries of the paths that were set."""
    values, entries = {}, []
    for path in (*SCALAR_PATHS.values(), "hiring.is_hiring", "hiring.last_checked"):
        win = F.col(_slot("hiring.is_hiring" if path == "hiring.last_checked" else path))
        old, owner = _old(path), _old_tier(path)
        empty = old.isNull()
        if isinstance(schemas.field_type(schemas.PRODUCT, path), T.StringType):
            empty = empty | (old == "")
        takes = (
            win.isNotNull()
            & (owner.isNull() | (win["tier"] < owner))
            & ((win["tier"] != GENERATED) | empty)
        )
        takes = F.coalesce(takes, F.lit(False))
        value = as_of.cast("date") if path == "hiring.last_checked" else win["value"]
        values[path] = F.when(takes, value).otherwise(old)
        entries.append(F.when(takes, F.struct(F.lit(path).alias("key"), _entry(win["source"], win["tier"], as_of).alias("value"))))
    first = F.col(_slot("company.url"))
    takes = _old("company.url").isNull() & first.isNotNull()
    values["company.url"] = F.when(takes, first["value"]).otherwise(_old("company.url"))
    entries.append(F.when(takes, F.struct(F.lit("company.url").alias("key"), _entry(first["source"], first["tier"], as_of).alias("value"))))
    return values, entries


def _known(path: str) -> Column:
    """The old items as text."""
    is_struct = isinstance(schemas.field_type(schemas.PRODUCT, path).elementType, T.StructType)
    old_text = F.transform(_old(path), lambda x: F.to_json(x)) if is_struct else _old(path)
    return F.coalesce(old_text, F.array().cast("array<string>"))


def _unseen_items() -> dict[str, Column]:
    """Per array path the items found that the product does not hold yet."""
    def without(found: Column, known: Column) -> Column:
        return F.filter(found, lambda x: ~F.coalesce(F.array_contains(known, x["item"]), F.lit(False)))

    out = {}
    for path in ARRAY_PATHS.values():
        found = F.try_element_at(F.col("found"), F.lit(path))
        is_struct = isinstance(schemas.field_type(schemas.PRODUCT, path).elementType, T.StructType)
        # in the filter the old items would be written as text for every item found
        out[path] = computed_once(_known(path), lambda known: without(found, known)) if is_struct else without(found, _known(path))
    return out


def _set_arrays(as_of: Column) -> tuple[dict[str, Column], list[Column]]:
    """Old items followed by the unseen ones; tags cut to the limit once something is added."""
    values, entries = {}, []
    for path in ARRAY_PATHS.values():
        dtype = schemas.field_type(schemas.PRODUCT, path)
        old, fresh = _old(path), F.col(_unseen(path))
        is_struct = isinstance(dtype.elementType, T.StructType)
        added = F.coalesce(F.size(fresh), F.lit(0)) > 0
        items = F.transform(fresh, lambda x: F.from_json(x["item"], dtype.elementType) if is_struct else x["item"])
        merged = F.concat(F.coalesce(old, F.array().cast(dtype)), items)
        if path == "tags":
            # an item past the limit is added again each time it arrives
            room = F.greatest(F.lit(MAX_TAGS) - F.size(_known(path)), F.lit(0))
            moments = F.transform(fresh, lambda x, i: F.when(i < room, x["first"]).otherwise(x["last"]))
            merged = F.slice(merged, 1, MAX_TAGS)
        else:
            moments = F.transform(fresh, lambda x: x["first"])
        values[path] = F.when(added, merged).otherwise(old)
        at = F.array_max(moments)
        entries.append(F.when(added, F.struct(F.lit(path).alias("key"), _entry(at["source"], at["tier"], as_of).alias("value"))))
    return values, entries


def _appended_sources(as_of: Column) -> Column:
    old = F.coalesce(_old("sources"), F.array().cast(T.ArrayType(schemas.SOURCE_ENTRY)))
    found = F.try_element_at(F.col("found"), F.lit("sources"))
    fresh = F.filter(found, lambda x: ~F.exists(old, lambda s: s["url"].eqNullSafe(x["item"])))
    links = F.transform(fresh, lambda x: F.struct(
        x["item"].alias("url"), x["first"]["source"].alias("source_name"),
        as_of.cast("date").alias("scraped_at"),
    ))
    return F.coalesce(F.concat(old, links), _old("sources"))


def upsert_provenance(old: Column, new: Column) -> Column:
    """Entries of ``new`` replace those of ``old`` with the same path."""
    empty = F.map_from_entries(F.array().cast(
        T.ArrayType(T.StructType([T.StructField("key", T.StringType(), False), T.StructField("value", schemas.PROVENANCE_ENTRY)]))
    ))
    kept = F.map_filter(F.coalesce(old, empty), lambda k, v: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def _rebuild(schema: T.StructType, values: dict[str, Column], prefix: str = "") -> list[Column]:
    """Columns of ``schema`` with the given paths replaced; absent parents stay NULL."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        touched = [p for p in values if p == path or p.startswith(path + ".")]
        if not touched:
            out.append(_old(path).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            node = F.struct(*_rebuild(f.dataType, values, path + "."))
            present = _old(path).isNotNull()
            for p in touched:
                present = present | values[p].isNotNull()
            out.append(F.when(present, node).alias(f.name))
        else:
            out.append(values[path].alias(f.name))
    return out


def tiered_merge(catalog: DataFrame, records: DataFrame, as_of: Column) -> DataFrame:
    """Catalog with every record merged into the product named by its ``slug``.

    ``records`` has the record schema plus ``slug``; untouched products pass through. Values
    that failed cross-validation must be NULL already (see ``crossval.blank_rejected``).
    """
    found = _summarise_scalars(records).join(_summarise_arrays(records), "slug", "left")
    base = catalog.select(F.col("slug"), F.struct(*[F.col(c) for c in schemas.PRODUCT.names]).alias("p"))
    joined = base.join(found, "slug", "left")
    # unseen items and new owners become columns first: several expressions read them, and the owners
    # would be put together again for every old one
    joined = joined.select("*", *[v.alias(_unseen(path)) for path, v in _unseen_items().items()])
    touched = F.col(_slot("company.url")).isNotNull()

    scalars, s_entries = _set_scalars(as_of)
    arrays, a_entries = _set_arrays(as_of)
    values = {
        **scalars, **arrays,
        "sources": F.when(touched, _appended_sources(as_of)).otherwise(_old("sources")),
        "meta.last_updated": F.when(touched, as_of.cast("date")).otherwise(_old("meta.last_updated")),
    }
    # the new values become columns too: rebuilding a parent looks at each of them again
    flat = joined.select(
        "p", touched.alias("touched"), *[v.alias(_value(path)) for path, v in values.items()],
        F.map_from_entries(F.array_compact(F.array(*s_entries, *a_entries))).alias("owners"),
    )
    owned = F.when(F.col("touched"), upsert_provenance(_old("meta.provenance"), F.col("owners"))).otherwise(_old("meta.provenance"))
    flat = flat.withColumn(_value("meta.provenance"), owned)
    return flat.select(*_rebuild(schemas.PRODUCT, {path: F.col(_value(path)) for path in (*values, "meta.provenance")}))


# ---------------------------------------------------------------- creation


def _nonempty(c: str) -> Column:
    return blank_to_null(F.col(c))


def _items(c: str) -> Column:
    return F.when(F.size(c) > 0, F.col(c))


def _struct_if(present: Column, **fields: Column) -> Column:
    return F.when(present, F.struct(*[v.alias(k) for k, v in fields.items()]))


def _created_columns(as_of: Column) -> dict[str, Column]:
    """Product columns of a first record."""
    today = as_of.cast("date")
    null = F.lit(None)
    city, country = _nonempty("company_headquarters_city"), _nonempty("company_headquarters_country")
    raised, last_round = F.col("company_total_raised_usd"), _nonempty("company_last_round")
    social = {
        "linkedin": "linkedin_url", "crunchbase": "crunchbase_url", "twitter": "twitter",
        "github": "github_url",
    }
    links = {k: blank_to_null(F.try_element_at(F.col("extra"), F.lit(v))) for k, v in social.items()}
    positions, stack = _items("hiring_positions"), _items("hiring_tech_stack")
    model, free = _nonempty("pricing_model"), F.col("has_free_tier")
    plain = (
        "name_zh icon_url description_zh sub_category architecture parameter_count api_docs_url "
        "license repository_url"
    ).split()
    kept = "context_window api_available open_source github_stars github_contributors release_date".split()
    lists = (
        "keywords key_people modalities supported_languages platforms target_audience use_cases "
        "competitors based_on"
    ).split()
    return {
        "slug": F.col("slug"),
        "name": F.col("name"),
        "product_url": F.coalesce(F.col("product_url"), F.lit("")),
        "description": F.coalesce(_nonempty("description"), F.concat(F.col("name"), F.lit(" is an AI product."))),
        "product_type": F.coalesce(_nonempty("product_type"), F.lit("other")),
        "category": F.coalesce(_nonempty("category"), F.lit("ai-application")),
        "status": F.coalesce(_nonempty("status"), F.lit("active")),
        **{c: _nonempty(c) for c in plain},
        **{c: F.col(c) for c in kept},
        **{c: _items(c) for c in lists},
        "tags": F.when(F.size("tags") > 0, F.slice("tags", 1, MAX_TAGS)),
        "pricing": _struct_if(model.isNotNull() | free.isNotNull(), model=model, has_free_tier=free),
        "company": F.struct(
            F.coalesce(_nonempty("company_name"), F.col("name")).alias("name"),
            _nonempty("company_name_zh").alias("name_zh"),
            company_url("company_website", "company_wikipedia_url", "company_name", "name").alias("url"),
            _nonempty("company_website").alias("website"),
            _nonempty("company_wikipedia_url").alias("wikipedia_url"),
            _nonempty("company_logo_url").alias("logo_url"),
            _nonempty("company_description").alias("description"),
            F.col("company_founded_year").alias("founded_year"),
            _struct_if(
                city.isNotNull() | country.isNotNull(), city=city, state=null.cast("string"),
                country=country, country_code=_nonempty("company_headquarters_country_code"),
            ).alias("headquarters"),
            _struct_if(
                raised.isNotNull() | last_round.isNotNull(), total_raised_usd=raised,
                last_round=last_round, last_round_date=null.cast("string"),
                valuation_usd=null.cast("double"), investors=null.cast("array<string>"),
            ).alias("funding"),
            _nonempty("company_employee_count_range").alias("employee_count_range"),
            _struct_if(F.coalesce(*links.values()).isNotNull(), **links).alias("social"),
        ),
        "hiring": _struct_if(
            positions.isNotNull() | stack.isNotNull(),
            is_hiring=F.when(positions.isNotNull(), F.lit(True)),
            total_positions=F.when(positions.isNotNull(), F.size(positions)),
            positions=positions, tech_stack=stack, last_checked=today,
        ),
        "sources": F.when(truthy("source_url"), F.array(F.struct(
            F.col("source_url").alias("url"), F.col("source").alias("source_name"), today.alias("scraped_at"),
        ))).otherwise(F.array().cast(T.ArrayType(schemas.SOURCE_ENTRY))),
    }


def leaf_paths(schema: T.StructType = schemas.PRODUCT, prefix: str = "") -> list[str]:
    """Provenance paths of the product schema; compound leaves are kept whole."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if path in ("meta", "sources", "slug"):
            continue
        if isinstance(f.dataType, T.StructType) and path not in PROVENANCE_LEAVES:
            out += leaf_paths(f.dataType, path + ".")
        else:
            out.append(path)
    return out


def _is_filled(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(dtype, T.ArrayType):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def initial_provenance(entry: Column, row: Column) -> Column:
    """Map of every filled leaf path of ``row`` to ``entry``."""
    pairs = []
    for path in leaf_paths():
        node = row
        for part in path.split("."):
            node = node[part]
        filled = _is_filled(node, schemas.field_type(schemas.PRODUCT, path))
        pairs.append(F.when(filled, F.struct(F.lit(path).alias("key"), entry.alias("value"))))
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def _create_single(records: DataFrame, as_of: Column) -> DataFrame:
    """One product per record (slugs must be distinct)."""
    shaped = records.select(
        *[v.alias(k) for k, v in _created_columns(as_of).items()],
        _entry(F.col("source"), F.col("source_tier"), as_of).alias("entry"),
    )
    have = set(shaped.columns)
    row = F.struct(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.PRODUCT.fields if f.name != "meta"
    ])
    today = as_of.cast("date")
    meta = F.struct(
        today.alias("added_date"), today.alias("last_updated"),
        F.lit(None).cast("double").alias("data_quality_score"),
        F.lit(None).cast("boolean").alias("needs_review"),
        initial_provenance(F.col("entry"), F.col("row")).alias("provenance"),
    )
    done = shaped.select(row.alias("row"), "entry").withColumn("meta", meta)
    return done.select(*[
        F.col("meta") if n == "meta" else F.col(f"row.{n}") for n in schemas.PRODUCT.names
    ])


def create_products(records: DataFrame, as_of: Column, last_wins: bool = False) -> DataFrame:
    """New products from records with a ``slug``.

    Several records of one slug: the first creates the product and the rest merge into it;
    with ``last_wins`` only the last one counts.
    """
    names = [*schemas.RECORD.names, "slug"]
    pick = F.max_by if last_wins else F.min_by
    lead = records.groupBy("slug").agg(
        pick(F.struct(*[F.col(n) for n in schemas.RECORD.names]), "seq").alias("r")
    ).select("slug", "r.*")
    created = _create_single(lead, as_of)
    if last_wins:
        return created
    firsts = lead.select("slug", F.col("seq").alias("first_seq"))
    rest = records.join(firsts, "slug").filter(F.col("seq") > F.col("first_seq")).select(*names)
    return tiered_merge(created, rest, as_of)


def merge_or_create(catalog: DataFrame, records: DataFrame, as_of: Column, last_wins: bool = False) -> DataFrame:
    """Next catalog: known slugs are merged, unknown ones created, the rest untouched."""
    slugs = catalog.select("slug")
    merged = tiered_merge(catalog, records.join(slugs, "slug", "left_semi"), as_of)
    created = create_products(records.join(slugs, "slug", "left_anti"), as_of, last_wins)
    return merged.unionByName(created)


def upsert(catalog: DataFrame, changed: DataFrame) -> DataFrame:
    """Changed products replace those of the same slug; the others are kept."""
    return catalog.join(changed.select("slug"), "slug", "left_anti").select(*catalog.columns).unionByName(
        changed.select(*catalog.columns)
    )


def append_source(sources: Column, url: Column, source: Column, as_of: Column) -> Column:
    """Append a source entry unless its URL is empty or listed already."""
    old = F.coalesce(sources, F.array().cast(T.ArrayType(schemas.SOURCE_ENTRY)))
    entry = F.struct(url.alias("url"), source.alias("source_name"), as_of.cast("date").alias("scraped_at"))
    fresh = truthy(url) & ~F.exists(old, lambda s: s["url"] == url)
    return F.when(fresh, F.concat(old, F.array(entry))).otherwise(old)


def ordered_union(old: Column, new: Column, limit: int | None = None) -> Column:
    """Old items, then unseen new ones, cut to ``limit``."""
    out = F.concat(
        F.coalesce(old, F.array().cast("array<string>")),
        F.coalesce(F.array_except(new, F.coalesce(old, F.array().cast("array<string>"))), F.array().cast("array<string>")),
    )
    return F.slice(out, 1, limit) if limit else out


def set_nested(df: DataFrame, path: str, value: Column, schema: T.StructType = schemas.PRODUCT) -> DataFrame:
    """Set a dotted path, creating missing parents."""
    top, *rest = path.split(".")
    if not rest:
        return df.withColumn(top, value)

    def put(node: Column, dtype: T.StructType, parts: list[str]) -> Column:
        blank = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dtype.fields])
        node = F.coalesce(node, blank)
        head, *tail = parts
        inner = value if not tail else put(node[head], dtype[head].dataType, tail)
        return node.withField(head, inner)

    return df.withColumn(top, put(F.col(top), schema[top].dataType, rest))


def to_long(records: DataFrame) -> DataFrame:
    """(slug, path, value, tier, seq, source) rows of every scalar value, as text."""
    pairs = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(p).alias("path"), F.col(c).cast("string").alias("value")))
        for c, p in SCALAR_PATHS.items() if c in records.columns
    ]
    return records.select(
        "slug", F.col("source_tier").alias("tier"), "seq", "source",
        F.explode(F.array_compact(F.array(*pairs))).alias("x"),
    ).select("slug", "x.path", "x.value", "tier", "seq", "source")


def winners(long: DataFrame) -> DataFrame:
    """The value owning each (slug, path): first arrival of the lowest allowed tier."""
    return long.filter(field_allowed(F.col("path"), "tier")).groupBy("slug", "path").agg(
        F.min_by(F.struct("value", "tier", "source"), F.struct("tier", "seq")).alias("w")
    ).select("slug", "path", "w.value", "w.tier", "w.source")


def pivot_winners(won: DataFrame, paths: list[str]) -> DataFrame:
    """One row per slug with a text column per path."""
    return won.groupBy("slug").agg(*[
        F.max(F.when(F.col("path") == p, F.col("value"))).alias(p.replace(".", "_")) for p in paths
    ])
