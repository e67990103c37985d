"""Names, slugs and text clean-up."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierweave.fixed import migration, terms
from tierweave.functions.base import blank_to_null, col, lookup, strings, strip

SLUG_PATTERN = r"^[a-z0-9][a-z0-9-]*[a-z0-9]$|^[a-z0-9]$"

# Latin letters that decompose to a base letter, found by rule from the Unicode tables.
_FOLDABLE = {
    chr(c): base
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))
    if len(base := "".join(
        ch for ch in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(ch)
    )) == 1 and base.isascii() and base.isalpha()
}
# Latin letters without a decomposition and their spelling.
_SPELLED = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d",
    "Đ": "D", "ł": "l", "Ł": "L", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ı": "i",
}


def fold_latin(text: Column | str) -> Column:
    """Accented Latin letters to ASCII, combining marks removed."""
    given = c = col(text)
    single = {**_FOLDABLE, **{k: v for k, v in _SPELLED.items() if len(v) == 1}}
    c = F.translate(c, "".join(single), "".join(single.values()))
    for src, dst in _SPELLED.items():
        if len(dst) > 1:
            c = F.replace(c, F.lit(src), F.lit(dst))
    # plain ASCII has as many bytes as characters
    return F.when(F.octet_length(given) == F.length(given), given).otherwise(F.regexp_replace(c, r"\p{M}", ""))


def slugify(text: Column | str) -> Column:
    """URL slug. NULL when letters remain that no rule can spell (review needed)."""
    folded = fold_latin(text)
    kept = F.regexp_replace(F.lower(folded), r"[^A-Za-z0-9_\s-]", "")
    slug = F.btrim(F.regexp_replace(strip(kept), r"[-\s]+", "-"), F.lit("-"))
    return F.when(~folded.rlike(r"(?![\x00-\x7F])\p{L}"), slug)


def product_slug(name: Column | str) -> Column:
    """Slug of a new product: of its name, or ``n-`` and a digest where the name cannot be spelt.

    NULL for names without a letter or digit.
    """
    own = slugify(name)
    digest = F.concat(F.lit("n-"), F.left(F.sha2(strip(col(name)).cast("binary"), 256), F.lit(16)))
    return F.when(valid_slug(own), own).otherwise(F.when(col(name).rlike(r"[\p{L}\p{N}]"), digest))


def valid_slug(slug: Column | str) -> Column:
    return F.coalesce(col(slug).rlike(SLUG_PATTERN), F.lit(False))


def normalize_name(name: Column | str) -> Column:
    """Trim and drop one trailing company suffix."""
    return F.regexp_replace(
        strip(name), r"(?i)\s*(,?\s*(Inc\.?|LLC|Ltd\.?|Corp\.?|Co\.?))\s*$", ""
    )


def clean_text(text: Column | str) -> Column:
    """Remove job-board leftovers; NULL when nothing is left."""
    cleaned = F.regexp_replace(col(text), f"(?i)({migration.JOB_BOARD_PATTERN})", "")
    return blank_to_null(strip(strip(cleaned), ",;:- \n\t"))


def is_placeholder_description(description: Column | str, name: Column | str) -> Column:
    stem = F.rtrim(strip(description), F.lit("."))
    return stem == F.concat(col(name), F.lit(" is an AI company"))


def has_chinese(text: Column | str) -> Column:
    return col(text).rlike("[一-鿿]")


def strip_html(text: Column | str) -> Column:
    return strip(F.regexp_replace(col(text), "<[^>]+>", ""))


def clean_description(text: Column | str) -> Column:
    """Markdown links to their text, emphasis marks off, cut at 500 characters."""
    plain = F.regexp_replace(col(text), r"\[([^\]]+)\]\([^)]+\)", "$1")
    return truncate(strip(F.regexp_replace(plain, r"[*_]{1,3}", "")))


def truncate(text: Column, limit: int = 500) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    ).otherwise(text)


def humanize_label(label: Column | str) -> Column:
    return F.regexp_replace(F.replace(col(label), F.lit("-"), F.lit(" ")), r"\bai\b", "AI")


def localized(base: Column | str, chinese: Column | str, locale: str) -> Column:
    """The Chinese text when asked for and present, else the base text, else ''."""
    if locale == "zh":
        return F.coalesce(blank_to_null(chinese), col(base), F.lit(""))
    return F.coalesce(col(base), F.lit(""))


def meaningful_words(text: Column | str) -> Column:
    """First 20 English terms that are preserved or long and not stop words."""
    words = F.regexp_extract_all(col(text), F.lit(f"({terms.WORD_PATTERN})"), F.lit(1))
    kept = F.filter(  # hashed look-ups of literals
        words,
        lambda w: F.lower(w).isin(*terms.PRESERVED_TERMS) | ((F.length(w) >= 4) & ~F.lower(w).isin(*terms.STOP_WORDS)),
    )
    return F.slice(kept, 1, terms.MAX_WORDS)


def han_runs(text: Column | str) -> Column:
    """First 15 runs of at least two Chinese characters."""
    runs = F.regexp_extract_all(col(text), F.lit(f"({terms.HAN_RUN_PATTERN})"), F.lit(1))
    return F.slice(runs, 1, terms.MAX_HAN_RUNS)


def looks_like_salary(text: Column | str) -> Column:
    from tierweave.fixed.sources import SALARY

    return col(text).rlike(SALARY)


def is_table_header(first: Column | str, second: Column | str) -> Column:
    from tierweave.fixed.sources import JOB_HEADERS

    def header(c):
        return F.btrim(F.lower(col(c)), F.lit(" -")).isin(*JOB_HEADERS)

    return header(first) | header(second)


def matches_any(text: Column, keywords) -> Column:
    """True when the lower-cased text holds any keyword."""
    hits = [F.contains(text, F.lit(k.lower())) for k in keywords]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


def job_text(title: Column | str, description: Column | str) -> Column:
    return F.lower(F.concat(col(title), F.lit(" "), F.coalesce(col(description), F.lit(""))))


def matches_ai_job(title, description, config=terms.JOB_KEYWORDS) -> Column:
    words = dict.fromkeys(k.lower() for lang in config.values() for k in lang["match"])
    return matches_any(job_text(title, description), words)


def job_category(title, description, config=terms.JOB_KEYWORDS) -> Column:
    """First category, in configuration order, with a keyword in the text."""
    text = job_text(title, description)
    return F.coalesce(
        *[
            F.when(matches_any(text, words), F.lit(category))
            for lang in config.values()
            for category, words in lang["categories"].items()
        ]
    )


def map_status(status: Column | str) -> Column:
    return lookup(status, migration.OLD_STATUS, "active")


def map_old_category(category: Column | str) -> Column:
    return lookup(category, migration.OLD_CATEGORY, "ai-app")


def map_sub_category(category: Column | str) -> Column:
    return lookup(category, migration.OLD_SUB_CATEGORY)


def map_product_type(category: Column | str) -> Column:
    return lookup(category, migration.OLD_PRODUCT_TYPE, "other")


def is_listing_name(name: Column, nav_words) -> Column:
    """A listing name that is not navigation: 2..80 characters, not a link or anchor."""
    low = strip(F.lower(name))
    length = F.length(name)
    return (
        ~low.isin(*nav_words) & (length >= 2) & (length <= 80)
        & ~low.rlike(r"^(http|www\.|#|/)")
    )

