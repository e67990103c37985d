"""Small building blocks shared by the column functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space when trimming.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str, chars: str = WHITESPACE) -> Column:
    """Trim ``chars`` from both ends."""
    return F.btrim(col(c), F.lit(chars))


def blank_to_null(c: Column | str) -> Column:
    """The value, or NULL when it is the empty string."""
    return F.nullif(col(c), F.lit(""))


def truthy(c: Column | str) -> Column:
    """True for a non-NULL, non-empty string."""
    c = col(c)
    return c.isNotNull() & (c != "")


def lookup(key: Column | str, table: Mapping[str, object], default=None) -> Column:
    """Literal-table lookup; NULL (or ``default``) when the key is missing."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), col(key))
    return found if default is None else F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def strings(items: Iterable[str]) -> Column:
    """Literal ARRAY<STRING>, typed even when empty."""
    return F.array(*[F.lit(i) for i in items]).cast("array<string>")


def first_match(text: Column, table: Mapping[str, str], mode: str) -> Column:
    """Value of the first key, in table order, that ``text`` starts with or contains."""
    test = {"prefix": F.startswith, "contains": F.contains}[mode]
    branches = [F.when(test(text, F.lit(k)), F.lit(v)) for k, v in table.items()]
    return F.coalesce(*branches)


def group(c: Column | str, pattern: str, idx: int = 1) -> Column:
    """Capture ``idx`` of the first match, NULL when there is none or it is empty."""
    return computed_once(F.regexp_extract(col(c), pattern, idx), lambda found: F.when(found != "", found))


def compact(*parts: Column) -> Column:
    """Array of the parts that are not NULL."""
    return F.array_compact(F.array(*parts))


def computed_once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body reads it.

    Written out it would be computed at every place, and a body of many places outgrows what is compiled.
    """
    return F.transform(F.array(value), body)[0]
