"""Literals that every match of a pattern holds, to try before the pattern itself."""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser
from re import error as bad_pattern

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shorter literals are met too often to spare anything.
SHORTEST = 3


def _needed(parts) -> list[str] | None:
    """Texts of which every match of the parts holds one; None where none is certain."""
    best, run = None, ""

    def offer(found: list[str] | None) -> None:
        nonlocal best
        if found and min(map(len, found)) >= SHORTEST and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    for kind, value in parts:
        if kind is op.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        offer([run])
        run = ""
        if kind is op.SUBPATTERN:
            offer(_needed(value[3]))
        elif kind is op.BRANCH:
            arms = [_needed(arm) for arm in value[1]]
            offer(None if None in arms else [x for arm in arms for x in arm])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
            offer(_needed(value[2]))
    offer([run])
    return best


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case ASCII texts of which every match of the pattern, in any case, holds one."""
    try:
        return _needed(parser.parse(pattern))
    except (bad_pattern, TypeError):
        return None


def folded(text: Column) -> Column:
    """The text in lower case as a match in any case sees it: dotted and dotless i and long s included."""
    return F.lower(F.translate(text, "İıſ", "iis"))


def matches_folded(text: Column, low: Column, pattern: str) -> Column:
    """Whether a pattern, in any case, matches the text; ``low`` is the folded text.

    The pattern only runs where one of its literals is there.
    """
    test = text.rlike(f"(?iU){pattern}")
    literals = required_literals(pattern)
    if not literals:
        return test
    there = F.lit(False)
    for x in literals:
        there = there | F.contains(low, F.lit(x))
    return there & test
