"""Weighted fuzzy search over the index.

Scoring rule (ours): per key the distance is 0 for equality, 0.1 when the value holds the
term, else the smallest edit distance between the term and a word of the value, divided by
the longer length. A key matches at or below the limit; a product's score is the sum of
weight * (1 - distance) over its matching keys, and products without a match are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.fixed.scoring import SEARCH_THRESHOLD, SEARCH_WEIGHTS
from tierweave.functions.base import computed_once
from tierweave.operators.index import file_order
from tierweave.session import spread

CONTAINED = 0.1


def _word_distance(text: Column, term: str) -> Column:
    words = F.filter(F.split(text, " "), lambda w: w != "")
    size = len(term)
    # words whose length alone rules them out are not compared
    near = F.filter(words, lambda w: F.abs(F.length(w) - size) <= F.greatest(F.length(w), F.lit(size)) * SEARCH_THRESHOLD)
    return F.array_min(F.transform(near, lambda w: F.levenshtein(w, F.lit(term)) / F.greatest(F.length(w), F.lit(size))))


def key_distance(value: Column, term: str) -> Column:
    """Distance of one text value, NULL when it does not match."""
    def of(low: Column) -> Column:
        return (
            F.when(low == term, F.lit(0.0)).when(F.contains(low, F.lit(term)), F.lit(CONTAINED))
            .otherwise(_word_distance(low, term))
        )

    return computed_once(F.lower(value), lambda low: computed_once(of(low), lambda d: F.when(d <= SEARCH_THRESHOLD, d)))


def search(index: DataFrame, query: str) -> DataFrame:
    """Matching products with ``score``, best first."""
    term = query.strip().lower()
    if not term:
        return index.withColumn("score", F.lit(0.0))
    gains = []
    for key, weight in SEARCH_WEIGHTS.items():
        if key == "tags":
            d = F.array_min(F.transform("tags", lambda t: key_distance(t, term)))
        else:
            d = key_distance(F.col(key), term)
        gains.append(F.lit(weight) * (1 - d))
    # NULL where no key matches
    score = computed_once(F.array_compact(F.array(*gains)), lambda found: F.when(
        F.size(found) > 0, F.round(F.aggregate(found, F.lit(0.0), lambda acc, g: acc + g), 6),
    ))
    return spread(index).withColumn("score", score).filter(F.col("score").isNotNull()).orderBy(F.desc("score"), file_order())
