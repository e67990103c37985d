"""Positions under an order, kept apart from the rows they belong to.

Only the key and the sort columns of a row are sorted, and only key and position are written, so
what a ranking costs does not depend on how wide the rows are. Stored positions lie in parts of a
fixed number of rows; a page reads the one or two parts it lies in, then the rows of its few keys.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.session import global_row_number, shared_folder

PART_ROWS = 100_000


def positions(df: DataFrame, order: list[Column], key: str = "slug", name: str = "rn") -> DataFrame:
    """(key, position from 1) of every row; keys must be distinct."""
    return global_row_number(df, order, name, [key])


@dataclass(frozen=True)
class Ranking:
    """Stored positions of the rows of a frame."""

    path: str
    key: str
    part_rows: int

    def keys_between(self, df: DataFrame, first: int, last: int) -> list:
        """Keys at positions ``first`` to ``last``, in order: as many as were asked for at most."""
        parts = range((first - 1) // self.part_rows, (last - 1) // self.part_rows + 1)
        held = df.sparkSession.read.parquet(self.path).filter(F.col("part").isin(*parts) & F.col("rn").between(first, last))
        return [r[self.key] for r in held.orderBy("rn").collect()]

    def page(self, df: DataFrame, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) of the frame the ranking was made of, in order.

        The keys of the page are a filter that the scan of the frame can push down.
        """
        keys = self.keys_between(df, (number - 1) * size + 1, number * size)
        if not keys:
            return df.limit(0)
        return df.filter(F.col(self.key).isin(*keys)).orderBy(F.array_position(F.array(*map(F.lit, keys)), F.col(self.key)))


def stored_ranking(df: DataFrame, order: list[Column], key: str = "slug", part_rows: int = PART_ROWS, path: str | None = None) -> Ranking:
    """Rank the rows and store (key, position) in parts of ``part_rows`` positions."""
    path = path or f"{shared_folder(df.sparkSession)}/ranking-{uuid.uuid4().hex}"
    placed = positions(df, order, key).withColumn("part", F.floor((F.col("rn") - 1) / part_rows))
    placed.repartition("part").write.partitionBy("part").parquet(path)
    return Ranking(path, key, part_rows)
