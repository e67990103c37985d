"""Registry of source mappers: landed payloads in, records out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.session import global_row_number

Mapper = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Source:
    name: str
    tier: int
    map: Mapper


_SOURCES: dict[str, Source] = {}


def source(name: str, tier: int):
    """Register a mapper ``landed -> DataFrame`` whose columns are record columns."""

    def wrap(fn: Mapper) -> Mapper:
        def mapped(landed: DataFrame) -> DataFrame:
            rows = fn(landed.filter(F.col("source") == name))
            return schemas.conform(
                rows.withColumns({"source": F.lit(name), "source_tier": F.lit(tier)}), schemas.RECORD
            )

        _SOURCES[name] = Source(name, tier, mapped)
        return mapped

    return wrap


def sources() -> dict[str, Source]:
    from tierweave.sources import mappers  # noqa: F401  (registers on import)

    return dict(_SOURCES)


def pick(names: str | None = None) -> list[Source]:
    """Sources of a comma-separated list, or all; unknown names are an error."""
    known = sources()
    if not names:
        return list(known.values())
    wanted = [n.strip() for n in names.split(",") if n.strip()]
    missing = [n for n in wanted if n not in known]
    if missing:
        raise ValueError(f"Unknown source(s): {', '.join(missing)}. Known: {', '.join(known)}")
    return [known[n] for n in wanted]


def union_records(frames: list[DataFrame]) -> DataFrame:
    """Bag union of record frames."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def in_arrival_order(records: DataFrame) -> DataFrame:
    """Records renumbered by source, place within the source and, where that is shared, name and link.

    ``seq`` becomes unique over all sources, as matching, checks and merging expect of it.
    """
    ordered = records.withColumnRenamed("seq", "_place")
    numbered = global_row_number(ordered, ["_source", "_place", "name", "source_url"], "seq")
    return schemas.conform(numbered, schemas.RECORD)


def map_sources(landed: DataFrame, names: str | None = None, limit: int | None = None) -> DataFrame:
    """Records of the picked sources in one arrival order, at most ``limit`` per source."""
    from tierweave.operators.quota import limit_per_source

    frames = [s.map(landed).withColumn("_source", F.lit(i)) for i, s in enumerate(pick(names))]
    out = in_arrival_order(union_records(frames))
    return limit_per_source(out, limit) if limit else out
