"""Interaction of document filters: what each removes, alone and in every order.

Each document gets a mask with a bit per filter that it fails. The bit of the last filter, repeats
of a text, comes from radix tries (``text_trie``); the others look at one text. All further figures
follow from the numbers of documents per part and mask: 2 ** filters rows a part, whatever the input.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import count, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import ship
from tierweave.llm.text_trie import TextTrie, prefix_bounds

ship(__name__)

SYMBOL = re.compile(b"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that a trie may hold before it is emptied, and texts sent on at once.
TRIE_BYTES = 96 << 20
SEND_BYTES = 8 << 20
ROW = "pid int, doc_id long, part string, mask int, n long, text string"


def text_mask(text: str, min_words: int = 200, distinct_percent: int = 50, capital_percent: int = 2) -> int:
    """Bits 0 to 3: too few words, too few different ones, too many capitals, a symbol of ``#$%&*|``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at the space and 0x09-0x0D only
    mask = len(words) < min_words
    mask |= (100 * len(set(words)) < distinct_percent * len(words)) << 1
    mask |= (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > capital_percent * len(text)) << 2
    return mask | (SYMBOL.search(raw) is not None) << 3


class _Repeats:
    """A trie of texts, and the rows that it has decided."""

    def __init__(self, repeat: int):
        self.repeat, self.trie, self.decided = repeat, TextTrie(), []

    def meet(self, doc: int, part: str, n: int, text: str, mask: Callable[[str], int]) -> None:
        node = self.trie.insert(text)
        least, held = node[2], node[3]
        if least is None:
            node[2], node[3] = doc, (mask(text), {part: n})
        elif doc > least:
            self.decided.append((doc, part, held[0] | self.repeat, n))
        elif doc == least:
            held[1][part] = held[1].get(part, 0) + n
        else:
            self.decided += [(least, p, held[0] | self.repeat, m) for p, m in held[1].items()]
            node[2], node[3] = doc, (held[0], {part: n})

    def rows(self) -> Iterator[tuple]:
        """What the trie holds: id, part, mask, number, text; the trie is empty then."""
        for text, doc, (mask, parts) in self.trie.terminals():
            for part, n in parts.items():
                yield doc, part, mask, n, text
        self.trie = TextTrie()


def _sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    types = [pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in ROW.split(", ")]
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    for row in rows:
        held.append(row)
        size += 40 + len(row[-1] or "")
        if size > SEND_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def filter_masks(
    docs: DataFrame, mask: Callable[[str], int] = text_mask, repeat: int = 1 << 4,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """doc_id, part, mask, n: how many rows of an id and part have a mask.

    ``repeat`` is the bit of texts that a smaller id has too. NULL texts and parts are empty ones.
    Rows without an id are neither repeats nor repeated; rows of one id do not repeat each other.
    Other columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    bounds = spark.sparkContext.broadcast(prefix_bounds(read, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = len(bounds.value) + 1

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Decide what a task can decide alone; one row per text is left."""
        known = bounds.value

        def found() -> Iterator[tuple]:
            held, spread = _Repeats(repeat), count()
            for batch in batches:
                for doc, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if doc is None:
                        yield next(spread) % ranges, None, part, mask(text), 1, None
                    else:
                        held.meet(doc, part, 1, text, mask)
                for row in held.decided:
                    yield next(spread) % ranges, *row, None
                held.decided = []
                if held.trie.size > TRIE_BYTES:
                    for row in held.rows():
                        yield bisect_right(known, row[-1]), *row
            for row in held.rows():
                yield bisect_right(known, row[-1]), *row

        return _sent(found())

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts in order, so a full trie can be emptied before a text that is not its last one."""
        def found() -> Iterator[tuple]:
            held, last = _Repeats(repeat), None
            for batch in batches:
                for doc, part, m, n, text in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                    if text is None:
                        yield 0, doc, part, m, n, None
                        continue
                    if text != last and held.trie.size > TRIE_BYTES:
                        for row in held.rows():
                            yield 0, *row[:-1], None
                    held.meet(doc, part, n, text, lambda _, m=m: m)
                    last = text
                for row in held.decided:
                    yield 0, *row, None
                held.decided = []
            for row in held.rows():
                yield 0, *row[:-1], None

        return _sent(found())

    dealt = read.mapInArrow(own, ROW).repartitionById(ranges, "pid").sortWithinPartitions("text")
    return dealt.mapInArrow(ranged, ROW).select("doc_id", "part", "mask", "n")


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """Figures of every filter at every place of every order, from part, mask, n, good, toxic.

    Letter ``i`` stands for bit ``i``. Per part, filter_order and step: kept, removed, redundant
    (failing, removed before), unique_fails (failing nothing else), good_lost, toxic_lost, shapley
    (removed by this filter, summed over all orders: ``filters! / k`` for a document failing ``k``).
    """
    places = [
        {"filter_order": "".join(order), "step": i + 1, "bit": 1 << letters.index(order[i]),
         "before": sum(1 << letters.index(x) for x in order[:i])}
        for order in permutations(letters) for i in range(len(letters))
    ]
    schema = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    placed = counts.withColumn("_at", F.explode(F.from_json(F.lit(json.dumps(places)), schema))).select("*", "_at.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    early = F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~early

    def total(what, condition):
        return F.sum(F.when(condition, what).otherwise(0)).cast("long")

    return placed.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), ~fails & ~early).alias("kept"),
        total(F.col("n"), removed).alias("removed"),
        total(F.col("n"), fails & early).alias("redundant"),
        total(F.col("n"), F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(F.col("good"), removed).alias("good_lost"),
        total(F.col("toxic"), removed).alias("toxic_lost"),
        total(F.expr(f"n * ({factorial(len(letters))} div bit_count(mask))"), fails).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """The five filters over all documents, per part; see ``interactions`` for the columns.

    A document is good or toxic if any row of ``labels`` for its id says so; NULL labels say nothing.
    """
    marked = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int")).alias(f"_{c}") for c in ("quality", "toxic")],
    )
    masks = filter_masks(docs).join(marked, "doc_id", "left")
    counts = masks.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(name) for c, name in (("_quality", "good"), ("_toxic", "toxic"))
    ])
    return interactions(counts, letters)


def filter_audit_sql() -> str:
    """The same figures from whole texts compared as they are."""
    return r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
m AS (
  SELECT d.doc_id, part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 2 * length(d.text))::INT
    + 8 * regexp_matches(d.text, '[#$%&*|]')::INT + 16 * coalesce(first < d.doc_id, false)::INT AS mask
  FROM d JOIN firsts USING (text)),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON a.bit <> b.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
  JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (
  SELECT filter_order, step::INT AS step, (SELECT bit FROM f WHERE letter = filter_order[step]) AS bit,
    coalesce((SELECT sum(bit) FROM f WHERE contains(filter_order[1:step - 1], letter)), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step))
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (WHERE mask & bit <> 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step"""
