"""Near-duplicate documents: sketches, bands, and confirmation on full shingle sets.

1. A document is the set of 64-bit keys of its five-word shingles. Equal sets meet by a digest of
   the set; from here on only the document with the smallest id of each set takes part.
2. Fast similarity sketching: in each round every key falls into a hashed bin and the smallest
   value stays; rounds go on until all bins are filled. After as many random rounds as bins, round
   ``bins + j`` sends all keys to bin j, so filling is certain. Two sketches agree in a bin with
   probability close to the similarity of the sets.
3. Sketches that agree on a band meet. Documents that meet, directly or through others, form a
   *neighbourhood*; links can only lie inside one. At 0.85 a link is missed with probability
   (1 - 0.85**9)**40 = 3e-5.
4. Neighbourhoods are dealt into blocks of bounded size and all links inside a block are decided
   by exact set intersection (a matrix product over the shared keys). In a neighbourhood of many
   blocks, all blocks then meet the first one, which joins nearly all of a group of copies. Only
   the documents that are still outside the largest component meet all blocks. Pairs stay inside
   a task: what leaves it is one link per pair of components.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import clean, ship
from tierweave.llm.graph import connected_components
from tierweave.session import cut_lineage

ship(__name__)

SHINGLE = 5
PERCENT = 85
BANDS = 40
BAND_ROWS = 9
#: Documents of a block.
BLOCK = 256
#: Columns of a slice of the incidence matrix.
COLUMNS = 1 << 15

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ sets and sketches


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_keys(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct keys of the shingles; of the whole sequence if it is shorter."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and blanks only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    take = min(size, n)
    h = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        h = h * _MULTIPLY + w[i:n - take + 1 + i]
    return np.unique(_mixed(h))


def sketch(keys: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch; the value of a bin names the round and the smallest hash in it."""
    low, shift = np.uint64((1 << 40) - 1), np.uint64(40)
    places = np.arange(bins, dtype=np.uint64) << shift
    out, empty = np.zeros(bins, np.uint64), np.ones(bins, bool)
    seeds = np.arange(1, 2 * bins + 1, dtype=np.uint64) * _MULTIPLY
    for r in range(2 * bins):
        x = _mixed(keys + seeds[r])
        if r < bins:
            placed = np.sort((((x >> shift) * np.uint64(bins)) >> np.uint64(24)) << shift | (x & low))
            at = np.minimum(np.searchsorted(placed, places), len(placed) - 1)
            found = placed[at]
            new = empty & (found >> shift == places >> shift) & (found >= places)
            out[new] = (found[new] & low) | np.uint64(r) << shift
            empty &= ~new
        elif empty[r - bins]:
            out[r - bins] = (x & low).min() | np.uint64(r) << shift
            empty[r - bins] = False
        if not empty.any():
            break
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = values.reshape(bands, rows)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        h = _mixed(h * _MULTIPLY + grid[:, j])
    return h.view(np.int64)


def sketched(docs: DataFrame, id_col: str, text_col: str, percent: int, bands: int, rows: int, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key and band keys; sets so small that only equal ones link have no bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], clean(batch["text"]), strict=True):
                keys = shingle_keys(text, size)
                n = len(keys)
                alone = 100 * n < percent * (n + 1)  # one more shingle is already too different
                out.append((
                    doc, n, blake2b(keys.tobytes(), digest_size=16).digest() if n else None,
                    [] if alone else band_keys(sketch(keys, bands * rows), bands, rows),
                ))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_key", "bands"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>",
    )


# ------------------------------------------------------------------ exact links


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of two lists."""
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    of_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    of_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    at_a, at_b = np.searchsorted(common, a), np.searchsorted(common, b)
    in_a = (at_a < len(common)) & (common[np.minimum(at_a, len(common) - 1)] == a) if len(common) else np.zeros(len(a), bool)
    in_b = (at_b < len(common)) & (common[np.minimum(at_b, len(common) - 1)] == b) if len(common) else np.zeros(len(b), bool)
    of_a, at_a, of_b, at_b = of_a[in_a], at_a[in_a], of_b[in_b], at_b[in_b]
    out = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - begin)
        m, k = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        s = (at_a >= begin) & (at_a < begin + width)
        m[of_a[s], at_a[s] - begin] = 1
        s = (at_b >= begin) & (at_b < begin + width)
        k[of_b[s], at_b[s] - begin] = 1
        out += m @ k.T
    return out.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    shared = shared_counts(left, right)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - shared
    return 100 * shared >= percent * union


def smallest_reachable(link: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component under a symmetric link matrix."""
    label = ids.copy()
    while True:
        best = np.where(link, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        best = np.minimum(best, label)
        if (best == label).all():
            return label
        label = best


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(k, np.uint64) for k in column]


def _inside_blocks(percent: int):
    """Rows sorted by block -> doc_id, label (smallest id linked inside the block)."""

    def solve(rows: list[tuple]) -> pd.DataFrame:
        ids = np.array([r[0] for r in rows], np.int64)
        sets = _sets(r[1] for r in rows)
        if len(rows) == 1:
            label = ids
        else:
            link = linked(sets, sets, percent)
            label = smallest_reachable(link, ids)
        return pd.DataFrame({"doc_id": ids, "label": label})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, block = [], None
        for batch in batches:
            out = []
            for root, blk, doc, keys in zip(batch["root"], batch["blk"], batch["doc_id"], batch["keys"], strict=True):
                if (root, blk) != block and held:
                    out.append(solve(held))
                    held = []
                block = (root, blk)
                held.append((doc, keys))
            if out:
                yield pd.concat(out)
        if held:
            yield solve(held)

    return run


def _between_blocks(percent: int):
    """Pairs of packed blocks -> one link per pair of labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"], strict=True):
                la, lb = np.array([x["label"] for x in a], np.int64), np.array([x["label"] for x in b], np.int64)
                link = linked(_sets(x["keys"] for x in a), _sets(x["keys"] for x in b), percent)
                i, j = np.nonzero(link & (la[:, None] != lb[None, :]))
                yield pd.DataFrame({"u": la[i], "v": lb[j]}).drop_duplicates()

    return run


def _packed(rows: DataFrame, part: str, name: str) -> DataFrame:
    return rows.groupBy("root", part, "blocks").agg(F.collect_list(F.struct("label", "keys")).alias(name))  # about BLOCK rows


def _to_every_block(rows: DataFrame, first: int = 0) -> DataFrame:
    """A copy of each row per block of its neighbourhood, so that joins spread over blocks."""
    return rows.withColumn("blk", F.explode(F.sequence(F.lit(first), F.col("blocks") - 1)))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, root, label after joining the linked labels."""
    found = cut_lineage(connected_components(links).select(F.col("node").alias("label"), F.col("root").alias("_to")))
    return labels.join(found, "label", "left").withColumn("label", F.coalesce("_to", "label")).drop("_to")


# ------------------------------------------------------------------ operator


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
    bands: int = BANDS, band_rows: int = BAND_ROWS, shingle: int = SHINGLE, block: int = BLOCK,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row.

    A component is what links of at least ``percent`` similarity connect; ``component_id`` is its
    smallest id and ``kept`` marks that document. NULL texts and texts without words have no
    shingles and stand alone. Rows of one id count as one document. No other column is read.
    """
    base = cut_lineage(sketched(docs, id_col, text_col, percent, bands, band_rows, shingle))
    firsts = cut_lineage(base.filter(F.col("set_key").isNotNull()).groupBy("set_key").agg(F.min("doc_id").alias("first")))
    nodes = base.filter(F.size("bands") > 0).join(firsts, "set_key").filter(F.col("doc_id") == F.col("first"))
    met = cut_lineage(nodes.select("doc_id", F.explode("bands").alias("band")).distinct())
    heads = cut_lineage(met.groupBy("band").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).filter("n > 1"))
    meeting = met.join(heads, "band").select(F.col("doc_id").alias("u"), F.col("head").alias("v"))
    hoods = cut_lineage(connected_components(meeting))
    sizes = cut_lineage(hoods.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    dealt = hoods.join(sizes, "root").select(
        F.col("node").alias("_node"), "root", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("blk"),
    )

    def with_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["keys"] = [shingle_keys(t, shingle).tobytes() for t in clean(batch.pop("text"))]
            yield batch

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = cut_lineage(
        texts.join(dealt.hint("shuffle_hash"), texts["doc_id"] == dealt["_node"]).drop("_node")
        .select("doc_id", "root", "blocks", "blk", "text")
        .mapInPandas(with_keys, "doc_id long, root long, blocks int, blk int, keys binary"),
    )
    labels = cut_lineage(
        sets.select("root", "blk", "doc_id", "keys").repartition("root", "blk").sortWithinPartitions("root", "blk")
        .mapInPandas(_inside_blocks(percent), "doc_id long, label long").distinct(),
    )
    wide = sets.filter("blocks > 1")
    if not wide.isEmpty():
        labels = labels.unionByName(_across_blocks(wide, labels, percent, block)).groupBy("doc_id").agg(
            F.min("label").alias("label"),
        )
    labels = cut_lineage(labels.select(F.col("doc_id").alias("first"), "label"))
    placed = base.select("doc_id", "n_shingles", "set_key").join(firsts, "set_key", "left").join(labels, "first", "left")
    component = F.coalesce("label", "first", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _across_blocks(wide: DataFrame, labels: DataFrame, percent: int, block: int) -> DataFrame:
    """doc_id, label of neighbourhoods of several blocks, all links between blocks included."""
    within = cut_lineage(wide.join(labels, "doc_id").select("doc_id", "root", "blk", "blocks", "label", "keys"))
    run, schema, key = _between_blocks(percent), "u long, v long", ["root", "blk"]
    pivot = _to_every_block(_packed(within.filter("blk = 0"), "blk", "a").drop("blk"), 1).drop("blocks")
    links = _packed(within.filter("blk > 0"), "blk", "b").join(pivot, key).select("a", "b").mapInPandas(run, schema)
    joined = cut_lineage(_relabelled(within.select("doc_id", "root", "blocks", "label"), links))
    # the largest component of a neighbourhood needs no more links inside itself
    counted = joined.groupBy("root", "blocks", "label").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", F.negative("label").alias("l")))
    mains = counted.groupBy("root", "blocks").agg(largest.alias("m"), F.sum("n").alias("all")).select(
        "root", "blocks", F.negative("m.l").alias("main"), F.ceil((F.col("all") - F.col("m.n")) / block).cast("int").alias("many"),
    )
    state = cut_lineage(
        within.drop("label").join(joined.select("doc_id", "label"), "doc_id").join(_to_every_block(mains).drop("blocks"), key),
    )
    outside = state.filter("label <> main").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("many")).cast("int"),
    )
    left = _to_every_block(_packed(outside, "part", "a").drop("part")).drop("blocks")
    links = left.join(_packed(state, "blk", "b"), key).select("a", "b").mapInPandas(run, schema)
    return _relabelled(joined.select("doc_id", "label"), links).select("doc_id", "label")
