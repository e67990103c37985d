"""Similarity joins on the ratio 2*LCS / (len a + len b).

Both joins are exact: every filter only drops pairs that cannot reach the limit.

Names: names that agree after at most one deletion on either side meet on those shortened
forms; each form keeps only its best catalog name, so no group is ever expanded to pairs. What is
left, where lengths allow a match at all, is searched in trees of prefixes of the catalog names;
pairs with a very long name meet on pairs of rare grams (extended prefix filter).

Texts: equal texts meet on the text itself and near copies on shared word sketches, each
probe against at most two leaders per sketch, so a group of copies of any size costs linear
work. Many that are left are compared with their neighbours in sorted order. Only texts that found no partner this way are compared further: with the texts of a
fitting length that share enough characters, block by block where two blocks meet. No equality key
can find every pair at this limit (an edit every few characters leaves no long common run),
so this last step is what makes the answer complete. It grows with the square of the texts that are
without a partner by then.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from math import ceil
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave.fixed.scoring import (
    DESCRIPTION_SIMILARITY, MIN_COMPARED_DESCRIPTION, NAME_SIMILARITY,
)
from tierweave.functions.base import computed_once, strip
from tierweave.operators.prefix_tree import nearest
from tierweave.operators.text_masks import PAIRS, Masks, bucket_rows, bucket_table
from tierweave.session import cut_lineage, global_row_number, spread

# send the helpers below with the task, so that workers need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: How many of the most frequent grams are ranked last; a hint for speed, not a limit.
RANKED_GRAMS = 4096
SKETCHES = 4
#: Names up to this length are searched in trees of prefixes, longer ones meet on grams.
TREE_LENGTH = 96
#: Catalog names per tree, names searched in it at a time, and the fewest for which a task is worth its tree.
TREE_ROWS, PROBE_ROWS, LEAST_ROWS = 200_000, 32_768, 1024
#: Texts up to this length meet on pairs of grams, longer ones on single grams.
PAIRED_LENGTH = 96
#: Rows that one key holds before it is split.
KEY_ROWS = 2048
#: Rows and characters per block of the last step of the text join, rows compared at a time.
#: Probes are cut into up to ``PROBE_BLOCKS`` more blocks, of ``LEAST_PROBES`` rows or ``LEAST_CHARS``, so that one band makes several tasks.
BLOCK_ROWS, BLOCK_CHARS, BLOCK_STEP = 65_536, 24_000_000, 256
PROBE_BLOCKS, LEAST_PROBES, LEAST_CHARS = 8, 4096, 500_000
#: So many texts without a partner are compared with their neighbours in the order of the texts first; characters that are sorted.
SORTED_FROM, SORTED_CHARS = 4096, 256
#: Classes of length that a band of lengths is cut into.
LENGTH_CLASSES = 16
#: Buckets of characters; tests of their counts that two texts up to a length are told apart by.
LETTERS, LEVELS, SHORT = 256, 128, 256
#: Rows and characters of the texts that are compared at a time, columns of a product; so few texts are compared one by one.
TILE_ROWS, TILE_CHARS, TILE_COLUMNS, FEW_TEXTS = 8192, 4_000_000, 2048, 32


def _best() -> Column:
    """Fewest characters deleted on either side, then the highest ratio, then the lowest slug."""
    return F.struct("cut", (-F.col("ratio")).alias("r"), "slug")


# ------------------------------------------------------------------ ratio


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def lcs_length(a: str, b: str, need: int = 0) -> int:
    """Longest common subsequence, one machine word per 64 characters of ``b`` and step.

    Stops early, with a result below ``need``, once no continuation can reach it: a common
    subsequence splits into one of ``a[:i], b[:j]`` and one of the two remainders.
    """
    if len(a) < len(b):
        a, b = b, a
    start = 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not b:
        return start + end
    need -= start + end
    codes = _codes(b)
    where = {
        chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little")
        for c in np.unique(codes)
    }
    full = (1 << len(b)) - 1
    row = full
    pause = max(64, len(a) // 16) if need > 0 else len(a) + 1
    for i, ch in enumerate(a, 1):
        hit = row & where.get(ch, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
        if i % pause == 0 and not _reachable(row, i, len(a), len(b), need):
            return 0
    return start + end + len(b) - row.bit_count()


def _reachable(row: int, i: int, la: int, lb: int, need: int) -> bool:
    """Whether some split of ``b`` still allows ``need`` common characters."""
    low, high = max(0, i - (la - need)), min(lb, i + (lb - need))
    step = max(1, (high - low) // 16)
    for j in range(low, high + 1, step):
        top = min(j + step, lb)
        common = top - (row & ((1 << top) - 1)).bit_count()
        if common + min(la - i, lb - j) >= need:
            return True
    return False


def ratio_at_least(a: str, b: str, limit: float) -> float | None:
    """The ratio when it reaches ``limit``, else None; cheap bounds first."""
    total = len(a) + len(b)
    if not total:
        return None
    need = ceil(limit * total / 2 - 1e-9)
    if min(len(a), len(b)) < need:
        return None
    if total > 64:
        ca, cb = Counter(a), Counter(b)
        if sum(min(n, cb[ch]) for ch, n in ca.items()) < need:
            return None
    found = lcs_length(a, b, need)
    return 2.0 * found / total if found >= need else None


@F.pandas_udf(T.DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2*LCS / (len a + len b); 0 for two empty texts."""
    return pd.Series([
        None if x is None or y is None else (2.0 * lcs_length(x, y) / (len(x) + len(y)) if x or y else 0.0)
        for x, y in zip(a, b)
    ], dtype="float64")


def _bounded_ratio(limit: float):
    @F.pandas_udf(T.DoubleType())
    def bounded(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio_at_least(x, y, limit) for x, y in zip(a, b)], dtype="float64")

    return bounded


# ------------------------------------------------------------------ grams


def _grams(text: str, q: int) -> list[str]:
    return [text[i:i + q] for i in range(len(text) - q + 1)]


def shared_grams(la: int, lb: int, q: int, limit: float) -> int:
    """Grams that texts of these lengths share at least when they reach ``limit``.

    With M common characters, la - M deletions and lb - M insertions disturb at most
    q and q - 1 grams each.
    """
    return (2 * q - 1) * ceil(limit * (la + lb) / 2 - 1e-9) - (q - 1) * (la + lb + 1)


def _gram_frequencies(texts: DataFrame, q: int) -> DataFrame:
    """(gram, number of texts holding it), summed per batch before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for text in pdf["text"]:
                seen.update(set(_grams(text, q)))
            yield pd.DataFrame({"gram": list(seen), "n": list(seen.values())})

    return texts.select("text").mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _hot_grams(texts: DataFrame, q: int) -> dict[str, int]:
    """Rank of the most frequent grams. Bounded; any ranking keeps the join exact."""
    top = _gram_frequencies(texts, q).orderBy(F.desc("n"), "gram").limit(RANKED_GRAMS)
    return {r.gram: r.n for r in top.collect()}


def prefix_keys(text: str, other: int, hot: dict[str, int], q: int, limit: float) -> list[int]:
    """Keys of a text towards partners of length ``other``: partners that reach ``limit`` share one.

    Of two texts that share ``need`` grams, the rarest ``grams - need + t`` of each share ``t``:
    the keys are the pairs of such grams (t = 2), or for long texts the grams themselves.
    """
    need = shared_grams(len(text), other, q, limit)
    if need < 1:
        return [0]
    seen: Counter = Counter()
    numbered = []
    for g in _grams(text, q):
        seen[g] += 1
        numbered.append((hot.get(g, 0), g, seen[g]))
    numbered.sort()
    # both sides must decide alike, so by the lengths alone
    together = 2 if need > 1 and max(len(text), other) <= PAIRED_LENGTH else 1
    rarest = [f"{g}{n}" for _, g, n in numbered[:max(0, len(numbered) - need + together)]]
    if together == 1:
        return [crc32(g.encode()) for g in rarest]
    return [crc32(f"{g}\0{h}".encode()) for i, g in enumerate(rarest) for h in rarest[i + 1:]]


def _partner_lengths(df: DataFrame, other: DataFrame, limit: float, cut: int) -> DataFrame:
    """The rows once per length of ``other`` with which they can reach ``limit`` at ``cut`` or more deletions a side."""
    n = F.length("text")
    step = (2 - limit) / limit
    lengths = other.select(F.length("text").alias("other")).distinct()
    reach = F.explode(F.sequence(F.ceil(n / step - 1e-9).cast("int"), F.floor(n * step + 1e-9).cast("int"))).alias("other")
    deepest = F.greatest(n, F.col("other")) - F.ceil((n + F.col("other")) * (limit / 2) - 1e-9)
    return df.select("*", reach).join(lengths, "other").filter(deepest >= cut)


#: Columns on which two keyed sides meet.
MET = ["la", "lb", "key"]


def _keyed(df: DataFrame, other: DataFrame, hot: dict[str, int], mine: str, theirs: str, q: int, limit: float, cut: int) -> DataFrame:
    """(id, la, lb, key) of every text and length of a possible partner."""
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(texts: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([prefix_keys(t, n, hot, q, limit) for t, n in zip(texts, others)])

    return spread(_partner_lengths(df, other, limit, cut), "id", "other").select(
        "id", F.length("text").alias(mine), F.col("other").alias(theirs), F.explode(keys("text", "other")).alias("key"),
    )


def _key_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct (a_id, b_id) that share a key; a key held by many is split."""
    many = b.groupBy(*MET).agg(F.ceil(F.count("*") / KEY_ROWS).cast("int").alias("parts")).filter("parts > 1")
    split = b.join(many, MET, "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    asked = a.join(many, MET, "left").select(F.col("id").alias("a_id"), *MET, every)
    held = split.select(F.col("id").alias("b_id"), *MET, "part")
    return asked.join(held, [*MET, "part"]).filter(F.col("a_id") != F.col("b_id")).select("a_id", "b_id").distinct()


# ------------------------------------------------------------------ blocks


def _letter_counts(texts: list[str]) -> np.ndarray:
    """A row per text: its characters by bucket; texts share no more than the smaller counts add up to."""
    return np.array([np.bincount(_codes(t) % LETTERS, minlength=LETTERS) for t in texts], dtype=np.int32)


def _letter_levels(counts: np.ndarray) -> list[tuple[int, int]]:
    """(bucket, count) of the tests "at least so many" that tell most of these texts apart."""
    tests = []
    for c in np.flatnonzero(counts.max(axis=0)):
        above = np.bincount(counts[:, c])[::-1].cumsum()[::-1] / len(counts)
        tests += [(p * (1 - p), int(c), t) for t, p in enumerate(above) if t and 0 < p < 1]
    return [(c, t) for _, c, t in sorted(tests, reverse=True)[:LEVELS]]


def _level_weights(counts: np.ndarray, levels: list[tuple[int, int]], limit: float, swap: bool) -> np.ndarray:
    """A row per text; the product of two rows is at least the characters the texts may share less those they need.

    Texts share a character per test that both pass. What the tests leave out counts by half for
    either text, as the smaller of two numbers is at most half their sum.
    """
    met = counts[:, [c for c, _ in levels]] >= np.array([t for _, t in levels], dtype=counts.dtype)
    n = counts.sum(axis=1)
    own = (n - met.sum(axis=1)) / 2 - n * (limit / 2)
    ends = [own, np.ones(len(n))]
    return np.column_stack([met, *(ends[::-1] if swap else ends)]).astype(np.float32)


def _open_slug(low: str, high: str, owners: set[str]) -> bool:
    """Whether a slug from ``low`` to ``high`` may still lack a partner of another slug."""
    return not owners - {low} if low == high else len(owners) < 2


def block_partners(a: pd.DataFrame, b: pd.DataFrame, limit: float) -> Iterator[tuple[str, str, str, float]]:
    """(id, low, high, ratio) of partners in ``b`` for the texts of ``a``.

    Texts are taken by length, so that a step meets fitting lengths only. Pairs of short texts that share too few characters
    are dropped by one product of matrices; the common characters in order of the others are counted for many pairs at a time. A text is done once every slug it stands for has a partner.
    """
    a, b = (x.assign(n=x["text"].str.len()).sort_values(["n", "id"]) for x in (a, b))
    la, lb = a["n"].to_numpy(), b["n"].to_numpy()
    step = (2 - limit) / limit
    a_id, a_text, a_low, a_high = (a[c].to_numpy() for c in ("id", "text", "low", "high"))
    b_id, b_text, b_low, b_high = (b[c].to_numpy() for c in ("id", "text", "low", "high"))
    letters = _letter_counts(list(b_text))
    table, levels = bucket_table(list(b_text)), _letter_levels(letters)
    owners: list[set[str]] = [set() for _ in a_id]
    still = np.array([_open_slug(x, y, set()) for x, y in zip(a_low, a_high)], dtype=bool)
    steps: dict[int, tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = {}

    def of_step(start: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Letter counts of a step of probes; weights and buckets of short ones."""
        if start not in steps:
            texts = list(a_text[start:start + BLOCK_STEP])
            counts, width = _letter_counts(texts), len(texts[-1])
            short = width <= SHORT
            steps[start] = counts, _level_weights(counts, levels, limit, False) if short else None, bucket_rows(texts, table, SHORT) if short else None
        return steps[start]

    def compared(pairs) -> Iterator[tuple[str, str, str, float]]:
        for i, j in pairs:
            own = {b_low[j], b_high[j]}
            if not still[i] or a_id[i] == b_id[j] or (a_low[i] == a_high[i] and own == {a_low[i]}) or own <= owners[i]:
                continue
            ratio = ratio_at_least(a_text[i], b_text[j], limit)
            if ratio is not None:
                owners[i] |= own
                still[i] = _open_slug(a_low[i], a_high[i], owners[i])
                yield a_id[i], b_low[j], b_high[j], ratio

    def fitting(low: int, high: int, top: int, end: int) -> tuple[int, int]:
        """The texts of a tile that fit lengths from ``low`` to ``high``."""
        return (top + int(np.searchsorted(lb[top:end], ceil(low / step - 1e-6))),
                top + int(np.searchsorted(lb[top:end], int(high * step + 1e-6), side="right")))

    def flushed(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], top: int, masks: Masks) -> Iterator[tuple[str, str, str, float]]:
        """The pairs of short texts that reach the limit, each text's most alike first."""
        row, col, shared = (np.concatenate(x) for x in zip(*found))
        keep = a_id[row] != b_id[col]
        row, col, shared = row[keep], col[keep], shared[keep]
        order = np.lexsort((-shared, row))
        row, col = row[order], col[order]
        # in a dense group most texts are done after one pair; what is left goes in parts of growing size
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        bounds = [0, 2, 16, 256, len(row) + 256]
        for low, high in zip(bounds, bounds[1:]):
            part = np.flatnonzero((rank >= low) & (rank < high))
            for i in range(0, len(part), PAIRS):
                now = part[i:i + PAIRS]
                now = now[still[row[now]]]
                if not len(now):
                    continue
                asked, place = np.unique(row[now], return_inverse=True)
                buckets = np.array([of_step(x - x % BLOCK_STEP)[2][x % BLOCK_STEP] for x in asked])
                kept = now[masks.pairs_reach(buckets, place, col[now] - top, la[asked], limit)]
                yield from compared(zip(row[kept], col[kept]))

    for top, end in _tiles(lb):
        masks = None
        from_a = int(np.searchsorted(la, ceil(lb[top] / step - 1e-6)))
        to_a = int(np.searchsorted(la, int(lb[end - 1] * step + 1e-6), side="right"))
        steps = {k: v for k, v in steps.items() if k > from_a - BLOCK_STEP}
        found, waiting = [], 0
        for start in range(from_a - from_a % BLOCK_STEP, to_a, BLOCK_STEP):
            rows = np.flatnonzero(still[start:start + BLOCK_STEP]) + start
            first, last = fitting(la[rows[0]], la[rows[-1]], top, end) if len(rows) else (0, 0)
            if first >= last:
                continue
            if masks is None:
                masks = Masks(list(b_text[top:end]), table)
                held = _level_weights(letters[top:end], levels, limit, True).T.copy() if la[rows[0]] <= SHORT else None
            mine, weights, _ = of_step(start)
            if weights is not None:
                for x in range(first, last, TILE_COLUMNS):
                    y = min(x + TILE_COLUMNS, last)
                    shared = weights[rows - start] @ held[:, x - top:y - top]
                    row, col = np.divmod(np.flatnonzero(shared >= -0.01), y - x)
                    found.append((rows[row], x + col, shared[row, col]))
                    waiting += len(row)
                if waiting >= PAIRS:
                    yield from flushed(found, top, masks)
                    found, waiting = [], 0
                continue
            for i in rows:
                low, high = fitting(la[i], la[i], top, end)
                near = np.arange(low, high) if high - low < max(FEW_TEXTS, la[i] // 100) else top + masks.may_reach(a_text[i], low - top, high - top, limit)
                common = np.minimum(letters[near], mine[i - start]).sum(axis=1)
                need = np.ceil(limit * (la[i] + lb[near]) / 2 - 1e-9)
                order = np.argsort(-common, kind="stable")
                yield from compared((i, j) for j in near[order][(common >= need)[order]])
        if found:
            yield from flushed(found, top, masks)


def _tiles(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bounded rows and characters of texts in the order of their lengths."""
    start = 0
    for end in range(1, len(lengths) + 1):
        if end == len(lengths) or end + 1 - start > TILE_ROWS or (end + 1 - start) * lengths[end] > TILE_CHARS:
            yield start, end
            start = end


def _bands_met(probes: DataFrame, build: DataFrame, limit: float) -> DataFrame:
    """(n, band): for every length of a probe the bands that hold a text of a fitting length."""
    def length_class(n: Column) -> Column:
        return F.floor(F.log(n) / F.log(F.lit((2 - limit) / limit)) * LENGTH_CLASSES).cast("int")

    held = build.select(length_class(F.length("text")).alias("class")).distinct()
    asked = probes.select(F.length("text").alias("n")).distinct()
    mine = length_class(F.col("n"))
    reach = LENGTH_CLASSES + 1
    return asked.select("n", F.explode(F.sequence(mine - reach, mine + reach)).alias("class")).join(held, "class").select(
        "n", F.floor(F.col("class") / LENGTH_CLASSES).cast("int").alias("band")).distinct()


def _of_fitting_lengths(df: DataFrame, other: DataFrame, limit: float) -> DataFrame:
    """The texts whose length leaves a partner in ``other`` possible; a row per length is broadcast."""
    able = _bands_met(df, other, limit).select("n").distinct()
    return df.join(F.broadcast(cut_lineage(able)), F.length("text") == F.col("n"), "left_semi")


def _block_matches(probes: DataFrame, build: DataFrame, limit: float) -> DataFrame:
    """(id, low, high, ratio): partners of the probe texts, one at least per slug and block that holds any.

    Both sides are (id, text, low, high). A partner's length lies within one band of the probe's, and a
    probe goes to a band only if some text there has a fitting length. Bands are cut into blocks of bounded rows and characters on both sides, so a band that holds
    most texts still spreads evenly. A pair of blocks is compared where it meets: only texts, never
    pairs, are shuffled.
    """
    met = cut_lineage(_bands_met(probes, build, limit))
    a = probes.join(F.broadcast(met), F.length("text") == F.col("n")).select("id", "text", "low", "high", "band")
    in_class = F.floor(F.log(F.length("text")) / F.log(F.lit((2 - limit) / limit)) * LENGTH_CLASSES)
    b = build.select("id", "text", "low", "high", F.floor(in_class / LENGTH_CLASSES).cast("int").alias("band"))

    def blocks(df: DataFrame, name: str, more: int) -> DataFrame:
        rows, chars = F.count("*"), F.sum(F.length("text"))
        size = F.greatest(rows / BLOCK_ROWS, chars / BLOCK_CHARS, F.least(F.greatest(rows / LEAST_PROBES, chars / LEAST_CHARS), F.lit(float(more))))
        return df.groupBy("band").agg(F.ceil(size).cast("int").alias(name))

    # one row per length band: at most about a hundred
    sizes = cut_lineage(blocks(a, "a_blocks", PROBE_BLOCKS).join(blocks(b, "b_blocks", 1), "band"))
    # by number, so that blocks that are small in bytes are not put into one task
    tasks = 2 * (sizes.agg(F.sum(F.col("a_blocks") * F.col("b_blocks"))).first()[0] or 1)

    def split(df: DataFrame, side: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(f"{side}_blocks")).cast("int").alias(f"{side}_block")
        spread = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        met = df.join(F.broadcast(sizes), "band").select(*df.columns, mine, spread)
        return met.repartition(tasks, "band", "a_block", "b_block").groupBy("band", "a_block", "b_block")

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = block_partners(x.sort_values("id"), y.sort_values("id"), limit) if len(x) and len(y) else ()
        return pd.DataFrame(found, columns=["id", "low", "high", "ratio"])

    return split(a, "a", "b").cogroup(split(b, "b", "a")).applyInPandas(compare, "id string, low string, high string, ratio double")


# ------------------------------------------------------------------ names


def _shortened(name: Column) -> Column:
    """The name and every form with one character deleted."""
    return F.array_distinct(F.concat(F.array(name), F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))),
        lambda i: F.concat(F.substr(name, F.lit(1), i - 1), F.substr(name, i + 1)),
    )))


def _of_lengths(df: DataFrame, other: DataFrame, limit: float, cut: int, reach: int | None = None) -> DataFrame:
    """The names whose length allows a partner at ``cut`` or more deletions a side, and at most ``reach``."""
    lengths = df.select("text").groupBy(F.length("text").alias("n")).agg(F.any_value("text").alias("text"))
    able = _partner_lengths(lengths, other, limit, cut)
    if reach is not None:
        able = able.filter(F.abs(F.col("n") - F.col("other")) <= reach)
    return df.join(F.broadcast(cut_lineage(able.select("n").distinct())), F.length("text") == F.col("n"), "left_semi")


def _by_forms(wanted: DataFrame, owned: DataFrame, limit: float) -> DataFrame:
    """(name, slug, ratio) of the best owner at one deletion a side or none.

    Names meet on their shortened forms. A form keeps one owner per length of name, so a dense
    group of names is never unfolded to pairs. Forms outgrow what the size of the names tells, so
    these joins are never left to a broadcast.
    """
    def forms(df: DataFrame) -> DataFrame:
        return spread(df, "name").withColumn("form", F.explode(_shortened(F.col("name"))))

    best = forms(owned).groupBy("form", F.length("name").alias("b_len")).agg(F.min("slug").alias("slug"))
    a_len, kept = F.length("name"), F.length("form")
    near = (
        forms(wanted).hint("merge").join(best.hint("merge"), "form")
        .select(
            "name", "slug",
            (F.greatest(a_len, F.col("b_len")) - kept).alias("cut"),
            (2.0 * kept / (a_len + F.col("b_len"))).alias("ratio"),
        )
        .filter(F.col("ratio") >= limit)
    )
    return near.groupBy("name").agg(F.min_by(F.struct("slug", "ratio", "cut"), _best()).alias("m")).select("name", "m.*")


def _by_tree(wanted: DataFrame, owned: DataFrame, limit: float) -> DataFrame:
    """(name, slug, ratio, cut) of the best owner per block at two deletions a side or more.

    Both sides are cut into blocks of bounded rows; where two meet, the owners form a tree of
    prefixes and the wanted names are searched in it. Only names are shuffled, never forms or pairs.
    """
    spark = wanted.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked, held = wanted.count(), owned.count()
    b_blocks = max(1, -(-held // TREE_ROWS))
    a_blocks = max(1, -(-asked // PROBE_ROWS), min(-(-parts // b_blocks), -(-asked // LEAST_ROWS)))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("name"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # by number, so that blocks that are small in bytes are not put into one task
    n = a_blocks * b_blocks
    a = wanted.select("name", block(a_blocks).alias("x"), every(b_blocks).alias("y")).repartition(n, "x", "y")
    b = owned.select("name", "slug", every(a_blocks).alias("x"), block(b_blocks).alias("y")).repartition(n, "x", "y")

    def search(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = nearest(list(x["name"]), dict(zip(y["name"], y["slug"])), lambda la, lb: ceil(limit * (la + lb) / 2 - 1e-9), 2)
        return pd.DataFrame(found, columns=["name", "slug", "ratio", "cut"])

    return a.groupBy("x", "y").cogroup(b.groupBy("x", "y")).applyInPandas(search, "name string, slug string, ratio double, cut int")


def _by_grams(wanted: DataFrame, owned: DataFrame, limit: float) -> DataFrame:
    """(name, slug, ratio, cut) of owners that share enough rare grams, for pairs with a long name."""
    def texts(df: DataFrame) -> DataFrame:
        return df.select(F.col("name").alias("id"), F.col("name").alias("text"))

    # shorter names have no partner that is longer than TREE_LENGTH
    able = F.length("name") > int(TREE_LENGTH * limit / (2 - limit))
    left, held = texts(wanted.filter(able)), texts(owned.filter(able))
    hot = _hot_grams(held, 2)
    longer = F.greatest("la", "lb") > TREE_LENGTH
    a = cut_lineage(_keyed(left, held, hot, "la", "lb", 2, limit, 2).filter(longer)).hint("merge")
    b = cut_lineage(_keyed(held, left, hot, "lb", "la", 2, limit, 2).filter(longer)).hint("merge")
    # edit distance never exceeds the number of deletions plus insertions
    total = F.length("a_id") + F.length("b_id")
    close = _key_pairs(a, b).filter(F.expr(f"levenshtein(a_id, b_id, cast(floor((length(a_id) + length(b_id)) * {1 - limit} + 1e-9D) AS int))") >= 0)
    scored = spread(close, "a_id", "b_id").withColumn("ratio", _bounded_ratio(limit)("a_id", "b_id")).filter(F.col("ratio").isNotNull())
    common = F.round(F.col("ratio") * total / 2).cast("int")
    return scored.join(owned, F.col("b_id") == F.col("name")).select(
        F.col("a_id").alias("name"), "slug", "ratio",
        (F.greatest(F.length("a_id"), F.length("b_id")) - common).alias("cut"),
    )


def fuzzy_name_match(probes: DataFrame, catalog: DataFrame, limit: float = NAME_SIMILARITY) -> DataFrame:
    """(name, slug, ratio): the catalog name each probe name matches, if any.

    ``probes(name)``, ``catalog(name, slug)``, both lower-cased. Among the names that reach
    the limit the one with the fewest characters deleted on either side wins, then the
    highest ratio, then the lowest slug.

    Names with a match at one deletion a side leave first. What is left, if lengths still allow a
    match, is searched in trees of catalog names, depth by depth; pairs with a name over
    ``TREE_LENGTH`` characters meet on rare grams.
    """
    names = probes.filter(F.length("name") > 0).select("name").distinct()
    wanted = cut_lineage(names.withColumn("text", F.col("name")))
    owned = cut_lineage(catalog.filter(F.length("name") > 0).groupBy("name").agg(F.max("slug").alias("slug")).withColumn("text", F.col("name")))
    first = cut_lineage(_by_forms(
        _of_lengths(wanted, owned, limit, 0, 1), _of_lengths(owned, wanted, limit, 0, 1), limit,
    ))
    rest = wanted.join(first, "name", "left_anti")
    rest, held = cut_lineage(_of_lengths(rest, owned, limit, 2)), _of_lengths(owned, rest, limit, 2)
    short = F.length("name") <= TREE_LENGTH
    late = _by_tree(rest.filter(short), held.filter(short), limit)
    if not held.filter(~short).isEmpty() or not rest.filter(~short).isEmpty():
        late = late.unionByName(_by_grams(rest, held, limit))
    best = late.groupBy("name").agg(F.min_by(F.struct("slug", "ratio"), _best()).alias("m")).select("name", "m.*")
    return first.select("name", "slug", "ratio").unionByName(best)


# ------------------------------------------------------------------ texts


def _sketch(text: Column) -> Column:
    """A few minimum hashes over runs of three words."""

    def runs(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.xxhash64(
            w, F.coalesce(F.get(words, i + 1), F.lit("")), F.coalesce(F.get(words, i + 2), F.lit("")),
        ))

    def least(hashes: Column, j: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(j))))

    return computed_once(computed_once(F.split(text, r"\s+"), runs), lambda hashes: F.array(*[
        F.struct(F.lit(j).alias("j"), least(hashes, j).alias("h")) for j in range(SKETCHES)
    ]))


def _neighbours(probes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a_id, b_id): the texts next to each probe where all texts are sorted, from their starts and from their ends."""
    both = probes.select("id", "text").unionByName(texts.select("id", "text"))
    ends = both.select("id", F.left("text", F.lit(SORTED_CHARS)).alias("start"), F.reverse(F.right("text", F.lit(SORTED_CHARS))).alias("end")).distinct()
    found = []
    for end in ("start", "end"):
        numbered = global_row_number(ends, [end, "id"], "place", keep=["id"])
        beside = numbered.select(F.col("id").alias("a_id"), F.explode(F.array(F.col("place") - 1, F.col("place") + 1)).alias("place"))
        found.append(beside.join(numbered, "place").select("a_id", F.col("id").alias("b_id")))
    return found[0].unionByName(found[1]).distinct()


def _other_owner(low: Column, high: Column, own: Column) -> Column:
    return F.when(low != own, low).when(high != own, high)


def near_duplicate_texts(probes: DataFrame, catalog: DataFrame, limit: float = DESCRIPTION_SIMILARITY) -> DataFrame:
    """(slug, id, other_slug, ratio): one catalog text of another slug each probe nearly equals.

    Both sides are ``(slug, text)``; ``id`` is the digest of the probe text. Probes are compared when their trimmed text has 20
    characters, catalog texts when the raw text has. Texts of a length that nothing on the other side
    fits are left out before anything else is done with them. Which of several partners is named is
    fixed by the data, not by the run.
    """
    wanted = probes.filter(F.length(strip("text")) >= MIN_COMPARED_DESCRIPTION).select("slug", "text")
    held = catalog.filter(F.length("text") >= MIN_COMPARED_DESCRIPTION).select("slug", "text")
    if probes is not catalog:
        # whole texts are hashed, sketched and written below: only those that can have a partner at all
        wanted, held = _of_fitting_lengths(wanted, held, limit), _of_fitting_lengths(held, wanted, limit)
    wanted, held = (df.withColumn("id", F.sha2("text", 256)) for df in (wanted, held))
    owners = held.groupBy("id").agg(F.min("slug").alias("low"), F.max("slug").alias("high"))

    same = wanted.select("slug", "id").join(owners, "id").select(
        "slug", "id", _other_owner(F.col("low"), F.col("high"), F.col("slug")).alias("other_slug"),
    )
    exact = same.filter(F.col("other_slug").isNotNull()).select("slug", "id", "other_slug", F.lit(1.0).alias("ratio"))

    open_probes = cut_lineage(wanted.join(exact.select("slug", "id"), ["slug", "id"], "left_anti"))
    open_texts = open_probes.groupBy("id").agg(F.any_value("text").alias("text"))
    texts = held.groupBy("id").agg(F.any_value("text").alias("text"))
    keys = texts.select("id", F.explode(_sketch(F.col("text"))).alias("s")).select("id", "s.j", "s.h")
    leaders = keys.groupBy("j", "h").agg(F.min("id").alias("lead"), F.max("id").alias("tail"))
    met = (
        open_texts.select("id", F.explode(_sketch(F.col("text"))).alias("s")).select("id", "s.j", "s.h")
        .join(leaders, ["j", "h"])
        .select(F.col("id").alias("a_id"), F.explode(F.array("lead", "tail")).alias("b_id"))
        .filter(F.col("a_id") != F.col("b_id")).distinct()
    )
    bounded = _bounded_ratio(limit)

    def verify(pairs: DataFrame, open_ids: DataFrame) -> DataFrame:
        """The pairs of distinct texts that reach the limit, best partner per probe."""
        a = open_texts.select(F.col("id").alias("a_id"), F.col("text").alias("a_text"))
        b = texts.select(F.col("id").alias("b_id"), F.col("text").alias("b_text"))
        scored = (
            spread(pairs.join(a, "a_id").join(b, "b_id"), "a_id", "b_id")
            .withColumn("ratio", bounded("a_text", "b_text"))
            .filter(F.col("ratio").isNotNull())
            .join(owners.withColumnRenamed("id", "b_id"), "b_id")
            .select(F.col("a_id").alias("id"), "low", "high", "ratio")
        )
        return named(scored, open_ids)

    def named(scored: DataFrame, open_ids: DataFrame) -> DataFrame:
        order = F.struct((-F.col("ratio")).alias("r"), "other_slug")
        return scored.join(open_ids, "id").select(
            "slug", "id", "ratio", _other_owner(F.col("low"), F.col("high"), F.col("slug")).alias("other_slug"),
        ).filter(F.col("other_slug").isNotNull()).groupBy("slug", "id").agg(
            F.min_by(F.struct("other_slug", "ratio"), order).alias("m")
        ).select("slug", "id", "m.*")

    probe_ids = open_probes.select("slug", "id")
    quick = cut_lineage(verify(met, probe_ids))
    left = cut_lineage(probe_ids.join(quick.select("slug", "id"), ["slug", "id"], "left_anti"))
    if left.count() >= SORTED_FROM:
        beside = _neighbours(open_texts.join(left.select("id").distinct(), "id", "left_semi"), texts)
        late = cut_lineage(verify(beside, left))
        quick = quick.unionByName(late)
        left = cut_lineage(left.join(late.select("slug", "id"), ["slug", "id"], "left_anti"))
    left_texts = open_texts.join(left.groupBy("id").agg(F.min("slug").alias("low"), F.max("slug").alias("high")), "id")
    late = _block_matches(left_texts, texts.join(owners, "id"), limit)
    return exact.unionByName(quick).unionByName(named(late, left))
