"""Equal texts by radix tries over ranges of texts.

Each task first inserts its texts into a compressed trie of its own, so a text leaves it once, with
the smallest document id it was met with; all other rows are decided on the spot. What is left is
dealt to ranges of texts and inserted into tries in order, range by range; a range ends at the shortest prefix that
tells two texts of a sample apart, so a bound is short where texts differ early and long where many
begin alike. The sample sets the sizes of ranges only, never a result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import ship
from tierweave.session import stored

ship(__name__)

#: Sampled texts that a range holds at most.
PER_RANGE = 16
#: Characters behind a shared prefix that are looked at once.
WINDOW = 24


def common_length(a: str, b: str, at: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    if b.startswith(a[:high], at):
        return high
    step = 16
    while low + step < high and b.startswith(a[low:low + step], at + low):
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle
    return low


class TextTrie:
    """Compressed trie: an edge per first character, with the least id and a payload at terminals.

    A node is a list [label, children or None, least id or None, payload].
    """

    def __init__(self):
        self.root = ["", {}, None, None]
        self.size = 0

    def insert(self, text: str):
        """The node of a text, made if it is new."""
        node, at = self.root, 0
        while at < len(text):
            below = node[1]
            child = below.get(text[at]) if below else None
            if child is None:
                leaf = [text[at:], None, None, None]
                if below is None:
                    below = node[1] = {}
                below[text[at]] = leaf
                self.size += len(text) - at + 200
                return leaf
            label = child[0]
            n = common_length(label, text, at)
            if n < len(label):
                middle = [label[:n], {label[n]: child}, None, None]
                child[0] = label[n:]
                below[text[at]] = middle
                self.size += 200
                child = middle
            node, at = child, at + n
        return node

    def terminals(self) -> Iterator[tuple[str, object, object]]:
        """Text, least id and payload of every text held, in no order across branches."""
        stack = [(self.root, "")]
        while stack:
            node, above = stack.pop()
            text = above + node[0]
            if node[2] is not None:
                yield text, node[2], node[3]
            if node[1]:
                stack.extend((child, text) for child in node[1].values())


def prefix_bounds(texts: DataFrame, ranges: int, text: str = "text") -> list[str]:
    """At most about ``2 * ranges`` rising bounds that cut the texts into ranges of even numbers.

    Looks at the different ones of about ``PER_RANGE * ranges`` texts, chosen by the hash of the
    text. Where too many of them begin alike, the characters behind what they share are looked at
    next; a pass handles all such places.
    """
    rows = texts.count()
    if ranges < 2 or not rows:
        return []
    share = min(1.0, PER_RANGE * ranges / rows)
    chosen = (F.xxhash64(text) >= F.lit(-(1 << 63))) if share == 1 else F.abs(F.xxhash64(text) % (1 << 30)) < share * (1 << 30)
    sample = stored(texts.filter(chosen).select(F.col(text).alias("text")).distinct())
    bounds, shared = set(), [""]
    while shared:
        def heads(batches: Iterator[pd.DataFrame], shared=tuple(shared)) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for t in batch["text"]:
                    i = bisect_right(shared, t) - 1
                    if i >= 0 and t.startswith(shared[i]):
                        at = len(shared[i])
                        out.append((i, t[at:at + WINDOW], t))
                yield pd.DataFrame(out, columns=["i", "head", "text"])

        found = sample.mapInPandas(heads, "i int, head string, text string").groupBy("i", "head").agg(
            F.count("*").alias("n"), F.min("text").alias("least"), F.max("text").alias("most"),
        ).select("i", "head", "n", *[F.when(F.col("n") > PER_RANGE, F.col(c)).alias(c) for c in ("least", "most")])
        # one short row per sampled text at most; whole texts only of the few places that go on
        rows = sorted(found.collect(), key=lambda r: (r["i"], r["head"]))
        held, last, go_on = 0, None, []
        for r in rows:
            before = shared[r["i"]]
            if r["i"] != last:
                held, previous, last = 0, "", r["i"]
            if held and held + r["n"] > PER_RANGE:
                # the shortest prefix that is larger than what came before
                bounds.add(before + r["head"][:common_length(previous, r["head"]) + 1])
                held = 0
            held += r["n"]
            previous = r["head"]
            if r["least"] is not None:
                n = common_length(r["least"], r["most"])
                go_on.append(r["least"][:n])
        shared = sorted(go_on)
    return sorted(bounds)

