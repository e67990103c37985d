"""Best-fit packing of tokenized documents into sequences of bounded length.

Bulk-synchronous best fit. Documents and gaps are both kept in order of size, and as lengths
are small integers that order is run-length coded: ``capacity`` runs of documents and as many
of gaps, whatever the number of documents. A step takes the longest documents left, all at
once, and sweeps the gaps from their length upwards: each gap is the successor of the documents
of that length, the documents compete for it by rank, the first ``gap // length`` of them per
gap win, the gaps shrink, and the rest goes on to the next gap. New sequences open when no gap
is left. The next step repeats this for the next length. The outcome equals sequential best fit
in descending order.

What is distributed is everything that grows with the input: tokenizing, the histogram of
lengths, the range sort that gives each piece its rank among all pieces, and the lookup of a
rank in the list of steps. The sweep itself only sees the histogram, whose size is bounded by
``capacity``.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.bpe import byte_letters
from tierweave.llm.common import Memo, chunk_parts, chunks, clean, read_bytes, ship, worker_cache
from tierweave.session import cut_lineage, global_row_number

ship(__name__)

PIECE = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary"


# ------------------------------------------------------------------ tokens

#: A word no byte-level pre-tokenizer cuts.
_LATIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")


def library_encoder(data: bytes):
    """text -> little-endian ids, as the library gives them for the whole text.

    Chunks are remembered. A chunk met for the first time is one word of Latin letters, which the
    pre-tokenizer leaves whole and so goes to the library's merges directly, or is cut into parts
    that are remembered themselves; anything else goes through the whole library.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    merge = tokenizer.model.tokenize
    packed = [struct.pack("<I", i) for i in range(tokenizer.get_vocab_size())]
    spelled = {ord(byte): letter for letter, byte in byte_letters().items()}

    def direct(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def new(key: str, memo: Memo, lead: str, mark: str) -> bytes:
        if _LATIN_WORD.fullmatch(key):
            word = key if key.isascii() else key.encode().decode("latin-1").translate(spelled)
            return b"".join([packed[token.id] for token in merge(mark + word)])
        parts = chunk_parts(key)
        if parts:
            return memo[parts[0]] + b"".join(map(bare.__getitem__, parts[1:]))
        return direct(lead + key)

    bare = Memo(lambda key: new(key, bare, "", ""), limit=100_000)
    spaced = Memo(lambda key: new(key, spaced, " ", spelled[ord(" ")]), limit=600_000)

    def encode(text: str) -> bytes:
        if any(s in text for s in specials):
            return direct(text)
        first, rest = chunks(text)
        return (bare[first] if first else b"") + b"".join(map(spaced.__getitem__, rest))

    return encode


def tokenized_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32, ids.

    A NULL or empty text is the closing id alone. Only documents that are too long are cut, the
    first piece being the short one. ``ids`` (little-endian 32-bit) is NULL unless ``keep_ids``.
    Rows with equal ids are separate documents; no other column of the input is read.
    """
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(read_bytes(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()
    closing = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = worker_cache(("library", vocabulary), lambda: library_encoder(data.value))
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], clean(batch["text"]), strict=True):
                ids = encode(text) + closing
                total = len(ids) // 4
                first = total % capacity or capacity
                for piece, start in enumerate([0, *range(first, total, capacity)]):
                    part = ids[4 * start:4 * (first if piece == 0 else start + capacity)]
                    rows.append((doc, piece, start, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInPandas(run, PIECE.format(id_type=id_type))


# ------------------------------------------------------------------ best fit


def best_fit_steps(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Steps of best fit for a histogram of lengths; bounded by ``capacity``, not by the counts.

    Rows: first rank, sequence, documents per sequence, offset of the first, length. Ranks count
    from 0 through all documents in ascending order of length.
    """
    begin, total = {}, 0
    for length in sorted(counts):
        begin[length] = total
        total += counts[length]
    gaps: dict[int, list[list[int]]] = {}
    sizes: list[int] = []
    opened = 0
    steps = []

    def put(gap: int, sequence: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append([sequence, many])

    for length in sorted(counts, reverse=True):
        rank, left = begin[length], counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                per = capacity // length
                new = -(-left // per)
                put(capacity, opened, new)
                opened += new
                continue
            gap = sizes[at]
            runs = gaps[gap]
            sequence, many = runs.pop()
            if not runs:
                del gaps[gap]
                del sizes[at]
            per = gap // length
            full = min(many, left // per)
            if full:
                steps.append((rank, sequence, per, capacity - gap, length))
                put(gap - per * length, sequence, full)
                rank, left = rank + full * per, left - full * per
            if full < many and 0 < left < per:
                steps.append((rank, sequence + full, left, capacity - gap, length))
                put(gap - left * length, sequence + full, 1)
                left, full = 0, full + 1
            put(gap, sequence + full, many - full)
    return np.array(sorted(steps), dtype=np.int64).reshape(-1, 5)


def best_fit(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", order: tuple[str, ...] = ()) -> DataFrame:
    """Give every row a ``sequence_id`` and its ``offset`` in that sequence.

    Lengths must lie in 1..capacity. Other columns are kept; ``order`` makes ties reproducible.
    An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).agg(F.count("*")).collect()}  # at most ``capacity`` rows
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    steps = spark.sparkContext.broadcast(best_fit_steps(counts, capacity))
    ranked = global_row_number(pieces, [length_col, *order], "_rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = steps.value
        for batch in batches:
            rank = batch.pop("_rank").to_numpy() - 1
            step = known[np.searchsorted(known[:, 0], rank, side="right") - 1]
            nth = rank - step[:, 0]
            batch["sequence_id"] = step[:, 1] + nth // step[:, 2]
            batch["offset"] = step[:, 3] + nth % step[:, 2] * step[:, 4]
            yield batch

    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Tokenize and pack: the pieces with ``sequence_id`` and ``offset``."""
    pieces = tokenized_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, keep_ids)
    pieces = cut_lineage(pieces if keep_ids else pieces.drop("ids"))
    return best_fit(pieces, capacity, order=("doc_id", "piece"))


def sequences(placed: DataFrame) -> DataFrame:
    """Whole sequences of a ``pack(..., keep_ids=True)``: sequence_id, length, ids, doc_ids."""
    part = F.struct("offset", "ids", "doc_id")
    return placed.groupBy("sequence_id").agg(  # at most ``capacity`` pieces a sequence
        F.sum("length").alias("length"), F.array_sort(F.collect_list(part)).alias("parts"),
    ).select(
        "sequence_id", "length",
        F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"),
        F.transform("parts", lambda x: x["doc_id"]).alias("doc_ids"),
    )
