"""Packing, token counts and the byte-level codec against the public libraries."""

import base64
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tierweave.llm.bpe_codec import PATTERN, Codec, decoded, encoded, round_trip
from tierweave.llm.common import Memo, chunks, read_bytes, vocabulary
from tierweave.llm.packing import best_fit, best_fit_steps, pack, sequences
from tierweave.llm.token_counts import PrefixCounter, prefix_table, token_counts, tokens_of_prefix, truncated

PACK, COUNT, CODEC = "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"
PARTS = [
    "a", "B", "'s", "'re", " ", "  ", "\n", "\t", ".", ",", "é", "é", "中", "<|endoftext|>", "<|startoftext|>",
    "\x1c", " ", "1", "!!", "\x85", "Σ", "<|", "word", "THE", "| ", "...", "\r\n",
]
EDGES = [
    "", " ", "  a  b c ", "foo  <|endoftext|> bar", "x<|startoftext|>y <|endoftext|>\n\n z", "it's  we'RE   x\x1c y\x85z",
    "é Å İstanbul ΑΣ ΑΣ. ßẞ", "a\nb\n\nc \nd. \n e.\nF", "it'. don't. x'y, 's. A's,", "ab" * 3000, "中文" * 500, "word " * 5000,
]


def odd_texts(n=400):
    random.seed(3)
    return EDGES + ["".join(random.choice(PARTS) for _ in range(random.randint(1, 25))) for _ in range(n)]


def frame(spark, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(len(texts), None, "x"), (0, texts[0], "x"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumn("ids", F.lit("clash")).withColumn("length", F.lit(1.5))


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(name))


def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, read_bytes(vocabulary(CODEC)).splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_chunks_give_the_text_back():
    for text in odd_texts():
        first, rest = chunks(text)
        assert " ".join([first, *rest]) == text


def test_memory_is_bounded():
    small = Memo(str.upper, limit=10, longest=3)
    for i in range(1000):
        assert small[str(i)] == str(i)
    assert len(small) <= 10 and len(small.older) <= 10
    assert small["abcd"] == "ABCD" and "abcd" not in small


def test_counts_equal_the_library(spark):
    texts = odd_texts()
    library = tokenizer(COUNT)
    got = token_counts(frame(spark, texts), vocabulary(COUNT), limit=20).collect()
    assert len(got) == len(texts) + 3
    for row in got:
        text = "no id" if row.doc_id is None else texts[row.doc_id] if row.doc_id < len(texts) else ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len(text.encode()), n > 20), repr(text)


def test_prefix_counts_equal_the_library():
    library, counter = tokenizer(COUNT), PrefixCounter(read_bytes(vocabulary(COUNT)))
    for text in odd_texts(150):
        if len(text) < 200:
            want = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(1, len(text) + 1)]
            assert counter.prefixes(text).tolist() == want, repr(text)


def test_budget_questions(spark):
    docs = spark.createDataFrame([(1, "hello there, unbelievable world"), (2, None), (3, "")], "doc_id int, text string")
    table = prefix_table(docs, vocabulary(COUNT))
    rows = {r.doc_id: r for r in table.select("*", truncated(3).alias("cut"), tokens_of_prefix(F.lit(5)).alias("five")).collect()}
    library = tokenizer(COUNT)
    assert len(library.encode(rows[1].cut, add_special_tokens=False).ids) == 3
    assert len(library.encode(rows[1].text[: len(rows[1].cut) + 1], add_special_tokens=False).ids) > 3
    assert rows[1].five == 1 and rows[3].cut == "" and rows[2].five == 0


def test_codec_equals_the_library(spark):
    texts = odd_texts()
    library = tiktoken_encoding()
    for row in round_trip(frame(spark, texts), vocabulary(CODEC)).collect():
        text = "no id" if row.doc_id is None else texts[row.doc_id] if row.doc_id < len(texts) else ""
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert bytes(row.decoded) == text.encode()


def test_codec_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    rows = decoded(encoded(docs, vocabulary(CODEC)), vocabulary(CODEC)).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in rows] == [b"a b", b""]
    assert encoded(docs.limit(0), vocabulary(CODEC)).count() == 0


def test_tokens_that_no_merge_reaches():
    # "abc" is a token although no merge order makes it; "ab" is made of two bytes
    ranks = b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate([b"a", b"b", b"c", b"d", b"ab", b"dcba"]))
    codec = Codec(ranks, r"\S+|\s+")
    assert np.frombuffer(codec.encode("abd"), "<u4").tolist() == [4, 3]
    assert np.frombuffer(codec.encode("dcba"), "<u4").tolist() == [5]
    assert np.frombuffer(codec.encode("dcbaa"), "<u4").tolist() == [3, 2, 1, 0, 0]


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= n]
        if fitting:
            gaps[min(fitting, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_steps_equal_sequential_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 100])
    lengths = [rng.randint(1, capacity) if seed % 2 else min(capacity, int(rng.expovariate(0.1)) + 1) for _ in range(400)]
    steps = best_fit_steps({n: lengths.count(n) for n in set(lengths)}, capacity)
    used = {}
    ranked = sorted(lengths)
    for r, n in enumerate(ranked):
        first, sequence, per, offset, length = steps[np.searchsorted(steps[:, 0], r, side="right") - 1]
        assert length == n
        nth = r - first
        used.setdefault(sequence + nth // per, []).append((offset + nth % per * n, n))
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(used) == best_fit_decreasing(lengths, capacity)


def test_packing(spark):
    texts = odd_texts(60)
    library, capacity = tokenizer(PACK), 64
    docs = frame(spark, texts)
    rows = pack(docs, vocabulary(PACK), capacity).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, parts in by_doc.items():
        text = "no id" if doc is None else texts[doc] if doc < len(texts) else ""
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        copies = 2 if doc == 0 else 1
        want = []
        start, piece = 0, 0
        first = len(ids) % capacity or capacity
        while start < len(ids):
            n = first if piece == 0 else capacity
            want.append((piece, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start, piece = start + n, piece + 1
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in parts) == sorted(want * copies)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    assert len(by_sequence) == best_fit_decreasing([r.length for r in rows], capacity)


def test_whole_sequences(spark):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(1, 30)], "doc_id long, text string")
    placed = pack(docs, vocabulary(PACK), 50, keep_ids=True)
    total = placed.agg(F.sum("length")).first()[0]
    rows = sequences(placed).collect()
    assert sum(r.length for r in rows) == total and all(len(r.ids) == 4 * r.length <= 200 for r in rows)


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack(docs, vocabulary(PACK)).count() == 0
    with pytest.raises(ValueError):
        best_fit(spark.createDataFrame([(5,)], "length int"), 4)
