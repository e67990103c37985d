"""Vector codes, filter audit and token files against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tierweave.llm.common import vocabulary
from tierweave.llm.filter_audit import filter_audit, filter_audit_sql, filter_masks, text_mask
from tierweave.llm.text_trie import TextTrie, prefix_bounds
from tierweave.llm.token_files import EliasFano, fetch_documents, read_documents, write_token_files, written_and_read
from tierweave.llm.vector_codes import choose_pivots, integers, nearest, pivot_distances, vector_codes, vector_codes_sql

PACK = "byte_bpe_50k.json"


# ------------------------------------------------------------------ vector codes


@pytest.mark.parametrize(("width", "size"), [(16, 0.2), (3, 0.01), (5, 1e8), (4, 1e20)])
def test_nearest_equals_all_distances(width, size):
    rng = np.random.default_rng(1)
    x = rng.normal(0, size, (700, width)).astype(np.float32)
    x[50:90] = x[3]
    parts = integers(x, 1024)
    entries = parts[:64].copy()
    entries[40] = entries[7]
    pivots = choose_pivots(entries)
    choice, squared, tried = nearest(parts, entries, pivot_distances(parts, pivots), pivot_distances(entries, pivots))
    for row, c, s in zip(parts.astype(object), choice, squared, strict=True):
        distances = [int(((row - e) ** 2).sum()) for e in entries.astype(object)]
        assert (min(distances), distances.index(min(distances))) == (s, c)
    assert tried < 700 * 64


def codes_by_force(rows, parts=4, entries=256, rounds=4):
    """rows: (id or None, integer vector, label), all vectors of one length."""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def assign():
        out = []
        for vector in cut:
            best = []
            for p, part in enumerate(vector):
                distances = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in books[p]]
                best.append((min(distances), distances.index(min(distances))))
            out.append(best)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(rows)) if found[i][p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in best) for best in found]
    by_label = Counter()
    for (_, _, label), error in zip(rows, errors, strict=True):
        by_label[label] += error
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in best), error, by_label[label], digest)
         for (i, _, label), best, error in zip(rows, found, errors, strict=True)), key=str,
    )


def test_codes_with_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], rng.choice([1, 2, None])) for i in range(60)]
    rows += [(3, rows[3][1], 1), (None, rows[4][1], None), (None, [0.5] * 8, 2), (70, [-0.0] * 8, 7), (71, [1e-30, -1e-30] * 4, 7)]
    bad = [(80, None, 1), (81, [None] + [0.0] * 7, 1), (82, [float("nan")] * 8, 1), (83, [float("inf")] + [0.0] * 7, 1)]
    schema = "vec_id long, embedding array<double>, label int"
    frame = spark.createDataFrame(rows + bad, schema).withColumn("code", F.lit("clash")).withColumn("x", F.lit(1))
    got = vector_codes(frame, entries=10, rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    whole = [(i, [int(np.floor(x * 1024)) for x in v], label) for i, v, label in rows]
    assert sorted(map(tuple, got.collect()), key=str) == codes_by_force(whole, entries=10, rounds=3)


def test_codes_of_large_components(spark):
    rows = [(i, [float(i % 5) * 10.0 ** (i % 30)] * 4, 1) for i in range(40)]
    got = vector_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), entries=6, rounds=2)
    exact = [(i, [int(np.float32(x)) * 1024 for x in v], label) for i, v, label in rows]
    want = codes_by_force(exact, entries=6, rounds=2)
    for row, (i, code, error, total, digest) in zip(sorted(map(tuple, got.collect()), key=str), want, strict=True):
        assert row == (i, code, error if error < 1 << 63 else None, total if total < 1 << 63 else None, digest)


def test_codes_of_few_and_uneven_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 1)], schema)).count() == 0
    rows = vector_codes(spark.createDataFrame([(2, [1.0, 2.0, 3.0], 1), (1, [1.0], 1), (3, [], 1)], schema)).orderBy("vec_id").collect()
    # filled with zeros, each vector is its own entry; equal parts go to the lower index
    assert [(r.vec_id, r.code, r.error) for r in rows] == [(1, "00000000", 0), (2, "00010100", 0), (3, "02000000", 0)]


def test_codes_equal_the_sql(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({vector_codes_sql(entries=16, rounds=2)})").fetchall()
    got = vector_codes(spark.read.parquet(path), entries=16, rounds=2).select(names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# ------------------------------------------------------------------ tries and the audit


def test_trie_holds_what_was_put_in():
    rng = random.Random(2)
    texts = ["", "a", "ab", "é中", "x" * 5000, "x" * 4999 + "y"]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    trie, want = TextTrie(), {}
    for i, text in enumerate(texts):
        node = trie.insert(text)
        if node[2] is None:
            node[2] = i
        want.setdefault(text, i)
    assert {text: i for text, i, _ in trie.terminals()} == want


def test_bounds_reach_behind_shared_prefixes(spark):
    rng = random.Random(4)
    shared = "boilerplate " * 200
    texts = [shared + "".join(rng.choice("abcdef") for _ in range(30)) for _ in range(3000)] + [str(rng.random()) for _ in range(3000)]
    bounds = prefix_bounds(spark.createDataFrame([(t,) for t in texts], "text string"), 40)
    assert bounds == sorted(set(bounds)) and all(len(b) < len(shared) + 10 for b in bounds)
    sizes = Counter(np.searchsorted(np.array(bounds, object), np.array(texts, object), side="right").tolist())
    assert len(bounds) > 20 and max(sizes.values()) < len(texts) / 6
    assert prefix_bounds(spark.createDataFrame([("same",)] * 50, "text string"), 40) == []


def audit_by_force(docs, labels):
    """docs: (id, text, source); labels: (id, quality, toxic)."""
    masks = []
    for doc, text, part in docs:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": doc is not None and any(o is not None and o < doc and (u or "") == t for o, u, _ in docs),
        }
        good = any(d == doc and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc and x == 1 for d, _, x in labels if d is not None)
        masks.append((part or "", {f for f, hit in fails.items() if hit}, good, toxic))
    out = []
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        removed = Counter()
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                failing = sum(letter in m[1] for m in own)
                left = [m for m in left if letter not in m[1]]
                removed[letter] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(m[1] == {letter} for m in own),
                    sum(m[2] for m in gone), sum(m[3] for m in gone),
                ))
        out += [(*r, removed[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def odd_documents():
    rng = random.Random(9)
    words = ["word", "An", "THE", "#x", "é", "\x1c", "a\tb", " ", "50%"]
    texts = [None, "", " ", "\n", "A" * 500, "w " * 300, "long " * 20000 + "end", "long " * 20000 + "END"]
    texts += [" ".join(rng.choice(words) + str(rng.randint(0, 300)) * rng.randint(0, 1) for _ in range(rng.choice([3, 199, 200, 260]))) for _ in range(40)]
    docs = [(i, rng.choice(texts), rng.choice(["x", "y", None, ""])) for i in range(160)]
    docs += [(7, docs[7][1], "x"), (7, docs[7][1], "y"), (7, "other", "x"), (None, docs[3][1], "x"), (None, None, None), (-5, docs[9][1], "y"), (200, "x", "only")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 1), (None, 1, 1)]
    return docs, labels


def test_audit_with_odd_rows(spark, tmp_path):
    docs, labels = odd_documents()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    frame = frame.withColumn("part", F.lit("clash")).withColumn("mask", F.lit(99)).withColumn("n", F.lit(1.5))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audit_by_force(docs, labels)
    assert sorted(map(tuple, filter_audit(frame, marks).select(COLUMNS).collect())) == want
    frame.coalesce(1).write.parquet(f"{tmp_path}/d")
    marks.coalesce(1).write.parquet(f"{tmp_path}/l")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    con.execute(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{tmp_path}/l/*.parquet')")
    assert sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({filter_audit_sql()})").fetchall()) == want


def test_audit_empties_full_tries(spark, monkeypatch):
    import tierweave.llm.filter_audit as audit

    monkeypatch.setattr(audit, "TRIE_BYTES", 2000)
    docs = [(i, f"text {i % 90} " * 20, "x") for i in range(700)]
    rows = audit.filter_masks(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(6)).collect()
    assert sum(r.n for r in rows) == 700 and {r.doc_id for r in rows if not r["mask"] & 16} == set(range(90))


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, source string")
    assert filter_masks(one).collect() == [(None, "", text_mask(""), 1)]
    assert filter_audit(one, labels).count() == 600


# ------------------------------------------------------------------ token files


@pytest.mark.parametrize("values", [
    [], [5], [-3, -3, 0, 7], list(range(1000)), [0, 2**63 - 1], [-(2**63), 0, 2**63 - 1], [7] * 3000,
    sorted(random.Random(1).sample(range(10**12), 4000)),
])
def test_rising_sequences(values):
    held = EliasFano(EliasFano.encode(values))
    assert held.n == len(values) and (not values or held.values().tolist() == values)
    for i in range(0, len(values), max(1, len(values) // 200)):
        assert held.select(i) == values[i]
    for v in [*values[:20], 1, 10**6]:
        assert held.rank(v) == sum(x < v for x in values)


def test_sequences_are_small():
    values = sorted(random.Random(1).sample(range(10**7), 5000))
    assert 8 * len(EliasFano.encode(values)) < 14 * len(values)  # log2(2000) = 11 and 2 bits, positions kept


def expected(texts, end=2):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(PACK))
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4").tobytes() for t in texts]


def test_files_hold_all_documents(spark):
    rng = random.Random(3)
    texts = [None, "", "a <|endoftext|> b", "é 中文\n\n  x", "word " * 30000] + [
        "".join(rng.choice(["a", " b", "\n", "The", " über", "!"]) for _ in range(rng.randint(1, 60))) for _ in range(120)
    ]
    ids = list(range(-10, len(texts) - 10))
    rng.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1))
    folder, index = write_token_files(docs, vocabulary(PACK), file_bytes=800)
    assert index.count() > 5
    got = {r.doc_id: r for r in read_documents(folder, index, keep_ids=True).collect()}
    assert len(got) == len(rows)
    start = 0
    for doc, raw in sorted(zip(ids, expected(texts), strict=True)):
        row = got[doc]
        assert (row.start, row.n_tokens, row.ids_crc32, bytes(row.ids)) == (start, len(raw) // 4, zlib.crc32(raw), raw)
        start += len(raw) // 4
    some = fetch_documents(folder, index, [-10, 3, 40, 10**6]).collect()
    assert {(r.doc_id, r.start, bytes(r.ids)) for r in some} == {(d, got[d].start, bytes(got[d].ids)) for d in (-10, 3, 40)}
    assert fetch_documents(folder, index, []).count() == 0


def test_files_with_repeated_and_missing_ids(spark):
    rows = [(5, "a"), (5, "a"), (5, "b c"), (None, "x"), (None, None), (1, "first one")]
    got = written_and_read(spark.createDataFrame(rows, "doc_id int, text string"), vocabulary(PACK)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 5, 5, 5, None, None]
    want = Counter((d, len(raw) // 4, zlib.crc32(raw)) for (d, _), raw in zip(rows, expected([t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ends = np.cumsum([r.n_tokens for r in got]).tolist()
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_files_of_nothing(spark):
    assert written_and_read(spark.createDataFrame([], "doc_id long, text string"), vocabulary(PACK)).count() == 0
