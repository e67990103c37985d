"""Top-k, archives, line and near-duplicate removal, and the pipeline."""

import base64
import hashlib
import itertools
import math
import random
import zlib
from collections import defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from check import rows
from pyspark.sql import functions as F
from tierweave.llm import ORACLES, QUERIES
from tierweave.llm.graph import connected_components
from tierweave.llm.line_dedup import without_widespread_lines
from tierweave.llm.near_dups import near_duplicates, shared_counts, shingle_keys, sketch
from tierweave.llm.packing import pack
from tierweave.llm.topk import exact_top_k
from tierweave.llm.warc import parse_record, read_records, write_archives

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in cur.description], cur.fetchall())


# ------------------------------------------------------------------ top-k


def brute_top(vectors, queries, k):
    q = {i: [math.floor(256 * x) for x in v] for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in queries:
        if a in q:
            best = sorted((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), b) for b in q if b != a and len(q[b]) == len(q[a]))[:k]
            out += [(a, r + 1, b, -s) for r, (s, b) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.02, 1.0, 3e4])
def test_top_k_equals_brute_force(spark, scale):
    rng = random.Random(4)
    vectors = [(i, [rng.uniform(-scale, scale) for _ in range(4)]) for i in range(150)]
    vectors += [(200 + i, [scale] * 4) for i in range(40)]  # ties
    vectors += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (304, [1.0, 2.0]), (306, [3.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("qb", F.lit(1)).repartition(3)
    got = sorted(map(tuple, exact_top_k(df.filter("vec_id % 2 = 0"), df, 5).collect()))
    assert got == brute_top(vectors, [i for i, _ in vectors if i % 2 == 0], 5)


@pytest.mark.parametrize("scale", [1e6, 1e8, 1e10, 1e12, 1e20])
def test_top_k_of_large_components(spark, scale):
    rng = random.Random(6)
    vectors = [(i, [rng.choice([0.3, 1.0]) * rng.uniform(-scale, scale) for _ in range(4)]) for i in range(60)]
    vectors += [(100 + i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)] + [(200, [1e300] * 4), (201, [-1e300] * 4)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2)
    got = sorted(map(tuple, exact_top_k(df.filter("vec_id % 3 = 0"), df, 4).collect()))
    top, last = 1 << 52, (1 << 63) - 1
    q = {i: [max(-top, min(top, math.floor(256 * x))) for x in v] for i, v in vectors}
    want = []
    for a in q:
        if a % 3 == 0:
            best = sorted((-max(-last, min(last, sum(x * y for x, y in zip(q[a], q[b], strict=True)))), b) for b in q if b != a)[:4]
            want += [(a, r + 1, b, -s) for r, (s, b) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in exact_top_k(df.filter("vec_id = 0"), df).collect()] == [(0, 1, 1, 256 * 512)]
    assert exact_top_k(df.limit(0), df).count() == 0 and exact_top_k(df, df.limit(0)).count() == 0
    assert exact_top_k(df.filter("vec_id = 0"), df.filter("vec_id = 0")).count() == 0


# ------------------------------------------------------------------ archives


def test_archives_round_trip(spark, tmp_path):
    big = "é\r\n\r\n" * 3000
    data = [
        (3, "http://a/x", "same"), (1, "http://b\r\nX: y", "same"), (2, None, ""), (7, "u", None), (5, "u", big),
        (5, "u", big), (9, "u", "tail\r\n\r\n"), (None, "u", "no id"), (4, "v", "same"),
        (None, None, "same"), (None, "u", "no id"), (2**60 + 1, "u", "same"),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("offset", F.lit("clash"))
    folder, index = write_archives(pages, folder=str(tmp_path / "w"), archive_bytes=300)
    got = read_records(folder, index, with_payload=True).collect()
    kept = [(i, u, h or "") for i, u, h in data]
    first = {h: min((i for i, _, x in kept if x == h and i is not None), default=None) for _, _, h in kept}
    assert len(got) == len(kept)
    want = sorted(((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if first[h] == i else "revisit", None if first[h] == i else first[h]) for i, _, h in kept), key=str)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    assert all(bytes(r.payload).decode() == next(h for i, _, h in kept if i == r.page_id) for r in got if r.record_type == "response")
    only = read_records(folder, index.filter("page_id in (5, 9)")).collect()
    assert sorted(r.page_id for r in only) == [5, 5, 9]
    # the archives are plain sequences of gzip members, one a record
    members = 0
    for part in (tmp_path / "w").glob("*.warc.gz"):
        raw, at = part.read_bytes(), 0
        for r in index.filter(F.col("archive") == part.name).orderBy("offset").collect():
            assert r.offset == at and parse_record(zlib.decompress(raw[at:at + r.length], wbits=31))["page_id"] == r.page_id
            at += r.length
            members += 1
        assert at == len(raw)
    assert members == len(kept)
    assert read_records(folder, index).rdd.getNumPartitions() == index.select("archive").distinct().count() > 1
    every = write_archives(pages, folder=str(tmp_path / "all"), min_bytes=10_000)[1]
    assert {r.page_id for r in every.filter("record_type = 'revisit'").collect()} == set()


def test_archives_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder, index = write_archives(pages, folder=str(tmp_path / "w"))
    assert read_records(folder, index).count() == 0


def test_damaged_record():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 7\r\n\r\nH\r\n\r\nab\r\n\r\n"
    with pytest.raises(ValueError):
        parse_record(record)


# ------------------------------------------------------------------ lines


def test_lines_of_many_sites(spark):
    data = [(i, f"shared line \nown line {i}\n\n shared line", f"s{i % 6}") for i in range(12)]
    data += [(20 + i, f"near limit\nmore {i}", f"s{i}") for i in range(4)] + [(30 + i, "hot site", "s0") for i in range(50)]
    data += [(90, None, "s1"), (91, "", "s1"), (92, "shared line", None), (None, "shared line\nx", "s2"), (0, data[0][1], "s0")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("n_removed", F.lit("clash")).withColumn("_pos", F.lit(1))
    got = without_widespread_lines(docs, min_sites=5).collect()
    text = defaultdict(list)
    for r in got:
        text[r.doc_id].append((r.text, r.n_lines, r.n_removed))
    assert len(got) == len(data)
    # a NULL id sorts first, so that document keeps the line
    assert text[None] == [("shared line\nx", 2, 0)]
    assert text[0] == [("own line 0\n", 4, 2)] * 2 and text[11] == [("own line 11\n", 4, 2)]
    assert text[20] == [("near limit\nmore 0", 2, 0)] and text[30] == [("hot site", 1, 0)]
    assert text[90] == [(None, 0, 0)] and text[91] == [("", 1, 0)] and text[92] == [("", 1, 1)]
    assert without_widespread_lines(docs.limit(0)).count() == 0


def test_sketches_of_many_sites(spark):
    data = [(i, "wide\nclose" if i < 203 else "wide\nrare" if i < 303 else "wide", f"site{i}") for i in range(1000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    for limit, gone in ((203, 2 * 202 + 797), (204, 999), (1000, 999), (1001, 0)):
        got = without_widespread_lines(docs, min_sites=limit).agg(F.sum("n_removed")).first()[0]
        assert got == (999 + (202 if limit <= 203 else 0) if limit <= 1000 else 0), (limit, gone)


# ------------------------------------------------------------------ near duplicates


def brute_components(data, percent=85):
    sets = {}
    for i, text in data:
        words = [w for w in (text or "").encode().lower().decode().replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets[i] = set(zip(*(words[k:] for k in range(5)), strict=False)) if len(words) >= 5 else {tuple(words)} if words else set()
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    out = []
    for g in range(3):
        for i in range(25):
            words = [f"g{g}w{x}" for x in range(120)]
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(120)] = f"e{rng.random()}"
            out.append((1000 * g + i, " ".join(words)))
    out += [(5000 + i, " ".join(f"c{x}" for x in range(i * 2, i * 2 + 120))) for i in range(40)]  # a chain
    out += [(9000 + i, x) for i, x in enumerate([
        None, "", "  \n", "a b", "A  B", "a b c d e", "a b c d e f", "a b c d e f g", "x " * 3000, "y z " * 2000, "Y Z " * 2000, "é É", "É É",
    ])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [256, 7])
def test_near_duplicates_equal_brute_force(spark, texts, block):
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("root", F.lit("clash"))
    got = near_duplicates(docs, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(texts)


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(2, long), (2, long), (None, long), (None, None), (5, long + " more"), (7, "short")], "doc_id long, text string")
    got = sorted(near_duplicates(docs).collect(), key=str)
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == sorted([
        ("2", "2", True), ("2", "2", True), ("None", "2", False), ("None", "None", True), ("5", "2", False), ("7", "7", True),
    ])
    assert near_duplicates(docs.limit(0)).count() == 0


def test_sketches_agree_as_often_as_sets_overlap():
    a, b = shingle_keys(" ".join(f"a{i}" for i in range(1004))), shingle_keys(" ".join(f"a{i}" for i in range(200, 1204)))
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (sketch(a, 360) == sketch(b, 360)).mean()
    assert abs(same - truth) < 0.1
    assert (sketch(a[:1], 64) > 0).all() and shared_counts([a], [b])[0, 0] == len(np.intersect1d(a, b))


def test_components_of_a_random_graph(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(70)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = list(range(80))
    for _ in range(80):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert all(got.get(i, i) == label[i] for i in range(80))
    assert connected_components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash")).withColumn("n_lines", F.lit(None).cast("string"))
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "line_dedup", "minhash_near_dedup", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == before.columns
        assert docs.join(before, "doc_id", "left_anti").count() == 0
        if name == "quality_classifier":
            judged = docs.join(marks, "doc_id")
            good = marks.join(before, "doc_id").filter("quality = 1").count()
            assert judged.filter("quality = 0").count() <= 2 and judged.filter("quality = 1").count() >= 0.97 * good
        if name == "minhash_near_dedup":
            want = brute_components([(r.doc_id, r.text) for r in before.collect()], 80)
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
    got = corpus_pipeline.run(spark, SF)
    assert got.select("doc_id").distinct().count() == docs.count()
    same = pack(docs, corpus_pipeline.vocabulary("byte_bpe_50k.json"))
    assert rows(got.columns, map(tuple, got.collect())) == rows(same.columns, map(tuple, same.collect()))


def test_pipeline_stages_on_odd_rows(spark):
    data = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, "12 34", "en", "a", 5), (4, "plain words in a text " * 9, "en", "b", 9), (4, "plain words in a text " * 9, "en", "b", 9), (None, "no id here", None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumn("_kept", F.lit(1))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, SF).collect()} <= {4, None}
    assert corpus_pipeline.near_duplicate_groups(spark, docs, SF).count() == 6


def test_pipeline_rejects_unlearned_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = [
        "这是一个中文文本，没有学过的语言。" * 5, "Эта строка на русском языке " * 5, "to jest tekst w języku polskim " * 5,
        "tämä on suomenkielinen teksti jota malli ei tunne " * 4, "αυτό είναι ένα κείμενο στα ελληνικά " * 4, "##### $$$ a",
    ]
    rows = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(strange)]
    got = corpus_pipeline.language(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF)
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    assert not {i for i in kept if i < 0}
    assert len(kept) >= 0.99 * docs.count()
