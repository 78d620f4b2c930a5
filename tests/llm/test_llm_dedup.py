import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from nightjar.llm import exact_dedup as ex  # noqa: E402
from nightjar.llm import simhash as sh  # noqa: E402
from nightjar.llm import substring_dedup as sub  # noqa: E402
from nightjar.llm import suffix_dedup as suf  # noqa: E402
from nightjar.llm import tables  # noqa: E402

SCHEMA = "doc_id long, text string, key string, row string, spans int"


def corpus():
    r = random.Random(7)
    vocab = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(4000)]
    make = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, line = make(30), make(13)
    docs = []
    for i in range(60):
        parts = [make(r.randint(0, 80))]
        if i % 3 == 0:
            parts.append(passage)
        if i % 4 == 0:
            parts.append(line)
        parts.append(make(r.randint(0, 60)))
        docs.append((i, " ".join(parts)))
    long = docs[9][1].split(" ") + make(100).split(" ")
    for i in range(60, 70):                                   # near copies
        w = list(long)
        w[r.randrange(len(w))] = "changed"
        docs.append((i, " ".join(w)))
    docs += [(70, docs[5][1]), (71, docs[5][1].replace(" ", "\n \t")), (72, docs[5][1].upper()), (73, None), (74, ""),
             (75, " \n "), (76, "ab " * 400), (77, "ab " * 400), (78, "x" * 2000), (79, line), (80, "Ab\x1cc d\x85e"),
             (81, (line + " ") * 5)]
    r.shuffle(docs)
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


@pytest.fixture(scope="module")
def frame(spark, docs):
    return spark.createDataFrame([(d, t, "k", "r", 1) for d, t in docs], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_equals_brute_force(frame, docs):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in ex.exact_dedup(frame).collect()}
    assert got == brute.exact(docs)
    kept = ex.drop_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in brute.exact(docs).items() if v[2])


def test_exact_keeps_one_of_repeated_rows_and_takes_empty_tables(spark, empty):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "ab"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ex.exact_dedup(df).collect()
    assert sum(r.kept for r in got) == 2 and len(got) == 6
    assert {r.keep_id for r in got} == {1, 3}
    assert sorted(r.doc_id for r in ex.drop_copies(df).collect()) == [1, 3]
    assert ex.exact_dedup(empty).count() == 0 and ex.drop_copies(empty).count() == 0


@pytest.mark.parametrize("capacity", [tables.CAPACITY, 0])
def test_substring_equals_brute_force(frame, docs, monkeypatch, capacity):
    monkeypatch.setattr(tables, "CAPACITY", capacity)          # 0: joins instead of key filters
    monkeypatch.setattr(sub, "CAPACITY", capacity)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sub.substring_dedup(frame).collect()}
    want = {d: (n, n - len(k), brute.sha(" ".join(k))) for d, (n, k) in brute.substring(docs).items()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 500


def test_substring_takes_missing_ids_repeated_rows_and_empty_tables(spark, empty):
    text = " ".join(f"v{i}" for i in range(20))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (None, None)]
    got = sub.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 20)]
    assert sub.substring_dedup(empty).count() == 0


def test_automaton_extends_hits_to_whole_matches():
    p = [str(i) for i in range(40)]
    a = sub.PhraseAutomaton([(1, " ".join(p))])
    text = " ".join(["x"] + p[3:25] + ["y"] + p[30:40] + p[0:13])
    assert sorted(set(a.occurrences(5, text))) == [(1, 23), (34, 47)]
    assert a.occurrences(1, text) == []


def test_golay_anchors_meet_for_every_close_pair():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, 300, dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << r.integers(0, 64, 300, dtype=np.uint64)
    i, a, home = sh.anchors(x)
    j, b, _ = sh.anchors(y)
    homes = {(int(k), int(c)) for k, c, h in zip(i, a, home) if h}
    visits = {(int(k), int(c)) for k, c in zip(j, b)}
    assert {k for k, _ in homes & visits} == set(range(300))
    assert np.bincount(i).max() <= 30


@pytest.mark.parametrize("block", [sh.BLOCK, 3])
def test_simhash_links_equal_brute_force(spark, block):
    r = np.random.default_rng(2)
    centre = int(r.integers(0, 2**63))
    codes = [int(x) for x in r.integers(0, 2**63, 200)]
    for _ in range(60):                                        # one dense group
        c = centre
        for b in r.integers(0, 64, 2):
            c ^= 1 << int(b)
        codes.append(c)
    codes = sorted({c - 2**64 if c >= 2**63 else c for c in codes})
    df = spark.createDataFrame([(c,) for c in codes], "fp long")
    found = sh.links(df, block=block).collect()
    unsigned = {c: c % 2**64 for c in codes}
    assert all((unsigned[x.a] ^ unsigned[x.b]).bit_count() <= 3 for x in found)
    parent = {c: c for c in codes}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for x in found:
        a, b = find(x.a), find(x.b)
        parent[max(a, b)] = min(a, b)
    want = brute.components(unsigned)
    assert {c: find(c) for c in codes} == want


def test_simhash_equals_brute_force(frame, docs, empty):
    got = {r.doc_id: (r.f, r.component_id) for r in
           sh.near_duplicates(frame).withColumn("f", sh.hex_fingerprint("fp")).collect()}
    prints = {d: brute.fingerprint(t) for d, t in docs}
    classes = brute.components(prints)
    assert got == {d: (f"{prints[d]:016x}", classes[d]) for d, _ in docs}
    assert sh.near_duplicates(empty).count() == 0


def test_suffix_equals_brute_force(frame, docs, empty):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suf.suffix_dedup(frame).collect()}
    assert got == brute.suffix(docs)
    assert suf.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("ids", [(1, 2), (-2**63, 2**63 - 8)])
def test_suffix_rows_without_a_doc_id_are_documents(spark, ids):
    r = random.Random(11)
    make = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    p, q = make(230), make(240)
    rows = [(ids[0], make(90) + p + make(50)), (None, make(40) + p + make(70)), (None, make(30) + q), (None, q + make(60)),
            (ids[1], make(300)), (None, make(250)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.suffix(list(enumerate(t for _, t in rows)))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suf.suffix_dedup(docs).collect())
    assert got == sorted((d is None, d or 0, *want[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("group", [suf.GROUP, 2])
def test_suffix_repeats_of_crowded_keys(spark, group):
    r = random.Random(3)
    make = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    p = make(260)
    docs = [(i, make(r.randint(0, 200)) + p[r.randint(0, 40):260 - r.randint(0, 40)] + make(90)) for i in range(40)]
    spans = suf.repeats(spark.createDataFrame(docs, "doc_id long, text string"), group=group).collect()
    got = {}
    for s in spans:
        got.setdefault(s.doc_id, set()).update(range(s.start, s.end))
    want = brute.suffix(docs)
    assert {d: len(got.get(d, ())) for d, _ in docs} == {d: want[d][1] for d, _ in docs}


def test_suffix_counts_contexts_that_cut_characters(spark):
    """Contexts of crowded keys begin and end inside characters too."""
    r = random.Random(8)
    make = lambda n: "".join(r.choice("aeäöüßéñ€😀 ") for _ in range(n))
    p = make(160)
    docs = [(i, make(r.randint(0, 90)) + p[r.randint(0, 25):160 - r.randint(0, 25)] + make(40)) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.suffix(docs)
    for group in (2, suf.GROUP):
        got = {}
        for s in suf.repeats(frame, group=group).collect():
            got.setdefault(s.doc_id, set()).update(range(s.start, s.end))
        assert {d: len(got.get(d, ())) for d, _ in docs} == {d: want[d][1] for d, _ in docs}


def test_blocks_take_strings_and_bytes():
    import pyarrow as pa

    from nightjar.llm.textbytes import blocks

    rows = ["é€", None, "", "😀a"]
    cut = [None if x is None else x.encode()[1:] for x in rows]
    for column in (pa.array(rows), pa.array(rows, pa.large_string()), pa.array(cut, pa.binary())):
        want = [(x if isinstance(x, bytes) else x.encode()) if x is not None else b"" for x in column.to_pylist()]
        for size in (1, 100):
            assert [b.text(i) for b in blocks(column, size) for i in range(b.hi - b.lo)] == want


@pytest.mark.parametrize("capacity", [suf.CAPACITY, 0])
def test_suffix_keeps_groups_whole_beside_crowded_keys(spark, monkeypatch, capacity):
    """Keys with few contexts are not split over tasks when others are
    crowded, whatever the optimiser does about skew."""
    monkeypatch.setattr(suf, "CAPACITY", capacity)
    r = random.Random(5)
    make = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passages = [make(260) for _ in range(9)]
    docs = [(i, make(r.randint(0, 200)) + p[r.randint(0, 40):260 - r.randint(0, 40)] + make(90))
            for i, p in enumerate(passages[:1] * 60 + passages[1:] * 12)]
    r.shuffle(docs)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
        spans = suf.repeats(frame, group=20).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {}
    for s in spans:
        got.setdefault(s.doc_id, set()).update(range(s.start, s.end))
    want = brute.suffix(docs)
    assert {d: len(got.get(d, ())) for d, _ in docs} == {d: want[d][1] for d, _ in docs}


def test_intervals_of_a_small_array():
    assert sorted(suf.intervals(np.array([1, 3, 3, 0, 2]))) == [(0, 3, 1), (1, 3, 3), (4, 5, 2)]


def test_substring_words_with_equal_polynomial_hashes_are_different(spark):
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    head = " ".join(f"v{i}" for i in range(12))
    docs = [(1, f"{head} {a}"), (2, f"{head} {b}"), (3, f"{head} {b}")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in
           sub.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: (n, n - len(kept)) for d, (n, kept) in brute.substring(docs).items()}
    assert got[3] == (13, 13)
