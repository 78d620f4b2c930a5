import os
import random
import struct
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from nightjar.llm import packing  # noqa: E402
from nightjar.llm.bpe import model  # noqa: E402
from nightjar.llm.bpe_codec import decode, digests, encode, frequent_words  # noqa: E402
from nightjar.llm.lexicon import Lexicon, compile_lexicon, minimal_automaton  # noqa: E402

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "b", "Z", "é", "É", "ß", "İ", "Σ", "ς", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\u00a0", "\u3000",
          "'", "''", "'s", "'ll", "'re", "'ve", "'m", "'d", "'t", "'S", "1", "23", "½", "Ⅷ", "!", "?!", "中文", "é",
          "한", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|", "the", "don", "ing", "\x00", "ﬁ", "a" * 60]


def texts(n=400):
    r = random.Random(5)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["", " ", "x" * 3000]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(path):
    library, own = Tokenizer.from_file(path), model(path)
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    r = own.encode(texts())
    assert [r.flat[s:e].tolist() for s, e in zip(r.bounds, r.bounds[1:])] == want


def test_lexicon_is_minimal_and_maps_words_to_ranks():
    words = sorted({w.encode() for w in ["tap", "taps", "top", "tops", "stop", "stops", "é"]})
    arcs, final = minimal_automaton(words)
    used = {0}
    todo = [0]
    while todo:
        for t in arcs[todo.pop()].values():
            if t not in used:
                used.add(t)
                todo.append(t)
    right = set()
    for s in used:                                             # no two states accept the same endings
        def endings(x):
            return frozenset(([b""] if final[x] else []) +
                             [bytes([b]) + y for b, t in arcs[x].items() for y in endings(t)])
        right.add(endings(s))
    assert len(right) == len(used)
    lex = Lexicon(compile_lexicon(words, model(BYTE)))
    probe = words + [b"to", b"tapsx", b"zz"]
    data = np.frombuffer(b"".join(probe), dtype=np.uint8)
    edge = np.concatenate(([0], np.cumsum([len(p) for p in probe])))
    assert lex.find(data, edge[:-1], edge[1:]).tolist() == [*range(len(words)), -1, -1, -1]


def test_codec_round_trip(spark):
    docs = list(enumerate(texts(150))) + [(1000, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, ids int").repartition(3)
    library = Tokenizer.from_file(BYTE)
    want = {}
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)),
                   brute.sha(library.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(df, BYTE).collect()} == want
    back = decode(encode(df, BYTE, limit=10), BYTE)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {d: t or "" for d, t in docs}
    assert digests(df.limit(0), BYTE).count() == 0
    assert frequent_words(spark.createDataFrame([(1, "b b a b")], "doc_id long, text string"), BYTE, 1) == [b" b"]


def test_packing_is_gapless_and_as_good_as_best_fit(spark):
    r = random.Random(8)
    docs = [(i, " ".join(f"{r.randrange(99)}" for _ in range(int(r.expovariate(1 / 40))))) for i in range(300)]
    docs += [(300, None), (301, "7 " * 500), (302, "7 " * 500), (303, "8 " * 99)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = packing.pack(df, WORD, size=100, with_ids=True).collect()
    library = Tokenizer.from_file(WORD)
    want = {}
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 100):
            part = struct.pack(f"<{len(ids[p:p + 100])}I", *ids[p:p + 100])
            want[d, p // 100] = (p, len(part) // 4, zlib.crc32(part), part)
    assert {(x.doc_id, x.piece): (x.start, x.length, x.ids_crc32, bytes(x.ids)) for x in rows} == want
    at = {}
    for x in sorted(rows, key=lambda x: (x.sequence_id, x.offset)):
        assert at.get(x.sequence_id, 0) == x.offset
        at[x.sequence_id] = x.offset + x.length
    assert max(at.values()) <= 100
    assert len(at) <= brute.best_fit([v[1] for v in want.values()], 100) * 1.01 + 1
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_sweep_serves_longer_runs_first():
    placed, left, gaps = packing.sweep([(5, 0, 3), (3, 0, 4)], [(6, 0, 1), (10, 1, 1)], 20)
    assert left == [(3, 0, 4)] and gaps == [(1, 0, 1)]
    assert sorted(placed) == [(5, 0, 1, 0, 1, 14), (5, 1, 2, 1, 2, 10)]


def test_frequent_words_count_every_occurrence(spark):
    """A word that each document has once is the most frequent one, however
    the documents are dealt out."""
    rows = [(i, "often" + (" twice twice" if i == 0 else " only" + "abcdef"[i])) for i in range(6)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    try:
        for size in ("1", "512"):
            spark.conf.set(key, size)
            assert frequent_words(docs, BYTE, 2) == [b"often", b" twice"]
    finally:
        spark.conf.set(key, before)


def colliding(k=10):
    """Two words whose polynomial hashes modulo 2**64 are equal."""
    s = "a"
    for _ in range(k):
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_with_equal_polynomial_hashes_keep_their_own_ids(path, spark):
    a, b = colliding()
    library, own = Tokenizer.from_file(path), model(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in (a, b)]
    for batch in ([a, b], [b], [a]):                       # together, and from the cache
        r = own.encode(batch)
        assert [r.flat[s:e].tolist() for s, e in zip(r.bounds, r.bounds[1:])] == [want[t == b] for t in batch]
    if path == BYTE:
        got = digests(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string").coalesce(1), path).collect()
        assert {r.doc_id: r.decoded_sha256 for r in got} == {1: brute.sha(a), 2: brute.sha(b)}


def test_the_most_frequent_words_are_ranked_on_the_executors(spark):
    from nightjar.llm.bpe_codec import _first_rows
    rows = [(f"w{i:03}".encode(), i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "word binary, n long").repartition(5)
    want = [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for limit in (1, 30, 57, 200, 1000):
        assert [bytes(r.word) for r in _first_rows(df, limit).collect()] == want[:limit]
    assert _first_rows(df.limit(0), 5).collect() == []
