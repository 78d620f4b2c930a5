import hashlib
import os
import random
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from nightjar.llm import queries  # noqa: E402
from nightjar.llm.periodic_runs import periodic_runs, row_runs  # noqa: E402


def own(rows, least):
    tokens = np.array([x for r in rows for x in r], dtype=np.int64)
    bounds = np.cumsum([0] + [len(r) for r in rows])
    out = [[] for _ in rows]
    for row, *found in zip(*(x.tolist() for x in row_runs(tokens, bounds, least))):
        out[row].append(tuple(found))
    return out


def thue_morse(k):
    s = [0]
    for _ in range(k):
        s = s + [1 - x for x in s]
    return s


def rows():
    r = random.Random(3)
    a, b = [0], [0, 1]
    for _ in range(12):
        a, b = b, b + a
    out = [thue_morse(10), thue_morse(10) * 2, b, [0] * 300, [0, 1] * 50 + [0] + [0, 1] * 60, ([0] * 30 + [1]) * 9,
           ([0, 1] * 20 + [0]) * 7 + [1] * 5, [], [0], ([0, 0, 1] * 15 + [0]) * 8 + [2] + ([0, 0, 1] * 15 + [0]) * 3]
    for _ in range(150):
        k = r.choice([1, 2, 3, 5])
        out.append([r.randrange(k) for _ in range(r.randint(0, 200))])
    for _ in range(300):                                  # powers of powers, with and without a break
        u = [r.randrange(2) for _ in range(r.randint(1, 4))]
        for _ in range(r.randint(1, 4)):
            if len(u) < 300:
                u = u * r.randint(1, 9) + [r.randrange(3) for _ in range(r.randint(0, 2))]
        out.append(u[r.randint(0, 3):])
    return out


def test_all_runs_equal_brute_force():
    texts = rows()
    for least in (2, 12):
        assert own(texts, least) == [brute.runs(t, least) for t in texts]


def test_stretches_with_equal_hashes_are_compared_word_by_word():
    # A Thue-Morse sequence and its complement have equal polynomial hashes.
    t = thue_morse(11)
    text = [*t, *[1 - x for x in t], 5, *t, *t, 6]
    assert own([text], 12) == [brute.runs(text, 12)]


def test_words_spans_and_odd_rows(spark):
    def doc(n):
        return " ".join(["x", "y z"[n % 2], *["é", "b", "c"] * n, "b"])

    data = [(1, doc(9)), (1, doc(9)), (2, None), (3, ""), (None, "q " * 30), (4, " \t\n"), (5, "a\x0bb\x0c" * 9),
            (6, "a b " * 12), (7, "one two")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS runs", "'k' AS collapsed")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect()),
                 key=str)
    want = sorted(((d, *brute.periodic(brute.words(t))) for d, t in data), key=str)
    assert got == want
    assert periodic_runs(df.limit(0)).collect() == []


def test_a_very_long_text(spark):
    r = random.Random(1)
    head = [str(r.randrange(50)) for _ in range(150_000)]
    text = head + head[-60_000:] + ["end"] * 40
    (got,) = periodic_runs(spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")).collect()
    found = [tuple(x) for x in got.runs]
    assert len(" ".join(text)) > 500_000 and (90_000, 120_000, 60_000) in found and (210_000, 40, 1) in found
    for start, length, period in found:
        own_ = text[start:start + length]
        assert own_[:-period] == own_[period:]


def test_query_equals_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, sf).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert len(got) == len(docs)
    changed = 0
    for d, text in docs:
        w = brute.words(text)
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
            changed += 1
        _, found, collapsed = brute.periodic(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert got[d] == (len(found), *best, 1000 * best[1] // best[2] if found else None,
                          hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())
    assert changed
