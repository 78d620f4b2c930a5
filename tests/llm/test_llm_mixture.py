import collections
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nightjar.llm import queries
from nightjar.llm.mixture_packing import LEAST, Schedule, mixture_pack, plan

WORD = public_tokenizers.path("word_bpe_49k.json")


def check_sequences(rows, size):
    """Offsets are gapless, no sequence is over ``size`` and nothing is padded."""
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    full = sum(r.length for r in rows) // size
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size and at & (at - 1) == 0
    assert len(bins) == full + bin(sum(r.length for r in rows) % size).count("1")


def check_documents(rows, docs, closing=1):
    """Every id of every document lies in one piece; docs: doc_id -> text, all different."""
    library = Tokenizer.from_file(WORD)
    library.no_truncation()
    library.no_padding()
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(docs)
    for d, text in docs.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [closing]
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            part = ids[at:at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("natural", [True, False])
def test_plan_sends_every_token_once_and_fills_windows(natural):
    r = random.Random(int(natural))
    for _ in range(60):
        size = r.choice([16, 64, 2048])
        tokens = [r.choice([0, 1, 5, 100, 3000, 30000]) + r.randint(0, 50) for _ in range(r.randint(1, 9))]
        phases = plan(tokens, list(tokens) if natural else [r.choice([0, 0.1, 0.5, 1.0]) for _ in tokens], size)
        assert len(phases) <= 2 * len(tokens) + 14
        s, windows = Schedule(phases), collections.defaultdict(list)
        for j, n in enumerate(tokens):
            at = 0
            while at < n:
                x = min(n - at, r.randint(1, 3000))
                _, start, length, window, offset = s.pieces(*(np.array([v]) for v in (j, at, x)))
                assert start.tolist() == (np.cumsum(length) - length).tolist() and length.sum() == x
                for w, o, y in zip(window.tolist(), offset.tolist(), length.tolist()):
                    windows[w].append((o, y))
                at += x
        assert sorted(windows) == list(range(sum(tokens) // size + bin(sum(tokens) % size).count("1")))
        for w, spans in windows.items():
            at = 0
            for o, y in sorted(spans):
                assert o == at
                at += y
            assert at == size if w < sum(tokens) // size else at & (at - 1) == 0


def test_every_window_has_the_corpus_proportions_also_with_long_tables():
    """Windows far into a table of 10^13 tokens, whose deficits no task has counted up to."""
    tokens = [3 * 10**12, 10**12 + 7, 5 * 10**12, 10**12 - 5, 12 * 10**9]
    s = Schedule(plan(tokens, tokens))
    total = sum(tokens)
    for share in (0.0, 0.3, 0.9):
        sent = collections.Counter()
        for j, n in enumerate(tokens):
            at = int(n * share)
            # 64 windows from the first one that holds this place
            _, _, length, window, _ = s.pieces(*(np.array([v]) for v in (j, at, 64 * 2048 * n // total + 3)))
            for w, y in zip(window[1:-1].tolist(), length[1:-1].tolist()):
                assert abs(y - 2048 * n / total) < 2
                sent[w] += y
        assert max(sent.values()) <= 2048


def test_query_equals_the_library_and_keeps_the_mixture(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op13_mixture_packing(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    check_sequences(rows, 2048)
    check_documents(rows, {r.doc_id: r.text for r in docs})
    total, source = sum(r.length for r in rows), collections.Counter()
    mix = collections.defaultdict(collections.Counter)
    for r in rows:
        source[r.source] += r.length
        mix[r.sequence_id][r.source] += r.length
    for w in range(total // 2048 - 2):
        assert all(abs(mix[w][s] - 2048 * n / total) <= 2 for s, n in source.items())


def test_targets_hold_until_a_source_is_empty(spark):
    r = random.Random(2)
    data = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 80))), "xyzw"[i % 4]) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    rows = mixture_pack(df, WORD, size=64, targets={"x": 0.5, "y": 0.25}, with_ids=True).collect()
    check_sequences(rows, 64)
    check_documents(rows, {d: t for d, t, _ in data})
    assert all(zlib.crc32(x.ids) == x.ids_crc32 for x in rows)
    mix = collections.defaultdict(collections.Counter)
    for x in rows:
        mix[x.sequence_id]["zw" if x.source in "zw" else x.source] += x.length
    half = sum(x.length for x in rows if x.source == "x") // 32
    for w in range(half - 1):                            # "x" is the first to end
        assert abs(mix[w]["x"] - 32) <= 1 and abs(mix[w]["y"] - 16) <= 1 and abs(mix[w]["zw"] - 16) <= 1


def test_many_small_sources_share_a_queue_and_spread_over_it(spark):
    r = random.Random(4)
    data = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 30))), "big" if i % 3 else f"s{i % 60}")
            for i in range(1500)]
    data += [(2000 + i, "once only", f"single{i}") for i in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(6)
    rows = mixture_pack(df, WORD, size=64, least=LEAST).collect()
    check_sequences(rows, 64)
    check_documents(rows, {d: t for d, t, _ in data})
    total = sum(x.length for x in rows)
    big = sum(x.length for x in rows if x.source == "big")
    mix, halves = collections.Counter(), collections.Counter()
    for x in rows:
        mix[x.sequence_id] += x.length * (x.source == "big")
        halves[x.source, x.sequence_id < total // 128] += x.length
    assert all(abs(mix[w] - 64 * big / total) <= 2 for w in range(total // 64 - 2))
    for s in (f"s{3 * i}" for i in range(20)):
        assert 0.2 < halves[s, True] / (halves[s, True] + halves[s, False]) < 0.8


def test_nulls_long_texts_repeated_rows_and_clashing_columns(spark):
    long = " ".join(str(i) for i in range(40_000))
    data = [(1, None, None), (2, "", ""), (None, "no id", "a"), (None, "no id", "a"), (3, long, "a"), (4, "z", "b")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS n", "2 AS at", "3 AS part", "'x' AS ids", "7 AS place")
    rows = mixture_pack(df, WORD).collect()
    check_sequences(rows, 2048)
    check_documents([x for x in rows if x.doc_id is not None], {d: t for d, t, _ in data if d})
    assert sum(x.length for x in rows if x.doc_id is None) == 6
    assert mixture_pack(df.limit(0), WORD).collect() == []
    rows = mixture_pack(df.where("doc_id > 3").drop("source"), WORD).collect()
    assert [(x.doc_id, x.source, x.length) for x in rows] == [(4, "", 2)]
