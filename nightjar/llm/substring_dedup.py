"""Substring deduplication with repeated-phrase automata.

A window is 13 consecutive words of one document. Every word covered by a
window whose word sequence also starts in a document with a smaller doc_id is
removed; windows are judged on the input.

1. Documents with equal word sequences form classes; only the one with the
   smallest doc_id is searched, the others lose everything (if they have a
   window at all).
2. Candidates: the anchor of a window is the smallest of its seven 7-word
   hashes. Anchors seen in two documents (min and max doc_id, combined before
   the shuffle) mark the stretches of text that may recur.
3. Confirmation: the windows of those stretches are counted by 64-bit hash;
   each recurring window belongs to its first document. Runs of such windows
   are the passages, each kept once, as words.
4. Automata: stretches are dealt over shards by document; a shard gets the
   passages that its documents need and compiles them into one Aho-Corasick
   automaton: of a passage the 7-word phrases at every 7th word, of which any
   13-word window holds one whole. Every stretch is streamed through its
   shard's automaton; a hit is extended word by word to the whole match, and
   13 or more equal words are an occurrence. So results rest on words, not on
   hashes.

No step needs more than one document's or one shard's text in a task; a
passage that a third of all documents share is sent once to each shard.

Defined cases: a null text has no words; a row without doc_id has no place in
the order, so it neither loses words nor costs others theirs; rows that repeat
a doc_id are one document (of the same text) and lose nothing to one another;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.llm.tables import CAPACITY, documents, key_filter, map_without, materialize, split_by_keys
from nightjar.llm.textbytes import (blocks, gram_hashes, runs, signed, sliding_min, strings, word_hashes, words)

WINDOW = 13
PHRASE = 7
SHARD_BYTES = 8 << 20
MIN_SHARDS = 48


def _windows(values: np.ndarray, bounds: np.ndarray, window: int, phrase: int):
    """(first word, anchor, hash) of every window inside one row."""
    n = len(values) - window + 1
    if n <= 0:
        z = np.zeros(0, dtype=np.uint64)
        return np.zeros(0, dtype=np.int64), z, z
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    anchor = sliding_min(gram_hashes(values, phrase), window - phrase + 1)
    whole = gram_hashes(values, window)
    at = np.flatnonzero(row[:n] == row[window - 1:])
    return at, anchor[at], whole[at]


def _read(b, window, phrase):
    w = words(b)
    h = word_hashes(b.data, w.start, w.end)
    at, anchor, whole = _windows(h, w.bounds, window, phrase)
    return w, at, anchor, whole


def word_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha (words joined by one space)."""

    def run(batches):
        for batch in batches:
            for b in blocks(batch.column(1)):
                w = words(b)
                tokens = strings(b.data, w.start, w.end)
                e = w.bounds.tolist()
                sha = [hashlib.sha256(b" ".join(tokens[i:j])).hexdigest() for i, j in zip(e, e[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.lo, b.hi - b.lo), pa.array(np.diff(w.bounds), pa.int64()),
                     pa.array(sha, pa.string())], names=["doc_id", "n_words", "sha"])

    return documents(docs).mapInArrow(run, "doc_id long, n_words long, sha string")


def _anchors(docs: DataFrame, gone: DataFrame, n_gone: int, window: int, phrase: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1)):
                w, at, anchor, _ = _read(b, window, phrase)
                if len(at):
                    row = w.row[at]
                    new = np.ones(len(at), dtype=bool)
                    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(anchor[new])), pa.array(ids[b.lo + row[new]], pa.int64())],
                        names=["key", "doc_id"])

    return map_without(docs, gone, n_gone, run, "key long, doc_id long")


def _stretches(docs: DataFrame, gone: DataFrame, n_gone: int, shared: DataFrame, window: int,
               phrase: int) -> DataFrame:
    """doc_id, first word, text of the runs of windows with a shared anchor."""
    n = shared.count()
    if n > CAPACITY:
        return _joined_stretches(docs.join(gone, "doc_id", "left_anti").select("doc_id", "text"), shared, window,
                                 phrase)
    f = key_filter(shared, n)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1)):
                w, at, anchor, _ = _read(b, window, phrase)
                if not len(at):
                    continue
                maybe = np.zeros(len(w.start), dtype=bool)
                maybe[at[f.contains(anchor)]] = True
                yield _stretch_batch(b, w, maybe, ids, window)

    return map_without(docs, gone, n_gone, run, "doc_id long, first long, text string")


def _stretch_batch(b, w, maybe, ids, window):
    """Stretches of the block whose windows start at the words in ``maybe``."""
    row = w.row
    cut = np.zeros(len(maybe) + 1, dtype=bool)
    cut[w.bounds] = True
    # Split runs at the borders of rows.
    s = np.flatnonzero(maybe & (~np.concatenate(([False], maybe[:-1])) | cut[:-1]))
    e = np.flatnonzero(maybe & (~np.concatenate((maybe[1:], [False])) | cut[1:])) + window
    out = []
    tokens = strings(b.data, w.start, w.end) if len(s) else []
    for x, y in zip(s.tolist(), e.tolist()):
        out.append(b" ".join(tokens[x:y]).decode("utf-8"))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[b.lo + row[s]], pa.int64()), pa.array(s - w.bounds[row[s]], pa.int64()),
         pa.array(out, pa.string())], names=["doc_id", "first", "text"])


def _joined_stretches(reps, shared, window, phrase):
    """The same by a join, for more shared anchors than a filter holds."""
    def places(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1)):
                w, at, anchor, _ = _read(b, window, phrase)
                row = w.row[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[b.lo + row], pa.int64()), pa.array(at - w.bounds[row], pa.int64()),
                     pa.array(signed(anchor))], names=["p_doc", "p_first", "p_key"])

    hits = (reps.mapInArrow(places, "p_doc long, p_first long, p_key long")
            .join(shared, F.col("p_key") == F.col("key"), "left_semi")
            .groupBy("p_doc").agg(F.sort_array(F.collect_list("p_first")).alias("at")))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            ats = batch.column(2).to_pylist()
            for b in blocks(batch.column(1)):
                w = words(b)
                maybe = np.zeros(len(w.start), dtype=bool)
                for i in range(b.lo, b.hi):
                    maybe[w.bounds[i - b.lo] + np.array(ats[i], dtype=np.int64)] = True
                yield _stretch_batch(b, w, maybe, ids, window)

    return (reps.join(hits, F.col("doc_id") == F.col("p_doc")).select("doc_id", "text", "at")
            .mapInArrow(run, "doc_id long, first long, text string"))


def _occurrences(stretches: DataFrame, window: int, phrase: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for b in blocks(batch.column(1)):
                w, at, _, whole = _read(b, window, phrase)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(whole)), pa.array(ids[b.lo + w.row[at]], pa.int64())],
                        names=["win", "doc_id"])

    return stretches.select("doc_id", "text").mapInArrow(run, "win long, doc_id long")


def _passages(stretches: DataFrame, recurring: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc_id and text of every passage, in the document it starts in first."""
    mine = recurring.groupBy(F.col("first_doc").alias("f_doc")).agg(F.collect_list("win").alias("wins"))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            wins = batch.column(2)
            docs, texts = [], []
            for b in blocks(batch.column(1)):
                w, at, _, whole = _read(b, window, phrase)
                edge = np.searchsorted(at, w.bounds)
                tokens = strings(b.data, w.start, w.end)
                for i in range(b.hi - b.lo):
                    sel = at[edge[i]:edge[i + 1]]
                    h = signed(whole[edge[i]:edge[i + 1]])
                    keep = np.isin(h, np.asarray(wins[b.lo + i].values.to_numpy(zero_copy_only=False)))
                    # A window that this stretch repeats is kept once.
                    once = np.zeros(len(h), dtype=bool)
                    once[np.unique(h, return_index=True)[1]] = True
                    s, e = runs(keep & once)
                    for x, y in zip(s.tolist(), e.tolist()):
                        docs.append(int(ids[b.lo + i]))
                        texts.append(b" ".join(tokens[sel[x]:sel[y - 1] + window]).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(texts, pa.string())],
                                             names=["f_doc", "passage"])

    return (stretches.join(mine, F.col("doc_id") == F.col("f_doc")).select("doc_id", "text", "wins")
            .mapInArrow(run, "f_doc long, passage string"))


class PhraseAutomaton:
    """Aho-Corasick automaton over word numbers, of the phrases at every
    ``phrase``-th word of the passages."""

    def __init__(self, passages, window: int = WINDOW, phrase: int = PHRASE):
        self.window, self.vocab = window, {}
        self.docs, self.words = [], []
        places: dict[tuple, list] = {}
        number = self.vocab.setdefault
        for doc, text in passages:
            ids = [number(x, len(self.vocab) + 1) for x in text.split(" ")]
            p = len(self.words)
            self.docs.append(doc)
            self.words.append(ids)
            for at in range(0, len(ids) - phrase + 1, phrase):
                places.setdefault(tuple(ids[at:at + phrase]), []).append((p, at))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in places.items():
            self.automaton.add_word(key, found)
        if places:
            self.automaton.make_automaton()
        self.phrase, self.empty = phrase, not places

    def occurrences(self, doc: int, text: str):
        """(start, end) word ranges of ``text`` that hold a passage's words,
        13 or more, from a document before ``doc``."""
        if self.empty:
            return []
        ids = [self.vocab.get(x, 0) for x in text.split(" ")]
        n, done, out = len(ids), {}, []
        for last, found in self.automaton.iter(tuple(ids)):
            start = last - self.phrase + 1
            for p, at in found:
                if self.docs[p] >= doc:
                    continue
                diagonal = (p, start - at)
                if done.get(diagonal, -1) >= last:
                    continue
                own = self.words[p]
                lo, q = start, at
                while lo > 0 and q > 0 and ids[lo - 1] == own[q - 1]:
                    lo -= 1
                    q -= 1
                hi, q = last + 1, at + self.phrase
                while hi < n and q < len(own) and ids[hi] == own[q]:
                    hi += 1
                    q += 1
                done[diagonal] = hi - 1
                if hi - lo >= self.window:
                    out.append((lo, hi))
        return out


def _stream(window: int, phrase: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        doc, start, end = [], [], []
        if len(left) and len(right):
            a = PhraseAutomaton(zip(right["f_doc"], right["passage"]), window, phrase)
            for d, first, text in zip(left["doc_id"], left["first"], left["text"]):
                for lo, hi in a.occurrences(d, text):
                    doc.append(d)
                    start.append(first + lo)
                    end.append(first + hi)
        return pd.DataFrame({"doc_id": pd.Series(doc, dtype="int64"), "start": pd.Series(start, dtype="int64"),
                             "end": pd.Series(end, dtype="int64")})

    return run


def repeated_spans(docs: DataFrame, classes: DataFrame | None = None, window: int = WINDOW,
                   phrase: int = PHRASE) -> tuple[DataFrame, DataFrame]:
    """(spans, copies). Spans: doc_id and word ranges [start, end) of text
    that starts in an earlier document too, for the first document of each
    class of equal texts. Copies: doc_id of the other documents of a class."""
    spark = docs.sparkSession
    if classes is None:
        classes = materialize(word_classes(docs), "op4-classes")
    first = classes.groupBy(F.col("sha").alias("c_sha")).agg(F.min("doc_id").alias("c_first"))
    copies = (classes.join(first, F.col("sha") == F.col("c_sha")).where(F.col("doc_id") > F.col("c_first"))
              .select("doc_id", "n_words").distinct())
    copies = materialize(copies, "op4-copies")
    known = documents(docs).where(F.col("doc_id").isNotNull())
    gone, n_gone = copies.select("doc_id"), copies.count()
    shared = (_anchors(known, gone, n_gone, window, phrase).groupBy("key")
              .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key"))
    shared = materialize(shared, "op4-anchors")
    stretches = materialize(_stretches(known, gone, n_gone, shared, window, phrase), "op4-stretches")
    seen = materialize(_occurrences(stretches, window, phrase), "op4-windows")
    recurring = materialize(seen.groupBy("win").agg(F.min("doc_id").alias("first_doc"),
                                                    F.max("doc_id").alias("last_doc"))
                            .where("first_doc < last_doc").select("win", "first_doc"), "op4-recurring")
    passages = materialize(_passages(stretches, recurring, window, phrase), "op4-passages")
    size = stretches.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(MIN_SHARDS, -(-size // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    needs = (seen.join(recurring.withColumnRenamed("win", "r_win"), F.col("win") == F.col("r_win"))
             .where(F.col("doc_id") > F.col("first_doc"))
             .select("first_doc", shard.alias("shard")).distinct())
    right = (passages.join(needs, F.col("f_doc") == F.col("first_doc")).select("shard", "f_doc", "passage"))
    spans = (stretches.withColumn("shard", shard).groupBy("shard").cogroup(right.groupBy("shard"))
             .applyInPandas(_stream(window, phrase), "doc_id long, start long, end long"))
    return spans.distinct(), copies


def _per_document(spans: DataFrame) -> DataFrame:
    return spans.groupBy(F.col("doc_id").alias("s_doc")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def covered(spans, n: int) -> np.ndarray:
    """Mask of n positions under [start, end) spans."""
    return covered_by(np.array([s["start"] for s in spans], dtype=np.int64),
                      np.array([s["end"] for s in spans], dtype=np.int64), n)


def covered_by(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    depth = (np.bincount(np.minimum(start, n), minlength=n + 1)
             - np.bincount(np.minimum(end, n), minlength=n + 1))
    return np.cumsum(depth[:-1]) > 0


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one
    space; null where nothing was removed), kept_sha256."""
    phrase = window - window // 2
    classes = materialize(word_classes(docs), "op4-classes")
    spans, copies = repeated_spans(docs, classes, window, phrase)
    spans = materialize(_per_document(spans), "op4-spans")
    gone = copies.where(F.col("n_words") >= window).select("doc_id")
    none = hashlib.sha256(b"").hexdigest()
    touched = spans.select(F.col("s_doc").alias("doc_id"))
    dropped = gone.withColumn("_gone", F.lit(True))
    base = (classes.join(touched.withColumn("_cut", F.lit(True)), "doc_id", "left")
            .join(dropped, "doc_id", "left"))
    whole = base.where(F.col("_cut").isNull()).select(
        "doc_id", "n_words", F.when(F.col("_gone"), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("_gone"), F.lit("")).alias("kept"),
        F.when(F.col("_gone"), F.lit(none)).otherwise(F.col("sha")).alias("kept_sha256"))
    _, maybe = split_by_keys(documents(docs), "doc_id", touched, touched.count())
    cut = maybe.join(spans, F.col("doc_id") == F.col("s_doc")).select("doc_id", "text", "spans")
    return whole.unionByName(cut.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, "
                                                  "kept string, kept_sha256 string"))


def _cut(batches):
    for batch in batches:
        spans = batch.column(2).to_pylist()
        for b in blocks(batch.column(1)):
            w = words(b)
            tokens = strings(b.data, w.start, w.end)
            out = []
            for i in range(b.hi - b.lo):
                own = tokens[w.bounds[i]:w.bounds[i + 1]]
                off = covered(spans[b.lo + i], len(own))
                text = b" ".join(t for t, x in zip(own, off.tolist()) if not x)
                out.append((len(own), int(off.sum()), text.decode("utf-8"), hashlib.sha256(text).hexdigest()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(b.lo, b.hi - b.lo), pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])
