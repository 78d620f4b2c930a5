"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The most frequent words of the corpus are compiled with their ids into a
transducer (``lexicon``); texts are cut into words, lexicon words get their
ids by walking it, all others are merged exactly (``bpe``). The ids equal
those of the tokenizers library; the lexicon only saves merges.

Words are counted over the whole corpus, every occurrence; a task's counts
are combined before the shuffle. The sums rank the words and the first
MAX_WORDS enter the lexicon (a fixed bound, so the driver and the broadcast
are bounded too).

Defined cases: a null text is empty and has no ids; a special token's string
inside a text is that token; repeated rows are encoded like any other; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightjar.llm.bpe import model
from nightjar.llm.lexicon import MAX_WORDS, compile_lexicon, opened
from nightjar.llm.tables import documents, materialize, partitions
from nightjar.llm.textbytes import blocks, strings, word_ids

_BLOCK = 1 << 20


def _texts(b) -> list[str]:
    raw = b.data.tobytes()
    edge = b.offsets.tolist()
    return [raw[s:e].decode("utf-8") for s, e in zip(edge, edge[1:])]


def frequent_words(docs: DataFrame, path: str, limit: int = MAX_WORDS) -> list[bytes]:
    def run(batches):
        bpe = model(path)
        for batch in batches:
            for b in blocks(batch.column(1), _BLOCK):
                pieces = [bpe.normalise(p) for t in _texts(b) for p in bpe.special_re.split(t)]
                data, s, e, _ = bpe.split(pieces)
                if not len(s):
                    continue
                which, first = word_ids(data, s, e)
                n = np.bincount(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(strings(data, s[first], e[first]), pa.binary()), pa.array(n, pa.int64())],
                    names=["word", "n"])

    counted = (documents(docs).select(F.lit(0), "text").mapInArrow(run, "word binary, n long")
               .groupBy("word").agg(F.sum("n").alias("n")))
    return [bytes(r.word) for r in _first_rows(materialize(counted, "op6-counts"), limit).collect()]


def _first_rows(counted: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most frequent words, ties in byte order: range-sorted on
    the executors, so no more than these reach the driver."""
    order = [F.col("n").desc(), F.col("word")]
    ranked = (counted.repartitionByRange(partitions(counted.sparkSession), *order).sortWithinPartitions(*order)
              .withColumn("at", F.monotonically_increasing_id()))
    ranked = materialize(ranked, "op6-ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    left, keep = limit, F.lit(False)
    for r in ranked.groupBy(part.alias("p")).count().orderBy("p").collect():     # a row a partition
        keep = keep | ((part == r.p) & (place < left)) if left > 0 else keep
        left -= r["count"]
    return ranked.where(keep).orderBy("at")


def encode(docs: DataFrame, path: str, limit: int = MAX_WORDS, decoded: bool = False) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit integers); with
    ``decoded`` also the text decoded from them, by the same worker."""
    raw = compile_lexicon(frequent_words(docs, path, limit), model(path))
    shared = docs.sparkSession.sparkContext.broadcast(raw)
    name = uuid.uuid4().hex

    def run(batches):
        bpe, lexicon = model(path), opened(name, shared.value)
        for batch in batches:
            for b in blocks(batch.column(1), _BLOCK):
                r = bpe.encode(_texts(b), lexicon)
                flat = r.flat.astype("<u4").tobytes()
                edge = (r.bounds * 4).tolist()
                ids = [flat[s:e] for s, e in zip(edge, edge[1:])]
                cols = [batch.column(0).slice(b.lo, b.hi - b.lo), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array([_decoded(bpe, x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"][:len(cols)])

    return documents(docs).mapInArrow(run, "doc_id long, ids binary" + ", decoded binary" * decoded)


def _decoded(bpe, ids: bytes) -> bytes:
    return bpe.decode(np.frombuffer(ids, dtype="<u4")).decode("utf-8", "replace").encode()


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded text as UTF-8 bytes; special tokens are
    written out, bytes that are no UTF-8 become the replacement character."""

    def run(batches):
        bpe = model(path)
        for batch in batches:
            out = [_decoded(bpe, x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the round trip."""
    back = encode(docs, path, decoded=True)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
