"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into ``m`` segments and indexed by each of them. In
round r every open query looks up, in each segment, the values at exactly r
bits from its own. A code within m (r + 1) - 1 bits of the query differs by r
bits or fewer in some segment, so after round r all codes up to that distance
have been seen and verified. A query closes when the distance of its k-th
verified row is within that radius: no unseen row can be nearer, or as near.

Equal codes are one index entry with their k smallest ids (more can never be
among the k nearest, as ties go to the smaller id), so a code that a third of
all rows share costs one entry.

Defined cases: rows with a null id or vector are neither queries nor answers; null
elements count as not positive; a query is among its own answers, at distance
0; ties go to the smaller id; repeated rows of an id are one row; fewer than
k rows give fewer answers; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightjar.llm.tables import materialize

BITS = 64
K = 10
QUERY_STEP = 50


def sign_code(vector: Column) -> Column:
    """Bit i (from the lowest) is 1 where element i mod 64 is positive; longer
    vectors fold by exclusive or."""
    bit = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function(
        "shiftleft", F.lit(1).cast("long"), (i % BITS).cast("int"))).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bit, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def segments_for(n: int) -> int:
    """Segments so that a segment value has about one code."""
    return 8 if n < 1 << 11 else 4 if n < 1 << 22 else 2


def _segment(code: Column, j: int, width: int) -> Column:
    return F.shiftrightunsigned(code, j * width).bitwiseAND(F.lit((1 << width) - 1))


def _index(entries: DataFrame, m: int) -> DataFrame:
    """Each entry once a segment."""
    width = BITS // m
    parts = [F.struct(F.lit(j).alias("seg"), _segment(F.col("code"), j, width).alias("val")) for j in range(m)]
    return entries.select("code", "ids", F.inline(F.array(*parts)))


def _probes(open_: DataFrame, m: int, r: int) -> DataFrame:
    """Segment values at exactly ``r`` bits from those of every open query,
    made on the executors: each step flips one bit above the last one."""
    width = BITS // m
    parts = [F.struct(F.lit(j).alias("p_seg"), _segment(F.col("q"), j, width).alias("p_val")) for j in range(m)]
    out = open_.select("q", "far", F.inline(F.array(*parts))).withColumn("top", F.lit(-1))
    for _ in range(r):
        rest = F.when(F.col("top") < width - 1, F.sequence(F.col("top") + 1, F.lit(width - 1)))
        out = out.withColumn("top", F.explode(rest)).withColumn(
            "p_val", F.col("p_val").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("top"))))
    return out.drop("top")


def _first_met(m: int, r: int) -> Column:
    """Whether (code, q) are met for the first time in round ``r`` and segment
    ``seg``: no segment differs by fewer bits, no earlier one by as few."""
    width = BITS // m
    own = F.lit(True)
    for j in range(m):
        bits = F.bit_count(_segment(F.col("code").bitwiseXOR(F.col("q")), j, width))
        own = own & (bits >= F.when(F.col("seg") > j, r + 1).otherwise(r))
    return own


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of (q, id, dist), ties to the smaller id."""
    w = W.partitionBy("q").orderBy("dist", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(codes: DataFrame, queries: DataFrame, k: int = K, m: int | None = None) -> DataFrame:
    """q (query code), rank, id, dist for ``codes`` (id, code; each id once)
    and ``queries`` (code, distinct).

    The index and the probes meet in a sort-merge join, as both grow with the
    data; a hit farther than the query's k-th so far is dropped before its ids
    are unfolded. Each round writes the answers of the queries that it closes
    and the best so far of the others."""
    w = W.partitionBy("code").orderBy("id")
    few = codes.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)
    entries = materialize(few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "op9-entries")
    n = entries.count()
    m = m or segments_for(n)
    width = BITS // m
    index = materialize(_index(entries, m), "op9-index")
    whole = min(k, entries.select(F.size("ids").alias("n")).agg(F.sum("n")).first()[0] or 0)
    state = materialize(queries.select(F.col("code").alias("q"), F.lit(BITS).alias("far")).distinct(), "op9-queries")
    best, done = None, []
    for r in range(width + 1):
        probes = _probes(state, m, r)
        hits = (index.join(probes.hint("merge"), (F.col("seg") == F.col("p_seg")) & (F.col("val") == F.col("p_val")))
                .where(_first_met(m, r))
                .select("q", "ids", "far", F.bit_count(F.col("code").bitwiseXOR(F.col("q"))).alias("dist"))
                .where("dist <= far").select("q", "dist", F.explode("ids").alias("id")))
        found = hits if best is None else hits.unionByName(best.select("q", "dist", "id"))
        radius = m * (r + 1) - 1
        mine = W.partitionBy("q")
        judged = _best(found, k).withColumns({"n": F.count("id").over(mine), "far": F.max("dist").over(mine)})
        # With fewer than k rows in all, seeing them all is enough.
        closed = (F.col("n") >= whole) & ((F.col("far") <= radius) | F.lit(whole < k)) if r < width else F.lit(True)
        judged = materialize(judged.withColumn("closed", closed), "op9-round")
        done.append(judged.where("closed").select("q", "rank", "id", "dist"))
        best = judged.where("NOT closed")
        seen = judged.where("rank = 1").select(F.col("q").alias("s_q"), "closed", F.when(
            F.col("n") >= k, F.col("far")).otherwise(BITS).alias("s_far"))
        state = materialize(state.join(seen.hint("merge"), F.col("q") == F.col("s_q"), "left")
                            .where("closed IS NULL OR NOT closed")
                            .select("q", F.coalesce("s_far", "far").alias("far")), "op9-open")
        if state.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def search(embeddings: DataFrame, k: int = K, step: int = QUERY_STEP, id_col: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """query_id, rank, id, distance of the k nearest rows of every row whose
    id is divisible by ``step``."""
    codes = embeddings.where(F.col(vector).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), sign_code(F.col(vector)).alias("code"))
    codes = materialize(codes.groupBy("id").agg(F.min("code").alias("code")), "op9-codes")
    asked = codes.where(F.col("id") % step == 0)
    found = top_k(codes, asked.select("code"), k)
    return (asked.select(F.col("id").alias("query_id"), F.col("code").alias("q_code"))
            .join(found.hint("merge"), F.col("q_code") == F.col("q"))
            .select("query_id", "rank", F.col("id").alias("vec_id"), F.col("dist").cast("long").alias("distance")))
