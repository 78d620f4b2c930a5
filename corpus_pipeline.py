"""A training corpus from ``documents``: five stages, each one of the
operators of ``nightjar.llm``.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and
returns a DataFrame; it is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns of ``docs``.

Defined cases: a null text counts as empty; rows without a doc_id are kept by
the near-duplicate and substring stages; an empty table passes through;
columns beyond those of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightjar.operators.lineage import materialize, written_mark


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    from nightjar.llm.tables import table
    from nightjar.llm.toxicity import drop_toxic, train

    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays, the longest."""
    from nightjar.llm.exact_dedup import drop_copies

    return drop_copies(docs)


def _boxed(docs: DataFrame) -> DataFrame:
    """doc_id and the whole row, so that no column's name can clash."""
    return docs.select("doc_id", F.struct("*").alias("row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the smallest doc_id."""
    from nightjar.llm.simhash import near_duplicates
    from nightjar.llm.tables import split_by_keys

    found = near_duplicates(docs)
    gone = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-gone")
    alone, maybe = split_by_keys(_boxed(docs), "doc_id", gone, gone.count())
    kept = maybe.join(gone.withColumnRenamed("doc_id", "gone"), F.col("doc_id") == F.col("gone"), "left_anti")
    return (kept if alone is None else alone.unionByName(kept)).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document of which
    nothing is left goes. Other documents keep their text as it is."""
    from nightjar.llm import substring_dedup as op
    from nightjar.llm.tables import split_by_keys

    cut = op.substring_dedup(docs).where("n_removed > 0").select(F.col("doc_id").alias("cut_id"), "kept")
    cut = materialize(cut, "substring-cut")
    ids = cut.select(F.col("cut_id").alias("doc_id"))
    alone, maybe = split_by_keys(_boxed(docs), "doc_id", ids, ids.count())
    changed = maybe.join(cut, F.col("doc_id") == F.col("cut_id"), "left").where("kept IS NULL OR kept <> ''")
    row, kept, cols = F.col("row"), F.col("kept"), []
    for f in docs.schema:
        own = row.getField(f.name)
        if f.name == "text":
            own = F.coalesce(kept, own)
        elif f.name == "n_chars":
            own = F.when(kept.isNull(), own).otherwise(F.char_length(kept)).cast(f.dataType)
        cols.append(own.alias(f.name))
    changed = changed.select(*cols)
    return changed if alone is None else alone.select("row.*").unionByName(changed)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2,048, packed by best fit."""
    import public_tokenizers

    from nightjar.llm.packing import pack

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("substring dedup", substring_dedup), ("best-fit packing", packing)]

#: No stage but exact deduplication has a SQL form; the tests compare run()
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The scratch tables of a stage are
    deleted once its result is written."""
    from nightjar.llm.tables import table

    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        mark = written_mark()
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(out, f"pipeline-{i}", after=mark)
    return out
