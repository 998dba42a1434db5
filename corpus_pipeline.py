"""A training-data pipeline over ``documents``: toxicity, near duplicates, personal data, packing.

Every stage takes all that the one before it kept, as Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelforge.llm import ngram_join, packing, pii, toxicity
from panelforge.llm.queries import HELD_OUT
from panelforge.llm.store import freeze, read_documents, small, tidy

REJECT = 0.7
DROPPED_ROWS = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.7, all columns unchanged.

    The model learns from the labelled ones among ``docs`` that are not held out.  Null texts and texts without words stay
    whatever the model says, as they hold no evidence; repeated rows are judged alike, and an empty table stays empty.
    """
    model = toxicity.fit(docs, read_documents(spark, sf_dir, "labels"), f"not {HELD_OUT}")
    whole = docs.select(F.struct(*docs.columns).alias("row"), docs["text"].alias("text"))
    wordless = ~F.coalesce(F.col("row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return toxicity.score(whole, model, keys=("row",)).where((F.col("score") < REJECT) | wordless).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one of the smallest doc_id, and of rows that repeat it
    the first.  Texts without words link with nothing and stay, all columns unchanged; an empty table stays empty."""
    tidy(spark)
    # Frozen with the number: one that every scan gives anew would follow the splits of that scan.
    numbered = freeze(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select(F.struct("doc_id", "__row").alias("key"), "text")
    groups = ngram_join.near_duplicates(keyed, key="key")
    dropped = freeze(groups.where("doc_id <> component_id").select(F.col("doc_id.__row").alias("__row")), "dropped")
    return numbered.join(small(dropped, DROPPED_ROWS), "__row", "left_anti").select(*docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their entities generalised and disclosing terms removed; ``n_chars`` follows the new text.
    Null texts stay null."""
    tidy(spark)
    whole = docs.select(F.struct(*docs.columns).alias("row"), docs["text"].alias("text"))
    found = pii.find(whole, keep=("row",))
    found = found.withColumn("text", pii.sanitised(F.col("row.text"), F.col("spans")))
    new = {"text": F.col("text"), "n_chars": F.when(F.size("spans") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2048 tokens: ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``, ``ids`` as
    little-endian unsigned 32-bit integers."""
    tidy(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("pii", sanitise), ("packing", pack)]

#: Tokenizing, the fitted model and the join by shingles have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to Parquet and read again as the next one's input."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
