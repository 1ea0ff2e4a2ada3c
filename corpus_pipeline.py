"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns of documents; the
last returns doc_id, source, lang, n_tokens, ids_sha256, decoded_sha256 and ids.  The mix gives a document once for
each pass over its source, with the words that the pass takes, so an id can come up twice in the last stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import bpe, mixing, neardup, recompress, toxicity
from framelake.llm.common import free_prefix, in_order, key, remainder, table, written
from framelake.llm.queries import vocabulary

#: Percent of shared shingles from which documents count as near-duplicates here.
SIMILAR = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity score is below the threshold; null and empty texts have a score too."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return docs.where(toxicity.probability(model, "text") < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text, that of the smallest id, of each group of near-duplicates; of rows that repeat its id and text, the first by all columns.

    Texts without words are alike to none and stay, once for each id and text.
    """
    p = free_prefix(docs)
    kept = neardup.representatives(docs, percent=SIMILAR).select(F.col("k").alias(f"{p}k"), F.col("t").alias(f"{p}t"))
    rows = docs.withColumns({f"{p}k": key(), f"{p}t": F.xxhash64("text")}).join(kept, [f"{p}k", f"{p}t"], "left_semi")
    return rows.groupBy(f"{p}k", f"{p}t").agg(F.min_by(F.struct(*docs.columns), in_order(docs, ("doc_id", "text"))).alias(f"{p}row")).select(f"{p}row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words that are covered by 20-word windows that start earlier; documents without such words stay as they are, null texts too."""
    p = free_prefix(docs)
    out = recompress.deduped(docs, names=(f"{p}words", f"{p}removed", f"{p}kept")).withColumn("text", F.when(F.col(f"{p}removed") == 0, F.col("text")).otherwise(F.col(f"{p}kept")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a document for each pass; texts without words are in none."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; null texts are empty."""
    return bpe.encoded(docs, vocabulary(), keep=("doc_id", "source", "lang"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mix", mix_sources),
    ("bpe", to_tokens),
]

#: Stages 1, 4 and 5 can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
