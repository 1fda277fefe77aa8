"""Training-data pipeline: toxicity, exact and near duplicates, decontamination, packing.

Every stage takes the documents that the one before it kept and returns those
it keeps, with the same columns; the last returns the pieces of packed
sequences. What a stage decides depends on its own input alone, besides the
labels and the benchmark.

Null texts are empty texts: they are scored, grouped and packed (as the end id
alone) like others. Null ids stay null and are kept by the same rules. Rows
that repeat an id and a text are one group of duplicates. Very long texts are
handled whole. An empty table goes through all stages and gives no pieces;
without labels no document is toxic, without a benchmark none is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.common import table, written
from tripmart.llm.decontaminate import drop_contaminated
from tripmart.llm.exact_dedup import drop_exact, half_by_hash
from tripmart.llm.packing import pack
from tripmart.llm.simhash import drop_near
from tripmart.llm.toxicity import drop_toxic, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a lexicon learned from the labels."""
    return drop_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the most code points, then the smallest id."""
    return drop_exact(docs, half_by_hash())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest id; three-word shingles, two bits."""
    return drop_near(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a fifth of its words."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, in sequences of at most 4096."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the toxicity scores nor the ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
