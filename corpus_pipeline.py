"""A training-data pipeline over ``documents``: five stages, each one of the operators in ``captureframe.llm``.

Each stage works on all rows that the one before kept; its result is written as Parquet in the shared folder and read again. All but the last
return the columns of ``documents``; the last returns the packed pieces. Rows are whole documents throughout: null texts and ids are defined
by the operators, and extra columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captureframe.llm import decontaminate, line_templates, packing, simhash, toxicity
from captureframe.llm.shared import columns_of, read_table, unused, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives a score of 0.5 or more go."""
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "score")
    return toxicity.scored(docs, model, score).where(F.col(score) < 0.5).select(*columns_of(docs))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; n_chars follows the text."""
    out = line_templates.drop_recurring(docs, names=tuple(unused(docs, "n_lines", "n_dropped"))).select(*columns_of(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8 or more) one document stays."""
    return simhash.one_per_group(docs, shingle=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.without_matches(docs, read_table(spark, sf_dir, "benchmark"), width=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 4096 tokens."""
    return packing.best_fit(docs, capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Learned scores, hashes and packing have no SQL. tests/llm holds line templates, near copies and decontamination against brute-force versions of
#: their definitions, packing against its invariants, toxicity against planted words, and the stages in a row against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
