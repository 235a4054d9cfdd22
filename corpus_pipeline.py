"""A corpus pipeline of five stages over ``documents``: from raw texts to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.staging import staged
from strandline.llm import jaccard, langid, mixing, packing, pii
from strandline.llm.textbytes import free_name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language holds at least half of them stay; a missing label is filled in.

    Learned from the labelled documents that are not held out. Texts that are null or without a letter go;
    repeated rows are judged apart; an empty table, or one without any label, gives an empty one. Columns that
    are not those of documents, whatever their names, stay as they are.
    """
    langs, model = langid.fit(docs.where(~langid.held_out()))
    best, score, shares = names = tuple(free_name(docs, n) for n in ("lang_pred", "score", "proportions"))
    seen = langid.predict(docs, langs, model, names=names).where((F.col(best) != "und") & (F.col(score) >= 0.5))
    return seen.withColumn("lang", F.coalesce("lang", best)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle Jaccard similarity 0.8 or more stays: that of the least doc_id.

    Null, empty and wordless texts are like nothing and stay, apart from repeated rows alike in doc_id and text,
    of which one stays if it has words. Other columns stay as they are.
    """
    return jaccard.one_of_each(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in angle brackets, and n_chars follows the text.

    Null and empty texts stay, repeated rows are masked apart, other columns stay as they are.
    """
    return pii.masked(docs, pii.train(pii.labelled_table(spark)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, the last one of a source in part.

    Null and empty texts have no words and are never taken; null is a source of its own; which of equal rows is
    cut is of no matter; other columns stay as they are.
    """
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048. A null text has the end id alone; copies differ by doc_row."""
    return packing.harmonic_packing(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("packing", packed)]

#: SQL can express none of language inference, CRF decoding and tokenising: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
