"""A training corpus from raw documents: language, toxicity, near duplicates, repeated passages, packing.

Each stage takes the documents that the one before it kept, written as Parquet
and read again, and returns documents of the same columns; the last returns the
pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import cover_dedup, cross_parsing, cutting_stock, simhash_pivots, toxicity_cnn
from tickframe.llm._common import fold, let_workers_import, written

#: No SQL expresses the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but doc_id and text under a reserved name, and what gives the columns their names back.

    So no name that an operator uses or adds can meet a column of the documents.
    """
    names = docs.columns
    inner = [n.lower() if n.lower() in ("doc_id", "text") else f"__column_{i}" for i, n in enumerate(names)]
    return docs.toDF(*inner), lambda found: found.select(*inner).toDF(*names)


#: The best language needs this share of phrases less than the second best.  Where both need about as many (a word or two
#: that several languages have, noise), the language can't be told.
LEAST_SCORE = 0.02
#: Languages that the corpus shall hold; None: all that the labelled documents have.
WANTED_LANGUAGES: list[str] | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: list[str] | None = None) -> DataFrame:
    """Documents in a wanted language (``wanted``, else ``WANTED_LANGUAGES``), as predicted from their text.

    Those go whose language can't be told: without a letter (or without text), or with a score below ``LEAST_SCORE``.
    """
    let_workers_import(spark)
    model = cross_parsing.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    inner, back = set_aside(docs)
    found = cross_parsing.identify(inner, model)
    names = model.languages if (wanted or WANTED_LANGUAGES) is None else (wanted or WANTED_LANGUAGES)
    return back(found.where(F.col("lang_pred").isin(names) & (F.col("score") >= LEAST_SCORE)))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't take for toxic; it learns from labels of four folds in five."""
    let_workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity_cnn.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    inner, back = set_aside(docs)
    return back(toxicity_cnn.score(inner, model).where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    let_workers_import(spark)
    inner, back = set_aside(docs)
    return back(simhash_pivots.one_of_each(inner))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that started earlier; a document that loses all its words goes.

    A text that loses words becomes its other words, joined by one space, and n_chars follows; other texts stay as they are.
    """
    let_workers_import(spark)
    inner, back = set_aside(docs)
    found = cover_dedup.remove_repetitions(inner).where("n_removed < n_words or n_words = 0")
    cut = F.col("n_removed") > 0
    changed = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text"))}
    for name, field in zip(inner.columns, docs.schema.fields, strict=True):
        if field.name == "n_chars":
            changed[name] = F.when(cut, F.length("kept_text")).otherwise(F.col(name)).cast(field.dataType)
    return back(found.withColumns(changed))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    let_workers_import(spark)
    return cutting_stock.pack(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
