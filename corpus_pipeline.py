"""From raw documents to packed training sequences: five stages, each over all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Models
are trained on the labels and documents of sf_dir, so that a stage judges by the same rules whatever is left of the corpus.
Null texts are rejected by the rules as texts without words; an empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from offerloom.llm import grades, nearjoin, packing, pii, rules
from offerloom.llm.common import saved, table

SURROGATE_KEY = "offerloom"
VOCABULARY = "byte_bpe_50k.json"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are more likely of the top grade than not."""
    model = grades.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return grades.score(docs, model).filter("selected").select(docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base limits and the learned decision list."""
    learned = rules.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rules.judge(docs, learned).filter("kept").select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of copies and near copies."""
    return nearjoin.one_of_each(docs).select(docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, personal data replaced by surrogates."""
    return pii.replace(docs, SURROGATE_KEY).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near-duplicate join", keep_one_of_each),
    ("personal data", replace_personal_data),
    ("packing", pack),
]

#: Trained models, similarity classes and tokenizers can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
