"""The cleaning pipeline over `documents`: quality rules, toxicity, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Results are written to the shared folder
between stages. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, ngramjoin, packing, quality, toxicity
from tessera.llm.common import load, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates share this percentage of their n-grams of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled thresholds keep.

    Null, empty and short texts go; equal rows stay or go together; a text of any length is judged whole. A null language is
    a stratum; null ids are judged like others. An empty table gives none. Other columns than those of documents are left out.
    """
    return quality.kept(docs, load(spark, sf_dir, "labels")).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half.

    Null and empty texts score as the labels' average does; equal texts stay or go together; a text of any length is scored
    whole. An empty table gives none. Other columns are left out.
    """
    return toxicity.toxicity(docs.select(*COLUMNS), load(spark, sf_dir, "labels")).where("predicted = 0").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest doc_id, once.

    Null, empty and blank texts are linked with nothing and stay; repeated rows stay once; rows without doc_id stay or go as
    `first_of_each` says. An empty table gives none. Other columns are left out.
    """
    return ngramjoin.first_of_each(docs.select(*COLUMNS), percent=NEAR_PERCENT, n=NEAR_WORDS).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source; null and empty texts have no words, and are drawn like others; repeated rows count each. An
    empty table gives none. Other columns are left out.
    """
    return mixing.taken(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix with their places in sequences.

    Null and empty texts are one piece of one id; long texts are cut; repeated rows are packed each. An empty table gives none.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: A trained classifier, a tokenizer and a linear program are not SQL; a test holds `run` equal to a plain version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over documents, each result written to the shared folder; the rows of the last.

    What a stage does with nulls, empty and very long texts, repeats and an empty table holds for the whole.
    """
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
