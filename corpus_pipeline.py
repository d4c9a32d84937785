"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from periodica.llm.common import read
from periodica.llm.mixing import mixed_documents
from periodica.llm.ngram_join import JaccardRules, deduplicated
from periodica.llm.packing import TOKENIZER, PackRules, pack, token_pieces
from periodica.llm.quality_lines import cleaned
from periodica.llm.toxicity import clean_documents
from periodica.session import delete_path, unique_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the base rules or are depleted, and without over-frequent lines."""
    return cleaned(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents predicted toxic by a model learnt from the labels of those at hand."""
    return clean_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 on five-word shingles."""
    return deduplicated(docs, JaccardRules(words=5, percent=80))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source; a document that it takes twice occurs twice."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents and their places in sequences of 2048 tokens."""
    rules = PackRules()
    return pack(token_pieces(docs, rules, public_tokenizers.path(TOKENIZER)), rules)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

# the chain random field and the packing search have no SQL; tests/llm compares the
# stages with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder, which goes
    as soon as the next one is written. The last one stays."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = unique_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            delete_path(spark, last)
        last = path
    return docs
