"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The first four
return documents with the columns they came with:

1. language ID: drops texts without letters and texts that no known language is likelier for;
2. quality rules: drops what fails the base rules or is depleted of lines that are its own;
3. n-gram Jaccard join: keeps one document of each group of near duplicates (five-word shingles,
   similarity 0.8 or more), the one of smallest id;
4. benchmark decontamination: drops documents that hold a benchmark item;
5. best-fit packing: packs what is left into sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.decontamination import decontaminate
from tidewatch.llm.folders import written
from tidewatch.llm.jaccard_join import one_of_each
from tidewatch.llm.language import language_filter
from tidewatch.llm.line_frequency import quality_filter
from tidewatch.llm.packing import pack_documents
from tidewatch.llm.queries import table, vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_filter(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary(), capacity=2048, end_id=0)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", packing),
]

#: No stage but the quality rules can be put in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
