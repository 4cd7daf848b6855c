"""The corpus pipeline: documents pass five stages, each written and read again by the next.

1. quality rules: failing lines leave the text, documents that fail as a whole go;
2. n-gram Jaccard join (five words, 0.8): of each group the document with the smallest id stays;
3. benchmark decontamination: documents that overlap with a benchmark item go;
4. mixing: documents with a stated share of all tokens are sampled so that sources, languages and
   topics meet their targets as far as there is text;
5. sharding: each document gets its shard and its slot.
"""

from pyspark.sql import DataFrame, SparkSession

from reelstat.llm import decontaminate, jaccard, mixing, quality, shards
from reelstat.llm.common import table
from reelstat.session import written

N_SHARDS = 40
#: Share of the tokens that mixing keeps.
KEPT = 0.6


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, budget=KEPT)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard_documents(docs, N_SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_to_targets),
    ("sharding", sharding),
]

#: SQL can't express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages, with ``shard`` and ``slot``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
