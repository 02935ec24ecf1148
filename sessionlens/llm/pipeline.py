"""The corpus pipeline: toxicity, near duplicates, contamination, mixing, sharding, each over all that the stage before kept.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of documents. run() applies them to documents, each result written as Parquet and read again; what a stage
leaves in the shared folder goes once the next one is written.

Every stage takes nulls in any column, extra columns under any name, empty tables and repeated rows; its docstring says
what comes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm import decontam, mixing, near_dup, sharding
from sessionlens.llm import toxicity as tox
from sessionlens.llm.common import disposable, hash128, table, with_package, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject. Every row is judged by its text alone, so repeated rows and ties
    fare alike; a null text has no words and stays. Labels are the table's, whose documents train if they are still there."""
    with_package(spark)
    return tox.non_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: a row of the text that stands for the group, of smallest doc_id (null last; of equal ones
    the smallest row hash). Null and empty texts are one group, as all texts without words are if they are equal."""
    with_package(spark)
    with disposable(spark) as keep:
        classes = near_dup.near_duplicates(docs)
        kept = written(classes.where(F.col("t") == F.col("class_t")).select(F.col("t").alias("__t")).distinct(), "kept-texts")
        keep(kept)
    row, order = F.struct(*docs.columns), F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns))
    # Copies are reduced to one row before they are shuffled, so a text with a third of all rows is no hot key of the join.
    first = docs.withColumn("__t", hash128(docs["text"])).groupBy("__t").agg(F.min_by(row, order).alias("row"))
    return first.join(kept, "__t", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate. Equal texts fare alike; texts without words stay."""
    with_package(spark)
    with disposable(spark) as keep:
        judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
        bad = written(judged.where("contaminated").select(F.col("t").alias("__t")).distinct(), "contaminated-texts")
        keep(bad)
    return docs.withColumn("__t", hash128(docs["text"])).join(bad, "__t", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. A null source is a source; repeated rows are
    documents of their own; documents without words are taken as their source's share says."""
    with_package(spark)
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row; a null doc_id is a key of its own, repeated rows
    take slots of their own."""
    with_package(spark)
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can't express trained classifiers, balanced sampling and the ring's walk; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with disposable(spark) as keep:
        for name, stage in STAGES[:-1]:
            with disposable(spark) as keep_stage:
                docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
                keep_stage(docs)
        keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
