"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go; of each group of similar documents one stays; passages that repeat across documents stay in the first alone;
documents that hold benchmark items go; sources are mixed to their target weights.

Cases, alike in all stages: the columns of ``documents`` must be there (a missing one is an error), further ones are dropped whatever
their names; lang and n_chars may be null and are passed on as they are; an empty table gives an empty result with the same columns.
Texts are judged whole, whatever their length.  What null ids, null and empty texts, ties and repeated rows do is said of each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.graphs import shared_folder
from tidemark.llm.mixing import emit_mix
from tidemark.llm.ngram_join import drop_similar
from tidemark.llm.substrings import remove_repeats
from tidemark.llm.toxicity import drop_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words in a row that must repeat before a passage is cut.
PASSAGE = 30


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from all labelled rows, does not reject.

    Null and empty texts score the base rate and stay unless most labelled texts are toxic; repeated rows are judged each; a null id is
    judged like any other but has no label; without labels of both kinds all stay.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles.

    The smallest id stays, a null id only if the group has no other; of repeated rows one stays; a similarity of exactly 80 % counts;
    null and empty texts are like nothing and stay, rows of one id with equal ones once.
    """
    return drop_similar(docs, 5, 80, 100).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in one with a smaller id; the documents all stay.

    A null id counts as larger than any other; of rows with equal ids none removes from the other; null and empty texts are kept as
    they are, and so is the white space of a text that loses nothing; a text that loses all its words becomes empty.
    """
    return remove_repeats(docs, PASSAGE).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Each row is judged by its own text, whatever other rows have its id or none; null and empty texts hold none and stay; null
    items and items without words are left out.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, numbered by ``copy``.

    A null source is a source; a document without words has size 0 and is taken as often as others of its source, never in a source
    without any words; repeated rows are taken each.
    """
    return emit_mix(docs).select(*COLUMNS, "size", "source_size", "target", F.col("copy").cast("long").alias("copy"))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", similar),
    ("substring_dedup", passages),
    ("benchmark_decontamination", benchmark),
    ("source_mixing", mixing),
]

#: The stages learn a lexicon and follow links through a graph, which SQL does not express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared checkpoint folder."""
    at, docs, last = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}", spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{k}-{name}")
            docs = spark.read.parquet(f"{at}/{k}-{name}")
            if last:  # the table of the stage before has been read for the last time
                path = spark._jvm.org.apache.hadoop.fs.Path(last)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            last = f"{at}/{k}-{name}"
    return docs
