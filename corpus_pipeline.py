"""A corpus pipeline: quality rules, line dedup, near-dedup, substring dedup, packing.

Every stage works on all that the stage before kept and returns the columns of ``documents``; the
last one returns the places of the pieces.  ``run`` writes each stage to the shared folder and reads
it back, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import lines, near, packing, quality, substring
from tributary.llm.common import cut, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the classifier is fitted on the labelled ones.  Null, empty and blank
    texts have too few words and go; a repeated row fares as its twin; an empty table stays empty.  In this and
    every stage columns other than those of documents are left out."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are the same, or nearly, the first stays; a document that loses all its lines goes.  Null, empty
    and blank texts stay as they are.  Rows are told apart by id and text, so rows that share an id, or have none, lose
    only lines of their own; a row repeated as a whole keeps what its twin keeps."""
    return _counted(lines.without_repeated_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words a shingle, similarity 0.8): the one with the
    smallest id, with all rows of that id.  Texts without words are linked with nothing and stay.  Rows without an id
    are one document; they stay if one of them is linked with no document that has one."""
    kept = near.near_components(docs).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that start earlier go; a document that loses all its words goes.  Null, empty and blank texts
    stay as they are; rows without an id count as the last; a row repeated as a whole keeps what its twin keeps."""
    return _counted(substring.without_repeats(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens.  A null or empty text is its end id alone; rows that repeat
    an id, or have none, are documents of their own."""
    encoder = packing.broadcast_encoder(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, encoder)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("substring dedup", substring_dedup), ("best-fit packing", best_fit_packing)]

#: A trained classifier, MinHash and a bitset packing are not expressible in SQL: tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
