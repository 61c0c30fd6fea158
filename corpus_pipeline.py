"""A corpus pipeline: quality, repeated lines, near copies, benchmarks, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads;
all but the last keep the columns of ``documents``.  As an application the
pipeline sets the session's Arrow batches to ``BATCH_ROWS`` rows: results of
its stages are written by the caller, and texts can be long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, line_dedup, ngram_join, packing, quality
from pulsegrid.llm.common import BATCH_ROWS, drop_stored, stored, stored_paths, table


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts are scored, too."""
    _small_batches(spark)
    measured = stored(quality.document_statistics(docs.select("doc_id", "text")))
    return quality.keep_quality(docs, quality.fit_quality(measured, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones have.

    A document of which every line goes is a copy and goes, too; blank and
    null texts had no line to lose and stay.
    """
    _small_batches(spark)
    left = line_dedup.dedup_lines(docs).filter("n_removed = 0 or n_removed < n_lines")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by rows: see ``keep_one`` for null and repeated ids."""
    return ngram_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages.

    Null and empty texts have no words and stay; repeated rows are judged each; an empty benchmark drops
    nothing, an empty table stays empty; very long texts are scanned like others.
    """
    _small_batches(spark)
    found = decontaminate.contamination(decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark")))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their length bucket and batch.

    Null, empty and blank texts have no piece; repeated rows and ids have pieces of their own; long texts
    are several pieces; an empty table gives no rows.
    """
    return packing.pack(stored(packing.pieces(docs)))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = stored_paths()
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            made = stored_paths() - before
            docs = stored(docs)
            drop_stored(spark, made)
    return docs
