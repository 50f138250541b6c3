"""Corpus pipeline: language filter, exact and near deduplication, benchmark decontamination, piece encoding.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents. Other columns pass through every
stage, whatever their names; rows may repeat, have no doc_id or share one, and texts may be null, empty or of any length. A stage gives no rows for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm import decontaminate, exactdedup, langid, ngramjoin, spm
from strataframe.storage import stored

#: Least posterior of the predicted language; what is below, or undetermined, goes.
LEAST_SCORE = 0.5
#: Several stages cannot be expressed in SQL (a trained classifier, byte-pair merging): see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language that the classifier, trained on their labels, is sure of. Texts without letters, null ones
    among them, go; where no document has a language, all stay."""
    model = langid.fit(docs)
    if not model.langs:  # nothing labelled: nothing can be rejected
        return docs
    lang, score = unused(docs, "__lang"), unused(docs, "__score")
    sure = (F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)
    return langid.identify(docs, model, lang_out=lang, score_out=score).filter(sure).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, white space aside: the longest, then the smallest doc_id (null last). Null and
    empty texts are one group."""
    rows, row = keyed(docs)
    found = exactdedup.exact_duplicates(rows, key=row)
    return without(rows, row, found.filter("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram Jaccard join (five words, 0.8): that with the smallest doc_id (null last). Texts
    without words link with none and stay."""
    rows, row = keyed(docs)
    found = ngramjoin.jaccard_components(rows, key=row)
    return without(rows, row, found.filter("doc_id <> component_id"))


def unused(docs: DataFrame, name: str) -> str:
    """name, or a longer one where docs has a column of that name."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """(docs with one more column, its name): it has no nulls, no value twice, and the order of doc_id, null last."""
    row = unused(docs, "__row")
    if docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("doc_id IS NULL OR c > 1").isEmpty():
        return docs.withColumn(row, F.col("doc_id")), row
    # the second key parts the rows of a doc_id that many have; written, as the numbers must stay
    ordered = docs.orderBy(F.asc_nulls_last("doc_id"), F.monotonically_increasing_id())
    return stored(ordered.withColumn(row, F.monotonically_increasing_id()), "keyed"), row


def without(rows: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """rows without those whose row is a doc_id of gone, which has each once; and without that column."""
    return rows.join(stored(gone.select(F.col("doc_id").alias(row)), "gone"), row, "left_anti").select([c for c in rows.columns if c != row])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item within the error budget. Null and empty texts contain none; null and empty items are in none."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = unused(docs, "__leaks")
    return decontaminate.find_leaks(docs, items, out=leaks).filter(F.size(leaks) == 0).select(docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids; null and empty texts have none."""
    return spm.encode(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("ngram_jaccard", near), ("decontamination", benchmark), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; each result is written to the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
