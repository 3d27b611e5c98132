"""Five stages from raw documents to packed training sequences; each is written, and read by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm.near_duplicates import near_duplicates
from stockroom.llm.packing import pack_documents
from stockroom.llm.personal_data import redact
from stockroom.llm.quality import score_quality
from stockroom.llm.registry import ROW, Check, in_fewer_files, packed, small_batches, stored, table, unpacked
from stockroom.llm.repeats import remove_repeats

#: The vocabulary's file; the driver reads it.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Labels of the table teach it, but for the held-out third."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return score_quality(docs, labels).where("predicted = 1").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingles of five words and a similarity of 0.8, the smallest id stays.

    Of rows that repeat an id one stays; rows without an id stay all.
    """
    small_batches(spark)
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(packed(docs), "doc_id", F.xxhash64("text").alias("order")).join(kept, "doc_id", "left_semi")
    # A minimum, so that of an id's many rows each task hands on one.
    chosen = rows.groupBy("doc_id").agg(F.min_by(ROW, F.struct("order", F.xxhash64(ROW))).alias(ROW))
    return in_fewer_files(chosen, 4).select(*unpacked(docs, {})).unionByName(docs.where("doc_id is null"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole lines and passages that an earlier place has are cut out of the later ones. All documents stay.

    Inside a line, 20 words are what a passage of just over 50 leaves without the sentences at its edges.
    """
    small_batches(spark)
    return _measured(remove_repeats(docs, least_run=20, whole_lines=True), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets. All documents stay."""
    return _measured(redact(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of neighbouring documents."""
    small_batches(spark)
    with open(TOKENIZER, encoding="utf-8") as file:
        return pack_documents(docs, file.read())


def _measured(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the number of characters as it is now."""
    length = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return changed.withColumn("n_chars", length).select(*docs.columns)


STAGES = [
    ("quality classifier", keep_good_text),
    ("MinHash near-dedup", keep_one_of_near_copies),
    ("substring dedup", remove_repeated_passages),
    ("PII", mask_personal_data),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{at}")
    return docs


CHECK = Check(run, ORACLE_SQL)
