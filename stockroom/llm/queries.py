"""Check queries: each operator with production parameters on its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm.alignment import Definitions, alignment_figures
from stockroom.llm.byte_bpe import encode_and_decode
from stockroom.llm.exact_duplicates import exact_duplicates, exact_duplicates_sql
from stockroom.llm.fingerprints import edited_and_next
from stockroom.llm.licences import find_licences, licence_sql
from stockroom.llm.near_duplicates import near_duplicates, near_duplicates_sql
from stockroom.llm.neighbours import nearest_neighbours
from stockroom.llm.packing import pack_documents
from stockroom.llm.personal_data import find_personal_data
from stockroom.llm.quality import in_held_out, score_quality
from stockroom.llm.registry import CHECKS, check, table
from stockroom.llm.repeats import remove_repeats, repeats_sql
from stockroom.llm.spelling import count_words, spelling_variants, spelling_variants_sql
from stockroom.llm.url_filters import Rule, filter_urls

__all__ = ["CHECKS"]

#: Where the vocabularies lie; the driver reads them.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

URL_RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)


@check()
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


@check()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_and_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@check()
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))


@check(licence_sql())
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))


@check()
def op6_pack_along_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        definition = file.read()
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), definition)


@check()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(BYTE_RANKS, "rb") as file:
        ranks = file.read()
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_and_decode(documents, ranks, public_tokenizers.PATTERN)


@check(near_duplicates_sql(3, 85))
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, percent=85)


@check()
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


@check(repeats_sql())
def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@check()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@check(exact_duplicates_sql())
def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@check(spelling_variants_sql())
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(table(spark, sf_dir, "documents").select("doc_id", "text"), damaged=31))


@check()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(BYTE_TOKENIZER, encoding="utf-8") as a, open(PIECE_TOKENIZER, "rb") as b:
        definitions = Definitions(a.read(), b.read())
    return alignment_figures(table(spark, sf_dir, "documents").select("doc_id", "text"), definitions)
