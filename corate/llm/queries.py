"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.llm.align import align_tokens, read_vocabularies
from corate.llm.common import table, with_columns_last
from corate.llm.decontaminate import find_contamination
from corate.llm.exact import exact_groups
from corate.llm.html_text import extract_main_text
from corate.llm.langid import fit_language, predict_language
from corate.llm.lines import line_dedup
from corate.llm.mixing import mix_sources
from corate.llm.near import near_groups
from corate.llm.prefix_trie import prefix_trie
from corate.llm.quality import fit_quality, score_quality
from corate.llm.substrings import substring_dedup
from corate.llm.toxicity import fit_toxicity, score_toxicity
from corate.llm.url_rules import filter_urls

# Fixed values of the URL contract: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Folder of the public tokenizers' files.
TOKENIZERS = "/opt/tokenizers"
QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.1
# Seed words of the categories before ``toxic``.
TOXIC_SEEDS = {
    "insult": ("idiot", "moron", "stupid", "clown"),
    "contempt": ("scum", "trash", "disgusting", "pathetic", "worthless", "loser"),
}


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"]))).alias("item_ids"),
        "matches",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "text"
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def remainder(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def quality_scores(docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with score and predicted, learned from the training rows of documents."""
    spark = docs.sparkSession
    train = table(spark, sf_dir, "documents").where(remainder(5) != 0).select("doc_id", "text")
    model = fit_quality(train, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model)
    return with_columns_last(scored, {"predicted": (F.col("score") >= QUALITY_THRESHOLD).cast("int")})


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    return quality_scores(docs, sf_dir).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs.where(remainder(4) != 2).select("doc_id", "text", "lang"))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit_toxicity(docs, table(spark, sf_dir, "labels"), TOXIC_SEEDS)
    scored = score_toxicity(docs, chain, names=[*TOXIC_SEEDS, "toxic"])
    return scored.select(
        "doc_id", "p_insult", "p_contempt", F.col("p_toxic").alias("score"), (F.col("p_toxic") >= TOXIC_THRESHOLD).alias("toxic")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), read_vocabularies(TOKENIZERS))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_html_text": op7_html_text,
    "op8_near_dedup": op8_near_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_substring_dedup": op13_substring_dedup,
}
