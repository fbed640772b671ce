"""The registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from shoplens.llm import (bpe, extraction, jaccard, line_quality, orc_tokens, packing, pii, rabitq, spelling, toxicity, url_filter,
                          warc, whitening)
from shoplens.llm.common import table


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of the cross-document line rules."""
    return line_quality.quality_rules(table(spark, sf_dir, "documents")).drop("removed", "_key")


#: The pattern that splits words in word_bpe_49k.json (a fixed value of that file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back by byte ranges."""
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, payloads=False)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extraction.main_text(pages, extraction.train(pages))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; digests of the ids and of the decoded bytes."""
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, digests=True)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of personal data in every text."""
    docs = table(spark, sf_dir, "documents")
    return pii.spans(docs, pii.train(docs))


def op5_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    index = rabitq.build_index(table(spark, sf_dir, "embeddings"))
    return rabitq.search(index, index.filter(F.col("vec_id") % 20 == 0), 20)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2,
                        True, public_tokenizers.PATTERN, 1024)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents in ORC files, read back."""
    files = orc_tokens.id_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1,
                                False, WORD_PATTERN)
    return orc_tokens.read_ids(files)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the corpus."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings whitened along their 16 strongest components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


#: The rules that the query is given (fixed values): verdict, host, path.
SITE_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
              ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every url."""
    rules = [url_filter.site_rule(*r) for r in SITE_RULES] + url_filter.host_words(url_filter.BLOCK, url_filter.BLOCKED_HOST_WORDS)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules).drop("glob")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_main_text": op2_main_text,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_personal_data": op4_personal_data,
    "op5_one_bit_search": op5_one_bit_search,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_files": op10_token_files,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_whitening": op12_whitening,
    "op13_url_filters": op13_url_filters,
}
