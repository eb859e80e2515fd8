"""The queries of this subpackage, one for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.llm import (
    decontaminate, language, licenses, mixing, phrases, pii, quality, recipes, simhash, spelling, substrings, tokens, urls,
)

# The key of a deployment is its own secret; this one is for the queries here.
PII_KEY = b"key of the registered queries"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.protect(docs, PII_KEY)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.held_out()
    model = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action")) for rule, action in urls.RULES]
    rules = spark.range(1).select(F.inline(F.array(*rows)))
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f.name for f in licenses.FIELDS if f.name != "spans"])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recipes.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_pii": op2_pii,
        "op3_language": op3_language,
        "op4_token_counts": op4_token_counts,
        "op5_url_filter": op5_url_filter,
        "op6_licenses": op6_licenses,
        "op7_quality": op7_quality,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_mixing": op9_mixing,
        "op10_simhash": op10_simhash,
        "op11_phrases": op11_phrases,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_spelling": op13_spelling,
    }
