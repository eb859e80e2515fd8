"""From raw documents to a training mix: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.llm import decontaminate, language, mixing, pii, simhash
from subscriber_analytics.llm.arrow import stored
from subscriber_analytics.llm.registry import PII_KEY

# Documents whose language is less sure than this are rejected.
LEAST_SCORE = 0.5
# Not SQL: the model of the first stage, fingerprints, keyed pseudonyms and hashed draws have no form in it.
ORACLE_SQL = None


def _aside(docs: DataFrame, own: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with the columns renamed that an operator would replace, and what brings them back in place."""
    clash = {c: f"_aside_{n}" for n, c in enumerate(docs.columns) if c.lower() in own}
    return docs.withColumnsRenamed(clash), lambda out: out.select(
        *[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without letters, or of no sure language, go.

    The model is learned from the labels of the documents. If none has a label there is no language to
    tell, and all stay. Null and empty texts go; repeated rows are judged alike.
    """
    model = language.learn(docs.where(~language.held_out()))
    if not model.langs:
        return docs
    free, back = _aside(docs, language.FIELDS.names)
    found = language.identify(free, model)
    return back(found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: that of the smallest id.

    3-word shingles and at most 2 differing bits, as the operator's contract says. Rows repeated under one id and
    text are one document. A document without an id stays only where none of its group has one.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    found = stored(simhash.near_duplicates(keyed), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = stored(found.groupBy("cluster").agg(F.min(place).alias("first")), "first-of-group")
    later = found.join(first, "cluster").where(place != F.col("first"))
    losers = later.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    repeated = found.groupBy("doc_id", "text_key").count().where("count > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))

    def same(other: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(other["_id"]) & (F.xxhash64(docs["text"]) == other["_key"])

    left = docs.join(losers, same(losers), "left_anti")
    once = left.join(repeated, same(repeated), "left_anti")
    again = left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionAll(again).select(*[f"`{c}`" for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; null texts stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    hit = decontaminate.find(keyed, items).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_key"])
    return docs.join(hit, same, "left_anti")


def protect_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text."""
    free, back = _aside(docs, ["n_pii", "pii_kinds"])
    out = pii.protect(free, PII_KEY)
    return back(out.withColumn("n_chars", F.when(F.col("n_pii") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each once, with size, source_size, target, copies and taken."""
    return mixing.mix(docs).where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("pii", protect_persons),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
