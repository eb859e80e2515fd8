import hypothesis.strategies as st
import public_tokenizers
from hypothesis import given, settings
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subscriber_analytics.llm import registry, tokens
from tests.llm.data import ROWS, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_counts(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_awkward_texts():
    texts = [r[1] or "" for r in ROWS] + [
        "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "don't we'll I'VE 's", "  \n\n  x \t y  ",
        "aaaaaaaaaaaaaaa aaaa", "ab" * 3000, "½ ² ① 10 1234567", "\x1c\x1d \x85  "]
    assert tokens.token_counts(texts, PATH) == library_counts(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_texts(texts):
    assert tokens.token_counts(texts, PATH) == library_counts(texts)


def test_columns_of_the_same_name_are_replaced(spark):
    docs = documents(spark).withColumn("N_Tokens", F.lit("mine")).withColumn("other", F.lit(1))
    got = tokens.count_tokens(docs, PATH, 1024)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "other", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(zip([len((r[1] or "").encode()) for r in ROWS], library_counts([r[1] for r in ROWS])))
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got.collect())
    assert tokens.count_tokens(docs.limit(0), PATH, 1024).collect() == []


def test_query_counts_as_the_library(spark):
    got = {r["doc_id"]: r["n_tokens"] for r in registry.queries()["op4_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got == dict(zip([r["doc_id"] for r in docs], library_counts([r["text"] for r in docs])))
