import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subscriber_analytics.llm import phrases
from tests.llm.data import LOWER, ROWS, documents


def brute(rows, least, top=2000, cover=80):
    """rows of (text, lang); the query's rows by counting every phrase on its own."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    chosen = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    covered = {}
    for (lang, words), a in chosen.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = lang, words[i:i + size]
                covered[inner] = max(covered.get(inner, 0), a)
    found = {}
    for (lang, words), a in chosen.items():
        if 100 * covered.get((lang, words), 0) >= cover * a:
            continue
        cuts = []
        for cut in range(1, len(words)):
            left, right = counts[lang, words[:cut]], counts[lang, words[cut:]]
            cuts.append((2_000_000 * a // (left + right), cut, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, rank, row[2].decode(), -row[1], row[3], row[4], totals[lang], -row[0])
                  for lang, own in found.items() for rank, row in enumerate(sorted(own)[:top], 1))


@pytest.mark.parametrize("top", [2000, 3])
def test_awkward_rows_are_the_brute_force_ones(spark, top):
    more = [(50 + k, "A b, a b. a B a b\tc! à la là\r\x0b a b a b c d e a b c", lang, "s", 1) for k, lang in enumerate(["en", None, "und", "z\t\\t\nz", "en"])]
    rows = [*ROWS, *more]
    docs = documents(spark, rows).withColumns({c: F.lit(7) for c in ("w1", "k", "f", "phrase", "piece", "n")})
    got = phrases.collocations(docs, least=2, top=top)
    assert sorted(tuple(r) for r in got.collect()) == brute([(r[1], r[2]) for r in rows], 2, top)
    assert dict(got.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in got.columns}
    assert phrases.collocations(docs.limit(0)).collect() == []


@pytest.mark.parametrize("common, coded", [(1, 50_000), (4, 2), (4, 0), (1000, 50_000)])
def test_common_pairs_are_dealt_and_counted_whole(spark, monkeypatch, common, coded):
    rows = [("a b " * 3000, "en"), ("a b c a b d. " * 500, "en"), ("a b", None), (" ".join(f"a b x{k}" for k in range(2000)), "en"),
            ("# $! # $; " * 40 + "z" * 50 + " ! 1 " + ("z" * 50 + " # ") * 40, "en")]
    monkeypatch.setattr(phrases, "COMMON", common)
    monkeypatch.setattr(phrases, "CODED_WORDS", coded)
    docs = spark.createDataFrame(rows, "text string, lang string")
    words, most = phrases.frequent_words(phrases.word_counts(docs))
    assert len(words) <= coded and set(words[:most]) <= {"a", "b", "c", "d", "#", "$"} and most == min(coded, {1: 0, 4: 2, 1000: 6}[common])
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == brute(rows, 30)


@pytest.mark.parametrize("top", [1, 40, 2000])
def test_many_equal_scores_and_a_cut_inside_a_band(spark, top):
    # 600 phrases of one score and one count, fewer of others, in two languages.
    same = ". ".join(f"p{k} q{k}" for k in range(600))
    rows = [(f"{same}. a b. a c. a b. d e f", lang) for lang in ("en", "de")] * 2 + [("d e. p1 x. q2", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in phrases.collocations(docs, least=2, top=top).collect()) == brute(rows, 2, top)


# Counts what is allocated in it; outlives all that is.
POOL = pa.proxy_memory_pool(pa.default_memory_pool())


def _block(words):
    picked = np.random.default_rng(5).zipf(1.3, words) % 20_000
    parts = np.array_split(picked, 300)
    texts = pa.array([" ".join(f"w{k}" + ("." if k % 11 == 7 else "") for k in part) for part in parts])
    coded = pa.array([f"w{k}" for k in np.argsort(-np.bincount(picked), kind="stable")[:500]])
    return texts, pa.array(["en", None, "de"] * 100), coded


def test_a_block_of_windows_is_counted_in_bounded_memory():
    texts, langs, coded = _block(500_000)
    before = pa.default_memory_pool()
    pa.set_memory_pool(POOL)
    tracemalloc.start()
    try:
        for _ in phrases._counted_windows(texts, langs, coded, 20):
            pass
        peak = tracemalloc.get_traced_memory()[1] + POOL.max_memory()
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(before)
    assert peak < 120 * 500_000, peak


def test_a_block_of_windows_comes_in_parts_and_whole(monkeypatch):
    texts, langs, coded = _block(20_000)
    whole = [line for part in phrases._counted_windows(texts, langs, coded, 20) for line in part.column("line").to_pylist()]
    monkeypatch.setattr(phrases, "OUT_ROWS", 7)
    parts = [part.column("line").to_pylist() for part in phrases._counted_windows(texts, langs, coded, 20)]
    assert [line for part in parts for line in part] == whole and len(parts) > 1000
    assert all(len(part) == 1 or sum(len(line.split("\n")) - 2 for line in part) <= 7 for part in parts)
    assert sum(int(line.split("\n")[1]) for line in whole) == 20_000
    assert list(phrases._counted_windows(pa.array([None, " . "], pa.string()), pa.array(["en", None]), coded, 20)) == []


def test_numbers_are_short_and_distinct():
    made = [phrases._number(k) for k in range(20_000)]
    assert len(set(made)) == len(made) and len(made[0]) == 1 and max(map(len, made)) == 3
    assert not any(set(m) & set(" !\t\r\n") for m in made)


def test_products_pass_64_bits(spark):
    big = 10 ** 17
    counts = [("en", 0, "", 9 * big), ("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", big + 1)]
    table = spark.createDataFrame(counts, "lang string, k int, phrase string, f long")
    keep, phrases.phrase_counts = phrases.phrase_counts, lambda *a: table
    try:
        row = phrases.collocations(table).collect()
    finally:
        phrases.phrase_counts = keep
    assert [tuple(r) for r in row] == [("en", 1, "a b", big + 1, 3 * big, 2 * big, 9 * big, 2_000_000 * (big + 1) // (5 * big))]


def test_query_is_the_brute_force_one(spark):
    path = "/root/testdata/sf0.001"
    from subscriber_analytics.llm import registry
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in registry.queries()["op11_phrases"](spark, path).collect()) == brute(docs, 30)
