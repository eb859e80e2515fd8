import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from subscriber_analytics.llm import registry, simhash
from subscriber_analytics.llm.arrow import flat
from tests.llm.data import LOWER, ROWS, SPACED, documents


def brute_print(text):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: list of (id, fingerprint); the smallest id that each reaches."""
    values = sorted({p for _, p in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[root(p)] = min(least.get(root(p), doc), doc)
    return {p: least.get(root(p)) for p in values}


def test_hash_is_the_library_one():
    rng = np.random.default_rng(3)
    body = rng.integers(0, 256, 5000, dtype=np.uint8)
    sizes = np.r_[np.arange(1, 80), 300, 1000]
    starts = rng.integers(0, 3000, len(sizes))
    data = np.r_[body, np.zeros(8, np.uint8)]
    got = simhash.xxh64(data, starts, starts + sizes)
    assert got.tolist() == [xxhash.xxh64_intdigest(body[s:s + n].tobytes(), 42) for s, n in zip(starts, sizes)]


def test_fingerprints_of_awkward_texts():
    texts = [r[1] for r in ROWS]
    assert simhash.simhashes(*flat(pa.array(texts, pa.string()))).tolist() == [brute_print(t) for t in texts]
    assert simhash.simhashes(*flat(pa.array([], pa.string()))).tolist() == []


def test_trie_join_finds_exactly_the_near_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) for _ in range(4)]
    values = np.unique(np.concatenate([base, *near]))
    left, right = simhash.trie_pairs(values, np.array([0, len(values)]), 2)
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    want = set(zip(*(x.tolist() for x in np.nonzero(np.triu(distance <= 2, 1)))))
    assert {(min(a, b), max(a, b)) for a, b in zip(left.tolist(), right.tolist())} == want


def test_links_are_whole_when_tries_are_cut(spark):
    # 256 values that differ in the lowest 8 bits alone: two cuts leave tries small enough.
    rows = [(5 << 40 | v, v) for v in range(256)] + [(-(v << 30) - 1, 1000 + v) for v in range(5)]
    want = brute_components([(n, v & (2**64 - 1)) for v, n in rows])
    prints = spark.createDataFrame(rows, "simhash long, rep long")
    for size in (100, 2048):
        found = {r["node"]: r["component"] for r in simhash.components(simhash.links(prints, 2, size)).collect()}
        assert {v & (2**64 - 1): found.get(n, n) for v, n in rows} == want


def test_near_duplicates_of_awkward_rows(spark):
    docs = documents(spark).withColumn("SimHash", F.lit("mine")).withColumn("component_id", F.lit("mine"))
    got = simhash.near_duplicates(docs)
    assert got.columns.count("simhash") == 1 and got.count() == len(ROWS)
    prints = [(r[0], brute_print(r[1])) for r in ROWS]
    want = brute_components(prints)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=repr) == sorted(
        ((doc, want[p]) for doc, p in prints), key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_rows_without_an_id_link_those_with_one(spark, monkeypatch):
    # Fingerprints 0, 3 (of a row without an id) and 15: one component, and one of rows without ids alone.
    rows = [(4, "a", 0), (None, "b", 3), (7, "c", 15), (None, "d", -1), (None, "e", -3), (9, "f", 7 << 40)]
    made = spark.createDataFrame(rows, "doc_id long, text string, simhash long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, text: made)
    got = {r["simhash"]: (r["cluster"], r["component_id"]) for r in simhash.near_duplicates(made).collect()}
    assert got == {0: (0, 4), 3: (0, 4), 15: (0, 4), -1: (-3, None), -3: (-3, None), 7 << 40: (7 << 40, 9)}


def test_query_is_the_brute_force_one(spark):
    found = registry.queries()["op10_simhash"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = [(r["doc_id"], brute_print(r["text"])) for r in docs]
    want = brute_components(prints)
    assert sorted(tuple(r) for r in found.collect()) == sorted((d, f"{p:016x}", want[p]) for d, p in prints)
    assert re.fullmatch("[0-9a-f]{16}", found.first()["fingerprint"])
