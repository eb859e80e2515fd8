import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from subscriber_analytics.llm import registry, substrings
from subscriber_analytics.llm.arrow import flat
from subscriber_analytics.llm.suffixes import common_prefix, deep_shallow
from tests.llm.data import ROWS, documents


def brute(texts, length):
    """Per text: the mask of removed bytes."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[k:k + length] for b in bodies for k in range(len(b) - length + 1))
    masks = []
    for b in bodies:
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k:k + length]] > 1:
                mask[k:k + length] = b"\1" * length
        masks.append(mask)
    return bodies, masks


def spans_of(mask):
    edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(bytes(mask), np.uint8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def test_deep_shallow_orders_and_measures():
    random.seed(1)
    for _ in range(500):
        base = bytes(random.choices(b"ab", k=120))
        strings = []
        for _ in range(random.randint(1, 12)):
            b = bytearray(base)
            for _ in range(random.randint(0, 2)):
                b[random.randrange(120)] = random.choice(b"abc")
            strings.append(bytes(b[:random.randint(0, 120)]))
        order, common = deep_shallow(strings)
        assert [strings[k] for k in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        for n in range(1, len(order)):
            a, b = strings[order[n - 1]], strings[order[n]]
            assert common[n] == common_prefix(a, b) == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_equal_strings_have_equal_anchors():
    random.seed(2)
    part = "".join(random.choices("abcdefgh ", k=700))
    texts = ["x" * 50 + part + "tail", "some other head " + part, part, "aaaa" * 200]
    rows = substrings.anchors(*flat(pa.array(texts)))
    at = {}
    for text, pos, lo, hi, key in zip(*(rows[c].tolist() for c in ("text", "pos", "lo", "hi", "key"))):
        for start in range(pos - hi, pos - lo + 1):
            at[text, start] = (pos - start, key)
    assert len(at) == sum(len(t) - 399 for t in texts)
    for k in range(len(part) - 399):
        assert at[0, 50 + k] == at[1, 16 + k] == at[2, k]


def test_a_long_text_has_all_its_strings_whatever_the_segments():
    random.seed(6)
    data, offsets = flat(pa.array(["".join(random.choices("ab ", k=5000)) + "x" * 700]))
    for segment in (100, 333, 5300, 10_000):
        rows = substrings.anchors_by_segment(data, offsets, 400, 64, segment)
        starts = [p - d for p, lo, hi in zip(*(rows[c].tolist() for c in ("pos", "lo", "hi"))) for d in range(lo, hi + 1)]
        assert sorted(starts) == list(range(len(data) - 399))
        whole = substrings.anchors(data, offsets)
        at = {p: k for p, k in zip(whole["pos"].tolist(), whole["key"].tolist())}
        assert all(at[p] == k for p, k in zip(rows["pos"].tolist(), rows["key"].tolist()))


def _texts():
    random.seed(4)

    def words(n):
        return " ".join("".join(random.choices("etaoin", k=random.randint(1, 9))) for _ in range(n))

    passage, header = words(40), words(16)
    texts = [words(60) for _ in range(6)]
    texts += [words(10) + passage + words(random.randint(0, 12)) for _ in range(30)]
    texts += [header + " " + words(30) for _ in range(30)]
    copy = words(80)
    texts += [copy, copy, copy[:150] + "#" + copy[151:], copy[7:], copy + copy]
    texts += ["ab" * 300, "ab" * 120, "é" * 200, passage[:150], passage[:151], None, ""]
    return texts


def test_removal_is_the_brute_force_one_also_when_groups_are_split(spark):
    texts = _texts()
    bodies, masks = brute(texts, 150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for together in (3, 256):
        spans = substrings.repeated_spans(docs, length=150, gram=40, together=together)
        got = {r["id"]: [tuple(s) for s in r["spans"]] for r in spans.collect()}
        assert got == {k: spans_of(m) for k, m in enumerate(masks) if any(m)}
    kept = {r["doc_id"]: (r["n_bytes"], bytes(r["kept"])) for r in substrings.remove_repeats(docs, length=400).collect()}
    bodies, masks = brute(texts, 400)
    assert kept == {k: (len(b), bytes(c for c, m in zip(b, mask) if not m)) for k, (b, mask) in enumerate(zip(bodies, masks))}


def test_rows_of_a_frequent_key_are_not_dealt_to_one_task(spark):
    rows = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 6 < 5, -1).otherwise(F.col("id")).alias("key"), "id")
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left_semi"):
            got = substrings.joined(rows, counts, ["key"], "n", how)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(counts, ["key"], how).collect()))
            tasks = got.where("key = -1").groupBy(F.spark_partition_id().alias("task")).count().collect()
            assert max(r["count"] for r in tasks) <= 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_frequent_keys_change_no_span(spark, monkeypatch):
    texts = _texts()
    _, masks = brute(texts, 150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(substrings, "FREQUENT", 2)
    got = {r["id"]: [tuple(s) for s in r["spans"]] for r in substrings.repeated_spans(docs, length=150, gram=40, together=3).collect()}
    assert got == {k: spans_of(m) for k, m in enumerate(masks) if any(m)}


def test_awkward_rows(spark):
    docs = documents(spark).withColumn("Spans", F.lit("mine")).withColumn("kept", F.lit(1))
    got = substrings.remove_repeats(docs)
    _, masks = brute([r[1] for r in ROWS], 400)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], len(r["kept"])) for r in got.collect()) == sorted(
        (r[0] or -1, len(m), len(m) - sum(m)) for r, m in zip(ROWS, masks))
    assert substrings.remove_repeats(docs.limit(0)).collect() == []


def test_query_is_the_brute_force_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    bodies, masks = brute([r["text"] for r in docs], 400)
    want = sorted((r["doc_id"], len(b), sum(m), len(spans_of(m)), hashlib.sha256(bytes(c for c, x in zip(b, m) if not x)).hexdigest())
                  for r, b, m in zip(docs, bodies, masks))
    assert sorted(tuple(r) for r in registry.queries()["op8_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()) == want
