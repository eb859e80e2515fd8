from pyspark.sql import functions as F

from subscriber_analytics.llm import decontaminate, registry
from tests.llm.data import ITEM_WORDS, LOWER, ROWS, documents


def brute(docs, items):
    """docs: (id, text); items: (id, text). (id, n_words, n_hit, items) of each document."""
    windows = {}
    for item, text in items:
        words = ITEM_WORDS.findall((text or "").translate(LOWER))
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[k:k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        words = ITEM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(words[k:k + size])]
        out.append((doc, len(words), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


ITEMS = [
    (10, "quick brown fox"), (9, "QUICK, brown. FOX!"), (1, "the lazy dog and runs on"), (2, "Straße"), (3, "straße strasse"),
    (4, None), (5, ""), (6, "?!"), (None, "text of no document"), (7, "a a a"), (8, " ".join(f"word{k}" for k in range(900, 935))),
    (11, "ΣΊΣΥΦΟΣ"), (12, "word5 word6 word7 word8 word9 word10 word11 word12 word13 word15"), (13, "élan"),
]


def test_awkward_rows(spark):
    rows = [*ROWS, (20, "A a a A a a", "en", "a", 1), (21, "fox quick brown fox quick brown fox", "en", "a", 1), (21, "another text", "en", "a", 1)]
    docs = documents(spark, rows).withColumn("N_Hit", F.lit("mine")).withColumn("_places", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("window", F.lit(1))
    got = decontaminate.find(docs, items)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "n_hit", "n_items", "items", "contaminated"]
    found = got.collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=repr) == brute([r[:2] for r in rows], ITEMS)
    assert all(r["n_items"] == len(r["items"]) and r["contaminated"] == (r["n_hit"] > 0) for r in found)


def test_empty_tables(spark):
    docs = documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find(docs.limit(0), items).collect() == []
    assert decontaminate.find(docs, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_large_benchmarks_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    rows = [(1, "one two three four", None, None, 1), (2, "two three", None, None, 1)]
    items = [(1, "two three four"), (2, "two")]
    got = decontaminate.find(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=repr) == brute([r[:2] for r in rows], items)


def test_query_is_the_brute_force_one(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").select("item_id", "text").collect()]
    got = registry.queries()["op1_decontamination"](spark, path).collect()
    want = brute(docs, items)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in got), key=repr) == [(d, n, h, len(i)) for d, n, h, i in want]


def test_rows_without_an_id_keep_their_own_places(spark):
    rows = [(None, f"row {k} quick brown fox {'the lazy dog and runs on ' * (k % 3)}", None, None, 1) for k in range(300)]
    got = decontaminate.find(documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=repr) == brute([r[:2] for r in rows], ITEMS)
