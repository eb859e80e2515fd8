import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.llm import registry, spelling
from tests.llm.data import LOWER, ROWS, documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [] for w in n}
    ordered = sorted(n)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


CHAIN = [("stone", 3), ("stones", 6), ("tones", 12), ("tonese", 24), ("atonese", 48), ("notes", 4), ("onset", 4), ("seton", 4),
         ("àéîõü", 3), ("àéîõÿ", 9), ("÷×÷×÷", 5), ("÷×÷×÷×", 10), ("aaaaa", 3), ("aaaaaa", 4), ("aaaaaaa", 40), ("b" * 3000, 3),
         ("b" * 3001, 7), ("tiesa", 10), ("tiesb", 10), ("tiesc", 5)]


def test_awkward_rows_are_the_brute_force_ones(spark):
    rows = [*ROWS, *[(100 + k, " ".join([word] * n), "en", "a", 1) for k, (word, n) in enumerate(CHAIN)]]
    rows += [(None, "STONES Stones stoned stoner stoner stoner 1stoner2", "en", "a", 1)]
    docs = documents(spark, rows).withColumns({c: F.lit(7) for c in ("word", "n", "run", "id", "key", "side", "size")})
    assert rows_of(spelling.variants(docs)) == brute([(r[0], r[1]) for r in rows])
    assert spelling.variants(docs.limit(0)).collect() == []


def test_signatures_meet_for_every_near_pair(spark):
    import random
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(400)]
    words = sorted(set(base) | {w[1:] for w in base if len(w) > 5} | {"z" + w for w in base[:50]})
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {(r["word"], r["other"]) for r in spelling.near_pairs(table).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize("path", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_is_the_brute_force_one(spark, path):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert rows_of(registry.queries()["op13_spelling"](spark, path)) == brute(docs)
