import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from subscriber_analytics.llm import quality, registry
from tests.llm.data import ROWS, SPACED, documents


def brute(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {k, k + 1, k + 2}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def estimate(x):
    """Minimum covariance determinant of the rows of x, by whole sorts of their binned distances."""
    rank = lambda p: np.sort(x, axis=0)[max(math.ceil(p * len(x)), 1) - 1]
    floors = np.array(quality.FLOORS)
    center, logdet = rank(0.5), math.inf
    inverse = np.diag(1 / np.maximum((rank(0.75) - rank(0.25)) / 1.349, floors) ** 2)
    while True:
        d = np.einsum("ni,ij,nj->n", x - center, inverse, x - center)
        bins = np.minimum(np.floor(np.log1p(np.maximum(d, 0)) * (quality.DISTANCE_BINS / 20)), quality.DISTANCE_BINS)
        core = x[bins <= np.sort(bins)[math.ceil(quality.CORE * len(x)) - 1]]
        made = np.cov(core.T, bias=True) * quality.CONSISTENCY if len(core) > 1 else np.zeros((4, 4))
        made[np.diag_indices(4)] = np.maximum(np.diag(made), floors ** 2)
        values, vectors = np.linalg.eigh(made / np.outer(floors, floors))
        made = vectors @ np.diag(np.maximum(values, quality.GUARD)) @ vectors.T * np.outer(floors, floors)
        if not np.linalg.slogdet(made)[1] < logdet - 1e-6:
            return np.array([*center, *cov.ravel()])
        center, cov, inverse, logdet = core.mean(axis=0), made, np.linalg.inv(made), np.linalg.slogdet(made)[1]


def brute_distances(rows):
    """rows of (text, lang, source); the squared distance of each, None where the fixed limits fail."""
    x, keys = [], []
    for text, lang, source in rows:
        n, chars, symbols, lines, repeats, failed = brute(text)
        keys.append(None if failed else ((0,), (1, lang), (2, lang, source)))
        x.append((math.log(max(chars / max(n, 1), 0.1)), math.sqrt(symbols / max(chars, 1)),
                  math.sqrt(lines / max(n, 1)), math.sqrt(repeats / max(n, 1))))
    x, members = np.array(x).reshape(-1, 4), {}
    for k, own in enumerate(keys):
        for key in own or ():
            members.setdefault(key, []).append(k)
    own = {key: estimate(x[rows_of]) for key, rows_of in members.items()}
    found = []
    for k, levels in enumerate(keys):
        if levels is None:
            found.append(None)
            continue
        blended = own[levels[0]]
        for key in levels[1:]:
            share = len(members[key]) / (len(members[key]) + quality.PRIOR)
            blended = share * own[key] + (1 - share) * blended
        off = x[k] - blended[:4]
        found.append(float(off @ np.linalg.inv(blended[4:].reshape(4, 4)) @ off))
    return found


def same_distance(got, expected):
    if expected is None or got is None:
        return got is expected
    return abs(got - expected) <= 1e-6 * max(1, expected)


def test_statistics_of_awkward_rows(spark):
    docs = documents(spark).withColumn("Kept", F.lit("mine")).withColumn("center", F.lit("mine"))
    got = quality.judge(docs).collect()
    stats = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got), key=repr)
    assert stats == sorted(((r[0], *brute(r[1])) for r in ROWS), key=repr)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.judge(docs.limit(0)).collect() == []


def test_outliers_go_and_the_rest_stays(spark):
    plain = [(k, " ".join(f"word{(k * 31 + j) % 500}" for j in range(80)), "en", "a", 1) for k in range(120)]
    odd = [(1000 + k, " ".join(f"w{k}{j}###&&&" for j in range(80)), "en", "a", 1) for k in range(12)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(documents(spark, plain + odd)).collect()}
    assert all(got[k] for k in range(120)) and not any(got[1000 + k] for k in range(12))


def test_a_share_of_symbols_is_an_outlier_where_none_has_symbols(spark):
    plain = [(k, " ".join(f"word{100 + (k * 31 + j) % 500}" for j in range(80)), "en", "a", 1) for k in range(120)]
    odd = [(1000 + k, " ".join(f"word{100 + (k * 17 + j) % 500}#" for j in range(80)), "en", "a", 1) for k in range(12)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(documents(spark, plain + odd)).collect()}
    assert all(got[k] for k in range(120)) and not any(got[1000 + k] for k in range(12))


def test_small_groups_are_judged_by_the_next_wider_one(spark):
    def text(k, mark=""):
        return " ".join(f"word{100 + (k * 31 + j) % 500}{mark}" for j in range(80))

    # English has 60 documents in sources of 5; the other languages have 3 each; one short document of a group of its own.
    rows = [(k, text(k), "en", f"s{k // 5}", 1) for k in range(60)] + [(100 + k, text(k), f"l{k // 3}", None, 1) for k in range(30)]
    odd = [(1000, text(1, "#"), "en", "s1", 1), (1001, text(2, "#"), "l2", None, 1), (1002, text(3, "#"), None, "x", 1)]
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, [*rows, *odd, (2000, "too short", "xx", "y", 1)])).collect()}
    assert all(got[r[0]]["kept"] and got[r[0]]["distance"] is not None for r in rows)
    assert all(not got[r[0]]["kept"] and got[r[0]]["distance"] is not None for r in odd)
    assert not got[2000]["kept"] and got[2000]["distance"] is None


def test_a_group_of_few_documents_is_between_its_own_estimate_and_that_of_its_language(spark):
    def text(k, mark):
        return " ".join(f"word{100 + (k * 31 + j) % 500}{mark if j % 8 == 0 else ''}" for j in range(80))

    # A source whose documents all have symbols: alien while it is small, its own measure as it grows.
    seen = []
    for size in (1, 28, 29, 30, 31, 400):
        rows = [(k, text(k, ""), "en", "a", 1) for k in range(200)] + [(1000 + k, text(k, "#"), "en", "b", 1) for k in range(size)]
        got = {r["doc_id"]: r for r in quality.judge(documents(spark, rows)).collect()}
        seen.append(got[1000]["distance"])
        assert all(got[k]["kept"] for k in range(200))
    assert seen[0] > quality.CUTOFF > seen[-1] and sorted(seen, reverse=True) == seen
    # No jump from one document to the next.
    assert all(a - b < 0.1 * a for a, b in zip(seen[1:4], seen[2:5]))


def test_distances_are_the_brute_force_ones_in_groups_of_all_sizes(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(400):
        words = [f"w{rng.integers(10 ** rng.integers(1, 6))}{'#' * int(rng.random() < 0.02)}" for _ in range(rng.integers(50, 120))]
        text = " ".join(words) + ("\n" + " ".join(words[:5])) * int(rng.integers(0, 3))
        rows.append((k, text, ["en", "de", None][int(rng.integers(3)) if k % 40 else 2], [f"s{k % 7}", None, "one"][min(k % 5, 2)] if k else "alone", 1))
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, rows)).collect()}
    expected = brute_distances([(r[1], r[2], r[3]) for r in rows])
    assert sum(d is not None for d in expected) > 300
    for row, d in zip(rows, expected):
        assert same_distance(got[row[0]]["distance"], d), (row[0], got[row[0]]["distance"], d)
        assert got[row[0]]["kept"] == (d is not None and d <= quality.CUTOFF)


def test_query_is_the_brute_force_one(spark):
    path = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    distances = dict(zip(docs, brute_distances([(r["text"], r["lang"], r["source"]) for r in docs.values()])))
    for r in registry.queries()["op7_quality"](spark, path).collect():
        d = distances[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(docs[r["doc_id"]]["text"])
        assert r["kept"] == (d is not None and d <= quality.CUTOFF)
