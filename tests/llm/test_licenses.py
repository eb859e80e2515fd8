from pyspark.sql import functions as F

from subscriber_analytics.llm import licenses, registry
from tests.llm.data import ITEM_WORDS, LOWER, ROWS, documents

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def brute(text):
    words = ITEM_WORDS.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES:
        parts = phrase.split()
        found = [k for k in range(len(words) - len(parts) + 1) if words[k:k + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License. mit\n-license permit license", "mit licenses", "MIT mit License license",
    "GNU General Public License version 3 and Apache License, Version 2.0 and Apache  license; general public license",
    "émit license", "mit licenseé", "mit_license MITLICENSE mit--license", "mit license " * 3000, None, "",
]


def test_base_phrases():
    for text in TEXTS + [r[1] for r in ROWS]:
        assert licenses.scan_text(text or "")[:5] == brute(text)


def test_every_rule_finds_its_own_words_and_holds_its_keyword():
    rules, _ = licenses.rules()
    assert len(rules) > 200
    for rule, line in zip(rules, licenses.SIGNATURES.strip().splitlines()):
        words = line.split("|", 2)[2].replace("(", " ").replace(")", " ")
        example = " ".join(w.split("|")[0] for w in words.split())
        match = rule.pattern.search(example.encode())
        assert match and rule.keyword in match[0].decode(), line


def test_stronger_and_containing_spans_suppress():
    found = licenses.scan_text("licensed under the apache license version 2.0, see CC BY-SA 4.0")
    assert [s["label"] for s in found[7]] == ["apache-2.0", "cc-by-sa"]
    assert found[5] == "apache,apache-2.0,cc-by-sa" and 0 < found[6] <= 1


def test_awkward_rows_and_query(spark):
    docs = documents(spark).withColumn("Labels", F.lit("mine"))
    got = licenses.scan(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *licenses.FIELDS.names] and got.count() == len(ROWS)
    assert licenses.scan(docs.limit(0)).collect() == []
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    for r in registry.queries()["op6_licenses"](spark, path).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
