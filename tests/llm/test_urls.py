from pyspark.sql import functions as F

from subscriber_analytics.llm import urls
from subscriber_analytics.llm.components import components

PAGES = [
    (1, "http://a.net/x?q#f", None), (2, "HTTPS://Sub.Example.NET/en/1", ""), (3, "https://example.net/de/1#en/", "<p>"),
    (4, "http://example.com/de/9", None), (5, "http://notexample.com/de/9", None), (6, "http://m.x.org/fr/", None),
    (7, None, None), (8, "no scheme", "<link rel=canonical href='http://a.net/'>"), (9, "http://a.net", None), (10, "x://", None),
    # 11 -> 12 -> blocked; 13 is an alias of both a blocked and an allowed address.
    (11, "http://one.info/p", "<LINK href=\"//two.info/q?x=1\" REL='canonical'>"),
    (12, "http://two.info/q?x=1#top", "<meta http-equiv=refresh content='0; url=http://bad.net/z'>"),
    (13, "http://three.info/a/b", "<link rel=\"canonical\" href=\"c\"><meta http-equiv=\"refresh\" content=\"5;URL=http://x.net/1\">"),
    (14, "http://three.info/a/c", "<link rel='canonical' href='http://example.net/en/z'>"),
    (15, "http://four.info/", "<link rel='stylesheet' href='http://bad.net/z'>"), (11, "http://one.info/p", None),
    (16, "http://example.com/de/1?u=://q", None),
    # Pages that differ in their query alone are different nodes.
    (17, "http://hub.info/i.php?id=1", "<link rel=canonical href='http://bad.net/z'>"), (18, "http://hub.info/i.php?id=2", None),
    (19, "http://hub.info/i.php?id=3", "<link rel=canonical href='?id=1'>"), (20, "http://hub.info/i.php?id=4", "<link rel=canonical href='#x'>"),
    # A relative link on an empty path.
    (21, "http://five.info", "<link rel=canonical href='x.html'>"), (22, "http://five.info/x.html", "<link rel=canonical href='//bad.net/1'>"),
]
WANT = {
    1: ("a.net", "/x", "net/", "block"), 2: ("sub.example.net", "/en/1", "example.net/en/", "allow"),
    3: ("example.net", "/de/1", "net/", "block"), 4: ("example.com", "/de/9", "example.com/de/", "block"),
    5: ("notexample.com", "/de/9", None, "allow"), 6: ("m.x.org", "/fr/", "org/fr/", "allow"), 7: ("", "", None, "allow"),
    8: ("", "", None, "allow"), 9: ("a.net", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("one.info", "/p", None, "block"),
    12: ("two.info", "/q", None, "block"), 13: ("three.info", "/a/b", None, "allow"), 14: ("three.info", "/a/c", None, "allow"),
    15: ("four.info", "/", None, "allow"), 16: ("example.com", "/de/1", "example.com/de/", "block"),
    17: ("hub.info", "/i.php", None, "block"), 18: ("hub.info", "/i.php", None, "allow"), 19: ("hub.info", "/i.php", None, "block"),
    20: ("hub.info", "/i.php", None, "allow"), 21: ("five.info", "", None, "block"), 22: ("five.info", "/x.html", None, "block"),
}


def test_rules_and_aliases(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("Verdict", F.lit("mine")).withColumn("component", F.lit(1)).withColumn("action", F.lit("mine")).withColumn("blocked", F.lit(False))
    rules = spark.createDataFrame(urls.RULES, "rule string, action string")
    got = urls.judge(pages, rules).collect()
    assert len(got) == len(PAGES)
    for row in got:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == WANT[row["page_id"]], row
    assert urls.judge(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_components_of_a_path_a_hub_and_a_loop(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
