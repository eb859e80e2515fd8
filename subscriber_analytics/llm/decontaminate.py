"""Benchmark decontamination: a prefix-filtered set join of shingles, verified over item-sized windows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored, without

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# All ASCII characters but digits and letters part words.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Benchmark shingles up to this number are sent to every task; more are joined by a shuffle.
BROADCAST_SHINGLES = 100_000

OWN = ("n_words", "n_hit", "n_items", "items", "contaminated", "_places", "_words", "_held", "_windows", "_hash", "_key", "_items")
_PLACES = "array<struct<start:int,size:int,window:string>>"


def _words(text: Column) -> Column:
    """Words of a text, A-Z in lower case. Only texts with other characters need the slower mapping."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(lowered, GAPS), lambda w: w != "")


def _folded(text: Column) -> Column:
    """All letters in lower case, the two small sigmas as one: what is equal in A-Z lower case stays equal."""
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def _joined(words: Column, start: Column, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, window, size): all windows of 10 consecutive words; a shorter item is one window of all its words."""
    worded = items.select(F.col(item_id).cast("string").alias("item"), _words(F.col(text)).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(WINDOW_WORDS))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - size + 1))
    return worded.select("item", "words", size.alias("size"), starts.alias("start")).select(
        "item", _joined(F.col("words"), F.col("start"), F.col("size")).alias("window"), "size").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, size, shingle, width, place) of distinct windows: their 3-word shingles, or all words of a shorter one."""
    words = F.split("window", " ")
    width = F.least("size", F.lit(SHINGLE_WORDS))
    rows = windows.select("window", "size").distinct().select("window", "size", words.alias("w"), width.alias("width"))
    rows = rows.select("window", "size", "w", "width", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("width"))).alias("place"))
    return rows.select("window", "size", "width", "place", _joined(F.col("w"), F.col("place") + 1, F.col("width")).alias("shingle"))


def _text_shingles(docs: DataFrame, key: str, text: str, widths: list[int]) -> DataFrame:
    """(key, at, token, total): hashes of the shingles of the given widths at each word, and the words of the text.

    Only candidates come of this, so it may map all letters to lower case: equal words stay equal.
    """
    worded = docs.select(F.col(key).alias("key"), F.filter(F.split(_folded(F.coalesce(F.col(text), F.lit(""))), GAPS), lambda w: w != "").alias("w"))

    def hashed(width: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("w") - width)
        made = F.transform(starts, lambda k: F.xxhash64(*[F.get("w", k + j) for j in range(width)]))
        return F.when(F.size("w") >= width, made)

    total = F.size("w").alias("total")
    if len(widths) == 1:
        return worded.select("key", total, F.posexplode(hashed(widths[0])).alias("at", "token"))
    rows = worded.select("key", total, F.explode(F.array(*[hashed(n) for n in widths])).alias("tokens"))
    return rows.select("key", "total", F.posexplode("tokens").alias("at", "token"))


def candidates(docs: DataFrame, windows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, start, size, window): places where a document may hold a window.

    A window is held only if all its shingles are, so the prefix that must be met is one shingle: its
    rarest in the documents. One scan finds all benchmark shingles in the documents and thereby how
    rare each is; then only places of prefixes go on, and of these only where the window begins not
    before the text (its place in the window) and ends not after it (its length).
    """
    tokens = stored(window_shingles(windows).withColumn("token", _token(F.col("shingle"), F.col("width"))), "benchmark-shingles")
    widths = sorted(r["width"] for r in tokens.select("width").distinct().collect())
    if not widths:
        return docs.select(F.col(doc_id).alias("key"), F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit("").alias("window")).where("false")
    known = tokens.select("token").distinct()
    known = F.broadcast(known) if known.count() <= BROADCAST_SHINGLES else known
    met = stored(_text_shingles(docs, doc_id, text, widths).join(known, "token"), "shingles-met")
    counts = met.groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.row_number().over(Window.partitionBy("window").orderBy("n", "token", "place"))
    # A shingle that no document has makes its window impossible, and is not in counts.
    ranked = tokens.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("nth", rarest)
    prefixes = ranked.where("nth = 1 AND n > 0").select("token", "window", "size", "place")
    start = (F.col("at") - F.col("place")).alias("start")
    found = met.join(prefixes, "token").where("at >= place AND at - place + size <= total")
    return found.select("key", start, "size", "window").distinct()


def _token(shingle: Column, width: Column) -> Column:
    """The hash that _text_shingles gives the same words."""
    words = F.split(_folded(shingle), " ")
    made = None
    for n in range(1, SHINGLE_WORDS + 1):
        this = F.xxhash64(*[F.get(words, F.lit(j)) for j in range(n)])
        made = F.when(width == n, this) if made is None else made.when(width == n, this)
    return made


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """docs (without text) with n_words, n_hit, n_items, items and contaminated.

    n_hit counts the words that lie in an occurrence of a window, items are the ids, sorted as strings,
    of the items that have an occurring window. A null or empty text has no words and no hit; an item
    without words has no window; an item without an id counts in n_hit alone. Rows that share a
    document id are judged each by their own text. An empty benchmark hits nothing.
    """
    windows = stored(benchmark_windows(items, item_id, item_text), "windows")
    # Places belong to a row's id and text: rows that share an id, or have none, do not get those of each other.
    # Should two rows have the same hash all the same, the check of the words decides.
    row_key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    places = candidates(docs.select(row_key.alias("key"), F.col(f"`{text}`").alias("text")), windows, "key", "text")
    by_doc = places.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("start", "size", "window")).alias("_places"))
    kept = [f"`{c}`" for c in without(docs, [*OWN, text])]
    joined = docs.select(*kept, text).join(by_doc, row_key == F.col("_key"), "left")
    worded = joined.select(*kept, F.xxhash64(text).alias("_hash"), "_places", _words(F.col(text)).alias("_words"))
    true = F.filter(F.coalesce("_places", F.array().cast(_PLACES)), lambda p: _joined(F.col("_words"), p["start"] + 1, p["size"]) == p["window"])
    held = worded.select(*kept, "_hash", F.size("_words").cast("long").alias("n_words"), true.alias("_held"))
    spans = F.array_sort(F.transform("_held", lambda p: F.struct(p["start"].alias("start"), (p["start"] + p["size"]).alias("end"))))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(spans, none, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n")), lambda a: a["n"])
    hit = stored(held.select(*kept, "_hash", "n_words", covered.cast("long").alias("n_hit"),
                             F.array_distinct(F.transform("_held", lambda p: p["window"])).alias("_windows")), "hits")
    named = hit.select(F.col(doc_id).alias("_key"), F.col("_hash").alias("_text"), F.explode("_windows").alias("window")).distinct()
    found = named.join(windows.where("item IS NOT NULL").select("window", "item"), "window").groupBy("_key", "_text").agg(
        F.array_sort(F.collect_set("item")).alias("_items"))
    same = F.col(doc_id).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_text"))
    items_of = F.coalesce("_items", F.array().cast("array<string>"))
    return hit.join(found, same, "left").select(
        *kept, "n_words", "n_hit", F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"))
