"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets."""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored

RUNS = r"[A-Za-z\u00C0-\u00FF]+"
LEAST_LETTERS = 5
LEAST_COUNT = 3
# One run in so many loses a letter.
SLIP_EVERY = 97
# A form is at least so many times as frequent as the word.
FORM_TIMES = 2
# Parts of the letters. At most two of them hold the differences of two near words.
PARTS = 8


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, at least five letters long and found at least three times.

    A run loses one letter where 97 divides the checksum of its document's id and itself; a null id counts as
    an empty text there.
    """
    low = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(low, F.lit(RUNS), F.lit(0))).alias("run"))
    # Shorter runs cannot make a word: a slip only shortens.
    sized = runs.withColumn("size", F.length("run")).where(F.col("size") >= LEAST_LETTERS)
    check = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = (F.col("check") % F.col("size")).cast("int")
    slipped = F.concat(F.left("run", cut), F.substr("run", cut + 2))
    made = sized.withColumn("check", check).select(
        F.when(F.col("check") % SLIP_EVERY == 0, slipped).otherwise(F.col("run")).alias("word"))
    return made.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _part(part: int) -> Column:
    """The sorted letters of ``letters`` in one part: the word's vector on those dimensions."""
    return F.array_join(F.filter("letters", lambda c: F.ascii(c) % PARTS == part), "")


def signatures(vocabulary: DataFrame) -> DataFrame:
    """vocabulary (word, n) with a row for each signature: key and side.

    A word is a binary vector with a dimension for each letter and repetition of it. One replaced letter makes a
    Hamming distance of 2 between words of one length, one inserted letter a distance of 1 between lengths
    that differ by 1. The dimensions are dealt into parts, by letter. Two vectors at distance 2 agree on all
    but two parts at most, so each choice of two left-out parts gives a signature of the others (side 0); at
    distance 1 one part is left out, in one signature under the length of the shorter word for either role
    (side 1 the shorter word, 2 the longer). A signature's 64-bit hash may meet another one; words are compared.
    """
    letters = F.array_sort(F.filter(F.split("word", ""), lambda c: c != ""))
    parted = vocabulary.select("word", "n", F.length("word").alias("size"), letters.alias("letters")).select(
        "word", "n", "size", *[_part(p).alias(f"p{p}") for p in range(PARTS)])

    def key(left_out: tuple[int, ...], size: Column) -> Column:
        kept = [F.lit("-") if p in left_out else F.col(f"p{p}") for p in range(PARTS)]
        return F.xxhash64(F.concat_ws("/", *kept), F.lit(len(left_out)), size)

    size = F.col("size")
    made = [(key(two, size), 0) for two in combinations(range(PARTS), 2)]
    made += [(key((one,), size), 1) for one in range(PARTS)] + [(key((one,), size - 1), 2) for one in range(PARTS)]
    rows = F.array(*[F.struct(k.alias("key"), F.lit(side).alias("side")) for k, side in made])
    return parted.select("word", "n", F.inline(rows))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways round: words that differ by one inserted, deleted or replaced letter.

    Words meet by equal signatures; a pair that meets under several is verified there and kept once.
    """
    signed = stored(signatures(vocabulary), "signatures")
    left = signed.where("side < 2")
    right = signed.where("side <> 1").select("key", F.col("side").alias("other_side"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    role = ((F.col("side") == 0) & (F.col("other_side") == 0) & (F.col("word") < F.col("other"))) | (
        (F.col("side") == 1) & (F.col("other_side") == 2))
    met = left.join(right, "key").where(role & (F.levenshtein("word", "other", 1) == 1))
    pairs = stored(met.select("word", "n", "other", "other_n").distinct(), "near-words")
    return pairs.unionAll(pairs.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for forms (word, form): the last word of each chain.

    Each round doubles the length of the path a word has gone. A form is at least twice as frequent as its word, so
    chains have no loops and at most as many steps as the greatest count has bits.
    """
    paths = stored(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = stored(paths.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "paths")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        paths = moved.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    The form is the near word of the largest n, of equal ones the first in code points, if it is at least twice as
    frequent; else null, as form_n. The root is the last word of the chain of forms, the word itself without one.
    Null and empty texts have no words, repeated rows count as often as they occur, an empty table gives an empty
    one. Other columns are not read.
    """
    vocabulary = stored(words(docs, doc_id, text), "words")
    best = near_pairs(vocabulary).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    frequent = -F.col("best.less") >= FORM_TIMES * F.col("n")
    chosen = stored(best.select("word", "n_near", F.when(frequent, F.col("best.other")).alias("form"),
                                F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(chosen.where("form IS NOT NULL"))
    return vocabulary.join(chosen, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
