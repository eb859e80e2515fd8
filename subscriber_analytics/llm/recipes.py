"""Exact duplicates by content-defined chunk recipes, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored, without

# Characters that do not count: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
# Bytes of a chunk: at least and at most.
LEAST, MOST = 256, 4096
NEW = ("keep_id", "group_size", "kept", "n_chunks", "text_sha256")


def _bytes(factor: int) -> str:
    """A class of three sixteenths of all bytes, as a regex class."""
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if b * factor % 256 < 48) + "]"


# A chunk ends behind three bytes of three classes, which depends on those bytes alone.
CHUNK = rf"(?s).{{{LEAST},{MOST - 1}}}?(?<={_bytes(167)}{_bytes(89)}{_bytes(211)})|.{{1,{MOST}}}"


def normalized(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def chunks(normal: Column) -> Column:
    """The UTF-8 bytes of a text cut at content-defined places: an array of binaries, empty for an empty text."""
    one_a_byte = F.decode(normal.cast("binary"), "ISO-8859-1")
    return F.transform(F.regexp_extract_all(one_a_byte, F.lit(CHUNK), F.lit(0)), lambda c: F.encode(c, "ISO-8859-1"))


def chunk_hash(body: Column) -> Column:
    return F.xxhash64(body)


def _shared_hashes(bodies: DataFrame) -> DataFrame:
    """Hashes that different chunks share, found by comparing whole chunks; each distinct chunk is moved once."""
    return stored(bodies.groupBy("hash").count().where("count > 1").select("hash"), "shared-hashes")


def _recipes(rows: DataFrame, identify: Callable[[Column], Column]) -> DataFrame:
    """rows (with normal) with recipe and places instead: the identifiers of the chunks in order.

    An identifier is a chunk's hash with the place of the chunk among the different ones of that hash. Places are left
    empty where every hash belongs to one chunk, which is what the comparison of all distinct chunks found.
    """
    cut = rows.withColumn("bodies", chunks(F.col("normal"))).drop("normal")
    bodies = cut.select(F.explode("bodies").alias("body")).select(identify(F.col("body")).alias("hash"), "body").distinct()
    shared = _shared_hashes(bodies)
    recipe = F.transform("bodies", identify)
    alone = F.array().cast("array<int>")
    if shared.isEmpty():
        return cut.select("*", recipe.alias("recipe"), alone.alias("places")).drop("bodies")
    cut = stored(cut, "chunked-texts")
    order = F.row_number().over(W.partitionBy("hash").orderBy("body"))
    ranked = stored(bodies.join(shared, "hash", "left_semi").withColumn("place", order), "verified-chunks")
    used = cut.select("row", F.posexplode("bodies").alias("n", "body")).select("row", "n", identify(F.col("body")).alias("hash"), "body")
    used = used.join(ranked, ["hash", "body"], "left").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("n", F.coalesce("place", F.lit(1)).alias("place")))).alias("used"))
    used = used.select("row", F.transform("used", lambda c: c["place"]).alias("places"))
    return cut.select("*", recipe.alias("recipe")).drop("bodies").join(used, "row", "left").withColumn(
        "places", F.coalesce("places", alone))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          identify: Callable[[Column], Column] = chunk_hash) -> DataFrame:
    """docs (without text) with keep_id, group_size, kept, n_chunks and text_sha256.

    Rows are copies if their texts are equal without blanks, tabs and line ends, that is, if their recipes are. Of a
    group stays the row with the longest original text, then the smallest id, rows without an id last; exactly one
    row has kept, also where rows are repeated. Null and empty texts and those of blanks alone are one group.
    text_sha256 is of the text without them, in UTF-8. An empty table gives an empty one. Columns of
    the new names are replaced. Texts are read twice and never moved, but for one copy of each distinct chunk.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in without(docs, (text, *NEW))])
    full = F.col(f"`{text}`")
    rows = docs.select(own.alias("own"), F.col(f"`{doc_id}`").alias("id"), F.length(F.coalesce(full, F.lit(""))).alias("size"),
                       F.xxhash64(full).alias("tie"), normalized(full).alias("normal"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "text_sha256": F.sha2(F.col("normal").cast("binary"), 256)})
    rows = stored(_recipes(rows, identify), "recipes")
    first = F.min(F.struct((-F.col("size")).alias("size"), F.col("id").isNull().alias("none"), "id", "tie", "row"))
    groups = stored(rows.groupBy("recipe", "places").agg(first.alias("first"), F.count("*").alias("group_size")), "recipe-groups")
    return rows.join(groups, ["recipe", "places"]).select(
        "own.*", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        F.size("recipe").cast("long").alias("n_chunks"), "text_sha256")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, unchanged; the texts are joined back by a row number (column _copy_row, replaced)."""
    numbered = stored(docs.withColumn("_copy_row", F.monotonically_increasing_id()), "numbered")
    left = judge(numbered, doc_id, text).where("kept").select("_copy_row")
    return numbered.join(left, "_copy_row", "left_semi").drop("_copy_row")
