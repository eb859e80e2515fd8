"""Mixing sources to target weights: whole copies, then Pareto order sampling up to each target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscriber_analytics.llm.arrow import stored, without

MAX_COPIES = 3
WORDS = r"[^\x20\x09-\x0D]+"
SEED = 9
# Sampling ranks are whole numbers of LEVELS groups of DIGIT bits; a level looks at one group.
LEVELS, DIGIT = 5, 10
RANK_BITS = LEVELS * DIGIT

OWN = ("size", "source_size", "target", "copies", "taken", "_draw", "_rank", "_id", "_class", "_whole", "_part",
       "_below", "_rest", "_cut", "_last")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """docs with size (words), the class of the size (its length in bits) and a uniform draw.

    The draw is a hash of id and text, so that every run and every retried task draws the same.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS)).cast("long")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11).cast("double")
    return docs.select(*[f"`{c}`" for c in without(docs, OWN)], words.alias("size"), ((draw + 0.5) / 2.0**53).alias("_draw")).withColumn(
        "_class", F.when(F.col("size") == 0, 0).otherwise(F.length(F.bin("size"))))


def source_targets(sized: DataFrame, source: str = "source", weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, _id, source_size, target): the words that each source is to give.

    Sources by code point, null last, take the weights in turn and share all words by them. A target
    stops at MAX_COPIES times its source; what it cannot take goes to the others by weight.
    """
    sizes = sized.groupBy(source).agg(F.sum("size").alias("source_size"))
    # One row a source in one task: the only thing here that is not spread.
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last(source)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % len(weights)) + 1)
    rows = sizes.select(source, nth.alias("_id"), "source_size", weight.alias("w"))
    rows = rows.withColumn("most", F.lit(float(MAX_COPIES)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("w"), "_id")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(after)
    rows = rows.withColumns({"level": level, "place": F.row_number().over(order)})
    # The first source, by room for its weight, that the level does not fill sets the level for all after it.
    fits = F.when(F.col("level") <= F.col("most") / F.col("w"), F.struct("place", "level"))
    level = F.min(fits).over(everything)["level"]
    return rows.select(source, "_id", "source_size", F.least("most", F.coalesce(level * F.col("w"), "most")).alias("target"))


def expected_copies(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(_id, _class, expected): copies of a document of each source and size class.

    Longer documents are taken more often: expected copies go with the bits of the size, up to
    MAX_COPIES, by the factor that makes the expected words of the source its target.
    """
    classes = sized.where("size > 0").groupBy("_id", "_class").agg(F.sum("size").cast("double").alias("words"))
    rows = classes.join(targets.select("_id", "target"), "_id")
    down = Window.partitionBy("_id").orderBy(F.desc("_class"))
    full = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(F.col("words") * F.col("_class")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("factor", (F.col("target") - MAX_COPIES * full) / rest)
    fits = F.when(F.col("factor") * F.col("_class") <= MAX_COPIES, F.struct(F.col("_class").alias("c"), "factor"))
    best = F.max(fits).over(Window.partitionBy("_id"))
    expected = F.when(F.col("_class") > best["c"], float(MAX_COPIES)).otherwise(best["factor"] * F.col("_class"))
    return rows.select("_id", "_class", F.greatest(F.coalesce(expected, F.lit(float(MAX_COPIES))), F.lit(0.0)).alias("expected"))


def _rank() -> Column:
    """Odds of the draw by odds of the inclusion, squeezed into RANK_BITS bits; null without a chance."""
    odds = F.col("_draw") / (1 - F.col("_draw")) * (1 - F.col("_part")) / F.when(F.col("_part") > 0, F.col("_part"))
    return F.floor(odds / (1 + odds) * float((1 << RANK_BITS) - 1)).cast("long")


def _cuts(rows: DataFrame, rests: DataFrame) -> DataFrame:
    """(_id, _cut, _last): ranks below _cut are taken, the rank itself where _last.

    Level by level: words are summed by source and digit of the rank, the digit in which the rest of
    the target is reached is the place of the cut, and the next level looks only inside it. Each
    level sends at most 2 ** DIGIT sums a source to one task.
    """
    # Stored, as the cuts of each level are: a join with a stored table is planned by its size, and split where hot.
    cuts = stored(rests.select("_id", "_rest", F.lit(0).cast("long").alias("_cut"), F.lit(0).cast("long").alias("_below")), "cuts")
    for level in range(LEVELS):
        shift = RANK_BITS - DIGIT * (level + 1)
        inside = rows.join(cuts, "_id").where(F.shiftright("_rank", shift + DIGIT) == F.col("_cut"))
        digits = inside.groupBy("_id", F.shiftright("_rank", shift).alias("digit"), "_rest", "_below").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("_id").orderBy("digit"))
        summed = digits.withColumn("upto", F.col("_below") + upto)
        reached = summed.where(F.col("upto") > F.col("_rest")).groupBy("_id").agg(
            F.min(F.struct("digit", (F.col("upto") - F.col("words")).alias("below"))).alias("at"))
        # A source that never reaches its rest is taken whole: its cut lies behind all ranks.
        found = cuts.select("_id", "_rest").join(reached, "_id", "left")
        cuts = stored(found.select(
            "_id", "_rest", F.coalesce(F.col("at.digit"), F.lit((1 << (RANK_BITS - shift)))).alias("_cut"),
            F.coalesce(F.col("at.below"), F.lit(0)).alias("_below")), "cuts")
    at_cut = rows.join(cuts, "_id").where("_rank = _cut").groupBy("_id").agg(F.sum("size").alias("words"))
    nearer = F.coalesce(F.col("_below") + F.col("words") - F.col("_rest") < F.col("_rest") - F.col("_below"), F.lit(False))
    return stored(cuts.join(at_cut, "_id", "left").select("_id", "_cut", nearer.alias("_last")), "cuts")


def _placed(sized: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    return sized.join(targets.withColumnRenamed(source, "_source"), F.col(source).eqNullSafe(F.col("_source"))).drop("_source")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), keep_text: bool = True,
) -> DataFrame:
    """docs with size, source_size, target, copies and taken (copies * size).

    A document of expected copies e gets floor(e) for certain. The rest of a source's target is a
    Pareto sample: documents in the order of (odds of a uniform draw) / (odds of e - floor(e)), as many
    as the words that are left to take, to the nearest document. Rows that are equal in id and text draw alike and
    are taken or left together. Texts that are null or without words have size 0 and are never
    taken; a null source is a source. An empty table gives an empty one.
    """
    full = measured(docs, doc_id, text)
    narrow = full.select("size", "_draw", "_class", source) if keep_text else full.drop(text)
    sized = stored(narrow, "sizes")
    targets = stored(source_targets(sized, source, weights), "targets")
    placed = _placed(sized, targets, source)
    expected = expected_copies(placed.select("_id", "_class", "size"), targets)
    copies = stored(expected.select("_id", "_class", F.floor("expected").alias("_whole"),
                                    (F.col("expected") - F.floor("expected")).alias("_part")), "copies")
    ranked = stored(placed.select("_id", "size", "_class", "_draw").join(copies, ["_id", "_class"]).select(
        "_id", "size", "_whole", _rank().alias("_rank")), "ranks")
    whole = ranked.groupBy("_id").agg(F.sum(F.col("_whole") * F.col("size")).alias("words"))
    rests = targets.join(whole, "_id").select("_id", (F.col("target") - F.col("words")).alias("_rest"))
    cuts = _cuts(ranked.where("_rank IS NOT NULL").select("_id", "size", "_rank"), rests)
    rows = _placed(full if keep_text else sized, targets, source)
    rows = rows.join(copies, ["_id", "_class"], "left").join(cuts, "_id", "left").withColumn("_rank", _rank())
    extra = F.coalesce((F.col("_rank") < F.col("_cut")) | ((F.col("_rank") == F.col("_cut")) & F.col("_last")), F.lit(False))
    rows = rows.withColumn("copies", F.coalesce("_whole", F.lit(0)) + extra.cast("long"))
    kept = [c for c in without(docs, OWN) if keep_text or c != text]
    return rows.select(*[f"`{c}`" for c in kept], "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))
