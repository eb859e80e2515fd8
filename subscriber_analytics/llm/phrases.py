"""Phrase collocations: one count of padded four-word windows, and its ROLLUP for every shorter phrase."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import blocks, flat, prepare, stored

LEAST_COUNT = 30
TOP = 2000
# A phrase goes if a longer candidate around it has this share of its occurrences.
COVER_PERCENT = 80
SCALE = 2_000_000
# Scores reach half of SCALE; phrases of a language are counted in bands of so many.
BAND = 1000
LONGEST = 4
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"
NO_LANG = "und"
# Bytes of text whose windows are counted together before the shuffle; a longer text is a block of its own.
BLOCK_BYTES = 6 << 20
OUT_ROWS = 50_000
# The most frequent words are short numbers in the shuffle, all others are written out. So many, of so many
# characters at most: that bounds what is sent to every task.
CODED_WORDS, CODED_LETTERS = 50_000, 40
# A word is common with more than this share of all words, so there are fewer common words than this. Windows
# that begin with two common words are dealt by their other words too.
COMMON = 256
SALTS = 64
# Digits of the numbers: printable, without the blank between words and the mark of a word written out.
DIGITS = "".join(chr(c) for c in range(35, 127))
SPELLED = "!"

PAIR_FIELDS = T.StructType([T.StructField("line", T.StringType(), False)])
WORD_FIELDS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("word", T.StringType()), T.StructField("f", T.LongType())])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.zeros(256, bool)
_END[[*b".,;:!?", 10, 11, 12, 13]] = True
_WORD = ~_END
_WORD[[9, 32]] = False


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The lower-cased words of all texts, the text of each, and whether the next word is in the same piece."""
    data, offsets = flat(texts)
    word = _WORD[data]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    edge[begins] = word[begins]
    starts = np.flatnonzero(edge)
    edge = word.copy()
    edge[:-1] &= ~word[1:]
    edge[begins[1:] - 1] = word[begins[1:] - 1]
    bounds = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(edge) + 1 - starts, out=bounds[1:])
    del edge
    body = _LOWER[data[word]]
    del word
    found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(body)]).dictionary_encode()
    del bounds, body
    owner = np.searchsorted(offsets[1:], starts, side="right").astype(np.int32)
    piece = np.searchsorted(np.flatnonzero(_END[data]), starts)
    same = np.zeros(len(starts), bool)
    same[:-1] = (owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1])
    return found, owner, same


def _number(place: int) -> str:
    """The place of a word as digits: fewer for the more frequent."""
    digits, place = "", place + 1
    while place:
        place, digit = divmod(place - 1, len(DIGITS))
        digits = DIGITS[digit] + digits
    return digits


def _coded(words: pa.Array, coded: pa.Array) -> pa.Array:
    """Each word as its number among the coded ones, or written out behind the mark."""
    numbers = pa.array([_number(k) for k in range(len(coded))], pa.string())
    spelled = pc.binary_join_element_wise(pa.scalar(SPELLED), words, "")
    return pc.coalesce(numbers.take(pc.index_in(words, value_set=coded)), spelled)


def _taken(words: pa.Array, codes: np.ndarray) -> pa.Array:
    """The words of the codes; -1 is no word."""
    return words.take(pa.array(codes, mask=codes < 0)).fill_null("")


def _joined(tokens: pa.Array, first: np.ndarray, second: np.ndarray) -> pa.Array:
    """Two words with a blank between them, or fewer."""
    a, b = _taken(tokens, first), _taken(tokens, second)
    return pc.ascii_rtrim(pc.binary_join_element_wise(a, b, " "), " ")


def _counted_windows(texts: pa.Array, langs: pa.Array, coded: pa.Array, common: int) -> Iterator[pa.RecordBatch]:
    """The windows of a block: for each pair of first words their number, and all ends with theirs.

    Sorted as numbers, written out in batches of about OUT_ROWS ends: what a task holds at once is mostly the numbers.
    """
    words, owner, same = _words(texts)
    langs = langs.fill_null(NO_LANG).dictionary_encode()
    known = words.dictionary
    lead = words.indices.to_numpy(zero_copy_only=False)
    lang = langs.indices.to_numpy(zero_copy_only=False)[owner]
    leads, within = [lead], same
    for k in range(1, LONGEST):
        ahead = np.full(len(lead), -1, np.int32)
        ahead[:-k] = np.where(within[:-k], lead[k:], -1)
        leads.append(ahead)
        within = within & np.r_[same[k:], np.zeros(min(k, len(same)), bool)]
    del words, owner, same, within
    hot = np.r_[pc.is_in(known, value_set=coded[:common]).to_numpy(zero_copy_only=False).astype(bool), False]
    salt = np.zeros(len(lead), np.int8)
    dealt = np.flatnonzero(hot[lead] & hot[leads[1]])
    used, places = np.unique(np.r_[leads[2][dealt], leads[3][dealt]], return_inverse=True)
    hashes = np.array([zlib.crc32(w.encode()) if w else 0 for w in _taken(known, used).to_pylist()], np.int64)[places]
    salt[dealt] = (hashes[:len(dealt)] * 31 + hashes[len(dealt):]) % SALTS + 1
    del dealt, used, places, hashes
    start = (lang.astype(np.int64) << 32) | lead, ((leads[1].astype(np.int64) + 1) << 8) | salt
    end = ((leads[2].astype(np.int64) + 1) << 32) | (leads[3] + 1)
    order = np.lexsort((end, start[1], start[0])).astype(np.int32)
    new_pair = np.ones(len(order), bool)
    new_pair[1:] = False
    for key in start:
        key = key[order]
        new_pair[1:] |= key[1:] != key[:-1]
    end = end[order]
    new_end = new_pair.copy()
    new_end[1:] |= end[1:] != end[:-1]
    del start, end, key
    pairs, ends = np.flatnonzero(new_pair).astype(np.int32), np.flatnonzero(new_end).astype(np.int32)
    del new_pair, new_end
    counts, sizes = np.diff(np.r_[ends, len(order)]), np.diff(np.r_[pairs, len(order)])
    bounds = np.r_[np.searchsorted(ends, pairs), len(ends)].astype(np.int32)
    rows, order = order[pairs], order[ends]
    third, fourth = leads[2][order], leads[3][order]
    lead, second, lang, salt = lead[rows], leads[1][rows], lang[rows], salt[rows]
    del leads, order, rows, pairs, ends
    tokens = _coded(known, coded)
    names = langs.dictionary
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
        names = pc.replace_substring(names, plain, escaped)
    first = 0
    while first < len(lead):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + OUT_ROWS, side="right")) - 1)
        own, inner = slice(first, last), slice(bounds[first], bounds[last])
        rests = _joined(tokens, third[inner], fourth[inner])
        many = pc.binary_join_element_wise(pa.scalar("\r"), pa.array(counts[inner]).cast(pa.string()), "")
        items = pc.binary_join_element_wise(rests, pc.if_else(pa.array(counts[inner] == 1), "", many), "")
        lists = pa.ListArray.from_arrays(pa.array(bounds[first:last + 1] - bounds[first]), items)
        salts = pc.binary_join_element_wise(pa.scalar("\t"), pa.array(salt[own]).cast(pa.string()), "")
        group = pc.binary_join_element_wise(names.take(pa.array(lang[own])), _joined(tokens, lead[own], second[own]), "\t")
        group = pc.binary_join_element_wise(group, pc.if_else(pa.array(salt[own] > 0), salts, ""), "")
        yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(
            group, pa.array(sizes[own]).cast(pa.string()), pc.binary_join(lists, "\n"), "\n")], names=PAIR_FIELDS.names)
        first = last


def _counted_words(texts: pa.Array, langs: pa.Array) -> pa.RecordBatch:
    words, owner, _ = _words(texts)
    langs = langs.fill_null(NO_LANG).dictionary_encode()
    size = max(len(words.dictionary), 1)
    keys = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] * size + words.indices.to_numpy(zero_copy_only=False)
    keys, counts = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(keys // size)), words.dictionary.take(pa.array(keys % size)), pa.array(counts)],
        names=WORD_FIELDS.names)


def _large_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of about BLOCK_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        for part in blocks(batch, "text", BLOCK_BYTES):
            held.append(part)
            size += part.nbytes
            if size >= BLOCK_BYTES:
                table = pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                yield table
                del table
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).cast(pa.string())
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of docs (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _large_blocks(batches):
            made = _counted_words(_column(table, "text"), _column(table, "lang"))
            yield from (made.slice(k, OUT_ROWS) for k in range(0, made.num_rows, OUT_ROWS))

    return docs.select("text", "lang").mapInArrow(run, WORD_FIELDS).groupBy("lang", "word").agg(F.sum("f").alias("f"))


def frequent_words(counted: DataFrame) -> tuple[list[str], int]:
    """The most frequent words of counted (lang, word, f), at most CODED_WORDS, and how many are common ones."""
    total = counted.agg(F.sum("f")).first()[0] or 0
    each = counted.where(F.length("word") <= CODED_LETTERS).groupBy("word").agg(F.sum("f").alias("f"))
    best = each.orderBy(F.desc("f"), "word").limit(CODED_WORDS).collect()
    return [r["word"] for r in best], sum(r["f"] * COMMON > total for r in best)


def windows(docs: DataFrame, coded: list[str], common: int) -> DataFrame:
    """Lines of the windows of a block of texts, for docs (text, lang).

    A window is a word and the three that follow it in its piece, or fewer at the piece's end. Those of a block that
    share their first two words are one text: the group, their number, and all ends, one a line, each with its
    number behind a carriage return if it is not 1. The group is the language (escaped), the pair and, for
    pairs of two common words, a salt of the end, behind tabs. Words are numbers or written out, as _coded says.
    """
    known = pa.array(coded, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _large_blocks(batches):
            yield from _counted_windows(_column(table, "text"), _column(table, "lang"), known, common)

    return docs.select("text", "lang").mapInArrow(run, PAIR_FIELDS)


def _spelled(docs: DataFrame, coded: list[str]) -> DataFrame:
    """docs (lang, phrase, ...) with the numbers of the words replaced by the words, and lang as it was."""
    words = {_number(k): word for k, word in enumerate(coded)}
    plain = {"\\\\": "\\", "\\t": "\t", "\\n": "\n"}
    schema, places = docs.schema, [docs.columns.index(c) for c in ("lang", "phrase")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [re.sub(r"\\[\\tn]", lambda m: plain[m[0]], name) for name in batch.column("lang").to_pylist()]
            full = [" ".join(t[1:] if t[:1] == SPELLED else words[t] for t in p.split(" ")) if p else p
                    for p in batch.column("phrase").to_pylist()]
            for place, name, values in zip(places, ("lang", "phrase"), (langs, full), strict=True):
                batch = batch.set_column(place, name, pa.array(values, pa.string()))
            yield batch

    return docs.mapInArrow(run, schema)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT) -> DataFrame:
    """(lang, k, phrase, f): phrases of k = 1 to 4 words with at least ``least`` occurrences, and all words as k = 0.

    Words are counted first, for their numbers. Of phrases only whole windows are counted; the ROLLUP over the pair
    of first words, w3 and w4 adds them up to the phrases they begin with.
    Windows of one pair of words meet in one task, where a beginning that is rarer than ``least`` shows: it is no
    phrase, so its last words are hidden like padding before the ROLLUP, or the pair left out, and nearly nothing is
    moved again. The windows of two common words, the only ones that many rows may share, are dealt over SALTS
    tasks; of these only whole windows are hidden, as a task has but part of their beginnings.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    counted = stored(word_counts(plain), "word-counts")
    coded, common = frequent_words(counted)
    words = counted.where(F.col("f") >= least).select("lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), "f")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("f")).select("lang", F.lit(0).alias("k"), F.lit("").alias("phrase"), "f")

    group = F.substring_index("line", "\n", 1)
    dealt = windows(plain, coded, common).repartition(group).withColumn("group", group)
    size = F.substring_index(F.substring_index("line", "\n", 2), "\n", -1).cast("long")
    salted = F.size(F.split("group", "\t")) > 2
    shared = dealt.groupBy("group").agg(F.sum(size).alias("f"), F.bool_or(salted).alias("salted")).where(
        F.col("salted") | (F.col("f") >= least)).select("group")
    ends = dealt.join(shared.hint("shuffle_hash"), "group", "left_semi")
    ends = ends.select("group", F.explode(F.expr("slice(split(line, '\n'), 3, length(line))")).alias("end"))
    rest = F.substring_index("end", "\r", 1)
    ends = ends.select("group", rest.alias("rest"), F.when(F.col("end").contains("\r"), F.substring_index("end", "\r", -1).cast("long"))
                       .otherwise(1).alias("f"))
    ends = ends.select("group", F.when(F.col("rest") != "", F.substring_index("rest", " ", 1)).alias("w3"),
                       F.when(F.col("rest").contains(" "), F.substring_index("rest", " ", -1)).alias("w4"), "f")
    ends = ends.withColumn("f4", F.sum("f").over(W.partitionBy("group", "w3", "w4")))
    # With f4 in it this sum stays behind the other, whose sort serves both.
    ends = ends.withColumn("f3", F.sum(F.when(F.col("f4") > 0, F.col("f"))).over(W.partitionBy("group", "w3")))
    shown = ends.select(
        F.substring_index("group", "\t", 2).alias("pair"),
        F.when(salted | (F.col("f3") >= least), F.col("w3")).alias("w3"),
        F.when(F.col("f4") >= least, F.col("w4")).alias("w4"), "f")
    summed = shown.rollup("pair", "w3", "w4").agg(F.sum("f").alias("f"), F.grouping_id().alias("left_out")).where(F.col("f") >= least)
    # Bits of left_out, from the right: w4, w3 and the pair are summed over. A null that is not is padding.
    begin = F.substring_index("pair", "\t", -1)
    k = (F.when((F.col("left_out") == 0) & F.col("w4").isNotNull(), 4).when((F.col("left_out") == 1) & F.col("w3").isNotNull(), 3)
         .when((F.col("left_out") == 3) & begin.contains(" "), 2))
    found = summed.select(F.substring_index("pair", "\t", 1).alias("lang"), k.alias("k"), F.concat_ws(" ", begin, "w3", "w4").alias("phrase"), "f")
    return _spelled(found.where("k IS NOT NULL"), coded).unionAll(words).unionAll(totals)


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, top: int = TOP,
                 cover: int = COVER_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Candidates are phrases of 2 to 4 words with a >= ``least`` occurrences. A cut gives l and r, the occurrences of
    both parts, and a score, floor(2,000,000 a / (l + r)); the lowest cut counts, of equal ones the first. A part occurs
    wherever its phrase does, so it is among the counted phrases. A candidate goes if it lies in a longer one
    with at least ``cover`` percent of its occurrences. Products are decimals of 38 digits. n counts all words.

    Null texts are empty, a null language is "und"; texts without words and empty tables give no rows. Repeated
    rows count as often as they occur; ties go by a, then by the bytes of the phrase. Other columns are not read.
    """
    found = stored(phrase_counts(docs, text, lang, least), "phrase-counts")
    totals = found.where("k = 0").select("lang", F.col("f").alias("n"))
    parts = found.where("k > 0").select("lang", "phrase", "f")
    chosen = found.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = chosen.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("k")).alias("rest"))
    sized = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    sized = sized.withColumns({"wide_a": _wide("a"), "wide_lr": _wide("l") + _wide("r")})
    sized = sized.withColumn("score", F.expr(f"wide_a * {SCALE} DIV wide_lr"))
    best = stored(sized.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")), "phrase-scores")

    inner = chosen.where("k > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    around = stored(inner.select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("around")), "phrases-around")
    left = stored(best.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (_wide("around") * 100 < _wide("a") * cover)), "phrases-left")

    # Of a language only the bands of scores that its first phrases lie in go to the task that ranks them.
    band = F.floor(F.col("best.score") / BAND).alias("band")
    bands = left.groupBy("lang", band).count()
    above = F.coalesce(F.sum("count").over(W.partitionBy("lang").orderBy(F.desc("band")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lowest = stored(bands.withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("band").alias("lowest")), "score-bands")
    left = left.join(lowest, "lang").where(band >= F.col("lowest"))
    # A band of many equal scores is cut in parts first.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part_place = F.row_number().over(W.partitionBy("lang", part).orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase")))
    left = left.withColumn("part_place", part_place).where(F.col("part_place") <= top)
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase")))
    ranked = left.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
