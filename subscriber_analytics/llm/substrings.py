"""Repeated substrings across all documents, removed byte by byte; sorted by the deep-shallow method."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from subscriber_analytics.llm.arrow import blocks, flat, prepare, stored, without
from subscriber_analytics.llm.suffixes import deep_shallow

LENGTH = 400
# Every string of LENGTH bytes is filed under the gram of so many bytes that has the least hash in it.
GRAM = 64
# Different contexts of a gram that are sorted in one task; more are split by longer shared bytes.
SORTED_TOGETHER = 256
# A key that more rows have is joined by broadcast; of n rows, at most n / FREQUENT such keys can be.
FREQUENT = 1000
BLOCK = 1 << 20
SEGMENT = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, below size."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (_BASE, inverse))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of all strings of ``length`` bytes inside the texts, one row for a run of strings with the same one.

    The anchor of a string is its gram of least hash, the first of equal ones: it depends on the
    string alone, so equal strings have it at the same place. Of each run: text, place of the anchor
    in it, least and greatest distance of a string's start before the anchor (lo, hi), the gram's
    hash (key) and the hash of all bytes of the run (full).
    """
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        none = np.zeros(0, np.int64)
        return {c: none for c in ("text", "pos", "lo", "hi", "key", "full")}
    powers, inverses = (p[:len(data) + 1] for p in _powers(1 << max(16, int(len(data) + 1).bit_length())))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:-1], out=sums[1:])
    hashes = _mixed((sums[gram:] - sums[:-gram]) * inverses[:len(data) - gram + 1])
    # The upper half of the hash, then the place: the least of these is the first least hash.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    window, step = length - gram + 1, 1
    while 2 * step <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:
        least = np.minimum(least[:len(least) - (window - step)], least[window - step:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = offsets[:-1][long]
    counts = sizes[long] - length + 1
    text = np.repeat(long, counts)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begins, counts)
    place = place[starts]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    pos, low, high = place[first], starts[first], starts[last]
    lo, hi = pos - high, pos - low
    body = (sums[high + length] - sums[low]) * inverses[low]
    full = _mixed(body + (lo * 1021 + hi).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return {"text": text[first], "pos": pos - offsets[:-1][text[first]], "lo": lo, "hi": hi,
            "key": hashes[pos].view(np.int64), "full": full.view(np.int64)}


def anchors_by_segment(
    data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, segment: int = SEGMENT,
) -> dict[str, np.ndarray]:
    """``anchors``, a text longer than ``segment`` bytes piece by piece: pieces overlap so that each string lies in one."""
    if len(offsets) != 2 or len(data) <= segment + length:
        return anchors(data, offsets, length, gram)
    parts = []
    for start in range(0, len(data) - length + 1, segment):
        piece = data[start:start + segment + length - 1]
        rows = anchors(piece, np.array([0, len(piece)]), length, gram)
        parts.append(rows | {"pos": rows["pos"] + start})
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def repeated_ranges(group: list[tuple[int, int, bytes]], length: int = LENGTH, gram: int = GRAM) -> list[list[tuple[int, int]]]:
    """Of each context (lo, hi, bytes around an anchor), the distances at which a string starts that another has too.

    Two contexts share the string that starts d bytes before their anchors if they are equal for d
    bytes to the left and length - d to the right of it. Both sides are sorted as suffixes of the
    anchor. Contexts that are equal for d bytes to the left are neighbours in the left order, and the
    one of them that is longest equal to the right is a neighbour in the right order.
    """
    rights = [body[hi:] for _, hi, body in group]
    lefts = [body[:hi][::-1] for _, hi, body in group]
    right_order, right_common = deep_shallow(rights, shallow=gram + 32)
    left_order, left_common = deep_shallow(lefts)
    rank = [0] * len(group)
    for n, index in enumerate(right_order):
        rank[index] = n
    found: list[list[tuple[int, int]]] = [[] for _ in group]
    depths = sorted(set(left_common[1:]), reverse=True)
    for n, depth in enumerate(depths):
        least = depths[n + 1] + 1 if n + 1 < len(depths) else 0
        start = 0
        for stop in range(1, len(group) + 1):
            if stop < len(group) and left_common[stop] >= depth:
                continue
            alike = sorted((rank[k], k) for k in left_order[start:stop])
            start = stop
            before = -1
            for m, (place, index) in enumerate(alike):
                after = min(right_common[place + 1:alike[m + 1][0] + 1]) if m + 1 < len(alike) else -1
                lo, hi, _ = group[index]
                low, high = max(length - max(before, after), least, lo), min(depth, hi)
                if max(before, after) >= 0 and low <= high:
                    found[index].append((low, high))
                before = after
    return found


def _schema(docs: DataFrame, doc_id: str, more: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("uid", T.LongType()), *more])


_PLACE = [T.StructField("pos", T.IntegerType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())]
_KEYS = [T.StructField("key", T.LongType()), T.StructField("full", T.LongType())]
_BODY = [T.StructField("body", T.BinaryType()), T.StructField("alone", T.BooleanType()),
         T.StructField("least", T.IntegerType()), T.StructField("most", T.IntegerType())]
_SPAN = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]


def _anchor_rows(schema: T.StructType, length: int, gram: int):
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", BLOCK):
                rows = anchors_by_segment(*flat(part.column("text").cast(pa.string())), length, gram)
                owners = pa.array(rows["text"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(owners), part.column("uid").take(owners)]
                    + [pa.array(rows[f.name]).cast(f.type) for f in list(target)[2:]], schema=target)

    return run


def _sorted_rows(schema: T.StructType, length: int, gram: int):
    """Spans of the strings that contexts of one key share; rows come sorted by key."""
    target = to_arrow_schema(schema)

    def spans(rows: list[dict]) -> list[tuple]:
        found = repeated_ranges([(r["lo"], r["hi"], r["body"]) for r in rows], length, gram)
        return [(r["id"], r["uid"], r["pos"] - high, r["pos"] - low + length)
                for r, ranges in zip(rows, found, strict=True) if r["alone"] for low, high in ranges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            done: list[tuple] = []
            for row in batch.to_pylist():
                if held and held[-1]["key"] != row["key"]:
                    done += spans(held)
                    held = []
                held.append(row)
            yield _batch(done, target)
        yield _batch(spans(held), target)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _hash(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "big", signed=True)


def _halved_rows(schema: T.StructType, length: int):
    """Each context twice, for either half of the distances, under a key of all bytes that such strings share."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle = (r["least"] + r["most"]) // 2
                for least, most in ((r["least"], middle), (middle + 1, r["most"])):
                    lo, hi = max(r["lo"], least), min(r["hi"], most)
                    if least > most or lo > hi:
                        continue
                    body = r["body"][r["hi"] - hi:r["hi"] - lo + length]
                    key = _hash(b"%d,%d" % (least, most), r["body"][r["hi"] - least:r["hi"] + length - most])
                    out.append((r["id"], r["uid"], r["pos"], lo, hi, key, _hash(b"%d,%d" % (lo, hi), body),
                                body, r["alone"], least, most))
            yield _batch(out, target)

    return run


def joined(rows: DataFrame, counts: DataFrame, on: list[str], n: str, how: str) -> DataFrame:
    """rows joined with counts, one row for a key that ``n`` rows have, so that no task gets all rows of a frequent key."""
    frequent = F.broadcast(counts.where(F.col(n) > FREQUENT))
    rest = rows.join(frequent.select(*on), on, "left_anti")
    return rows.join(frequent, on, how).unionAll(rest.join(counts.where(F.col(n) <= FREQUENT), on, how))


def _contexts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct contexts with their number of occurrences and one owner; and sizes of keys with several."""
    contexts = stored(rows.groupBy("key", "full").agg(
        F.count("*").alias("n"), F.min(F.struct("uid", "pos", "id", "lo", "hi")).alias("owner")), "contexts")
    sizes = stored(contexts.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    return contexts, sizes


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, together: int = SORTED_TOGETHER,
) -> DataFrame:
    """(id, uid, spans): byte ranges [start, end), sorted and apart, that strings found elsewhere too cover.

    ``uid`` is a hash of id and text, which tells rows of one id apart. Strings meet by the gram that
    anchors them. Contexts of an anchor that are equal as a whole are repeated as a whole and go on as
    one, so thousands of copies cost no more than one; different ones are sorted. Where more than ``together`` of
    them share an anchor they are split by halves of the distances from it, under keys of all bytes that the
    strings of a half share, until only strings that are equal are left together.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.lit("uid"), doc_id, text).alias("uid"), F.col(text).alias("text"))
    schema = _schema(docs, doc_id, [*_PLACE, *_KEYS])
    found = stored(rows.where(F.octet_length("text") >= length).mapInArrow(_anchor_rows(schema, length, gram), schema), "anchors")
    keys = stored(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    met = stored(joined(found, keys, ["key"], "n", "left_semi"), "anchors-met")

    def whole(of: DataFrame, contexts: DataFrame) -> DataFrame:
        again = joined(of, contexts.where("n > 1").select("key", "full", "n"), ["key", "full"], "n", "left_semi")
        return again.select("id", "uid", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("end"))

    contexts, sizes = _contexts(met)
    spans = [whole(met, contexts)]
    wanted = joined(contexts, sizes, ["key"], "size", "inner").select("key", "full", "size", (F.col("n") == 1).alias("alone"), "owner.*")
    wanted = wanted.withColumnRenamed("uid", "_uid").withColumnRenamed("id", "_id")
    body = F.substring(F.col("text").cast("binary"), F.col("pos") - F.col("hi") + 1, F.col("hi") - F.col("lo") + length)
    bodies = rows.join(wanted, (F.col("uid") == F.col("_uid")) & F.col("id").eqNullSafe(F.col("_id"))).select(
        "id", "uid", "pos", "lo", "hi", "key", "full", body.alias("body"), "alone",
        F.lit(0).alias("least"), F.lit(length - gram).alias("most"), "size").dropDuplicates(["key", "full"])
    span_schema = _schema(docs, doc_id, _SPAN)
    half_schema = _schema(docs, doc_id, [*_PLACE, *_KEYS, *_BODY])
    while True:
        bodies = stored(bodies, "bodies")
        small = bodies.where(F.col("size") <= together).drop("size").repartition("key").sortWithinPartitions("key")
        spans.append(small.mapInArrow(_sorted_rows(span_schema, length, gram), span_schema))
        large = bodies.where(F.col("size") > together).drop("size")
        if large.isEmpty():
            break
        halves = stored(large.mapInArrow(_halved_rows(half_schema, length), half_schema), "halves")
        contexts, sizes = _contexts(halves)
        spans.append(whole(halves.where("alone"), contexts))
        owners = joined(contexts, sizes, ["key"], "size", "inner").select("key", "full", "size", "n", F.col("owner.uid").alias("_uid"), F.col("owner.pos").alias("_pos"))
        bodies = halves.join(owners, ["key", "full"]).where("uid = _uid AND pos = _pos").withColumn(
            "alone", F.col("alone") & (F.col("n") == 1)).select(*half_schema.names, "size").dropDuplicates(["key", "full"])
    every = spans[0]
    for more in spans[1:]:
        every = every.unionAll(more)
    sorted_spans = F.array_sort(F.collect_set(F.struct("start", "end")))
    return every.groupBy("id", "uid").agg(sorted_spans.alias("spans")).withColumn("spans", _merged(F.col("spans")))


def _merged(spans: Column) -> Column:
    """Sorted ranges, those that overlap or touch made one."""
    kind = "struct<done:array<struct<start:int,end:int>>,start:int,end:int>"
    first = F.struct(F.array().alias("done"), spans[0]["start"].alias("start"), spans[0]["end"].alias("end")).cast(kind)

    def step(state: Column, span: Column) -> Column:
        closed = F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end"))))
        return F.when(span["start"] <= state["end"], F.struct(
            state["done"].alias("done"), state["start"].alias("start"), F.greatest(state["end"], span["end"]).alias("end"))).otherwise(
            F.struct(closed.alias("done"), span["start"].alias("start"), span["end"].alias("end"))).cast(kind)

    return F.aggregate(spans, first, step, lambda s: F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs (without text) with n_bytes, spans (removed byte ranges, sorted) and kept (remaining bytes).

    A byte goes if a string of ``length`` bytes covers it that also starts anywhere else, in the same
    document or another. A removed range may begin or end inside a character, so kept is binary. Null is
    an empty text; shorter texts stay whole; equal rows are repeats of each other.
    """
    spans = repeated_spans(docs, doc_id, text, length).select(F.col("id").alias("_id"), F.col("uid").alias("_uid"), "spans")
    names = [f"`{c}`" for c in without(docs, ["n_bytes", "spans", "kept", text])]
    rows = docs.select(*names, F.xxhash64(F.lit("uid"), doc_id, text).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_body"))
    rows = rows.join(spans, (F.col("_key") == F.col("_uid")) & F.col(doc_id).eqNullSafe(F.col("_id")), "left")
    # What is kept lies between the end of one range and the start of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length("_body")))
    parts = F.arrays_zip(begins.alias("b"), ends.alias("e"))
    kept = F.aggregate(parts, F.lit(b""), lambda done, p: F.concat(done, F.substring(F.col("_body"), p["b"] + 1, p["e"] - p["b"])))
    return rows.select(*names, F.octet_length("_body").cast("long").alias("n_bytes"),
                       F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
                       F.when(F.col("spans").isNull(), F.col("_body")).otherwise(kept).alias("kept"))
