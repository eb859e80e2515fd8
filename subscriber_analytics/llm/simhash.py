"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary trie self-join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns, flat, stored, without
from subscriber_analytics.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
# A trie larger than this is split by further bits before it is joined with itself.
TRIE_SIZE = 2048
# Fingerprints joined at once in a task; at least one trie.
CHUNK = 40_000

# Fixed values of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

FIELDS = T.StructType([T.StructField("simhash", T.LongType())])
EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Byte j of entry v is bit j of v: eight counters in one number.
_SPREAD = ((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).view("<u8").ravel()


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of data[start:end] for every pair of bounds; data is followed by eight bytes of padding."""
    sizes = ends - starts
    result = np.empty(len(starts), np.uint64)
    short = sizes < 32
    at, size = starts[short], sizes[short]
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = np.uint64(seed) + P5 + size.astype(np.uint64)
    for step in range(3):
        more = np.flatnonzero(size >= 8 * (step + 1))
        lane = lanes[at[more] + 8 * step]
        h[more] = _turn(h[more] ^ (_turn(lane * P2, 31) * P1), 27) * P1 + P4
    at, left = at + size // 8 * 8, size % 8
    more = np.flatnonzero(left >= 4)
    lane = lanes[at[more]] & np.uint64(0xFFFFFFFF)
    h[more] = _turn(h[more] ^ (lane * P1), 23) * P2 + P3
    at, left = at + left // 4 * 4, left % 4
    for step in range(3):
        more = np.flatnonzero(left > step)
        h[more] = _turn(h[more] ^ (data[at[more] + step].astype(np.uint64) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    result[short] = h ^ (h >> np.uint64(32))
    body = data.tobytes() if not short.all() else b""
    for k in np.flatnonzero(~short):
        result[k] = xxhash.xxh64_intdigest(body[starts[k]:ends[k]], seed)
    return result


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space between them, bounds of all shingles, and shingles per text."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = word[begins]
    words_before = np.r_[0, np.cumsum(first)]
    place = np.cumsum(word)[word] + words_before[1:][word] - 2
    text = np.full(int(word.sum() + first.sum()) + 8, 32, np.uint8)
    text[place] = _LOWER[data[word]]
    starts = place[first[word]]
    ends = np.r_[starts[1:] - 1, len(text) - 9]
    counts = np.diff(words_before[offsets])
    if not len(starts):
        return text, starts, ends, counts
    owner = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    width = np.minimum(counts, size)[owner]
    keep = nth + width <= counts[owner]
    index = np.flatnonzero(keep)
    return text, starts[index], ends[index + width[index] - 1], np.bincount(owner[index], minlength=len(counts))


def simhashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint of each text: a bit is 1 if over half of its shingles' hashes have it."""
    text, starts, ends, counts = shingles(data, offsets)
    result = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return result
    hashes = xxh64(text, starts, ends)
    sizes = counts[some]
    # Eight counters share a number, so at most 255 hashes are summed at once, then the sums are.
    runs = -(-sizes // 255)
    run_of = np.repeat(np.arange(len(sizes)), runs)
    nth = np.arange(len(run_of)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_starts = (np.cumsum(sizes) - sizes)[run_of] + 255 * nth
    text_starts = np.cumsum(runs) - runs
    for byte in range(8):
        lanes = _SPREAD[(hashes >> np.uint64(8 * byte)) & np.uint64(255)]
        sums = np.add.reduceat(lanes, run_starts).view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(sums.astype(np.int64), text_starts)
        bits = (2 * totals > sizes[:, None]).astype(np.uint64)
        result[some] |= (bits << np.arange(8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return result


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with simhash (long): 64 bits over all 3-word shingles, repeats included.

    Fewer words make one shingle of them all; a null text, or one without words, gets zero. A column
    of that name is replaced.
    """
    def work(texts: pa.Array) -> dict[str, object]:
        return {"simhash": simhashes(*flat(texts)).view(np.int64)}

    return add_columns(docs, text, FIELDS, work)


def trie_pairs(values: np.ndarray, bounds: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of values that differ in at most ``budget`` bits, inside each trie.

    ``values`` are sorted and distinct inside each trie values[bounds[k]:bounds[k + 1]]; a node is the
    range of values that share a prefix. All node pairs of a depth are one frontier: each pair opens
    into its child pairs, those on different branches with one more differing bit, and pairs over the
    budget are dropped. Two single leaves are compared at once.
    """
    a0, a1 = bounds[:-1], bounds[1:]
    b0, b1, errors = a0, a1, np.zeros(len(a0), np.int8)
    left, right = [], []
    for bit in range(63, -1, -1):
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[single], b0[single]
        near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        left.append(i[near])
        right.append(j[near])
        a0, a1, b0, b1, errors = (x[~single] for x in (a0, a1, b0, b1, errors))
        if not len(a0):
            break
        ones = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        opened = [(a0, am, b0, bm, errors), (am, a1, bm, b1, errors), (a0, am, bm, b1, errors + 1)]
        opened.append(tuple(x[~same] for x in (am, a1, b0, bm, errors + 1)))
        a0, a1, b0, b1, errors = (np.concatenate(x) for x in zip(*opened, strict=True))
        stay = (errors <= budget) & (a1 > a0) & (b1 > b0)
        a0, a1, b0, b1, errors = (x[stay] for x in (a0, a1, b0, b1, errors))
    else:
        near = a0 != b0
        left.append(a0[near])
        right.append(b0[near])
    return np.concatenate(left), np.concatenate(right)


def roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index that each index reaches over the pairs."""
    label = np.arange(size)
    while True:
        lowest = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], lowest)
        np.minimum.at(new, label[right], lowest)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _masks(level: int, budget: int) -> list[int]:
    """Bit masks of a level: each mask of the level before with one of budget + 1 parts of what it leaves."""
    found = [0]
    for _ in range(level + 1):
        wider = []
        for mask in found:
            free = [b for b in range(63, -1, -1) if not mask >> b & 1]
            cuts = [len(free) * k // (budget + 1) for k in range(budget + 2)]
            wider += [mask | sum(1 << b for b in free[s:e]) for s, e in zip(cuts, cuts[1:], strict=False)]
        found = wider
    return found


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _trie_edges(budget: int):
    """Edges from each representative to its root, for whole tries in sorted batches."""
    def joined(table: pa.Table) -> pa.RecordBatch:
        trie, key, value, rep = (table.column(c).to_numpy() for c in ("trie", "key", "simhash", "rep"))
        values = value.view(np.uint64)
        new = np.flatnonzero(np.r_[True, (trie[1:] != trie[:-1]) | (key[1:] != key[:-1])])
        bounds = np.r_[new, len(values)]
        # The sort is by signed numbers; tries need the top bit in its unsigned order.
        order = np.lexsort((values, np.repeat(np.arange(len(new)), np.diff(bounds))))
        values, rep = values[order], rep[order]
        root = roots(len(values), *trie_pairs(values, bounds, budget))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[root[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < CHUNK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            trie, key = table.column("trie").to_numpy(), table.column("key").to_numpy()
            last = int(np.argmax((trie == trie[-1]) & (key == key[-1])))
            if last:
                yield joined(table.slice(0, last))
            held = table.slice(last).to_batches()
            rows = table.num_rows - last
        if rows:
            yield joined(pa.Table.from_batches(held).combine_chunks())

    return run


def links(prints: DataFrame, budget: int = MAX_BITS, trie_size: int = TRIE_SIZE) -> DataFrame:
    """Edges (a, b) over the representatives of distinct fingerprints (simhash, rep) that join all near ones.

    Two fingerprints within the budget agree in one of budget + 1 parts of their bits. Those that share
    a part form a trie, which is joined with itself in one task. A trie of more than ``trie_size``
    is cut again the same way by its other bits, as often as needed: what is left free soon holds no more than
    that many values. Each trie gives a spanning forest, so a group of n near copies makes at
    most n edges a trie.
    """
    rows, ready, level = prints.withColumn("trie", F.lit(0)), [], 0
    while True:
        masks = _masks(level, budget)
        free = max(64 - mask.bit_count() for mask in masks)
        # Part p of the bits that mask t leaves makes mask t * (budget + 1) + p of the next level.
        parts = F.explode(F.array(*[F.lit(p) for p in range(budget + 1)])).alias("part")
        keyed = rows.select("simhash", "rep", "trie", parts).withColumn(
            "trie", (F.col("trie") * (budget + 1) + F.col("part")).cast("int")).drop("part")
        table = F.array(*[F.lit(_signed(mask)).cast("long") for mask in masks])
        keyed = keyed.withColumn("key", F.col("simhash").bitwiseAND(F.element_at(table, F.col("trie") + 1)))
        if 1 << free <= trie_size:
            ready.append(keyed)
            break
        large = stored(keyed.groupBy("trie", "key").count().where(F.col("count") > trie_size).drop("count"), "tries")
        if large.isEmpty():
            ready.append(keyed)
            break
        ready.append(keyed.join(large, ["trie", "key"], "left_anti"))
        rows = keyed.join(large, ["trie", "key"], "left_semi")
        level += 1
    edges = None
    for keyed in ready:
        sorted_tries = (keyed.select("trie", "key", "simhash", "rep").repartition("trie", "key")
                        .sortWithinPartitions("trie", "key"))
        found = sorted_tries.mapInArrow(_trie_edges(budget), EDGES)
        edges = found if edges is None else edges.unionAll(found)
    return edges


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = MAX_BITS) -> DataFrame:
    """docs (without text) with simhash, cluster and component_id.

    The nodes are the distinct fingerprints: cluster is the smallest fingerprint (as a signed number) reachable
    over near ones, component_id the smallest id of a row there. Exact copies share a fingerprint, so they
    are never paired. Rows without words have fingerprint zero and are linked like any other. Rows without an id
    link like any other and get the component's id; it is null if no row there has one. Repeated rows stay, in one
    component. Columns of the three names are replaced. An empty table gives an empty one.
    """
    printed = fingerprints(docs.select(*[f"`{c}`" for c in without(docs, ["simhash", "cluster", "component_id"])]), text)
    printed = stored(printed.drop(text), "fingerprints")
    prints = stored(printed.groupBy("simhash").agg(F.min(doc_id).alias("least")), "distinct-fingerprints")
    found = components(links(prints.select("simhash", F.col("simhash").alias("rep")), budget))
    grouped = prints.join(found.withColumnRenamed("node", "simhash"), "simhash", "left").select(
        "simhash", "least", F.coalesce("component", "simhash").alias("cluster"))
    ids = stored(grouped.groupBy("cluster").agg(F.min("least").alias("component_id")), "component-ids")
    named = stored(grouped.drop("least").join(ids, "cluster"), "clusters")
    return printed.join(named, "simhash", "left")
