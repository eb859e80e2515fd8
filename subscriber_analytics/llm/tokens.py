"""Token counts of byte-level BPE by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns, flat

# Fixed value: how byte-level BPE vocabularies of this kind split a text before merging.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same split, written for texts of the characters that PLAIN does not find: there letters, digits
# and white space are these ranges, and the standard library's matcher does it in half the time.
_LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN_TOKENS = re.compile(
    rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")
PLAIN = re.compile(r"[^\x00-\x1b\x20-\x7f\xc0-\xff]")
# Counts of pre-tokens that a worker remembers; the memory starts anew when it is full.
REMEMBERED = 500_000
# Bytes of new pre-tokens merged together.
MERGE_BYTES = 1 << 20
NO_RANK = np.int64(2**62)

FIELDS = T.StructType([
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
])


def byte_letters() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class MergeTable:
    """Ranks of symbol pairs. Symbols below 256 are bytes; 256 + r is what the merge of rank r makes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.splitter = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        symbols = byte_letters()
        merges = spec["model"]["merges"]
        self.width = 256 + len(merges)
        codes = np.empty(len(merges), np.int64)
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            codes[rank] = symbols[left] * self.width + symbols[right]
            symbols[left + right] = 256 + rank
        order = np.argsort(codes, kind="stable")
        self.codes, self.order = codes[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where no merge joins it."""
        codes = left * self.width + right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.order[at], NO_RANK)


    @functools.cached_property
    def byte_ranks(self) -> np.ndarray:
        """Ranks of all pairs of bytes, by 256 * left + right."""
        pairs = np.arange(65536)
        return self.ranks(pairs >> 8, pairs & 255)


@functools.lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def merged_lengths(words: list[bytes], table: MergeTable) -> np.ndarray:
    """Symbols that are left of each word once no pair has a rank.

    All words lie one behind the other in one array. In each round every word that still has a ranked
    pair merges all places of its lowest-ranked pair at once, from the left where they overlap; words
    without one are counted and leave the array.
    """
    result = np.array([len(w) for w in words], np.int64)
    symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    active = np.flatnonzero(result > 1)
    symbols = symbols[np.repeat(result > 1, result)]
    lengths = result[active]
    if not len(active):
        return result
    ranks = np.full(len(symbols), NO_RANK)
    ranks[:-1] = table.byte_ranks[(symbols[:-1] << 8) + symbols[1:]]
    while len(active):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        ranks[ends - 1] = NO_RANK
        lowest = np.minimum.reduceat(ranks, starts)
        here = ranks == np.repeat(np.where(lowest < NO_RANK, lowest, -1), lengths)
        # A run of places, as in "aaaa", is one pair over itself: every second place of a run merges.
        places = np.flatnonzero(here)
        first = np.r_[True, np.diff(places) != 1] if len(places) else np.zeros(0, bool)
        nth = np.arange(len(places))
        places = places[(nth - np.maximum.accumulate(np.where(first, nth, 0))) % 2 == 0]
        symbols[places] = 256 + ranks[places]
        stays = np.ones(len(symbols), bool)
        stays[places + 1] = False
        fresh = np.zeros(len(symbols), bool)
        fresh[places] = True
        lengths = np.add.reduceat(stays, starts, dtype=np.int64)
        result[active] = lengths
        going = (lowest < NO_RANK) & (lengths > 1)
        stays &= np.repeat(going, ends - starts)
        symbols, ranks, fresh = symbols[stays], ranks[stays], fresh[stays]
        active, lengths = active[going], lengths[going]
        # Only pairs with a new symbol have a new rank.
        changed = np.flatnonzero(fresh[:-1] | fresh[1:])
        ranks[changed] = table.ranks(symbols[changed], symbols[changed + 1])
    return result


def pre_tokens(text: str) -> list[str]:
    return (PRE_TOKENS if PLAIN.search(text) else PLAIN_TOKENS).findall(text)


_counts: dict[str, dict[str, int]] = {}


def token_counts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text; special strings inside a text are one token each."""
    table = merge_table(path)
    known = _counts.setdefault(path, {})
    found = []
    for text in texts:
        if table.splitter is not None and any(s in text for s in table.specials):
            parts = table.splitter.split(text)
            specials = len(parts) - 1
            pieces = list(itertools.chain.from_iterable(map(pre_tokens, parts)))
        else:
            specials, pieces = 0, pre_tokens(text)
        found.append((specials, pieces))
    fresh: set[str] = set()
    for _, pieces in found:
        fresh.update(pieces)
    if len(known) + len(fresh) > REMEMBERED:
        known.clear()
    new = [p for p in fresh if p not in known]
    start = 0
    while start < len(new):
        stop, size = start, 0
        part = []
        while stop < len(new) and (size < MERGE_BYTES or stop == start):
            part.append(new[stop].encode())
            size += len(part[-1])
            stop += 1
        known.update(zip(new[start:stop], merged_lengths(part, table).tolist(), strict=True))
        start = stop
    return [specials + sum(map(known.__getitem__, pieces)) for specials, pieces in found]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text") -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    ``vocabulary`` is the path of a byte-level BPE file that every executor can open. No begin, end or
    added tokens, no truncation. A null or empty text has 0 bytes and 0 tokens; repeated rows are
    counted each; an empty table gives an empty one; columns of these names are replaced.
    """
    def work(texts: pa.Array) -> dict[str, object]:
        counts = np.array(token_counts(texts.fill_null("").to_pylist(), vocabulary), np.int64)
        return {"n_bytes": np.diff(flat(texts)[1]), "n_tokens": counts, "over_limit": counts > limit}

    return add_columns(docs, text, FIELDS, work)
