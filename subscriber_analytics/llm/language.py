"""Language identification: words by log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns, blocks, prepare, stored

WORDS = re.compile(r"[^\W\d_]+")
# Longest n-gram first; a word between two blanks has at least one of each length up to its own plus two.
LENGTHS = (5, 4, 3, 2, 1)
# Documents a language is learned from, chosen by hash over all of its labelled documents.
SAMPLE_DOCUMENTS = 3000
# Words, and n-grams of each length, kept of a language: the most frequent ones. If there are so many languages that
# the model would hold more than MODEL_ENTRIES, each keeps an equal share of these.
KEPT_WORDS = 20_000
KEPT_GRAMS = 6_000
MODEL_ENTRIES = 1_000_000
# Tasks that the sampled documents are dealt to before their words are counted.
SPREAD = 32
# Distinct words of a text that are scored at once.
SCORED_ROWS = 65_536
# Entries of the model that are taken from Arrow at once.
OUT_ROWS = 50_000
# Entries of unseen words that a worker remembers; the memory starts anew when it is full. So many words are
# looked up at once.
REMEMBERED = 2_000_000
LOOKED_UP = 4096
UNDETERMINED = "und"

FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_COUNTS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("size", T.IntegerType()),
    T.StructField("gram", T.StringType()), T.StructField("n", T.LongType()),
])


def grams(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[k:k + size] for k in range(len(padded) - size + 1)]


@dataclass
class Rows:
    """Sparse rows: those of row k lie from bounds[k] to bounds[k + 1], each a language and how much it gains."""

    bounds: np.ndarray
    langs: np.ndarray
    gains: np.ndarray

    @classmethod
    def none(cls) -> Rows:
        return cls(np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all entries of the rows, and how many each row has."""
        starts = self.bounds[rows]
        sizes = self.bounds[rows + 1] - starts
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes), sizes

    def add_to(self, total: np.ndarray, rows: np.ndarray, times: np.ndarray) -> None:
        for k in range(0, len(rows), SCORED_ROWS):
            found, sizes = self.entries(rows[k:k + SCORED_ROWS])
            gains = self.gains[found] * np.repeat(times[k:k + SCORED_ROWS], sizes)
            total += np.bincount(self.langs[found], gains, len(total))

    def extended(self, sizes: np.ndarray, langs: np.ndarray, gains: np.ndarray) -> Rows:
        return Rows(np.r_[self.bounds, self.bounds[-1] + np.cumsum(sizes)],
                    np.concatenate([self.langs, langs]), np.concatenate([self.gains, gains]))


@dataclass
class LanguageModel:
    """Log frequency of words and n-grams in each language; size 0 stands for whole words.

    A word or n-gram has one and the same frequency in all languages that lack it, so its row holds only the
    languages that have it and what they gain over the others.
    """

    langs: list[str]
    index: dict[int, dict[str, int]]
    table: Rows
    _seen: dict[str, int] = field(default_factory=dict)
    _rows: Rows = field(default_factory=Rows.none)

    @classmethod
    def from_counts(cls, rows: Iterable[tuple[str, int, str, int]]) -> LanguageModel:
        """From (lang, size, gram, count). What a language lacks has half a count of the largest language
        there, so that one with few words is not taken for what nobody has."""
        at: dict[str, int] = {}
        index: dict[int, dict[str, int]] = {size: {} for size in (0, *LENGTHS)}
        number = 0
        columns = [array("q") for _ in range(4)]
        for lang, size, gram, n in rows:
            row = index[size].setdefault(gram, number)
            number += row == number
            for column, value in zip(columns, (row, at.setdefault(lang, len(at)), size, n), strict=True):
                column.append(value)
        row, lang, size, n = (np.array(column, np.int64) for column in columns)
        langs = sorted(at)
        place = np.empty(len(at), np.int64)
        place[[at[name] for name in langs]] = np.arange(len(at))
        lang = place[lang]
        totals = np.ones((len(LENGTHS) + 1, len(langs)))
        np.add.at(totals, (size, lang), n)
        gains = np.log(n / totals[size, lang]) - np.log(0.5 / totals.max(axis=1, initial=1)[size])
        order = np.lexsort((lang, row))
        bounds = np.searchsorted(row[order], np.arange(number + 1))
        return cls(langs, index, Rows(bounds, lang[order].astype(np.int32), gains[order].astype(np.float32)))

    def backed_off(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of unseen words, as sizes, languages and gains: the mean over a word's longest n-grams that
        are known, empty without any."""
        tables = [(size, self.index[size].get) for size in LENGTHS]
        rows: list[int] = []
        grams_of = np.zeros(len(words), np.int64)
        for n, word in enumerate(words):
            padded = f" {word} "
            for size, get in tables:
                found = [r for k in range(len(padded) - size + 1) if (r := get(padded[k:k + size])) is not None]
                if found:
                    rows += found
                    grams_of[n] = len(found)
                    break
        entries, sizes = self.table.entries(np.array(rows, np.int64))
        share = np.repeat(1 / grams_of[grams_of > 0], grams_of[grams_of > 0])
        owner = np.repeat(np.repeat(np.arange(len(words)), grams_of), sizes)
        # The gains of a word's n-grams in the same language are one entry.
        key, place = np.unique(owner * max(len(self.langs), 1) + self.table.langs[entries], return_inverse=True)
        gains = np.bincount(place, self.table.gains[entries] * np.repeat(share, sizes), len(key))
        owner, langs = np.divmod(key, max(len(self.langs), 1))
        return np.bincount(owner, minlength=len(words)), langs.astype(np.int32), gains.astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language of each text and its probability among the languages of the model."""
        words = [WORDS.findall(t.lower()) for t in texts]
        if len(self._rows.gains) + len(self._rows) > REMEMBERED:
            self._seen, self._rows = {}, Rows.none()
        known, size = self.index.get(0, {}), len(self.table)
        seen: set[str] = set()
        for found in words:
            seen.update(found)
        new = [word for word in seen if word not in known and word not in self._seen]
        self._seen.update(zip(new, range(size + len(self._rows), size + len(self._rows) + len(new)), strict=True))
        if new:
            parts = [self.backed_off(new[k:k + LOOKED_UP]) for k in range(0, len(new), LOOKED_UP)]
            self._rows = self._rows.extended(*(np.concatenate(found) for found in zip(*parts, strict=True)))
        langs, sure = [], []
        for found in words:
            # The word pattern lets signs like superscript two pass, which are no letters.
            if not self.langs or not any(map(str.isalpha, found)) and not any(c.isalpha() for w in found for c in w):
                langs.append(UNDETERMINED)
                sure.append(0.0)
                continue
            index = np.fromiter((known[w] if w in known else self._seen[w] for w in found), np.int64, len(found))
            rows, times = np.unique(index, return_counts=True)
            cut = int(np.searchsorted(rows, size))
            total = np.zeros(len(self.langs))
            self.table.add_to(total, rows[:cut], times[:cut])
            self._rows.add_to(total, rows[cut:] - size, times[cut:])
            best = int(np.argmax(total))
            langs.append(self.langs[best])
            sure.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
        return langs, sure


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams of each language, block by block."""
    for batch in batches:
        for part in blocks(batch, "text"):
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                words[lang].update(WORDS.findall((text or "").lower()))
            for lang, found in words.items():
                for size in (0, *LENGTHS):
                    counts: Counter = Counter()
                    for word, n in found.items():
                        if size:
                            for gram in grams(word, size):
                                counts[gram] += n
                        else:
                            counts[word] = n
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(counts), pa.string()), pa.array([size] * len(counts), pa.int32()),
                        pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()),
                    ], names=_COUNTS.names)


def learn(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: int = SAMPLE_DOCUMENTS, words: int = KEPT_WORDS, per_length: int = KEPT_GRAMS,
    entries: int = MODEL_ENTRIES,
) -> LanguageModel:
    """Model of the labelled rows.

    ``sample`` documents of each language are expected to be read: those whose key's hash falls below
    sample / (documents of the language); a language with fewer gives all. The model holds at most
    ``words`` + 5 * ``per_length`` entries a language and about ``entries`` in all, however large the table is
    and however many labels it has: with many, each keeps its most frequent ones in an equal share. Rows without
    a label or key teach nothing; without any labelled row the model has no language.
    """
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sizes = stored(rows.groupBy("lang").count(), "language-sizes")
    share = min(1.0, entries / (max(sizes.count(), 1) * (words + len(LENGTHS) * per_length)))
    words, per_length = max(1, int(words * share)), max(1, int(per_length * share))
    draw = F.pmod(F.xxhash64(F.lit("language-sample"), "key"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = rows.join(sizes.select("lang", (F.lit(float(sample)) / F.col("count")).alias("share")), "lang").where(draw < F.col("share"))
    counts = drawn.select("lang", "text").repartition(SPREAD).mapInArrow(_counted, _COUNTS)
    totals = counts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    top = totals.withColumn("rank", rank).where(
        F.col("rank") <= F.when(F.col("size") == 0, words).otherwise(per_length))
    found = top.select("lang", "size", "gram", "n").toArrow()
    return LanguageModel.from_counts(row for part in found.to_batches(max_chunksize=OUT_ROWS)
                                     for row in zip(*(column.to_pylist() for column in part.columns), strict=True))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (its probability, 0 to 1).

    A text that is null or has no letters, or a model without languages, gives "und" with score 0. Equal texts get equal
    results, a tie goes to the first language by name; columns of these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts: pa.Array) -> dict[str, object]:
        langs, sure = sent.value.predict(texts.fill_null("").to_pylist())
        return {"lang_pred": langs, "score": sure}

    return add_columns(docs, text, FIELDS, work)


def held_out(key: str = "doc_id"):
    """Rows kept from learning: crc32 of the key as text leaves 2 by 4. A null key isn't held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
