"""Quality rules: fixed limits, and robust outliers by minimum covariance determinant."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscriber_analytics.llm.arrow import add_columns, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])

# Transformed statistics: mean word length, and roots of the shares of symbols, repeated lines and words.
FEATURES = ("f_length", "f_symbols", "f_lines", "f_repeats")
# Least standard deviation of each. Symbols: a guard for groups without any. Length, repeated lines and words:
# clean documents have some now and then, and the labels say that less takes those for outliers (README).
FLOORS = (0.04, 0.01, 0.10, 0.10)
# Share of a group that the determinant is taken over.
CORE = 0.75
# Weight of the next wider estimate (all sources of the language, then all documents), as a number of documents.
PRIOR = 30
# Least variance in any direction, as a share of the least variances: keeps the covariance of a few rows invertible.
GUARD = 1e-3
# Distances fall into so many steps of their logarithm; the core of a group is cut between two of them.
DISTANCE_BINS = 2048
# Squared distance beyond which a document is an outlier: chi-square with 4 degrees of freedom at 0.999.
CUTOFF = 18.47
# What makes the covariance of a normal core that of all: CORE by the share that chi-square with 6 degrees
# of freedom has below 5.385, where that with 4 degrees reaches CORE.
CONSISTENCY = CORE / 0.5046


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has at least twice."""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(windows) == max(0, len(words) - 2):
        return 0
    covered = np.zeros(len(words) + 2, bool)
    twice = [k for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1]
    for step in range(3):
        covered[np.array(twice) + step] = True
    return int(covered.sum())


def text_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    data = np.frombuffer(text, np.uint8)
    words = text.split()
    chars = int(((data & 0xC0) != 0x80).sum() - _SPACE[data].sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(words), chars, int(SYMBOLS[data].sum()), len(lines) - len(set(lines)), repeated_words(words)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; a null text has none."""
    def work(texts: pa.Array) -> dict[str, object]:
        rows = [text_statistics(t) for t in texts.fill_null("").cast(pa.binary()).to_pylist()]
        return dict(zip(FIELDS.names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True))

    return add_columns(docs, text, FIELDS, work)


def base_failed() -> Column:
    """The fixed limits: too few words, or too many of them repeated."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _features(df: DataFrame) -> DataFrame:
    words = F.greatest("n_words", F.lit(1))
    return df.withColumns({
        "f_length": F.log(F.greatest(F.col("word_chars") / words, F.lit(0.1))),
        "f_symbols": F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        "f_lines": F.sqrt(F.col("n_dup_lines") / words),
        "f_repeats": F.sqrt(F.col("n_repeat_words") / words),
    })


_MODEL = T.StructType([
    T.StructField("group", T.StringType()), T.StructField("n", T.LongType()), T.StructField("center", T.ArrayType(T.DoubleType())),
    T.StructField("cov", T.ArrayType(T.DoubleType())), T.StructField("inverse", T.ArrayType(T.DoubleType())),
    T.StructField("logdet", T.DoubleType()),
])
_PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to the center of its group."""
    off = [F.col(f) - F.col("center")[k] for k, f in enumerate(FEATURES)]
    total = None
    for k, (i, j) in enumerate(_PAIRS):
        term = off[i] * off[j] * F.col("inverse")[k] * (1 if i == j else 2)
        total = term if total is None else total + term
    return total


def _start(rows: DataFrame) -> DataFrame:
    """First center and spread of each group: medians, and scaled quartile distances."""
    quartiles = rows.groupBy("group").agg(*[
        F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(f) for f in FEATURES])
    spread = [F.greatest((F.col(f)[2] - F.col(f)[0]) / 1.349, F.lit(floor)) for f, floor in zip(FEATURES, FLOORS, strict=True)]
    place = {pair: k for k, pair in enumerate(_PAIRS)}
    inverse: list[Column] = [F.lit(0.0)] * len(_PAIRS)
    for k, s in enumerate(spread):
        inverse[place[k, k]] = 1 / (s * s)
    # What is not known yet comes with the first step, which every group takes.
    return quartiles.select(
        "group", F.lit(0).cast("long").alias("n"), F.array(*[F.col(f)[1] for f in FEATURES]).alias("center"),
        F.array(*inverse).alias("cov"), F.array(*inverse).alias("inverse"), F.lit(math.inf).alias("logdet"))


def _full(values: np.ndarray) -> np.ndarray:
    """Symmetric matrices from rows of their _PAIRS."""
    made = np.empty((len(values), len(FEATURES), len(FEATURES)))
    for k, (i, j) in enumerate(_PAIRS):
        made[:, i, j] = made[:, j, i] = values[:, k]
    return made


def _guarded(cov: np.ndarray) -> np.ndarray:
    """cov with the least variances of FLOORS on its diagonal, and GUARD of them in every direction."""
    floors = np.array(FLOORS)
    cov = cov + np.diag(np.maximum(floors ** 2 - np.diag(cov), 0))
    values, vectors = np.linalg.eigh(cov / np.outer(floors, floors))
    return (vectors * np.maximum(values, GUARD)) @ vectors.T * np.outer(floors, floors)


def _core(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
    """Center and covariance over the nearest CORE of a group, from sums by distance bin."""
    bins = bins.sort_values("bin")
    last = int(np.searchsorted(bins["n"].cumsum().to_numpy(), CORE * bins["n"].sum())) + 1
    core = bins.iloc[:last]
    n = float(core["n"].sum())
    center = core[[f"s{k}" for k in range(len(FEATURES))]].sum().to_numpy() / n
    cov = np.empty((len(FEATURES),) * 2)
    for k, (i, j) in enumerate(_PAIRS):
        cov[i, j] = cov[j, i] = core[f"p{k}"].sum() / n - center[i] * center[j]
    # The nearest rows understate the spread; this is the factor for a normal core of this share.
    cov = _guarded(cov * CONSISTENCY)
    inverse = np.linalg.inv(cov)
    return pd.DataFrame([[key[0], int(bins["n"].sum()), center.tolist(), [cov[i, j] for i, j in _PAIRS],
                          [inverse[i, j] for i, j in _PAIRS], float(np.linalg.slogdet(cov)[1])]], columns=_MODEL.names)


def robust_models(rows: DataFrame) -> DataFrame:
    """Minimum covariance determinant of each group over all its rows.

    From medians and quartiles, each step takes the nearest CORE of every group and its mean and
    covariance, until no determinant falls; a group whose own does not fall any more takes no further step. A step is
    one aggregation: rows are summed by group and distance bin before the shuffle, so a hot group is a few
    thousand sums, and only those meet in a task.
    """
    model = stored(_start(rows).withColumn("better", F.lit(True)), "outliers")
    while not model.where("better").isEmpty():
        placed = rows.join(model.where("better").select("group", "center", "inverse"), "group").withColumn("d", _distance())
        step = F.floor(F.log1p(F.greatest("d", F.lit(0.0))) * (DISTANCE_BINS / 20))
        bins = placed.groupBy("group", F.least(step, F.lit(DISTANCE_BINS)).alias("bin")).agg(
            F.count("*").alias("n"), *[F.sum(f).alias(f"s{k}") for k, f in enumerate(FEATURES)],
            *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{k}") for k, (i, j) in enumerate(_PAIRS)])
        found = bins.groupBy("group").applyInPandas(_core, _MODEL)
        both = model.alias("old").join(found.alias("new"), "group", "left")
        better = F.coalesce(F.col("new.logdet") < F.col("old.logdet") - 1e-6, F.lit(False))
        model = stored(both.select("group", *[
            F.when(better, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in _MODEL.names[1:]],
            better.alias("better")), "outliers")
    return model.select(*_MODEL.names)


_LEVELS = ("group", "wider", "widest")


def blended_models(rows: DataFrame) -> DataFrame:
    """(group, center, inverse): the estimate of each group, drawn to that of its language and of all documents.

    Center and covariance are means of the group's own, by its number of documents, and the next wider ones, which
    count PRIOR documents; so are those of a language and of all. One document more or less changes
    an estimate by little at any size. ``rows`` have group, wider, widest and FEATURES.
    """
    models = stored(robust_models(rows.select(F.explode(F.array(*_LEVELS)).alias("group"), *FEATURES)), "models")
    plan = rows.select(*_LEVELS).distinct()
    for level in _LEVELS:
        own = models.select(F.col("group").alias(level), *[F.col(c).alias(f"{c}_{level}") for c in ("n", "center", "cov")])
        plan = plan.join(own, level)

    def blend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.zeros((len(batch), len(FEATURES) + len(_PAIRS)))
            for level in reversed(_LEVELS):
                n = batch[f"n_{level}"].to_numpy(float)[:, None]
                own = np.array([[*c, *v] for c, v in zip(batch[f"center_{level}"], batch[f"cov_{level}"], strict=True)])
                share = 1.0 if level == _LEVELS[-1] else n / (n + PRIOR)
                values = share * own.reshape(values.shape) + (1 - share) * values
            center, cov = values[:, :len(FEATURES)], _full(values[:, len(FEATURES):])
            inverse = np.linalg.inv(cov)
            yield pd.DataFrame({"group": batch["group"], "center": center.tolist(),
                                "inverse": [[m[i, j] for i, j in _PAIRS] for m in inverse]})

    return plan.mapInPandas(blend, "group string, center array<double>, inverse array<double>")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """docs (without text) with the statistics, base_failed, distance (squared, null if base_failed) and kept.

    A document goes if it fails the fixed limits, or if its statistics lie beyond ``cutoff`` from the
    robust center of its language and source. The estimates are taken over all documents that pass
    the limits; that of a small group is mostly the one of its language, or of all documents, so each document that
    passes the limits has a distance. Null languages or sources form groups of their own. Repeated rows are judged
    each, an empty table gives an empty one, and columns with the names of this result or of its steps are replaced.
    """
    own = [*FIELDS.names, *FEATURES, *_MODEL.names, *_LEVELS, "_group", "base_failed", "distance", "kept"]
    counted = statistics(docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in own]), text).drop(text)
    group = F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))
    wider = F.concat(F.lit("language "), F.to_json(F.struct(F.col(lang).alias("l"))))
    rows = stored(_features(counted.withColumn("base_failed", base_failed()).withColumns(
        {"group": group, "wider": wider, "widest": F.lit("all")})), "statistics")
    # Stored: the join with it is then planned by its size, and can be split where a group is hot.
    models = stored(blended_models(rows.where("NOT base_failed").select(*_LEVELS, *FEATURES)), "blended").withColumnRenamed("group", "_group")
    judged = rows.join(models, rows["group"] == models["_group"], "left").withColumn(
        "distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & (F.col("distance") <= cutoff)
    return judged.withColumn("kept", F.coalesce(kept, F.lit(False))).drop(*_LEVELS, "_group", "center", "inverse", *FEATURES)
