"""Quality scores by a regularised quadratic discriminant over document statistics.

Each class is a normal distribution of transformed statistics of a whole text. Its covariance is shrunk
towards the pooled one and towards a multiple of the identity. The score is the logistic function of the
difference of the two log densities, whose Mahalanobis terms come from cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.session import cut_lineage

from .words import SPACED, content, slices, words

STATISTICS = ("size", "symbols", "upper", "digits", "beyond_ascii", "word_length", "variety", "echo", "repeats", "bare")
FOLDS = 5
THRESHOLD = 0.3
POOLED_SHARE = 0.1
ROUND_SHARE = 0.01
_SYMBOLS, _UPPER, _LETTERS, _DIGITS, _BEYOND = (np.zeros(256, bool) for _ in range(5))
_SYMBOLS[list(b"!#$%&*+/<=>@[\\]^_`{|}~")] = True
_UPPER[65:91] = True
_LETTERS[65:91] = _LETTERS[97:123] = True
_DIGITS[48:58] = True
_BEYOND[128:] = True


def _angle(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share as an angle, whose variance does not depend on the share; 0 of nothing is 0."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _statistics(column: pa.Array) -> np.ndarray:
    data, ends = content(column)

    def sums(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))[ends])

    size = np.diff(ends)
    hashes, word_ends = words(column, SPACED, lower=True)
    n = np.diff(word_ends)
    owner = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    keys = np.sort(owner << np.uint64(40) | hashes >> np.uint64(24))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=len(n))
    begins = np.flatnonzero(new)
    runs = np.diff(np.append(begins, len(keys)))
    most = np.zeros(len(n), np.int64)
    np.maximum.at(most, (keys[begins] >> np.uint64(40)).astype(np.int64), runs)
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    echoes = np.bincount(owner[echo].astype(np.int64), minlength=len(n))
    lone = sums(_SYMBOLS)
    return np.stack(
        [
            np.log1p(size) / 10,
            _angle(lone, size),
            _angle(sums(_UPPER) - n, sums(_LETTERS)),
            _angle(sums(_DIGITS), size),
            _angle(sums(_BEYOND), size),
            np.log1p(sums(SPACED) / np.maximum(n, 1)),
            np.log1p(distinct) / np.maximum(np.log1p(n), 1e-9) * (n > 0),
            _angle(echoes, n),
            _angle(most - 1, n),
            _angle(lone, n),
        ],
        axis=1,
    )


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the transformed statistics of each whole text; null counts as empty."""

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, 1):
            columns = [pa.array(x) for x in _statistics(part.column(1)).T]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], [key, *STATISTICS])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(measure, f"`{key}` {kind}, " + ", ".join(f"{x} double" for x in STATISTICS))


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): log prior, mean, inverse Cholesky factor, log determinant. None: class unseen."""

    classes: tuple[tuple[float, np.ndarray, np.ndarray, float] | None, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if None in self.classes:
            seen = [c is not None for c in self.classes]
            return np.full(len(x), 0.5 if seen[0] == seen[1] else float(seen[1]))
        density = []
        for prior, mean, factor, logdet in self.classes:
            far = (x - mean) @ factor.T
            density.append(prior - 0.5 * logdet - 0.5 * np.einsum("ij,ij->i", far, far))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Discriminant:
    """Learns from labelled rows outside the held-out fold: sums and products only, in one pass."""
    shown = labels.select(F.col(key), F.col(label).cast("int").alias("_label")).where(F.col("_label").isin(0, 1))
    rows = measured.join(shown.where(~held_out(key)), key)
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(STATISTICS)]
    products = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]
    found = {r["_label"]: r for r in rows.groupBy("_label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    scatter, means, counts = {}, {}, {}
    for k, r in found.items():
        counts[k] = r["n"]
        means[k] = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        raw = np.zeros((d, d))
        for i, j in pairs:
            raw[i, j] = raw[j, i] = r[f"p{i}_{j}"] / r["n"]
        scatter[k] = raw - np.outer(means[k], means[k])
    total = sum(counts.values())
    pooled = sum((scatter[k] * counts[k] / total for k in counts), np.zeros((d, d)))
    classes = []
    for k in (0, 1):
        if k not in counts:
            classes.append(None)
            continue
        shrunk = (1 - POOLED_SHARE) * scatter[k] + POOLED_SHARE * pooled
        shrunk = (1 - ROUND_SHARE) * shrunk + (ROUND_SHARE * np.trace(shrunk) / d + 1e-9) * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        classes.append((float(np.log(counts[k] / total)), means[k], np.linalg.inv(lower), 2 * float(np.log(np.diag(lower)).sum())))
    return Discriminant(tuple(classes))


def held_out(key: str = "doc_id"):
    """Whether a row is in the fold that nothing is learnt from."""
    return F.coalesce(F.expr(f"crc32(cast(cast(`{key}` as string) as binary)) % {FOLDS} = 0"), F.lit(False))


def score(measured: DataFrame, model: Discriminant, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """``key``, held_out, score and predicted of each measured row."""

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = np.stack([c.to_numpy() for c in part.columns[1:]], axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x))], [key, "score"])

    kind = measured.schema[key].dataType.simpleString()
    scored = measured.select(key, *STATISTICS).mapInArrow(judge, f"`{key}` {kind}, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select(key, held_out(key).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""
    at = docs.columns.index(text)

    def choose(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts, at):
            yield part.filter(pa.array(model.scores(_statistics(part.column(at))) >= threshold))

    return docs.mapInArrow(choose, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all rows by a discriminant learnt from ``labels`` outside the held-out fold.

    Empty and null texts have the statistics of an empty text, repeated rows are scored each, labels
    other than 0 and 1 teach nothing, and an empty table gives no rows. Where only one class has labels
    the score is that class; without any it is 0.5.
    """
    measured = cut_lineage(statistics(docs, key, text))
    return score(measured, fit(measured, labels, key), key=key)
