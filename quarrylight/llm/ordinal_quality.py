"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > g | x) = logistic(w.x - t_g) with one weight vector w over hashed text features and ordered thresholds
t_0 < t_1 < ... (the first one free, each next one by a positive step, so order holds while fitting). The model gives an
expected grade and tail probabilities P(grade >= g); selection keeps what has enough of the latter.

Text features: of each distinct word its lower-cased letters, their first four and five, and its shape (case, digits, marks at its
ends), hashed; a document's vector is the mean-free sum over its distinct words, scaled by a power of their number, with how
often words recur as one more feature. So a document's score is a sum of word scores, kept in a bounded cache.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets; labelled rows that the fit takes at most (those of the smallest key hashes); words in a worker's cache.
DIMS, SAMPLE, CACHE = 1 << 18, 8_000, 150_000
#: The number of distinct words to this power divides sums over words.
SCALE = 0.5
_STRIP = ".,;:!?*$%&#|\"'()[]-"


def word_features(word: str) -> list[int]:
    """Buckets of one word's features."""
    core = word.strip(_STRIP).lower()
    shape = ("U" if word.isupper() else "T" if word[:1].isupper() else "l") + ("d" if any(c.isdigit() for c in word) else "")
    tail = word[len(word.rstrip(_STRIP)) :][:3]
    names = [f"w:{core}", f"s:{shape}", f"e:{tail}"]
    if len(core) > 4:
        names.append(f"p4:{core[:4]}")
    if len(core) > 5:
        names.append(f"p5:{core[:5]}")
    return [xxhash.xxh3_64_intdigest(n) % DIMS for n in names]


def _recurrence(n_words: int, n_distinct: int) -> float:
    return math.log(n_words / n_distinct) if n_distinct else 0.0


@dataclass
class Model:
    weights: np.ndarray  # DIMS buckets
    recurrence: float
    thresholds: np.ndarray  # ascending

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for g from 1, a column for each."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -500, 500)
        return 1 / (1 + np.exp(-z))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], grades: np.ndarray, n_grades: int, rounds: int = 150, l2: float = 1e-4, rate: float = 0.15) -> Model:
    """From (buckets, values, recurrence) of each text and its grade, by Adam on the mean negative log-likelihood.

    Grades that don't occur keep their thresholds where the fit began; no row at all gives a model without opinion.
    """
    k = n_grades - 1
    if not rows:
        return Model(np.zeros(DIMS), 0.0, np.linspace(-1, 1, k) if k > 1 else np.zeros(k))
    size = np.array([len(r[0]) for r in rows])
    col = np.concatenate([np.asarray(r[0], np.int32) for r in rows])
    val = np.concatenate([np.asarray(r[1], np.float32) for r in rows])
    used = np.flatnonzero(np.bincount(col, minlength=DIMS))
    place = np.zeros(DIMS, np.intp)
    place[used] = np.arange(len(used))
    col = place[col]
    full = size > 0
    begin = (np.cumsum(size) - size)[full]

    def by_row(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(size))
        if len(x):
            out[full] = np.add.reduceat(x, begin)
        return out

    rec = np.array([r[2] for r in rows])
    m = len(used)
    share = np.array([(grades >= g).mean() for g in range(1, n_grades)]).clip(0.01, 0.99)
    t0 = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(k))
    p = np.concatenate([np.zeros(m + 1), t0[:1], np.log(np.expm1(np.maximum(np.diff(t0), 1e-3)))])
    mean, square = np.zeros_like(p), np.zeros_like(p)
    i = np.arange(len(rows))
    for step in range(1, rounds + 1):
        w, r, t = p[:m], p[m], np.concatenate([p[m + 1 : m + 2], p[m + 1] + np.cumsum(np.log1p(np.exp(p[m + 2 :])))])
        score = by_row(w[col] * val) + r * rec
        z = np.clip(score[:, None] - t[None, :], -30, 30)
        tail = np.hstack([np.ones((len(rows), 1)), 1 / (1 + np.exp(-z)), np.zeros((len(rows), 1))])
        prob = np.maximum(tail[i, grades] - tail[i, grades + 1], 1e-9)
        slope = tail * (1 - tail)  # of each tail in the score
        d_score = -(slope[i, grades] - slope[i, grades + 1]) / prob
        d_t = np.zeros((len(rows), n_grades + 1))
        d_t[i, grades] += slope[i, grades] / prob
        d_t[i, grades + 1] -= slope[i, grades + 1] / prob
        g_t = d_t[:, 1:n_grades].sum(0)
        steps = np.cumsum(g_t[::-1])[::-1]  # a threshold moves with every step before it
        g = np.concatenate([np.bincount(col, np.repeat(d_score, size) * val, m), [rec @ d_score], steps[:1], steps[1:] / (1 + np.exp(-p[m + 2 :]))]) / len(rows)
        g[: m + 1] += l2 * p[: m + 1]
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        p -= rate / math.sqrt(step) ** 0.5 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    weights = np.zeros(DIMS)
    weights[used] = p[:m]
    return Model(weights, float(p[m]), np.concatenate([p[m + 1 : m + 2], p[m + 1] + np.cumsum(np.log1p(np.exp(p[m + 2 :])))]))


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray, float]:
    words = (text or "").split()
    distinct = set(words)
    if not distinct:
        return np.empty(0, np.int64), np.empty(0), 0.0
    col, n = np.unique(np.array([f for w in distinct for f in word_features(w)], np.int64), return_counts=True)
    return col, n / len(distinct) ** SCALE, _recurrence(len(words), len(distinct))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def _learn(self, w: str) -> float:
        s = float(self.model.weights[word_features(w)].sum())
        if len(self.cache) > CACHE:
            self.cache.clear()
        if len(w) < 64:
            self.cache[w] = s
        return s

    def score(self, text: str | None) -> float:
        words = (text or "").split()
        distinct = set(words)
        if not distinct:
            return 0.0
        get, learn = self.cache.get, self._learn
        total = math.fsum([s if (s := get(w)) is not None else learn(w) for w in distinct])
        return total / len(distinct) ** SCALE + self.model.recurrence * _recurrence(len(words), len(distinct))


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, grade: Column, n_grades: int, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents: all of them, or the `sample` rows of the smallest key hashes where there are more (this bounds the
    fit's memory, about 2 kB a row). Grades are whole numbers from 0; null keys, texts and grades and grades out of range take no part.

    A key (of any type) that is labelled more than once counts with its lowest grade.
    """
    few = labels.select(F.col(key).alias("key"), grade.cast("int").alias("grade")).filter(F.col("key").isNotNull() & F.col("grade").between(0, n_grades - 1))
    few = few.groupBy("key").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull()).join(F.broadcast(few), "key").select("key", "text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [text_features(x.as_py()) for x in b.column(1)]
            yield pa.record_batch(
                [b.column(0), b.column(2), pa.array([g[0].astype(np.int32).tobytes() for g in got], pa.binary()), pa.array([g[1].astype(np.float32).tobytes() for g in got], pa.binary()), pa.array([g[2] for g in got], pa.float64())],
                names=["key", "grade", "col", "val", "rec"],
            )

    kind = docs.schema[key].dataType.simpleString()
    # Arrow to numpy without a copy in pandas between: this, and no index of the rows, is what keeps the driver small
    got = rows.mapInArrow(run, f"key {kind}, grade int, col binary, val binary, rec double").toArrow()
    got = got.take(pc.sort_indices(got.select(["key", "grade", "rec"]), [(c, "ascending") for c in ("key", "grade", "rec")]))
    feats = [(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32), r) for c, v, r in zip(got["col"].to_pylist(), got["val"].to_pylist(), got["rec"].to_pylist())]
    grades = got["grade"].to_numpy().astype(np.int64)
    del got
    model = fit(feats, grades, n_grades)
    del feats
    pa.default_memory_pool().release_unused()
    return model


def grade_documents(df: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """key, score, expected_grade, and tail_1 ... tail_k (P(grade >= g)) for each row. Null and empty texts have score 0."""
    k = len(model.thresholds)
    names = ["key", "score", "expected_grade", *(f"tail_{g + 1}" for g in range(k))]
    small = Model(model.weights.astype(np.float32), model.recurrence, model.thresholds)  # a megabyte, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(small)
        for b in batches:
            score = np.array([scorer.score(x.as_py()) for x in b.column(1)])
            tails = small.tails(score)
            yield pa.record_batch([b.column(0), pa.array(score), pa.array(tails.sum(1)), *(pa.array(tails[:, g]) for g in range(k))], names=names)

    kind = df.schema[key].dataType.simpleString()
    out = df.select(df[key].alias("key"), df[text].alias("text")).mapInArrow(run, ", ".join([f"key {kind}", *(f"{n} double" for n in names[1:])]))
    return out.withColumnRenamed("key", key)


def select_documents(df: DataFrame, text: str, model: Model, grade: int, least: float) -> DataFrame:
    """The rows of df, with its columns, whose P(grade >= grade) is at least `least`. Rows without a word (null and empty texts) say
    nothing of their quality and stay; keys take no part."""
    small = Model(model.weights.astype(np.float32), model.recurrence, model.thresholds)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(small)
        for b in batches:
            texts = [x.as_py() for x in b.column(at)]
            keep = small.tails(np.array([scorer.score(t) for t in texts]))[:, grade - 1] >= least
            yield b.filter(pa.array(keep | np.array([not (t or "").split() for t in texts], bool)))

    return df.mapInArrow(run, df.schema)
