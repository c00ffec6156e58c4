"""Severity of toxic text: cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.common import LONGEST_WORD, worker_memory

#: Hashed features, letters of the word beginnings used besides whole words, words remembered per worker.
SPACE, BEGINNINGS, REMEMBERED = 2**20, (4, 5), 150_000
#: Bounded sample of labelled rows per label, how much more frequent a feature must be, features kept, weight of the L1 penalty, steps.
SAMPLE, LIFT, KEPT, PENALTY, STEPS = 4000, 10, 1024, 1e-4, 300
#: Chance of a grade above 0 from which a text is called toxic.
TOXIC = 0.3
WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings (inflected and compounded forms share those)."""
    forms = [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]
    return tuple(zlib.crc32(f.encode("utf-8", "surrogatepass")) % SPACE for f in forms)


class Counted:
    """Feature counts of texts; ``kept`` limits them to the features of a model."""

    def __init__(self, kept: set[int] | None = None):
        self.kept, self.seen = kept, {}

    def __call__(self, text: str | None) -> dict[int, int]:
        words = Counter(WORD.findall((text or "").lower()))
        out: dict[int, int] = {}
        for word, n in words.items():
            if (found := self.seen.get(word)) is None:
                found = features_of(word)
                if self.kept is not None:
                    found = tuple(f for f in found if f in self.kept)
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                if len(word) <= LONGEST_WORD:
                    self.seen[word] = found
            for f in found:
                out[f] = out.get(f, 0) + n
        return out


@dataclass
class OrdinalModel:
    """Weights by feature, shared by all thresholds, and the thresholds in ascending order."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def above(self, counts: dict[int, int]) -> np.ndarray:
        """Chance that the grade is above each threshold."""
        s = sum(self.weights[f] * np.log2(1.0 + n) for f, n in counts.items() if f in self.weights)
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - s, -50, 50)))


class Matrix:
    """Sparse rows with the two products that the fit needs."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.cols, self.values, self.shape = rows, cols, values, shape

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * w[self.cols], self.shape[0])

    def turned(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, self.values * g[self.rows], self.shape[1])


def fit_ordinal(x: Matrix, grade: np.ndarray, weight: np.ndarray, grades: int, penalty: float = PENALTY,
                steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the proportional-odds model: accelerated proximal steps with an L1 penalty.

    Each feature has the step that its own rows allow, so rare and frequent features learn alike.
    """
    weight = weight / weight.sum()
    share = np.cumsum(np.bincount(grade, weight, grades))[:-1].clip(1e-4, 1 - 1e-4)
    theta, w = np.log(share / (1 - share)), np.zeros(x.shape[1])
    width = x.times(np.ones(x.shape[1])) + 1
    step = 1.0 / np.maximum(0.25 * x.turned(weight * width), 1e-9)
    step_t = 1.0 / (0.25 * (weight * width).sum())
    rows = np.arange(len(grade))
    old_w, old_t, momentum = w, theta, 1.0
    for _ in range(steps):
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        yw, yt, momentum = w + pull * (w - old_w), np.sort(theta + pull * (theta - old_t)), following
        below = 1.0 / (1.0 + np.exp(np.clip(x.times(yw)[:, None] - yt[None], -50, 50)))
        edges = np.concatenate([np.zeros((len(grade), 1)), below, np.ones((len(grade), 1))], axis=1)
        high, low = edges[rows, grade + 1], edges[rows, grade]
        p = np.maximum(high - low, 1e-12)
        turn = np.zeros((len(grade), grades + 1))
        turn[rows, grade + 1] -= weight * high * (1 - high) / p
        turn[rows, grade] += weight * low * (1 - low) / p
        old_w, old_t = w, theta
        w = yw - step * x.turned(weight * (1 - high - low))
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        theta = np.sort(yt - step_t * turn[:, 1:-1].sum(axis=0))
    return w, theta


def _screened(cols: np.ndarray, rows: np.ndarray, marked: np.ndarray, kept: int) -> np.ndarray:
    """Features far more frequent in marked rows than in others, the best by chi-squared first.

    Words that occur in both kinds of rows would only slow the fit: the threshold stands for them.
    """
    both = np.bincount(cols, minlength=SPACE)
    with_mark = np.bincount(cols[marked[rows]], minlength=SPACE)
    n, m = len(marked), max(1, int(marked.sum()))
    expected = both * (m / n)
    telling = (with_mark >= 3) & (with_mark * max(1, n - m) > LIFT * m * (both - with_mark))
    score = np.where(telling, (with_mark - expected) ** 2 / np.maximum(expected, 1e-9), 0)
    best = np.argsort(-score, kind="stable")[:kept]
    return np.sort(best[score[best] > 0])


def sample_rows(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> list[tuple[int, bytes, bytes]]:
    """Feature counts of a bounded sample of labelled rows: (label, features, counts) with both as 32-bit numbers.

    Of each label the rows with the smallest hash of doc_id; the texts are read with the sampled ids
    at hand (at most ``per_label`` per label), so no text is shuffled.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    flag = F.col("toxic") > 0
    parts = [known.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for c in (flag, ~flag)]
    chosen = parts[0].union(parts[1]).select("doc_id", F.col("toxic").cast("int").alias("label"))

    def count(batches):
        worker_memory("toxicity")
        counted = Counted()
        for batch in batches:
            out = []
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                found = counted(text.as_py())
                out.append((label, np.fromiter(found, np.uint32, len(found)).tobytes(),
                            np.fromiter(found.values(), np.uint32, len(found)).tobytes()))
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary()))],
                ["label", "features", "counts"])

    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label").mapInArrow(
        count, "label int, features binary, counts binary")
    rows = {(r["label"], bytes(r["features"]), bytes(r["counts"])) for r in found.toLocalIterator()}  # copies teach once
    return sorted(rows, key=lambda r: (r[0], len(r[1]), r[1], r[2]))


def fit(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """Ordinal model of three grades from the toxic flags of ``labels``.

    The flag says only whether a text is toxic. Grade 0: it is not; grade 2: it is, and holds more
    words that occur almost only in flagged texts than the median flagged text; grade 1: the other
    flagged texts. Without labels of both kinds the model finds nothing toxic.
    """
    rows = sample_rows(docs, labels)
    flagged = np.array([r[0] > 0 for r in rows], bool)
    if not flagged.any() or flagged.all():
        return OrdinalModel({}, np.array([50.0, 50.0]))
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[1]) // 4 for r in rows])
    cols = np.frombuffer(b"".join(r[1] for r in rows), np.uint32)
    counts = np.frombuffer(b"".join(r[2] for r in rows), np.uint32)
    kept = _screened(cols, owner, flagged, KEPT)
    inside = np.isin(np.arange(SPACE), kept)[cols]
    owner, cols, counts = owner[inside], np.searchsorted(kept, cols[inside]), counts[inside]
    n, m = max(1, int((~flagged).sum())), int(flagged.sum())
    clean = np.bincount(cols[~flagged[owner]], minlength=len(kept))
    marked = np.bincount(cols[flagged[owner]], minlength=len(kept))
    marks = marked / m > 10 * clean / n
    dose = np.bincount(owner, np.log2(1.0 + counts) * marks[cols], len(rows))
    severe = flagged & (dose > np.median(dose[flagged]))
    grade = flagged.astype(int) + severe
    x = Matrix(owner, cols, np.log2(1.0 + counts), (len(rows), len(kept)))
    w, theta = fit_ordinal(x, grade, np.ones(len(rows)), 3)
    return OrdinalModel({int(f): float(v) for f, v in zip(kept, w) if v != 0}, theta)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and expected_severity, grade (the likeliest) and toxic (the chance
    of a grade above 0 is TOXIC or more).

    Expected severity is the sum of the chances to be above each threshold: 0 to the number of
    thresholds. NULL and empty texts have no features. The columns added replace those of their name.
    """
    added = ["expected_severity", "grade", "toxic"]
    docs = docs.drop(*added)
    kept = set(model.weights)

    def rate(batches):
        worker_memory("toxicity")
        counted = Counted(kept)
        for batch in batches:
            severity, grade, toxic = [], [], []
            for t in batch.column(text):
                above = model.above(counted(t.as_py()))
                chance = -np.diff(np.concatenate([[1.0], above, [0.0]]))
                severity.append(float(above.sum()))
                grade.append(int(np.argmax(chance)))
                toxic.append(bool(above[0] >= TOXIC))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(severity, pa.float64()), pa.array(grade, pa.int32()), pa.array(toxic, pa.bool_())],
                [*batch.schema.names, *added])

    kinds = (T.DoubleType(), T.IntegerType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)])
    return docs.mapInArrow(rate, schema)


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its expected severity, by a model fitted on the labelled documents.

    NULL text: rated like an empty one. Repeated rows get equal scores. Labels without doc_id or
    flag are left out; of repeated labels the higher flag counts. An empty table gives an empty
    result. Other columns come back unchanged.
    """
    return score(docs, fit(docs, labels))
