"""Quality of texts: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import LONGEST_WORD

#: Hashed words, bins per statistic, rank of the interactions, words remembered per worker.
SPACE, BINS, RANK, REMEMBERED = 2**15, 16, 8, 150_000
#: Bounded sample of labelled rows, passes over it, rows per step, rate, ridge.
SAMPLE, PASSES, STEP_ROWS, RATE, RIDGE = 8_000, 8, 64, 0.05, 1e-5
#: Score from which a text counts as good.
GOOD = 0.3
UPPER, LOWER, DIGIT, SPACES, STOPS, MARKS, HIGH = range(7)
KINDS = np.full(256, MARKS, np.uint8)
KINDS[[9, 10, 11, 12, 13, 32]] = SPACES
KINDS[48:58], KINDS[65:91], KINDS[97:123], KINDS[128:] = DIGIT, UPPER, LOWER, HIGH
KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = STOPS
STATISTICS = 20


def statistics_of(raw: bytes, words: list[bytes], n_chars: int | None) -> np.ndarray:
    """Shares of kinds of bytes, repetition, lengths of words and lines, mixture of scripts; and n_chars."""
    code = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(KINDS[code], minlength=7) / max(1, len(code))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.array([len(w) for w in words] or [0])
    n = max(1, len(words))
    accents = np.array([not w.isascii() for w in words] or [False])
    parts = [p.mean() for p in np.array_split(accents, min(8, n))]
    return np.array([
        *kinds, len(set(words)) / n, len(set(lines)) / max(1, len(lines)), lengths.mean(), lengths.std(),
        np.log1p(len(words)), np.log1p(n / max(1, len(lines))), np.ptp(parts), np.mean(accents),
        sum(w[-1:] in b".!?" for w in words) / n, sum(not w[-1:].isalnum() and w.isascii() for w in words) / n,
        raw.count(b"|") / n, sum(w.isupper() for w in words) / n,
        -1.0 if n_chars is None else np.log1p(max(0, n_chars)),
    ])


class Features:
    """Distinct hashed words and raw statistics of a text."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        out = set()
        for w in set(raw.lower().split()):
            if (h := self.seen.get(w)) is None:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                h = zlib.crc32(w) % SPACE
                if len(w) <= LONGEST_WORD:
                    self.seen[w] = h
            out.add(h)
        return np.fromiter(out, np.int64, len(out)), statistics_of(raw, words, n_chars)


@dataclass
class FactorisationMachine:
    """Bias, weights and factors; statistics fall in bins between the edges, each bin a feature."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def columns(self, words: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = (stats[:, None] > self.edges).sum(axis=1) + SPACE + np.arange(STATISTICS) * BINS
        value = np.full(len(words), 1.0 / np.sqrt(len(words) or 1))
        return np.concatenate([words, bins]), np.concatenate([value, np.ones(STATISTICS)])

    def margin(self, cols: np.ndarray, x: np.ndarray) -> float:
        """Pairwise interactions in linear time: half of the square of the sum less the sum of squares."""
        v = self.factors[cols] * x[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[cols] @ x + 0.5 * (total @ total - (v * v).sum()))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 5) -> FactorisationMachine:
    """Logistic loss, AdaGrad steps over small batches in a fixed order."""
    rng = np.random.default_rng(seed)
    size = SPACE + STATISTICS * BINS
    stats = np.stack([r[2] for r in rows]) if rows else np.zeros((1, STATISTICS))
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    share = (sum(r[0] for r in rows) + 1) / (len(rows) + 2)
    fm = FactorisationMachine(edges, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    data = [fm.columns(w, s) for _, w, s in rows]
    y = np.array([r[0] for r in rows], float)
    gw, gv, gb = np.full(size, 1e-4), np.full((size, RANK), 1e-4), 1e-4
    for _ in range(PASSES):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), STEP_ROWS):
            some = order[at:at + STEP_ROWS]
            lengths = [len(data[i][0]) for i in some]
            cols, x = (np.concatenate([data[i][j] for i in some]) for j in (0, 1))
            owner = np.repeat(np.arange(len(some)), lengths)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            v = fm.factors[cols] * x[:, None]
            total = np.add.reduceat(v, starts)
            margin = fm.bias + np.add.reduceat(fm.weights[cols] * x, starts)
            margin += 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), starts))
            error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y[some]) / len(some)
            unique, back = np.unique(cols, return_inverse=True)
            dw = np.bincount(back, error[owner] * x, len(unique)) + RIDGE * fm.weights[unique]
            slope = (error[owner] * x)[:, None] * (total[owner] - v)
            dv = np.stack([np.bincount(back, slope[:, f], len(unique)) for f in range(RANK)], axis=1)
            dv += RIDGE * fm.factors[unique]
            gw[unique] += dw**2
            gv[unique] += dv**2
            gb += error.sum() ** 2
            fm.weights[unique] -= RATE * dw / np.sqrt(gw[unique])
            fm.factors[unique] -= RATE * dv / np.sqrt(gv[unique])
            fm.bias -= RATE * error.sum() / np.sqrt(gb)
    fm.weights, fm.factors = fm.weights.astype(np.float32), fm.factors.astype(np.float32)
    return fm


def in_held_out(doc_id: str = "doc_id") -> Column:
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 5 == 0


def labelled_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Features of at most ``limit`` labelled rows outside the held-out fifth (smallest hashes of doc_id)."""
    known = labels.filter("doc_id is not null and quality is not null").filter(~in_held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def extract(batches):
        features = Features()
        for batch in batches:
            out = [(y, *(a.tobytes() for a in features(t, n))) for y, t, n in zip(
                *(batch.column(c).to_pylist() for c in ("label", "text", "n_chars")))]
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary()))], ["label", "words", "stats"])

    found = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id").drop("doc_id").select(
        "label", "text", "n_chars").mapInArrow(extract, "label int, words binary, stats binary")
    rows = sorted((r["label"], r["words"], r["stats"]) for r in found.toLocalIterator())
    return [(y, np.frombuffer(w, np.int64), np.frombuffer(s)) for y, w, s in rows]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with held_out, score (0 to 1) and predicted, by a machine fitted on the labels.

    Learns from a bounded sample of labelled rows whose crc32(doc_id) mod 5 is not 0. Inputs of a
    score are the text's words and structure and n_chars; never label, lang, source or doc_id.

    NULL text: scored like an empty one. NULL n_chars: a value of its own below all others. NULL
    doc_id counts as the empty text for the remainder. Repeated rows get equal scores; labels without
    doc_id or quality are left out, of repeated labels the higher counts. Without labels every
    score is the even prior. An empty table gives an empty result. Other columns are not read.
    """
    fm = train(labelled_rows(docs, labels))

    def rate(batches):
        features = Features()
        for batch in batches:
            out = []
            for text, n in zip(batch.column("text"), batch.column("n_chars").to_pylist()):
                margin = fm.margin(*fm.columns(*features(text.as_py(), n)))
                out.append(float(1 / (1 + np.exp(-np.clip(margin, -50, 50)))))
            value = pa.array(out, pa.float64())
            predicted = pa.array([int(s >= GOOD) for s in out], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), value, predicted], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", in_held_out().alias("held_out"), "text", "n_chars").mapInArrow(
        rate, "doc_id long, held_out boolean, score double, predicted int")
